"""The numbered queries over the whole test tables, with production parameters, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.chat_format import conversation_digests, format_chats
from ledgerloom.llm.decontaminate import mark_contaminated
from ledgerloom.llm.filter_audit import audit_filters, labelled, standard_failures
from ledgerloom.llm.html_extract import extract_main_text
from ledgerloom.llm.line_dedup import dedup_lines
from ledgerloom.llm.minhash import near_duplicates
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.quality_rules import judge_quality
from ledgerloom.llm.suffix_dedup import remove_repeats
from ledgerloom.llm.token_alignment import align_tokenizers
from ledgerloom.llm.toxicity import fit, score_toxicity
from ledgerloom.llm.url_filters import judge_urls

URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit(docs, _table(spark, sf_dir, "labels")))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return mark_contaminated(docs, _table(spark, sf_dir, "benchmark")).drop("text")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False).drop("ids")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "rule string, verdict string"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], turns.schema)
    return conversation_digests(format_chats(turns.unionByName(extra), tokenizer_path()), tokenizer_path())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, failures = standard_failures(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return audit_filters(labelled(docs, _table(spark, sf_dir, "labels")), failures, "lang")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))[0]


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_suffix_dedup, op2_quality_rules, op3_toxicity, op4_minhash_near_dedup, op5_html_extraction,
        op6_decontamination, op7_line_dedup, op8_best_fit_packing, op9_url_filters, op10_chat_formatting,
        op11_filter_audit, op12_token_alignment, op13_source_mixing,
    )
}

_QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS g
  FROM w WHERE len(w) >= 5),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, sum(n) AS n FROM (
  SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS n FROM twice) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '\P{Lu}', '', 'g')) AS n_capitals,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeats r ON r.doc_id = w.doc_id),
g AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 20 * n_words OR 100 * n_capitals > 50 * word_chars OR word_chars < 2 * n_words
    OR word_chars > 15 * n_words OR 100 * n_dup_lines > 50 * len(lines)
    OR 100 * len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•]'))) > 90 * len(lines)
    OR 100 * len(list_filter(w, lambda x: NOT regexp_matches(x, '\pL'))) > 40 * n_words) AS kept
FROM g
"""

_NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i : i + 4], ' '))) AS g FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS low FROM documents UNION SELECT b, low FROM reach JOIN links ON a = node),
low AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN low ON node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_LINE_DEDUP_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l),
r AS (SELECT *, (coalesce(lag(h) OVER p, 0) * 31 + h) % 3 = 0 AS ends FROM h WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM r),
chunks AS (SELECT doc_id, chunk, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM c GROUP BY doc_id, chunk),
gone AS (
  SELECT doc_id, chunk, n FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) AS k FROM chunks WHERE n > 1) WHERE k > 1),
sums AS (SELECT doc_id, sum(n) AS n_removed_lines, count(*) AS n_removed_chunks FROM gone GROUP BY doc_id),
cleaned AS (SELECT c.doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.chunk = c.chunk WHERE g.chunk IS NULL GROUP BY c.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
  coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_removed_lines, 0)::BIGINT AS n_removed_lines,
  coalesce(n_removed_chunks, 0)::BIGINT AS n_removed_chunks
FROM documents d LEFT JOIN cleaned k ON k.doc_id = d.doc_id LEFT JOIN sums s ON s.doc_id = d.doc_id
"""

_URL_SQL = r"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rule, rhost, rpath, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id
"""

_CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(regexp_replace(role, '<(\\*)(/?turn>|says>)', '<\1\\\2', 'g')) + length(regexp_replace(text, '<(\\*)(/?turn>|says>)', '<\1\\\2', 'g')) + 19 AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_AUDIT_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality IS NOT DISTINCT FROM 1) AS good, bool_or(toxic IS NOT DISTINCT FROM 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS fails
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
n AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT chr(65 + i::INT) AS letter, 1 << i::INT AS bit FROM range(5) r(i)),
orders AS (
  SELECT '' AS filter_order, 0 AS done, 0 AS before, 0 AS bit, 0 AS step, []::INT[][] AS steps
  UNION ALL
  SELECT o.filter_order || letter, o.done | l.bit, o.done, l.bit, o.step + 1, list_append(o.steps, [o.step + 1, o.done, l.bit])
  FROM orders o, letters l WHERE o.done & l.bit = 0),
steps AS (SELECT filter_order, unnest(steps) AS s FROM orders WHERE step = 5),
each AS (
  SELECT part, filter_order, s[1] AS step, s[3] AS bit, sum(n) FILTER (fails & (s[2] | s[3]) = 0) AS kept,
    sum(n) FILTER (fails & s[2] = 0 AND fails & s[3] > 0) AS removed, sum(n) FILTER (fails & s[2] > 0 AND fails & s[3] > 0) AS redundant,
    sum(n) FILTER (fails = s[3]) AS unique_fails, sum(n) FILTER (fails & s[2] = 0 AND fails & s[3] > 0 AND good) AS good_lost,
    sum(n) FILTER (fails & s[2] = 0 AND fails & s[3] > 0 AND toxic) AS toxic_lost
  FROM steps, n GROUP BY part, filter_order, s)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM each
"""

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": _QUALITY_SQL,
    "op4_minhash_near_dedup": _NEAR_DUPLICATES_SQL,
    "op7_line_dedup": _LINE_DEDUP_SQL,
    "op9_url_filters": _URL_SQL,
    "op10_chat_formatting": _CHAT_SQL,
    "op11_filter_audit": _AUDIT_SQL,
}
