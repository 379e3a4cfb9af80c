"""Filter audit, token alignment and source mixing against brute force, on texts with nulls, repeats, ties and odd bytes."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from ledgerloom.llm import token_alignment
from ledgerloom.llm.filter_audit import audit_filters, labelled, standard_failures
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.packing import byte_of_letter
from ledgerloom.llm.queries import QUERIES, tokenizer_path
from ledgerloom.llm.token_alignment import align_tokenizers
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


# ---- filter audit


def audited(rows, labels):
    """The contract, document by document and order by order."""
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good, toxic = ({i for i, *marks in labels if marks[k] == 1 and i is not None} for k in (0, 1))
    docs = []
    for doc_id, text, lang in rows:
        t, w = text or "", WORD.findall(text or "")
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": doc_id is not None and first[t] < doc_id,
        }
        docs.append((lang or "", fails, doc_id in good, doc_id in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own, shapley = [d for d in docs if d[0] == part], Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                removed = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                failing = [d for d in own if d[1][f]]
                out[part, "".join(order), step] = [
                    len(left), len(removed), len(failing) - len(removed), sum(sum(d[1].values()) == 1 for d in failing), sum(d[2] for d in removed), sum(d[3] for d in removed), f,
                ]
                shapley[f] += len(removed)
        for key, value in out.items():
            if key[0] == part:
                value[-1] = shapley[value[-1]]
    return out


def audit_rows(seed=5, n=160):
    rnd = random.Random(seed)
    texts = [None, "", " ", "A b " * 150, "x#", "Ünï Öde " * 60, "ONE TWO", " ".join(f"w{i}" for i in range(250)), " ".join(f"W{i}" for i in range(210)) + " $", "\x0bab\x1fc " * 120]
    rows = [(rnd.choice([i, i, i % 7]), rnd.choice(texts) if rnd.random() < 0.6 else " ".join(rnd.choice("abcDE$") * 2 for _ in range(rnd.randint(150, 260))), rnd.choice(["en", "de", None, ""])) for i in range(n)]
    return rows + [(None, "x#", "en"), (None, None, "zz")]


def audit(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "clash", True) for r in rows], "doc_id long, text string, lang string, digest string, good boolean")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    marked, failures = standard_failures(docs)
    return audit_filters(labelled(marked, marks), failures, "lang")


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = [(i, i % 2, 1 - i % 3 if i % 5 else None) for i in range(120)] + [(3, 0, 0), (3, 1, 1), (None, 1, 1)]
    got = {(r["part"], r["filter_order"], r["step"]): [r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]] for r in audit(spark, rows, labels).collect()}
    assert got == audited(rows, labels)


def test_audit_of_nothing_and_of_other_filters(spark):
    assert audit(spark, [], []).count() == 0
    docs = spark.createDataFrame([("p", True, None, True, False)], "part string, a boolean, b boolean, good boolean, toxic boolean")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["good_lost"]) for r in audit_filters(docs, {"a": "a", "b": "b"}, "part").collect()}
    assert got == {("ab", 1): (0, 1, 1), ("ab", 2): (0, 0, 0), ("ba", 1): (1, 0, 0), ("ba", 2): (0, 1, 1)}
    with pytest.raises(ValueError):
        audit_filters(docs, {"long": "a"}, "part")


def test_audit_persists_one_state_a_filter_at_most(spark, monkeypatch):
    from pyspark.sql import DataFrame

    alive, most = set(), []
    frame = type(spark.range(0))
    keep, drop = frame.persist, frame.unpersist
    monkeypatch.setattr(frame, "persist", lambda self, *a: (alive.add(id(self)), most.append(len(alive)), keep(self, *a))[-1])
    monkeypatch.setattr(frame, "unpersist", lambda self, *a: (alive.discard(id(self)), drop(self, *a))[-1])
    audit(spark, audit_rows(n=20), []).collect()
    assert not alive and max(most) <= 6 and len(most) == 32
    assert issubclass(frame, DataFrame)


# ---- token alignment


def whole_tokens(text):
    """Ids and bytes of both vocabularies, each by its own library on the whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(whole_tokens, "own"):
        a = Tokenizer.from_file(tokenizer_path())
        a.encode_special_tokens = True
        letters = byte_of_letter()
        vocab = json.load(open(tokenizer_path(), encoding="utf-8"))["model"]["vocab"]
        names = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        whole_tokens.own = a, names, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    a, names, b = whole_tokens.own
    ids = a.encode(" " + text, add_special_tokens=False).ids
    pieces = b.encode(text)
    decode = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return [(i, names[i]) for i in ids], [(i, decode(i)) for i in pieces]


def alignment(text):
    """(n_a, n_b, groups as text, links) by walking both token lists."""
    if not text:
        return 0, 0, "", []
    a, b = whole_tokens(text)
    if any(b"".join(x for _, x in t) != (" " + text).encode() for t in (a, b)):
        return 0, 0, "", []
    ends = [list(itertools.accumulate(len(x) for _, x in t)) for t in (a, b)]
    common = sorted(set(ends[0]) & set(ends[1]))
    groups, links, i, j = [], [], 0, 0
    for end in common:
        p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append(",".join(str(x) for x, _ in a[i:p]) + "|" + ",".join(str(x) for x, _ in b[j:q]))
        links.append((a[p - 1][0], b[q - 1][0]))
        i, j = p, q
    return len(a), len(b), ";".join(groups), links


def expected_alignment(rows):
    each = [(d, alignment(t)) for d, t in rows]
    count = Counter(x for _, (*_, links) in each for x in links)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return sorted(
        (d or -1, n_a, n_b, len(links), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(said.encode()).hexdigest() if said else "")
        for d, (n_a, n_b, said, links) in each
    )


def got_alignment(found):
    return sorted((r["doc_id"] or -1, *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))) for r in found.collect())


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n\n c\t", "x  y", "x　 y z", "x   y", "\u0085 q", "don't 'S it's 12 345", "<|endoftext|> <s> </s> <unk> <0x0A>",
    "▁ tied", "日本語 テキスト", "\U0001f600 é ﬁ ½", "\x00 nul \x1f us", "the the  the   the", "ab" * 300, "\r\n \r\n", "ﬁ ①",
]


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_alignment_equals_whole_texts_walked(spark, block):
    rnd = random.Random(9)
    chars = ["a", "the", "ing", " ", " ", "  ", "\n", "\t", "é", "日", "-", "'s", "1", "42", ".", " ", " ", "Z"]
    rows = list(enumerate(ODD)) + [(100 + i, "".join(rnd.choice(chars) for _ in range(rnd.randint(1, 120)))) for i in range(150)] + [(None, "the end"), (5, "a")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, block int, pairs string")
    found, counts = align_tokenizers(frame, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), block)
    assert got_alignment(found) == expected_alignment(rows)
    assert counts.where("best").select("b").distinct().count() == counts.select("b").distinct().count()


def test_alignment_of_a_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert got_alignment(QUERIES["op12_token_alignment"](spark, FOLDER)) == expected_alignment(rows)


def test_alignment_overlaps_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    found, counts = align_tokenizers(empty, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    assert found.count() == 0 and counts.count() == 0
    import pyarrow as pa

    # A ends at 2, 5, 6 and B at 3, 4, 6: one group; the pairs that share a byte are 5
    a, b = (pa.table({"s": s, "e": e, "id": pa.array(i, pa.int32())}) for s, e, i in (([0, 2, 5], [2, 5, 6], [1, 2, 3]), ([0, 3, 4], [3, 4, 6], [7, 8, 9])))
    assert token_alignment.aligned(a, b).to_pylist() == [{"e": 6, "a_id": 3, "b_id": 9, "n_a": 3, "n_b": 3, "n_overlaps": 5, "said": "1,2,3|7,8,9"}]


def test_alignment_of_a_long_text(spark):
    text = "ein langer text ohne ende " * 40_000
    found, _ = align_tokenizers(spark.createDataFrame([(1, text), (2, "ein")], "doc_id long, text string"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    short = alignment("ein langer text ohne ende ein langer text ohne ende ")
    got = {r["doc_id"]: r["n_a"] for r in found.collect()}
    a, _ = whole_tokens(text)
    assert got[1] == len(a) and got[2] == len(whole_tokens("ein")[0]) and short[0] > 0


# ---- mixing


def wanted(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {s for s in names if not sizes[s]}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else weight[s] * left / share for s in names}
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def tilted(sizes, target, most=3):
    """The tilt of one source by halving."""
    low, high = -50.0, 50.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(x * min(most, math.exp(min(mid * x, 5))) for x in sizes) < target else (low, mid)
    return low


def mix_rows(seed=2, n=900):
    rnd = random.Random(seed)
    rows = [(i, " ".join("w" for _ in range(min(4000, int(rnd.paretovariate(1.1) * 4)))), rnd.choice(["a", "b", "b", "b", "Z", "é", None, "", "huge"])) for i in range(n)]
    rows = [(i, t, s) for i, t, s in rows if s != "huge"] + [(10_000 + i, "w " * 60, "one size") for i in range(300)]
    return rows + [(20_000, None, "empty"), (20_001, " \t", "empty"), (20_002, None, None), (None, "w w w", "b"), (7, "w w", "b"), (7, "w w", "b"), (30_000, "w " * 9_000, "one size")]


def test_mix_meets_targets_with_tilted_rates(spark):
    rows = mix_rows()
    frame = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, source string, size int, nth string")
    got = mix_sources(frame).collect()
    sizes = defaultdict(list)
    for _, text, source in rows:
        sizes[source].append(len(WORD.findall(text or "")))
    target = wanted({s: sum(x) for s, x in sizes.items()})
    assert len(got) == len(rows) and sum(target.values()) == pytest.approx(sum(map(sum, sizes.values())))
    taken = Counter()
    for r in got:
        s = r["source"]
        assert r["target"] == pytest.approx(target[s], abs=1e-6) and r["source_size"] == sum(sizes[s])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] and r["copies"] >= 0
        taken[s] += r["taken"]
        if 0 < target[s] < 3 * sum(sizes[s]) and r["size"]:
            assert r["rate"] == pytest.approx(min(3, math.exp(min(tilted(sizes[s], target[s]) * r["size"], 5))), rel=1e-3)
    for s, words in taken.items():
        smallest = sorted(x for x in sizes[s] if x)[:1] or [0]
        assert abs(words - target[s]) <= max(2 * smallest[0], 0.002 * target[s]) + 1, (s, words, target[s])
    key = lambda r: (r["doc_id"] or -1, r["source"] or "", r["size"], r["copies"])
    again = mix_sources(frame.repartition(7, "text")).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_of_nothing_of_one_source_and_without_words(spark):
    schema = "doc_id long, text string, source string"
    assert mix_sources(spark.createDataFrame([], schema)).count() == 0
    assert [(r["taken"], r["target"]) for r in mix_sources(spark.createDataFrame([(1, None, None)], schema)).collect()] == [(0, 0.0)]
    one = mix_sources(spark.createDataFrame([(i, "a b c", "s") for i in range(5)], schema)).collect()
    assert [(r["taken"], r["target"], r["copies"]) for r in one] == [(3, 15.0, 1)] * 5


def test_mix_query_comes_near_its_targets(spark):
    got = QUERIES["op13_source_mixing"](spark, FOLDER)
    for r in got.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")).collect():
        assert abs(r["taken"] - r["target"]) <= max(2 * r["least"], 0.02 * r["target"])
