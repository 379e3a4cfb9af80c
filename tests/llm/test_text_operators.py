"""The operators on documents against brute force, on texts with nulls, repeats, ties and odd bytes."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.decontaminate import contaminated, mark_contaminated
from ledgerloom.llm.line_dedup import dedup_chunks_and_passages, dedup_lines, dedup_passages
from ledgerloom.llm import minhash, quality_rules
from ledgerloom.llm.minhash import near_duplicates
from ledgerloom.llm.packing import Encoder, encoder, pack_documents, plan
from ledgerloom.llm.quality_rules import Rule, cascade_order, judge_quality, measured, with_features
from ledgerloom.llm.queries import tokenizer_path
from ledgerloom.llm.suffix_dedup import remove_repeats, repeated_spans
import ledgerloom.llm.toxicity as toxicity
from ledgerloom.llm.toxicity import filter_toxic, fit, score_toxicity
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, key string, component long, text_hash string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text):
    w = WORD.findall(lower(text))
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def corpus(seed=3, n=120):
    rnd = random.Random(seed)
    words = ["wa", "Be", "ço", "dü", "ei", "fo", "gu", "日本", "ka", "lo"]
    base = [" ".join(rnd.choice(words) + rnd.choice(words) for _ in range(rnd.randint(1, 90))) for _ in range(25)]
    rows = []
    for i in range(n):
        text = rnd.choice(base)
        if rnd.random() < 0.6:
            w = text.split(" ")
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            text = rnd.choice([" ", "  ", "\n"]).join(w)
        rows.append((i * 3, text))
    return rows + [(1, None), (2, ""), (4, " \t\n"), (5, "one"), (7, "ONE"), (8, "x" * 700), (10, "ab " * 400)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 7, "h") for r in rows], SCHEMA)


@pytest.mark.parametrize("small", [256, 0])
def test_near_duplicates_match_brute_force(spark, monkeypatch, small):
    """``small``: sets are decided inside blocks, or presumed linked and verified afterwards."""
    monkeypatch.setattr(minhash, "SMALL", small)
    rows = corpus()
    if not small:  # a group of many members just above and just below the threshold of each other
        rnd, words = random.Random(8), [f"w{i}" for i in range(120)]
        for i in range(60):
            own = list(words)
            for at in rnd.sample(range(120), 3):
                own[at] = f"edit{i}-{at}"
            rows.append((5000 + i, " ".join(own)))
    sets = {i: frozenset(shingles(t)) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r.doc_id: r for r in near_duplicates(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, s in sets.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), find(i), find(i) == i)


def test_near_duplicates_of_nothing_and_of_repeated_rows(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    rows = near_duplicates(frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(1, 1), (1, 1), (2, 1)]


def test_near_copies_without_an_id_are_linked(spark):
    words = [f"w{i}" for i in range(100)]
    near, other = [*words[:50], "edit", *words[51:]], [f"v{i}" for i in range(100)]
    rows = [(None, " ".join(near)), (9, " ".join(words)), (None, " ".join(other)), (None, " ".join([*other[:-1], "last"])), (None, None), (None, "")]
    got = near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == [(0, 0, 0, True)] * 2 + [(0, 96, 0, True)] * 2 + [(0, 96, 9, False), (9, 96, 9, True)]


def test_many_near_copies_with_one_centre_form_one_component(spark):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(700):
        own = list(words)
        own[i % 190] = f"edit{i}"
        rows.append((i, " ".join(own)))
    assert {r.component_id for r in near_duplicates(frame(spark, rows)).collect()} == {0}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (None, 3), (5, 5)], "a long, b long")
    got = dict(connected_components(links).collect())
    assert all(got[i] == 0 for i in range(41)) and got[101] == got[100] == 100
    assert connected_components(links.limit(0)).count() == 0


def brute_spans(rows, length):
    texts = {i: (t or "").encode() for i, t in rows}
    places = defaultdict(list)
    for i, b in texts.items():
        for at in range(len(b) - length + 1):
            places[b[at : at + length]].append((i, at))
    marks = {i: bytearray(len(b)) for i, b in texts.items()}
    for found in places.values():
        if len(found) > 1:
            for i, at in found:
                marks[i][at : at + length] = b"\1" * length
    return {i: [m.span() for m in re.finditer(b"\1+", bytes(marks[i]))] for i in texts}, texts


@pytest.mark.parametrize("length", [200, 40])
def test_repeated_strings_match_brute_force(spark, length):
    rows = corpus(5, 40) + [(11, "ab" * 300), (13, "x" * 199), (14, "é" * 150)]
    spans, texts = brute_spans(rows, length)
    for r in remove_repeats(frame(spark, rows), length).collect():
        rest = bytearray()
        at = 0
        for a, b in spans[r.doc_id]:
            rest += texts[r.doc_id][at:a]
            at = b
        rest += texts[r.doc_id][at:]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(texts[r.doc_id]), len(texts[r.doc_id]) - len(rest), len(spans[r.doc_id]))
        assert r.kept_sha256 == hashlib.sha256(rest).hexdigest() and bytes(r.kept) == bytes(rest)


def test_repeats_across_segments_of_a_very_long_text(spark, monkeypatch):
    rnd = random.Random(1)
    noise = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    passage = noise(500)
    text = noise((1 << 20) - 250) + passage + noise(3000)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in repeated_spans(frame(spark, [(1, text), (2, noise(77) + passage + noise(90))])).collect()}
    assert got[2][0][0] <= 77 and got[2][0][1] >= 577 and len(got[1]) == 1 and got[1][0][1] - got[1][0][0] == got[2][0][1] - got[2][0][0]
    assert repeated_spans(frame(spark, [])).count() == 0


def test_decontamination_matches_brute_force(spark):
    rnd = random.Random(9)
    noise = lambda n: [rnd.choice(["alpha", "beta", "gam", "del"]) + str(rnd.randrange(300)) for _ in range(n)]
    items = [(i, noise(rnd.randint(12, 40))) for i in range(12)]
    items += [(20, ["one"]), (21, ["a", "b"] * 10)]
    rows = [(1, None), (2, ""), (3, "One"), (4, " ".join(["A", "b"] * 9))]
    for i in range(60):
        item = list(rnd.choice(items)[1])
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            item[rnd.randrange(len(item))] = "changed"
        rows.append((100 + i, " ".join(noise(rnd.randint(0, 60)) + item + noise(rnd.randint(0, 60)))))
    expected = set()
    for d, text in rows:
        s = shingles(text)
        for i, words in items:
            q = shingles(" ".join(words))
            n = min(len(q), len(s))
            for at in range(len(s) - n + 1 if n else 0):
                common = sum((Counter(s[at : at + n]) & Counter(q)).values())
                if 100 * common >= 75 * (n + len(q) - common):
                    expected.add((d, i))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(30, None), (31, "")], "item_id long, text string")
    got = {tuple(r) for r in contaminated(frame(spark, rows), bench).collect()}
    assert got == expected and len(expected) > 20
    assert {tuple(r) for r in contaminated(frame(spark, rows), bench, block=3).collect()} == expected
    marked = mark_contaminated(frame(spark, rows), bench)
    assert marked.where("kept").count() == len(rows) - len({d for d, _ in expected})
    assert contaminated(frame(spark, rows), bench.limit(0)).count() == 0


def test_line_dedup_removes_later_chunks_only(spark):
    block = [f"shared line {i} of the notice" for i in range(40)]
    rows = [(1, "\n".join(["start", *block, "end"])), (2, "\n".join(["other", "start here", *block])), (3, "single\n\n"), (4, None), (5, ""), (6, "x\ny\nx\ny")]
    got = {r.doc_id: r for r in dedup_lines(frame(spark, rows)).collect()}
    assert got[1].text == rows[0][1] and got[1].n_removed_lines == 0
    assert got[2].n_removed_lines > 25 and got[2].text.startswith("other\nstart here")
    assert set(got[2].text.split("\n")) <= set(rows[1][1].split("\n"))
    assert (got[4].text, got[4].n_lines, got[5].text, got[5].n_lines, got[3].text) == (None, 0, "", 1, "single\n\n")
    assert dedup_lines(frame(spark, [])).count() == 0
    assert got[1].key == "k" and got[1].text_hash == "h"


def test_line_dedup_keeps_repeated_rows_alike(spark):
    text = "\n".join(f"line {i}" for i in range(30))
    got = dedup_lines(frame(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed_lines > 0) for r in got) == [(1, False), (1, False), (2, True)]


def passages_removed(texts):
    """The lines left of each text, by brute force over all earlier windows of two lines with text."""
    seen, left = {}, {}
    for d, text in sorted(texts.items()):
        lines = text.split("\n")
        filled, gone = [i for i, x in enumerate(lines) if x.strip()], set()
        for a, b in zip(filled, filled[1:]):
            at = seen.setdefault(tuple(lines[a : b + 1]), (d, a, b))
            if at[0] != d or at[2] < a:
                gone |= set(range(a, b + 1))
        left[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return left


def test_no_repeated_passage_of_lines_stays(spark):
    rnd = random.Random(3)
    passages = [[f"passage {n} of {size} lines, line {i}" for i in range(size)] for size in range(2, 9) for n in range(6)]
    passages += [["apart", "", "by blank", " ", "lines"], ["same"] * 3, ["same"] * 5]
    texts = {}
    for d in range(60):
        parts = [[f"own line {d} {k}", ""] + rnd.choice(passages) for k in range(rnd.randint(1, 6))]
        texts[d] = "\n".join(x for p in parts for x in p) + "\n\n" * (d % 2)
    got = {r.doc_id: r for r in dedup_passages(frame(spark, list(texts.items()))).collect()}
    assert {d: r.text for d, r in got.items()} == passages_removed(texts)
    assert all(r.n_lines - r.n_removed_lines == len(r.text.split("\n")) for r in got.values() if r.text)
    kept = [x for r in got.values() for x in r.text.split("\n") if x.startswith("passage")]
    assert sorted(kept) == sorted({x for t in texts.values() for x in t.split("\n") if x.startswith("passage")})


def test_chunks_go_first_and_the_exact_check_takes_the_rest(spark):
    """the union of what chunks and windows of the input remove; blank lines that a repeated chunk holds go with it."""
    rnd = random.Random(5)
    passages = [[f"passage {n} of {size} lines, line {i}" if i % 4 else "" for i in range(size)] for size in range(2, 12) for n in range(5)]
    texts = {d: "\n".join(x for k in range(rnd.randint(1, 6)) for x in [f"own line {d} {k}", "", *rnd.choice(passages), "", ""]) for d in range(50)} | {None: "own line 3 0\n\nx", 60: "", 61: "\n\n\n", 62: "\n\n\n", 63: None}
    lines = {d: t.split("\n") for d, t in texts.items() if t is not None}
    seen_chunks, seen_windows, gone, by_chunks = {}, {}, {d: set() for d in lines}, 0
    for d in sorted(lines, key=lambda d: -1 if d is None else d):
        own, start, previous = lines[d], 0, 0
        for i, line in enumerate(own):
            h = int(hashlib.md5(line.encode()).hexdigest()[:7], 16)
            if (previous * 31 + h) % 3 == 0 or i == len(own) - 1:
                if i > start and seen_chunks.setdefault(tuple(own[start : i + 1]), (d, start)) != (d, start):
                    gone[d] |= set(range(start, i + 1))
                    by_chunks += 1
                start = i + 1
            previous = h
        filled = [i for i, x in enumerate(own) if x.strip()]
        for a, b in zip(filled, filled[1:]):
            at = seen_windows.setdefault(tuple(own[a : b + 1]), (d, a, b))
            if at[0] != d or at[2] < a:
                gone[d] |= set(range(a, b + 1))
    expected = {d: "\n".join(x for i, x in enumerate(own) if i not in gone[d]) for d, own in lines.items()} | {63: None}
    docs = frame(spark, list(texts.items()))
    got = {r.doc_id: r.text for r in dedup_chunks_and_passages(docs).collect()}
    assert got == expected and by_chunks > 20
    assert got != {r.doc_id: r.text for r in dedup_passages(docs).collect()} and got != {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    staged = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs.withColumn("n_chars", F.length("text").cast("long")), "").collect()}
    assert staged == expected


def test_chunks_and_passages_are_planned_apart(spark):
    """Pipeline, driver's memory: the plan of the result has no look-up of chunks or windows in it; the count is chunks and windows beside them."""
    rnd = random.Random(6)
    passages = [[f"passage {n} of {size} lines, line {i}" if i % 4 else "" for i in range(size)] for size in range(2, 12) for n in range(5)]
    texts = {d: "\n".join(x for k in range(rnd.randint(1, 6)) for x in [f"own line {d} {k}", *rnd.choice(passages)]) for d in range(50)}
    seen_chunks, seen_windows, expected = {}, {}, {}
    for d, text in texts.items():
        own, start, previous, chunk_of, n = text.split("\n"), 0, 0, {}, 0
        for i, line in enumerate(own):
            h = int(hashlib.md5(line.encode()).hexdigest()[:7], 16)
            if (previous * 31 + h) % 3 == 0 or i == len(own) - 1:
                if i > start and seen_chunks.setdefault(tuple(own[start : i + 1]), (d, start)) != (d, start):
                    chunk_of |= dict.fromkeys(range(start, i + 1), start)
                    n += 1
                start = i + 1
            previous = h
        filled = [i for i, x in enumerate(own) if x.strip()]
        for a, b in zip(filled, filled[1:]):
            at = seen_windows.setdefault(tuple(own[a : b + 1]), (d, a, b))
            again = at[0] != d or at[2] < a
            n += again and (a not in chunk_of or chunk_of[a] != chunk_of.get(b))
        expected[d] = n
    out = dedup_chunks_and_passages(frame(spark, list(texts.items())))
    assert {r.doc_id: r.n_removed_chunks for r in out.collect()} == expected and sum(expected.values()) > 100
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") <= 3


def test_passages_of_null_empty_and_repeated_rows(spark):
    text = "\n".join(f"line {i}" for i in range(4))
    rows = [(1, text), (1, text), (2, text), (3, None), (4, ""), (5, "\n\n\n"), (6, "\n\n\n"), (7, "line 1"), (None, "line 2\nline 3")]
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.text, r.n_lines) for r in dedup_passages(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(-1, "line 2\nline 3", 2), (1, "line 0\nline 1", 4), (1, "line 0\nline 1", 4), (2, "", 4), (3, None, 0), (4, "", 1), (5, "\n\n\n", 4), (6, "\n\n\n", 4), (7, "line 1", 1)], key=str)


def test_quality_features_match_brute_force(spark):
    rows = corpus(8, 60) + [(900, "a\nb\na\n \na"), (901, "#x *y $$ %"), (902, "w " * 30000), (903, "\n".join(f" - point {i} of many" for i in range(9))), (904, " ".join(f"{i} {i + 1} word{i}" for i in range(9)))]
    rows += [(905, " ".join(f"LOUD{i}" for i in range(20))), (906, " ".join(f"#{i} ok{i}" for i in range(20))), (907, "\n".join(["same line here"] * 9 + [f"other{i} line" for i in range(30)])), (908, " ".join("abcdefghijklmnopqrs"))]
    seen = set()
    for r in judge_quality(frame(spark, rows)).collect():
        text = dict(rows)[r.doc_id] or ""
        w = WORD.findall(text)
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        counts = Counter(grams)
        covered = set()
        for i, g in enumerate(grams):
            if counts[g] > 1:
                covered.update(range(i, i + 5))
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        loud, chars = sum(c.isupper() for c in text), sum(map(len, w))
        rejected = (
            100 * r.n_symbols > 20 * len(w), 100 * loud > 50 * chars, chars < 2 * len(w), chars > 15 * len(w), 100 * r.n_dup_lines > 50 * len(lines),
            100 * sum(x.strip(" \t\n\v\f\r")[:1] in tuple("-*\u2022") for x in lines) > 90 * len(lines), 100 * sum(not any(c.isalpha() for c in x) for x in w) > 40 * len(w),
        )
        assert r.kept == (not r.base_failed and not any(rejected))
        seen |= {i for i, x in enumerate(rejected) if x and not r.base_failed}
    assert seen >= {0, 1, 2, 5, 6}


def test_quality_order_does_not_change_the_verdict(spark):
    docs = frame(spark, corpus(8, 60))
    rules = [Rule("a", F.col("n_words") < 20), Rule("b", F.rlike("text", F.lit("Be.*Be.*Be.*Be"))), Rule("none", F.lit(None).cast("boolean"))]
    a = {(r.doc_id, r.kept) for r in judge_quality(docs, rules).collect()}
    assert a == {(r.doc_id, r.kept) for r in judge_quality(docs, rules[::-1]).collect()}
    assert len(cascade_order(docs, rules)) == 3
    shares = {m.rule.name: m.share for m in measured(docs, rules)}
    assert shares["none"] == 0 < shares["a"] < 1 and all(m.seconds > 0 for m in measured(docs, rules))


def test_quality_rules_after_a_rejection_are_not_evaluated(spark, monkeypatch):
    first, costly = Rule("first", F.col("word_chars") >= 0), Rule("costly", F.raise_error("text").cast("boolean"))
    monkeypatch.setattr(quality_rules, "cascade_order", lambda docs, rules, rows: [first, costly])
    docs = frame(spark, corpus(8, 20)).withColumns({"_lines": F.lit(1), "hashes": F.lit("x"), "n_words": F.lit("replaced")})
    rows = judge_quality(docs, [first, costly]).collect()
    assert len(rows) == docs.count() and not any(r.kept for r in rows) and {(r._lines, r.hashes) for r in rows} == {(1, "x")}
    monkeypatch.setattr(quality_rules, "cascade_order", lambda docs, rules, rows: [costly, first])
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        judge_quality(docs, [first, costly]).collect()


def test_columns_that_clash_stay_or_are_replaced(spark):
    notice = "one line of it\nand a second one\nand a third"
    rows = [(1, f"start\n{notice}"), (2, f"other\n{notice}"), (3, None), (4, "lone")]
    clash = {"removed": F.lit(1), "lines": F.lit("l"), "_lines": F.lit("x"), "own_id": F.lit(2), "items": F.lit(3), "n_lines": F.lit("n"), "kept": F.lit("k"), "a.b": F.lit(5)}
    docs = frame(spark, rows).withColumns(clash)
    for out in (dedup_lines(docs), dedup_passages(docs)):
        assert sorted(out.columns) == sorted([*docs.columns, "n_removed_lines", "n_removed_chunks"])
        assert {(r.removed, r.lines, r._lines, r.own_id, r["a.b"]) for r in out.collect()} == {(1, "l", "x", 2, 5)}
    out = mark_contaminated(docs, spark.createDataFrame([(7, "one line of it and a second one")], "item_id long, text string"))
    assert sorted(out.columns) == sorted([*docs.columns, "item_ids", "contaminated"])
    assert {r.doc_id: r.kept for r in out.collect()} == {1: False, 2: False, 3: True, 4: True}


def test_quality_of_nothing(spark):
    docs = frame(spark, [])
    assert with_features(docs.limit(0)).count() == judge_quality(docs.limit(0)).count() == 0


def test_packing_is_gapless_whole_and_tight(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["the", "of", "Zeit", "élan", "x1"]) for _ in range(rnd.choice([0, 3, 40, 700, 2047, 5000])))) for i in range(60)] + [(99, None), (98, "a  b <|endoftext|>\n\n c")]
    tokenizer = encoder(tokenizer_path()).tokenizer
    got = defaultdict(list)
    bins = defaultdict(list)
    for r in pack_documents(frame(spark, rows), tokenizer_path()).collect():
        got[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(got[i], key=lambda r: r.piece)
        assert np.frombuffer(b"".join(bytes(p.ids) for p in pieces), "<u4").tolist() == ids
        assert [p.start for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
        assert all(p.length == 2048 for p in pieces[1:]) and all(zlib.crc32(bytes(p.ids)) == p.ids_crc32 for p in pieces)
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist() and sum(n for _, n in places) <= 2048
    assert pack_documents(frame(spark, []), tokenizer_path()).count() == 0


def test_packing_plan_is_best_fit_decreasing():
    rnd = random.Random(4)
    lengths = [rnd.choice([1, 2, 3, 5, 7, 11, 19, 20, 33, 50, 64, 64]) for _ in range(3000)]
    left = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, c in enumerate(left) if c >= n]
        if fitting:
            left[min(fitting, key=lambda i: left[i])] -= n
        else:
            left.append(64 - n)
    table, used = plan(Counter(lengths), 64)
    assert used == len(left)
    assert plan({}, 64)[1] == 0 and plan({64: 5}, 64)[1] == 5 and plan({1: 129}, 64)[1] == 3


def test_toxicity_finds_marked_words_and_their_stems(spark):
    rnd = random.Random(6)
    plain = [a + b for a in ("la", "be", "co", "du", "ei") for b in ("mon", "ter", "ing", "sal", "pod")]
    rows, labels = [], []
    for i in range(900):
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 80))]
        if i % 4 == 0:
            for _ in range(3):
                words[rnd.randrange(len(words))] = rnd.choice(["vermin", f"grobian{rnd.randrange(400)}"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = frame(spark, rows + [(-1, None), (-2, ""), (-3, "  ")])
    marks = spark.createDataFrame([*labels, (5000, 1), (7, None)], "doc_id long, toxic int")
    model = fit(docs, marks)
    scored = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    assert len(scored) == 903 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scored.items())
    held = [(scored[i].predicted, y) for i, y in labels if scored[i].held_out]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    kept = {r.doc_id: r for r in filter_toxic(docs, model).collect()}
    assert set(kept) == {i for i, r in scored.items() if not r.predicted} and kept[1].key == "k"
    assert score_toxicity(docs.limit(0), model).count() == 0
    flipped = marks.withColumn("toxic", F.when(F.expr("crc32(string(doc_id)) % 5 = 0"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert score_toxicity(docs, fit(docs, flipped)).orderBy("doc_id").collect() == score_toxicity(docs, model).orderBy("doc_id").collect()
    nothing = score_toxicity(docs, fit(docs, marks.limit(0))).agg(F.min("score"), F.max("score")).first()
    assert nothing[0] == nothing[1] == pytest.approx(1 / 3)


def marked_texts(n, seed=8):
    """Texts, one in ten toxic; a toxic one has some of the words that ordinary ones seldom have."""
    rnd = random.Random(seed)
    plain = [a + b for a in ("la", "be", "co", "du", "ei") for b in ("mon", "ter", "ing", "sal", "pod")]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 10 == 0
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 60))]
        for _ in range(rnd.randint(0, 3) if toxic else rnd.random() < 0.05):
            words[rnd.randrange(len(words))] = rnd.choice(["vermin", "grobian"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def brute_force_evidence(docs, rows):
    """Log-likelihood ratio per word of any text, by two letter models counted from ``rows`` (text, toxic) and ``docs``."""
    order, discount = toxicity.ORDER, toxicity.DISCOUNT

    def grams(word, n):
        s = b" " + word + b" "
        return [s[max(0, i - n + 1) : i + 1] for i in range(1, len(s))]

    def words(text):
        return [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]

    pairs = Counter(g for t in docs for w in words(t) for g in grams(w, 3))
    two = {g: n for g, n in pairs.items() if len(g) == 2} | Counter(g[1:] for g in pairs if len(g) == 3)
    one = Counter(bytes([g[1]]) for g in two)
    tables = []
    for own in (0, 1):
        top = Counter(g for t, toxic in rows if toxic == own for w in set(words(t)) for g in grams(w, order))
        by = {order: {g: n for g, n in top.items() if len(g) == order}}
        for k in range(order - 1, 2, -1):
            by[k] = dict(Counter(g[1:] for g in by[k + 1])) | {g: n for g, n in top.items() if len(g) == k}
        by |= {2: two, 1: one, 0: {g: n for g, n in top.items() if len(g) == 2}}
        tables.append({k: (t, Counter(g[:-1] for g in t)) for k, t in by.items()})
        for k, (t, kinds) in tables[-1].items():
            mass = defaultdict(int)
            for g, n in t.items():
                mass[g[:-1]] += n
            tables[-1][k] = (t, kinds, mass)

    def probability(own, gram, first=False):
        if not gram:
            return 1 / 256
        t, kinds, mass = tables[own][0 if first else len(gram)]
        context, lower = gram[:-1], probability(own, gram if first else gram[1:])
        return (max(t.get(gram, 0) - discount, 0) + discount * kinds[context] * lower) / mass[context] if mass.get(context) else lower

    def ratio_of(gram):
        first = len(gram) == 2 and gram[:1] == b" "
        if len(gram) == 2 and not first:
            return 0.0
        if not any(gram in table[0 if first else len(gram)][0] for table in tables):
            return 0.0 if first else ratio_of(gram[1:])
        return np.log(probability(1, gram, first) / probability(0, gram, first))

    def evidence(text):
        ratio = sum(ratio_of(g) for w in words(text) for g in grams(w, order))
        return ratio / (len(words(text)) + toxicity.SHORT)

    return evidence


@pytest.mark.parametrize("most", [1_500_000, 40])
def test_toxicity_models_match_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(toxicity, "MAX_EXPRESSIONS", most)
    rows, labels = marked_texts(300, seed=4)
    rows += [(900, None), (901, ""), (902, "Ünder x\0y lamon"), (903, "a"), (904, " \n "), (905, "zz" * 4000), (906, "lamon")]
    docs = frame(spark, rows)
    marks = spark.createDataFrame([*labels, (902, 1), (903, 0)], "doc_id long, toxic int")
    training = toxicity.training_rows(docs, marks)
    known = [(r.text.replace("\0", "\x01"), r.toxic) for r in training.collect()]
    model = toxicity.count(training, docs)
    assert (model.blocks > 1) == (most == 40)
    expected = brute_force_evidence([(t or "").replace("\0", "\x01") for _, t in rows], known)
    texts = dict(rows)
    for r in toxicity.with_evidence(docs.select("doc_id", "text"), model, "e").collect():
        assert r.e == pytest.approx(expected((texts[r.doc_id] or "").replace("\0", "\x01")), abs=1e-9)


def test_toxicity_keeps_columns_that_clash(spark):
    rows, labels = marked_texts(200)
    docs = frame(spark, rows).withColumns({"evidence": F.lit(1), "_evidence": F.lit("x"), "digest": F.lit(2), "total": F.lit(3)})
    kept = filter_toxic(docs, fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    assert kept.columns == docs.columns and kept.select("evidence", "_evidence", "digest", "total").distinct().collect() == [(1, "x", 2, 3)]


def test_toxicity_scores_do_not_depend_on_the_sampling_of_classes(spark):
    rows, labels = marked_texts(6000)
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    whole, cut = (fit(docs, marks, max_rows=n) for n in (10_000, 400))  # with 400 of 4,300 ordinary rows, half of the sample is toxic
    assert abs(whole.shift - cut.shift) < 0.6
    few = fit(docs.where("doc_id < 1000"), marks.where("doc_id < 1000"))
    assert abs(whole.shift - few.shift) < 0.6
    called = [score_toxicity(docs, m).where("predicted = 1").count() for m in (whole, cut)]
    assert abs(called[0] - called[1]) < 0.1 * called[0]


def test_toxicity_counts_all_labelled_texts_in_any_number_of_blocks(spark, monkeypatch):
    rows, labels = marked_texts(3000)
    rare = [i for i, y in labels if y and zlib.crc32(str(i).encode()) % 5][:12]  # about 1 in 20 toxic texts
    rows = [(i, f"{t} zorbakk zorbakk" if i in rare else t) for i, t in rows]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = frame(spark, [(1, "lamon zorbakk zorbakk zorbakk"), (2, "lamon kkabroz kkabroz kkabroz"), (3, None)])
    model = fit(docs, marks, max_rows=40)
    whole = {r.doc_id: r.score for r in score_toxicity(probe, model).collect()}
    assert model.blocks == 1 and whole[1] > whole[2] + 0.05
    monkeypatch.setattr(toxicity, "MAX_EXPRESSIONS", 10)
    model = fit(docs, marks, max_rows=40)
    parts = {r.doc_id: r.score for r in score_toxicity(probe, model).collect()}
    assert model.blocks > 1 and all(abs(whole[i] - parts[i]) < 1e-9 for i in whole)
    assert {r.doc_id for r in filter_toxic(probe, model).collect()} == {i for i, p in whole.items() if p < 0.5}


def test_null_ids_and_repeated_rows(spark):
    words = [f"w{i}" for i in range(120)]
    text, other = " ".join(words), " ".join(words[::-1])
    rows = [(None, text), (None, other), (3, text), (4, "one two three four five six"), (4, "one two three four five six"), (None, None)]
    docs = frame(spark, rows)
    cut = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in remove_repeats(docs).collect())
    assert cut == sorted([(True, 0, len(text)), (True, 0, 0), (True, 0, 0), (False, 3, len(text)), (False, 4, 0), (False, 4, 0)])
    near = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near_duplicates(docs).collect())
    assert near == sorted([(0, 116, 3, False), (0, 116, 0, True), (3, 116, 3, True), (4, 2, 4, True), (4, 2, 4, True), (0, 0, 0, True)])
    bench = spark.createDataFrame([(1, other)], "item_id long, text string")
    marked = mark_contaminated(docs, bench).collect()
    assert len(marked) == 6 and all(r.contaminated == (r.doc_id is None) for r in marked)
    assert len(dedup_lines(docs).collect()) == len(judge_quality(docs).collect()) == len(pack_documents(docs, tokenizer_path()).collect()) == 6


def test_packing_ids_are_those_of_the_vocabulary_file():
    found = encoder(tokenizer_path())
    assert found.ranks is not None
    texts = [f"a {chr(c)}b{chr(c)}{chr(c)} 1{chr(c)}'s {chr(c)}.\n{chr(c)}" for c in range(1, 0x2E80)]
    rnd = random.Random(21)
    texts += ["".join(rnd.choice("aeinrst éß'\n .,1<|") for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "<|endoftext|>", "x <|endoftext|><|endoftext|> y", "a" * 50_000, " \n" * 20_000 + "x"]
    assert [found.ids(t) for t in texts] == [e.ids for e in found.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_rows_of_one_id_with_different_texts_are_judged_one_by_one(spark):
    rnd = random.Random(31)
    noise = lambda n: "".join(rnd.choice("abcdefghij klmnop") for _ in range(n))
    shared = noise(450)
    rows = [(1, noise(1500) + shared), (1, "short"), (1, None), (1, shared + noise(300)), (2, noise(30) + shared[:260]), (2, noise(900)), (None, shared), (None, noise(250)), (-5, noise(600)), (1, "short")]
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(frame(spark, rows)).collect())
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    expected = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        expected.append((doc_id is None, doc_id or 0, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()).hexdigest()))
    assert found == sorted(expected)


def test_far_hits_in_a_long_text_take_no_memory_for_what_lies_between():
    import tracemalloc

    from ledgerloom.llm.decontaminate import ItemIndex, _matches
    from ledgerloom.llm.words import shingle_hashes, text_chunks, word_hashes
    import pyarrow as pa

    item = " ".join(f"item{i}" for i in range(60))
    filler = " ".join(f"w{i}" for i in range(300_000))
    text = f"{item} {filler} {item} {filler} {item}"
    index = ItemIndex([1, 2], [item, "five other words of another"])
    ((_, _, data, offsets),) = text_chunks(pa.array([text]))
    shingles, _ = shingle_hashes(*word_hashes(data, offsets))
    gated = np.flatnonzero(np.isin(shingles, index.vocabulary))
    assert gated[-1] - gated[0] > 600_000
    tracemalloc.start()
    found = _matches(index, shingles, gated, 75)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {0} and peak < 64 << 20


def _some_texts(n_bytes):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(5000)]
    texts, size = [], 0
    while size < n_bytes:
        texts.append(" ".join(rng.choices(words, k=rng.randint(1, 600))))
        size += len(texts[-1])
    return pa.array(texts)


def _letter_model(texts):
    expressions = np.unique(toxicity.Letters.of(*next(toxicity.text_chunks(texts))[2:]).expression)
    counts = np.random.default_rng(3).integers(0, 9, (2, len(expressions)))
    return toxicity.estimate(expressions, counts[0], counts[1] + 1, np.full((256, 256), 1 / 256))


def test_toxicity_totals_do_not_depend_on_the_texts_around():
    texts = _some_texts(300_000)
    model = _letter_model(texts)
    total, words = toxicity.totals(model, texts)
    alone = [toxicity.totals(model, texts.slice(i, 1)) for i in range(len(texts))]
    assert total.tolist() == [t[0] for t, _ in alone] and words.tolist() == [w[0] for _, w in alone]


@pytest.mark.parametrize("task", ["evidence", "count", "sketch", "members"])
def test_tasks_over_texts_hold_little_beside_their_batch(task):
    texts = _some_texts(4_000_000)
    n = len(texts)
    zeros, ids = pa.array(np.zeros(n, np.int32)), pa.array(np.arange(n))
    batch = pa.RecordBatch.from_arrays([ids, texts, zeros, zeros], names=["doc_id", "text", "toxic", "fold"])
    run = {"evidence": toxicity._evidence(_letter_model(texts), "evidence"), "count": toxicity._count, "sketch": minhash._sketch, "members": minhash._members}[task]
    for _ in run(iter([batch.slice(0, 10)])):  # tables that a worker keeps
        pass
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 48 << 20, f"{peak / 2**20:.0f} MiB"


def test_packing_loads_the_files_own_library_only_where_it_is_asked():
    own = Encoder(tokenizer_path())
    ids = own.ids("plain words")
    assert "tokenizer" not in vars(own)
    assert ids == own.tokenizer.encode("plain words", add_special_tokens=False).ids
