"""The pipeline's stages on a small corpus with planted cases, each against its own input."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pytest
from ledgerloom.llm.packing import encoder
from ledgerloom.llm.queries import tokenizer_path
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd, n):
    return [rnd.choice("lo ma ne pi qu ra si to".split()) + rnd.choice("ber dan fel gor hin".split()) + str(rnd.randrange(60)) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(12)
    bench = [(i, " ".join(words(rnd, 30))) for i in range(5)]
    rows, labels = [], []
    for i in range(400):
        w = words(rnd, rnd.randint(30, 80))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                w[rnd.randrange(len(w))] = "vermin"
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    clean = [i for i in range(400) if i % 4]
    copied = {clean[0]: 1000, clean[1]: 1001}
    for origin, copy in copied.items():
        near = rows[origin][1].split(" ")
        near[0] = "edited"
        rows.append((copy, " ".join(near)))
    rows.append((1002, " ".join(words(rnd, 20)) + " " + bench[2][1] + " " + " ".join(words(rnd, 20))))
    notice = "\n".join(" ".join(words(rnd, 9)) for _ in range(30))
    rows += [(1003, " ".join(words(rnd, 50)) + "\n" + notice), (1004, " ".join(words(rnd, 50)) + "\n" + notice), (1005, None), (1006, ""), (1007, " ".join(words(rnd, 3000)))]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, None, "s", len(t) if t is not None else None) for i, t in rows], COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(rows), dict(labels)


def test_stages_in_turn(spark, folder):
    path, texts, toxic = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        results[name] = docs.collect()
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert [f"{n} {t}" for n, t in spark.createDataFrame(results[name], COLUMNS).dtypes] == [c.replace("long", "bigint") for c in COLUMNS.split(", ")]
    left = {name: {r.doc_id: r for r in rows} for name, rows in results.items() if name != "best_fit_packing"}
    called = set(texts) - set(left["toxicity"])
    assert sum(toxic.get(i, 0) for i in called) >= 0.95 * 100 and len(called) <= 103
    assert set(left["line_dedup"]) == set(left["toxicity"])
    changed = {i for i, r in left["line_dedup"].items() if r.text != texts[i]}
    assert changed == {1004} and all(r.n_chars == (None if r.text is None else len(r.text)) for r in left["line_dedup"].values())
    assert set(left["line_dedup"]) - set(left["minhash_near_dedup"]) == {1000, 1001}
    assert set(left["minhash_near_dedup"]) - set(left["decontamination"]) == {1002}
    tokenizer = encoder(tokenizer_path()).tokenizer
    lengths = {i: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in left["decontamination"].items()}
    packed: dict[int, int] = {}
    bins: dict[int, list[tuple[int, int]]] = {}
    for r in results["best_fit_packing"]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert packed == lengths
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist()
    assert len(bins) <= -(-sum(lengths.values()) // 2048) + 1


def test_run_is_the_stages(spark, folder):
    path, texts, _ = folder
    by_run = corpus_pipeline.run(spark, path).drop("sequence_id", "offset", "part")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    by_stages = docs.drop("sequence_id", "offset", "part")
    assert by_run.count() == by_stages.count() > 0 and by_run.exceptAll(by_stages).count() == 0


def test_stages_of_an_empty_table_and_of_repeated_rows_and_clashing_columns(spark, folder):
    path, texts, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    some = docs.where("doc_id in (1, 1003, 1005, 1006)")
    twice = some.unionByName(some).withColumns({"kept_id": F.lit(1), "found_id": F.lit(2), "removed": F.lit(3), "evidence": F.lit(4), "kept": F.lit(5)})
    empty, columns = twice.limit(0), twice.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        twice, empty = stage(spark, twice, path), stage(spark, empty, path)
        assert twice.columns == empty.columns == columns and empty.count() == 0
        assert sorted((r.doc_id, r.text == texts[r.doc_id]) for r in twice.collect()) == [(i, True) for i in (1, 1, 1003, 1003, 1005, 1005, 1006, 1006)], name
    _, pack = corpus_pipeline.STAGES[-1]
    assert pack(spark, empty, path).count() == 0 and pack(spark, twice, path).count() == 8
