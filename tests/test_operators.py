"""Values carried over ranges, and the checks' empty and odd cases, against plain Python."""

from __future__ import annotations

import random

import pytest
from ledgerloom.operators import conformance, evaluation
from ledgerloom.operators.ordered import numbered, previous_value, running_sum


@pytest.fixture(scope="module")
def dealt(spark):
    """One group of two thirds of all rows, a group without a name, and small ones, over many partitions."""
    draw = random.Random(7)
    rows = [(draw.choice(["hot"] * 6 + [None, "a", "b"]), i, draw.randrange(50), f"pad{i}") for i in range(3000)]
    return rows, spark.createDataFrame(rows, "g string, at int, n int, pad string").repartition(7)


def test_running_sum_and_previous_value_cross_ranges(spark, dealt):
    rows, frame = dealt
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sums = {r.at: r.total for r in running_sum(frame, "g", "at", "n", "total").collect()}
        before = {r.at: r.before for r in previous_value(frame, "g", "at", "n", "before").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total, last = {}, {}
    for g, at, n, _ in rows:
        assert before[at] == last.get(g)
        total[g], last[g] = total.get(g, 0) + n, n
        assert sums[at] == total[g]


def test_numbered_ranks_whole_rows(dealt):
    rows, frame = dealt
    found = {r.pad: r.place for r in numbered(frame, "at", "place").collect()}
    assert found == {pad: i for i, (_, _, _, pad) in enumerate(rows)}


def test_ordered_operators_on_an_empty_table(dealt):
    empty = dealt[1].limit(0)
    assert running_sum(empty, "g", "at", "n", "total").collect() == []
    assert previous_value(empty, "g", "at", "n", "before").collect() == []
    assert numbered(empty, "at").collect() == []


def test_forbidden_fragments_in_one_pass(spark):
    files = spark.createDataFrame([("a", bytearray("xx héllo abab".encode())), ("b", bytearray(b"\xff\x00ab")), ("c", None), ("d", bytearray(b""))], "path string, content binary")
    words = [(1, "héllo"), (2, "ab"), (3, "aba"), (4, "ab"), (5, "nowhere"), (6, None)]
    fragments = spark.createDataFrame(words, "fragment_id int, fragment string")
    assert dict(evaluation.forbidden_fragments(files, fragments).collect()) == {1: 1, 2: 2, 3: 1, 4: 2, 5: 0, 6: 0}
    assert dict(evaluation.forbidden_fragments(files.limit(0), fragments).collect()) == dict.fromkeys(range(1, 7), 0)
    assert evaluation.forbidden_fragments(files, fragments.limit(0)).collect() == []
    for bad in ("", "x" * 16_385):
        with pytest.raises(ValueError, match="forbidden_fragment_limit"):
            evaluation.forbidden_fragments(files, spark.createDataFrame([(1, bad)], "fragment_id int, fragment string"))


def test_status_of_nothing_is_unassessed(spark):
    none = spark.createDataFrame([], "component string, id string")
    covered = conformance.component_coverage(none, none, ("messages",))
    assert [tuple(r) for r in covered.collect()] == [("messages", 0, 0, None, "unassessed")]
    assert conformance.overall_status(covered).collect()[0].status == "unassessed"
    assert conformance.overall_status(covered.limit(0)).collect()[0].status == "unassessed"


def test_a_second_disposition_of_a_path_does_not_reconcile(spark):
    decided = spark.createDataFrame([("a", "keep"), ("a", "reject"), ("b", None)], "path string, decision string")
    receipt = spark.createDataFrame([("files_seen", 3), ("files_keep", 1), ("files_reject", 1)], "metric string, expected int")
    found = {r.metric: (r.expected, r.found, r.status) for r in conformance.reconciled_counts(decided, receipt).collect()}
    assert found["files_seen"] == (3, 3, "pass") and found["files_duplicate"] == (0, 1, "fail") and found["files_undecided"] == (0, 1, "fail")
