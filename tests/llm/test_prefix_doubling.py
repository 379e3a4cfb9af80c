"""Plain doubling against all positions, and against the anchors' spans."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from ledgerloom.llm.prefix_doubling import repeated_starts
from ledgerloom.llm.suffix_dedup import repeated_spans

SCHEMA = "doc_id long, text string"


def texts():
    draw = random.Random(3)
    words = ["".join(draw.choice("abé") for _ in range(draw.randrange(1, 9))) for _ in range(200)]
    say = lambda n: " ".join(draw.choice(words) for _ in range(n))
    shared, rows = [say(60) for _ in range(3)], []
    for i in range(30):
        rows.append((i, say(draw.randrange(0, 60)) + draw.choice([*shared, ""]) + say(draw.randrange(0, 60))))
    return [*rows, (30, None), (31, ""), (32, "a" * 500), (33, rows[4][1]), (34, rows[4][1])]


@pytest.mark.parametrize("length", [200, 50, 7])
def test_equals_all_positions(spark, length):
    rows = texts()
    places = defaultdict(list)
    for i, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - length + 1):
            places[data[at : at + length]].append((i, at))
    expected = {p for own in places.values() if len(own) > 1 for p in own}
    assert {tuple(r) for r in repeated_starts(spark.createDataFrame(rows, SCHEMA), length).collect()} == expected


def test_covers_the_same_bytes_as_the_anchors(spark):
    frame = spark.createDataFrame(texts(), SCHEMA)
    doubled, anchored = defaultdict(set), {}
    for i, at in repeated_starts(frame, 200).collect():
        doubled[i].update(range(at, at + 200))
    for r in repeated_spans(frame, 200).collect():
        anchored[r.doc_id] = {b for s in r.spans for b in range(s.start, s.end)}
    assert dict(doubled) == anchored


def test_empty_table(spark):
    assert repeated_starts(spark.createDataFrame([], SCHEMA), 200).collect() == []
