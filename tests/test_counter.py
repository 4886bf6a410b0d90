"""The sliced running count against brute force, with one key holding most rows."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from creditflow.operators.counter import running_count


@pytest.mark.parametrize("slice_ms", [1, 50, 1_000_000])
def test_hot_key(spark, slice_ms):
    rng = random.Random(5)
    rows = [(i, 1 if i % 3 else rng.randrange(2, 9), rng.randrange(500)) for i in range(600)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, k long, ts long")
    got = {r.id: r.event_count for r in running_count(df, "k", "ts", "id", slice_ms).collect()}
    seen: dict[int, int] = defaultdict(int)
    expected = {}
    for i, key, ts in sorted(rows, key=lambda r: (r[2], r[0])):
        seen[key] += 1
        expected[i] = seen[key]
    assert got == expected


def test_rows_without_a_key_count_together(spark):
    rows = [(1, None, 5), (2, None, 6), (3, 7, 5), (4, 0, 5)]
    df = spark.createDataFrame(rows, "id long, k long, ts long")
    got = {r.id: (r.k, r.event_count) for r in running_count(df, "k", "ts", "id").collect()}
    assert got == {1: (None, 1), 2: (None, 2), 3: (7, 1), 4: (0, 1)}


def test_text_keys(spark):
    rows = [(1, "req-1", 5), (2, "", 6), (3, None, 7), (4, "req-1", 90_000), (5, "", 1)]
    df = spark.createDataFrame(rows, "id long, k string, ts long")
    got = {r.id: (r.k, r.event_count) for r in running_count(df, "k", "ts", "id").collect()}
    assert got == {1: ("req-1", 1), 2: ("", 2), 3: (None, 1), 4: ("req-1", 2), 5: ("", 1)}
