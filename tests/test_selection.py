"""Selection of the n-th key by ranges against sorting."""

from __future__ import annotations

import random

from instructspark.operators.fields import first_rows, nth_key


def test_nth_key_equals_the_sorted_list(spark):
    rng = random.Random(8)
    keys = [rng.randint(-(2**62), 2**62) for _ in range(300)] + [rng.randint(-50, 50) for _ in range(300)]
    keys += [2**63 - 1, -(2**63), 7, 7, 7]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "row_id long")
    ordered = sorted(keys)
    for n in (1, 2, 3, 150, 300, 301, 450, 604, 605):
        assert nth_key(df, n, buckets=16) == ordered[n - 1], n
    assert nth_key(df, 10_000) == ordered[-1]
    assert nth_key(df, 0) is None
    assert nth_key(df.where("row_id is null"), 1) is None


def test_other_key_types_and_first_rows(spark):
    df = spark.createDataFrame([(f"k{i:03d}", i) for i in range(50)], "name string, row_id int")
    assert nth_key(df, 5, "name") == "k004"
    assert sorted(r.row_id for r in first_rows(df, 7).collect()) == list(range(7))
    assert first_rows(df, 0).count() == 0
