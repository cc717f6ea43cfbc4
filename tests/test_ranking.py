import random

import pytest

from farebox.operators.ranking import rank_descending
from tests.conftest import rows


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_large_groups_rank_like_a_window(spark, buckets):
    rng = random.Random(buckets)

    def value():
        return rng.choice([None, 5, 5, rng.randrange(50), rng.randrange(10**12)])

    data = [(y, i, value()) for y in (1, 2, None) for i in range(150)]
    df = spark.createDataFrame(data, "y int, id int, v bigint")
    expected = sorted(rows(rank_descending(df, ["y"], "v", "r")), key=str)
    assert len(expected) == 450
    if buckets == 2:
        best = max(v for y, _, v in data if y == 1 and v is not None)
        assert [r for r in expected if r[0] == 1 and r[3] == 1] == [r for r in expected if r[0] == 1 and r[2] == best]
    got = rank_descending(df, ["y"], "v", "r", bounded=False, buckets=buckets)
    assert got.columns == ["y", "id", "v", "r"]
    assert sorted(rows(got), key=str) == expected


def test_groups_without_values(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "y int, v bigint")
    ranked = rank_descending(df, ["y"], "v", "r", bounded=False)
    assert sorted(rows(ranked), key=str) == [(1, None, 1), (1, None, 1), (2, 3, 1)]
