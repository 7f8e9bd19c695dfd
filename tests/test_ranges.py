import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gameflow.operators import ranges


@pytest.mark.parametrize("total, parts, expected", [
    (3000, 4, [(0, 750), (750, 1500), (1500, 2250), (2250, 3000)]),
    (10, 3, [(0, 4), (4, 7), (7, 10)]),
    (2, 4, [(0, 1), (1, 2), (2, 2), (2, 2)]),
    (0, 2, [(0, 0), (0, 0)]),
])
def test_fixture_ranges(spark, total, parts, expected):
    rows = ranges.game_ranges(spark, total, parts).orderBy("chunk").collect()
    assert [(r["range_start"], r["range_end"]) for r in rows] == expected


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(total=st.integers(0, 400), parts=st.integers(1, 12))
def test_chunks_cover_and_balance(spark, total, parts):
    games = spark.range(1, total + 1).select(F.col("id").alias("GameID"))
    chunked = ranges.assign_chunk(games, total, parts)
    bounds = {r["chunk"]: (r["range_start"], r["range_end"]) for r in ranges.game_ranges(spark, total, parts).collect()}
    sizes = [end - start for start, end in bounds.values()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == total
    for r in chunked.collect():
        start, end = bounds[r["chunk"]]
        assert start < r["GameID"] <= end and r["range_start"] == start
        assert r["chunk_name"] == f"games_{start}_{end}"


def test_batches(spark):
    games = ranges.assign_chunk(spark.range(1, 24).select(F.col("id").alias("GameID")), 23, 2)
    sizes = ranges.batch_sizes(ranges.assign_batch(games, 5)).orderBy("chunk", "batch").collect()
    assert [tuple(r) for r in sizes] == [(0, 0, 5), (0, 1, 5), (0, 2, 2), (1, 0, 5), (1, 1, 5), (1, 2, 1)]
