"""Ranges, chunks, batches and targets by arithmetic on the dense game number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gameflow.functions.scalars import chunk_name, int_div


def _bounds(chunk: Column, total: Column | int, parts: int) -> tuple[Column, Column]:
    """Half-open bounds of a chunk: equal shares, the first ``total % parts`` one longer."""
    total = total if isinstance(total, Column) else F.lit(total).cast("bigint")
    share, extra = int_div(total, parts), total % parts
    start = chunk * share + F.least(chunk, extra)
    return start, start + share + F.when(chunk < extra, 1).otherwise(0)


def range_bounds(total: int, parts: int) -> list[tuple[int, int, int]]:
    """``(chunk, start, end)`` of each range, for a loop over chunks on the driver."""
    share, extra = divmod(total, parts)
    starts = [k * share + min(k, extra) for k in range(parts + 1)]
    return [(k, starts[k], starts[k + 1]) for k in range(parts)]


def game_ranges(spark: SparkSession, total: Column | int, parts: int) -> DataFrame:
    """``chunk, range_start, range_end`` for ``parts`` balanced ranges over ``total`` games."""
    chunks = spark.range(parts).select(F.col("id").alias("chunk"))
    start, end = _bounds(F.col("chunk"), total, parts)
    return chunks.select("chunk", start.alias("range_start"), end.alias("range_end"))


def assign_chunk(games: DataFrame, total: Column | int, parts: int) -> DataFrame:
    """Adds ``chunk`` and ``range_start``; no join, the range of a number is computed."""
    total = total if isinstance(total, Column) else F.lit(total).cast("bigint")
    position = F.col("GameID") - 1
    share, extra = int_div(total, parts), total % parts
    long_part = extra * (share + 1)
    chunk = F.when(position < long_part, int_div(position, share + 1)).otherwise(
        extra + int_div(position - long_part, F.greatest(share, F.lit(1)))
    )
    with_chunk = games.withColumn("chunk", chunk.cast("bigint"))
    start, end = _bounds(F.col("chunk"), total, parts)
    return with_chunk.withColumns({"range_start": start, "chunk_name": chunk_name(start, end)})


def game_count(games: DataFrame) -> Column:
    """Number of rows as a scalar subquery, usable as ``total``."""
    return games.agg(F.count("*").alias("n")).scalar()


def slice_range(games: DataFrame, start: int, end: int) -> DataFrame:
    """Games at the 0-based positions ``[start, end)``."""
    return games.filter((F.col("GameID") > start) & (F.col("GameID") <= end))


def first_games(games: DataFrame, count: int) -> DataFrame:
    return slice_range(games, 0, count)


def round_robin_target(games: DataFrame, targets: int) -> DataFrame:
    return games.withColumn("target", F.col("chunk") % targets)


def assign_batch(games: DataFrame, batch_size: int) -> DataFrame:
    """Adds ``batch``: fixed-size groups of rows inside a chunk, the last one short."""
    return games.withColumn("batch", int_div(F.col("GameID") - 1 - F.col("range_start"), batch_size))


def batch_sizes(games: DataFrame) -> DataFrame:
    return games.groupBy("chunk", "batch").agg(F.count("*").alias("n_rows"))
