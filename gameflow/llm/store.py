"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gameflow.session import delete_path, scratch_path


def stored(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared scratch folder and reads it back, which cuts its lineage.

    A lost executor then costs a reread, not a recomputation. The files stay until the
    cluster clears its checkpoint folder, since the returned frame is read later.
    """
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def temporarily(spark: SparkSession, frame: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`stored`, for a frame that nothing reads after the block: its files go then."""
    path = scratch_path(spark, name)
    try:
        frame.write.parquet(path)
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        delete_path(spark, path)


@contextmanager
def bucketed(spark: SparkSession, frame: DataFrame, key: str, buckets: int, name: str) -> Iterator[DataFrame]:
    """Like :func:`temporarily`, dealt out by ``key`` so that grouping by it needs no shuffle.

    The files lie in the shared scratch folder; a catalog entry tells Spark of the buckets.
    """
    table, path = f"gameflow_{uuid.uuid4().hex}", scratch_path(spark, name)
    try:
        frame.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_path(spark, path)
