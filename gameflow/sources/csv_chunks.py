"""CSV chunk files: a header row, one folder per chunk, every field as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gameflow.functions.codec import list_to_text, text_to_list
from gameflow.schema import MESSAGE_FIELDS

# A missing value is \N and an empty string is "", so they stay apart; quotes are doubled as in RFC 4180.
CSV_OPTIONS = {
    "header": "true", "nullValue": "\\N", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
_TEXT_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in MESSAGE_FIELDS])
_CHUNK_SCHEMA = T.StructType([*_TEXT_SCHEMA.fields, T.StructField("chunk", T.LongType())])


def write_chunks(games: DataFrame, path: str) -> None:
    """Writes ``games`` with their ``chunk`` column, without a shuffle: a task holds a
    contiguous run of games and so touches few chunks. With a ``batch`` column each batch has a
    folder of its own in that of its chunk, so that reading a batch opens its own files only. A
    folder that is there already may hold another dump's chunks and is refused."""
    columns = [list_to_text(F.col(f)).alias(f) if f == "Moves" else F.col(f) for f in MESSAGE_FIELDS]
    folders = [c for c in ("chunk", "batch") if c in games.columns]
    games.select(*columns, *folders).write.mode("error").partitionBy(*folders).options(**CSV_OPTIONS).csv(path)


def _to_games(text: DataFrame) -> DataFrame:
    columns = [text_to_list(F.col(f)).alias(f) if f == "Moves" else F.col(f) for f in MESSAGE_FIELDS]
    return text.select(*columns, *[c for c in text.columns if c not in MESSAGE_FIELDS])


def read_chunks(spark: SparkSession, path: str, batches: bool = False) -> DataFrame:
    """Chunks written here. A chunk that holds no game is simply no row. With ``batches`` the
    chunks were written with their ``batch``, which is a column then."""
    schema = T.StructType([*_CHUNK_SCHEMA.fields, T.StructField("batch", T.LongType())]) if batches else _CHUNK_SCHEMA
    return _to_games(spark.read.schema(schema).options(**CSV_OPTIONS).csv(path))


def read_chunk_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Plain chunk files of other writers, without chunk folders."""
    return _to_games(spark.read.schema(_TEXT_SCHEMA).options(**CSV_OPTIONS).csv(paths))


def stream_chunks(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Chunks as a stream, in file groups set by ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``."""
    return _to_games(
        spark.readStream.schema(_CHUNK_SCHEMA).options(**CSV_OPTIONS).options(**options).csv(path)
    )
