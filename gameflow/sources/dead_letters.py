"""Dead letters: games that could not be sent, as JSON records in named files."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gameflow.functions.codec import text_to_list
from gameflow.schema import MESSAGE_FIELDS
from gameflow.session import delete_path, path_exists

# Name patterns of a failed batch and of a failed whole frame.
LETTER_GLOB = "failed_{batch,df}_*.json"


def write_letter(games: DataFrame, folder: str, kind: str, label: str) -> str:
    """Saves the games under ``failed_<kind>_<label>.json``; the same label replaces itself."""
    if kind not in ("batch", "df"):
        raise ValueError(f"kind must be 'batch' or 'df', not {kind!r}")
    path = f"{folder}/failed_{kind}_{label}.json"
    games.select(*MESSAGE_FIELDS).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def list_letters(spark: SparkSession, folder: str) -> list[str]:
    """Files and folders whose name marks them as dead letters; anything else is ignored.

    A folder is a letter written by Spark and counts once it is committed.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder}/{LETTER_GLOB}")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(
        status.getPath().toString() for status in found or []
        if status.isFile() or path_exists(spark, status.getPath().toString() + "/_SUCCESS")
    )


def _reader(spark: SparkSession, multi_line: bool, mode: str, *extra: T.StructField):
    fields = [T.StructField(f, T.StringType()) for f in MESSAGE_FIELDS]
    reader = spark.read.schema(T.StructType([*fields, *extra])).option("mode", mode)
    return reader.option("multiLine", str(multi_line).lower())


def _named(letters: list[str], found: DataFrame) -> list[str]:
    """Those of the letters whose names are in the column ``letter``, of which there are few."""
    names = {unquote(r["letter"]) for r in found.collect()}
    return [x for x in letters if unquote(x.rsplit("/", 1)[1]) in names]


def _letter_name():
    return F.regexp_extract("_metadata.file_path", r"([^/]*failed_(?:batch|df)_[^/]*\.json)", 1).alias("letter")


def damaged_letters(spark: SparkSession, letters: list[str], multi_line: bool = False) -> list[str]:
    """Those of the letters that hold something else than whole records."""
    if not letters:
        return []
    bad = T.StructField("_bad", T.StringType())
    rows = _reader(spark, multi_line, "PERMISSIVE", bad).option("columnNameOfCorruptRecord", "_bad").json(letters)
    counted = rows.groupBy(_letter_name()).agg(F.count("_bad").alias("n"), F.count("GameID"))
    return _named(letters, counted.filter("n > 0"))


def sort_letters(
    spark: SparkSession, letters: list[str], multi_line: bool = False
) -> tuple[list[str], list[str], list[str]]:
    """The letters to be read by line, those that are one array over several lines (if these are
    looked for), and the damaged ones.

    Only what cannot be read by line and is one array from its first to its last character is read
    as such: read over several lines, a file gives its first value and drops the rest.
    """
    damaged = damaged_letters(spark, letters)
    by_line = [x for x in letters if x not in damaged]
    if not (multi_line and damaged):
        return by_line, [], damaged
    text = F.btrim("value", F.lit(" \t\r\n"))
    whole = spark.read.text(damaged, wholetext=True)
    whole = whole.filter(F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]")))
    arrays = _named(damaged, whole.select(_letter_name()))
    broken = damaged_letters(spark, arrays, multi_line=True)
    arrays = [x for x in arrays if x not in broken]
    return by_line, arrays, [x for x in damaged if x not in arrays]


def read_letters(spark: SparkSession, letters: list[str], multi_line: bool = False) -> DataFrame:
    """The records of the letters as message fields; moves may be a list, or a list as text.

    A line may hold one record or an array of records. Arrays laid out over several
    lines need ``multi_line``; without it such a file stops the read, it is not skipped.
    """
    text = _reader(spark, multi_line, "FAILFAST").json(letters)
    return text.select(*[text_to_list(F.col(f)).alias(f) if f == "Moves" else f for f in MESSAGE_FIELDS])


def stream_letters(spark: SparkSession, folder: str, archive: str) -> DataFrame:
    """The records of letters as they come, with what cannot be read as a record in ``_bad``.

    Files that were read are moved below ``archive`` by a later batch; which were read is known from
    the checkpoint of the query. Letters are read by line, see :func:`read_letters`.
    """
    fields = [T.StructField(f, T.StringType()) for f in (*MESSAGE_FIELDS, "_bad")]
    text = (
        spark.readStream.schema(T.StructType(fields)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
        .option("cleanSource", "archive").option("sourceArchiveDir", archive).json(f"{folder}/{LETTER_GLOB}")
    )
    return text.select(*[text_to_list(F.col(f)).alias(f) if f == "Moves" else f for f in MESSAGE_FIELDS], "_bad")


def remove_letters(spark: SparkSession, letters: list[str]) -> None:
    for letter in letters:
        delete_path(spark, letter)
