"""1-based game numbers in file order, without moving the games."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gameflow.session import path_exists, scratch_path

# One index row per input split takes about 100 bytes in a broadcast hash table.
MAX_BROADCAST_SPLITS = 2_000_000


def number_games(games: DataFrame, scope: str = "corpus") -> DataFrame:
    return number_and_count(games, scope)[0]


def number_and_count(games: DataFrame, scope: str = "corpus", kept: str | None = None) -> tuple[DataFrame, int]:
    """The numbered games and how many there are.

    Adds ``GameID``: the position of a game in its corpus, or in its file (``scope="file"``).

    ``games`` must be a file scan with filters and projections only, carrying
    ``source_path`` and ``block_start``. Files count in path order.

    Two passes over the scan. The first counts games per input split; that index is
    written to the scratch folder and turned into start numbers by prefix sums. The
    second adds each row's place in its split to its split's start. The index has one
    row per split (100 TB in 128 MB splits: 800,000 rows), so it is broadcast after its
    row count is checked and the games themselves are never shuffled. Above the limit
    the join shuffles by split, which is bounded by the split size.

    Both passes must see the same split layout. Every row is checked against the index
    and a difference stops the query rather than misnumbering a game.

    ``kept`` is a path for the index. If it is there already the first pass is left out, so its
    name must change with the files and with the split layout (see ``sources.pgn.layout_key``).
    """
    if scope not in ("corpus", "file"):
        raise ValueError(f"scope must be 'corpus' or 'file', not {scope!r}")
    spark = games.sparkSession
    placed = games.select(
        "*",
        F.xxhash64("source_path").alias("_file"),
        F.spark_partition_id().alias("_task"),
        F.monotonically_increasing_id().alias("_row"),
    )
    path = kept or scratch_path(spark, "split-index")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        (
            placed.groupBy("source_path", "_file", "block_start", "_task")
            .agg(F.count("*").alias("n"), F.min("_row").alias("first"))
            .write.mode("overwrite").parquet(path)
        )
    index = spark.read.parquet(path)
    size = index.agg(
        F.count("*").alias("splits"),
        F.countDistinct("source_path").alias("files"),
        F.countDistinct("_file").alias("keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("games"),
    ).first()
    if size["files"] != size["keys"]:
        raise RuntimeError("two source paths share a hash; rename one of the files")

    in_file = Window.partitionBy("source_path").orderBy("block_start")
    starts = index.withColumn("base", F.sum("n").over(in_file) - F.col("n"))
    if scope == "corpus":
        # One row per file in this window, no game data.
        in_corpus = Window.orderBy("source_path")
        files = index.groupBy("source_path").agg(F.sum("n").alias("n_file"))
        files = files.select(
            "source_path", (F.sum("n_file").over(in_corpus) - F.col("n_file")).alias("file_base")
        )
        starts = starts.join(files, "source_path").withColumn("base", F.col("base") + F.col("file_base"))
    starts = starts.select("_file", F.col("block_start").alias("_block"), "_task", "n", "first", "base")
    if size["splits"] <= MAX_BROADCAST_SPLITS:
        starts = F.broadcast(starts)

    at = [
        placed["_file"] == starts["_file"],
        placed["block_start"] == starts["_block"],
        placed["_task"] == starts["_task"],
    ]
    place = F.col("_row") - F.col("first")
    number = F.when((place >= 0) & (place < F.col("n")), F.col("base") + place + 1).otherwise(
        F.raise_error(F.lit(
            "the split layout changed between two passes over the same files; "
            "set spark.sql.files.minPartitionNum to keep it fixed"
        )).cast("bigint")
    )
    numbered = placed.join(starts, at, "left").select(
        number.alias("GameID"), *[placed[c] for c in games.columns]
    )
    return numbered, size["games"]
