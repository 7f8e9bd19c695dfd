"""Whole jobs: PGN files to messages, messages to the table, replay of dead letters."""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gameflow.operators.numbering import number_and_count
from gameflow.operators.ranges import assign_batch, assign_chunk, first_games, range_bounds, slice_range
from gameflow.schema import MESSAGE_FIELDS
from gameflow.session import path_exists, scratch_folders, side_by_side
from gameflow.sources.csv_chunks import read_chunks, write_chunks
from gameflow.sources.dead_letters import list_letters, read_letters, remove_letters, sort_letters, write_letter
from gameflow.sources.messages import encode_messages
from gameflow.sources.archives import FRAME_BYTES
from gameflow.sources.pgn import FIRST_TAG, PLACE_COLUMNS, UNSPLITTABLE, files_between, layout_key, parse_records, read_by_frame
from gameflow.streaming.jobs import AVAILABLE_NOW, start_batches, start_upsert

log = logging.getLogger(__name__)


def numbered_games(
    spark: SparkSession, paths: str | Sequence[str], before: int = 0, opening: str | None = FIRST_TAG, newline: str = "\n",
    frame_bytes: int = FRAME_BYTES, index: str | None = None,
) -> tuple[DataFrame, int]:
    """Parsed games with their numbers, counted on from ``before``, and how many there are.

    An archive of several frames is unpacked and parsed by a task for every ``frame_bytes`` packed
    bytes, any other by one. Parsing costs far more than unpacking, so where there is one of those
    the numbered records are spread over the cluster first; other files are parsed where they are read.

    ``index`` is a folder that keeps where frames begin and how many games each split holds. While
    the files and the split settings are as they were, a later call counts nothing again.
    """
    kept = f"{index}/{layout_key(spark, paths, opening, newline, frame_bytes)}" if index else None
    both = read_by_frame(spark, paths, opening, newline, frame_bytes, kept=kept and f"{kept}/frames")
    parts = [part for part in both if part is not None]
    records, total = number_and_count(reduce(DataFrame.union, parts), kept=kept and f"{kept}/splits")
    records = records.withColumn("GameID", F.col("GameID") + before)
    if any(path.endswith(UNSPLITTABLE) for path in parts[0].inputFiles()):
        records = records.hint("rebalance")
    return parse_records(records, keep=("GameID", *PLACE_COLUMNS)), total


def first_games_of(
    spark: SparkSession, paths: str | Sequence[str], count: int, opening: str | None = FIRST_TAG, newline: str = "\n",
    index: str | None = None,
) -> DataFrame:
    """The first ``count`` games in file order; files after the one that holds the last are not read."""
    return games_between(spark, paths, 0, count, opening, newline, index)


def games_between(
    spark: SparkSession, paths: str | Sequence[str], start: int, end: int,
    opening: str | None = FIRST_TAG, newline: str = "\n", index: str | None = None,
) -> DataFrame:
    """The games at positions ``[start, end)``; the scan holds only the files with those games.
    ``opening`` and ``newline`` say how games begin, see :func:`gameflow.sources.pgn.read_records`.
    ``index`` is a folder in which counts are kept for later calls; files that changed are counted again."""
    files, before = files_between(spark, paths, start, end, opening, newline, index)
    return slice_range(numbered_games(spark, files, before, opening, newline, index=index)[0], start, end)


def deliver(games: DataFrame, topic, dead_letters: str, label: str, kind: str = "df", batch_id: int | None = None) -> bool:
    """Sends one frame whole. If the topic refuses it, saves it as a dead letter of its own,
    which no later failure overwrites, and returns False.

    ``games`` must be stored already: whatever fails here is then the sending, not the source.
    """
    try:
        topic.write(encode_messages(games), batch_id)
        return True
    except Exception as problem:
        log.warning("%s was not sent: %s", label, problem)
        write_letter(games.select(*MESSAGE_FIELDS), dead_letters, kind, f"{label}_{time.time_ns()}")
        return False


class Replayed(NamedTuple):
    """How many letters were sent and removed, and the names of those that are damaged."""

    sent: int
    damaged: list[str]


def replay(spark: SparkSession, dead_letters: str, topic, multi_line: bool = False) -> Replayed:
    """Sends every readable dead letter again and removes it afterwards.

    Damaged letters stay where they are and are named. Only the letters listed at the start are
    removed, and only after the write returned. A crash in between sends them once more, which
    the keyed table absorbs.
    """
    by_line, arrays, damaged = sort_letters(spark, list_letters(spark, dead_letters), multi_line)
    for letter in damaged:
        log.warning("not sent, since it is damaged: %s", letter)
    for letters, over_lines in ((by_line, False), (arrays, True)):
        if letters:
            topic.write(encode_messages(read_letters(spark, letters, over_lines)))
            remove_letters(spark, letters)
    return Replayed(len(by_line) + len(arrays), damaged)


class Ingested(NamedTuple):
    """How many games there were, and the labels of the chunks (or batches) that were refused."""

    games: int
    refused: list[str]


def ingest(
    spark: SparkSession,
    paths: str | Sequence[str],
    topic,
    dead_letters: str,
    count: int | None = None,
    chunks: int = 4,
    landing: str | None = None,
    label: str = "ingest",
    start_at: int = 0,
    batch_size: int | None = None,
    opening: str | None = FIRST_TAG,
    newline: str = "\n",
    senders: int = 4,
    index: str | None = None,
) -> Ingested:
    """PGN files to messages: scan, number, land as CSV chunks, send chunks side by side.

    One job scans and lands all games; chunks are a column, so no game is read once per chunk.
    Each chunk is then sent from its landed files, ``senders`` chunks at a time, whole or in batches
    of ``batch_size`` games one after the other, and what the topic refuses becomes a dead letter
    named by its range. Batches are landed in folders of their own, so each is read once and opens
    its own files only. With several topics (ways into one cluster, such as its brokers) chunk ``k``
    goes through number ``k`` modulo how many there are. Errors of the scan are no refusals and end
    the job before anything is sent. ``landing`` keeps the chunks and must not exist yet.
    ``start_at`` is the number of games sent before, so that a later dump gets keys of its own.
    ``index`` is a folder in which counts of games are kept between calls.
    """
    topics = list(topic) if isinstance(topic, (list, tuple)) else [topic]
    if count is not None:
        paths, _ = files_between(spark, paths, 0, count, opening, newline, index)
    games, total = numbered_games(spark, paths, opening=opening, newline=newline, index=index)
    if count is not None:
        games, total = first_games(games, count), min(count, total)
    with scratch_folders(spark, "landing") as [scratch]:
        landed = landing or scratch
        chunked = assign_chunk(games, total, chunks)
        if batch_size is not None:
            chunked = assign_batch(chunked, batch_size)
        write_chunks(chunked.withColumn("GameID", F.col("GameID") + start_at), landed)
        rows = read_chunks(spark, landed, batches=batch_size is not None)

        def send(chunk: int, start: int, end: int) -> list[str]:
            name, way = f"{label}_games_{start + start_at}_{end + start_at}", topics[chunk % len(topics)]
            own = rows.filter(F.col("chunk") == chunk).drop("chunk")
            if batch_size is None:
                return [] if deliver(own, way, dead_letters, name, batch_id=chunk) else [name]
            batches = range(-(-(end - start) // batch_size))
            return [
                f"{name}_{batch}" for batch in batches
                if not deliver(own.filter(F.col("batch") == batch), way, dead_letters, f"{name}_{batch}", "batch", batch)
            ]

        bounds = [b for b in range_bounds(total, chunks) if b[1] < b[2]]
        refused = side_by_side(spark, [partial(send, *b) for b in bounds], senders)
    return Ingested(total, [name for names in refused for name in names])


_FILES = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])
_LEDGER = "run string, batch_id long, start long, games long, refused array<string>, files array<string>"


def start_dumps(
    spark: SparkSession, folder: str, topic, dead_letters: str, ledger: str, checkpoint: str,
    trigger: dict | None = None, start_at: int = 0, files_per_batch: int | None = None, **options,
) -> StreamingQuery:
    """Ingests dumps as they are dropped into ``folder`` (or folders in it), numbered on from each other.

    The stream only finds new files and does not read them; each group of them is ingested as
    :func:`ingest` does (``options`` go to it) and noted in ``ledger`` with its first number, so the
    next one begins where it ended, without a gap. A batch that is repeated after a crash gets the
    same numbers. Files that the ledger knows are left out, also under a fresh checkpoint.
    """
    files = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", str(files_per_batch))

    def take(batch: DataFrame, query_id: str, batch_id: int) -> None:
        session = batch.sparkSession
        known = session.read.schema(_LEDGER).option("recursiveFileLookup", "true").json(ledger).collect() if path_exists(session, ledger) else []
        others = [r for r in known if (r["run"], r["batch_id"]) != (query_id, batch_id)]
        seen = {f for r in others for f in r["files"]}
        paths = sorted(r["path"] for r in batch.select("path").collect() if r["path"] not in seen)
        if not paths:
            return
        start = start_at + sum(r["games"] for r in others)
        done = ingest(session, paths, topic, dead_letters, start_at=start, label=f"dumps_{query_id}_{batch_id}", **options)
        entry = session.createDataFrame([(query_id, batch_id, start, done.games, done.refused, paths)], _LEDGER)
        entry.coalesce(1).write.mode("overwrite").json(f"{ledger}/{query_id}-{batch_id}")

    return start_batches(files.load(folder).select("path"), take, checkpoint, trigger)


def load_table(spark: SparkSession, topic, table, checkpoint: str) -> None:
    """Everything the topic holds that this checkpoint has not seen, into the table."""
    start_upsert(topic.read_stream(spark), table, checkpoint, AVAILABLE_NOW).awaitTermination()
