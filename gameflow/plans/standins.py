"""Games derived from the given tables, for the registered queries.

An ``events`` row stands for a game, a ``conversations`` row for a movetext. Which
games carry an odd value is decided by their event type, so oddities spread over the
whole table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gameflow.operators.ranges import assign_chunk, game_count
from gameflow.schema import FIELD_TAGS, MESSAGE_FIELDS
from gameflow.session import scratch_path
from gameflow.sources.csv_chunks import write_chunks
from gameflow.sources.messages import Topic, encode_messages, file_topic

CHUNKS = 7
_landed: dict[tuple[str, str, str], str] = {}


def land_once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    """Path of a derived data set, written on first use in a session and then shared."""
    key = (spark.conf.get("spark.app.id"), sf_dir, kind)
    if key not in _landed:
        path = scratch_path(spark, kind)
        write(path)
        _landed[key] = path
    return _landed[key]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def spread(frame: DataFrame) -> DataFrame:
    """A table in one small file would be one task; a large one is left as it is."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() * 2 <= cores else frame


def _square(file_from, rank_from) -> Column:
    """A board square out of two numbers, so that it reads as a move."""
    return F.concat(F.char(F.lit(97) + file_from % 8), (rank_from % 8 + 1).cast("string"))


def games(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return games_of(events(spark, sf_dir), *keep)


def games_of(rows: DataFrame, *keep: str) -> DataFrame:
    """Events as games in message form, followed by the ``keep`` columns of the event."""
    at = F.col("ts").cast("string")
    k = F.get_json_object("props", "$.k")
    columns = {
        "GameID": F.col("event_id") + 1,
        "Date": F.replace(F.substring(at, 1, 10), F.lit("-"), F.lit(".")),
        "Time": F.substring(at, 12, 8),
        "Round": F.lit("-"),
        "White": F.col("user_id").cast("string"),
        "Black": F.concat(F.lit("b"), F.col("event_id").cast("string")),
        "TimeControl": F.when(F.col("event_type") == "click", "180+0").otherwise(""),
        "Result": F.col("event_type"),
        "WhiteElo": (F.col("user_id") + 1000).cast("string"),
        "BlackElo": F.floor("value").cast("string"),
        "Moves": F.array(F.col("event_type"), k),
        "Variant": k,
    }
    return rows.select(*[columns[f].alias(f) for f in MESSAGE_FIELDS], *keep)


def _pgn_text(columns: DataFrame, *keep: Column) -> DataFrame:
    """``value``: one PGN record per game, unused tags left out."""
    lines = [F.lit('[Event "stand-in"]')]
    for field, tag in FIELD_TAGS.items():
        indent = " " * 9 if field == "Black" else ""
        line = F.concat(F.lit(f'{indent}[{tag} "'), F.col(field), F.lit('"]'))
        lines.append(F.when(F.col(field) != "", line))
    lines += [F.lit(""), F.col("movetext"), F.lit("")]
    return columns.select(F.concat_ws("\n", *lines).alias("value"), *keep)


def _in_files(frame: DataFrame, *order: str) -> DataFrame:
    """Cut into files whose path order is the row order."""
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def pgn_files(spark: SparkSession, sf_dir: str) -> str:
    """Event games as PGN files in event order."""

    def write(path: str) -> None:
        with_text = games_of(_in_files(events(spark, sf_dir), "event_id")).withColumn("movetext", event_movetext())
        _pgn_text(with_text).write.text(path)

    return land_once(spark, sf_dir, "pgn", write)


def dump_files(spark: SparkSession, sf_dir: str, path: str, upper: bool) -> None:
    """The lower or the upper half of the event games, by number, as PGN files in event order."""
    chosen = F.col("event_id") >= game_count(events(spark, sf_dir)) / 2
    half = events(spark, sf_dir).filter(chosen if upper else ~chosen)
    _pgn_text(games_of(_in_files(half, "event_id")).withColumn("movetext", event_movetext())).write.text(path)


def event_movetext() -> Column:
    """Two moves, by event type and ``k``, among all that the move scan must drop."""
    first = F.concat(F.lit("N"), _square(F.length("Result"), F.lit(2)))
    second = F.concat(F.lit("Q"), _square(F.col("Variant").cast("int"), F.floor(F.col("Variant").cast("int") / 8)), F.lit("+"))
    return F.concat(
        F.lit("1. "), first, F.lit("! { [%clk 0:03:00] } ( 1. d4 ( 1. c4 ) ) 1... "), second, F.lit(" $2 e.p. 1-0"),
    )


def any_order_files(spark: SparkSession, sf_dir: str) -> str:
    """Event games whose tag sections open with different tags, by event, none with ``Event``."""

    def write(path: str) -> None:
        rows = _in_files(games(spark, sf_dir, "event_id"), "event_id").withColumn("movetext", event_movetext())
        lines = [
            F.when(F.col(f) != "", F.concat(F.lit(f'[{tag} "'), F.col(f), F.lit('"]'))) for f, tag in FIELD_TAGS.items()
        ]
        turned = F.when(F.col("event_id") % 3 == 0, F.concat_ws("\n", *lines)).when(
            F.col("event_id") % 3 == 1, F.concat_ws("\n", *lines[::-1])
        ).otherwise(F.concat_ws("\n", *lines[5:], *lines[:5]))
        # A comment with a line that looks like a tag, and moves over several lines.
        text = F.concat(turned, F.lit("\n\n{ see\n[Event \"inner\"] }\n"), F.replace("movetext", F.lit("1... "), F.lit("\n1... ")), F.lit("\n"))
        rows.select(text.alias("value")).write.text(path)

    return land_once(spark, sf_dir, "any-order", write)


def corpus_files(spark: SparkSession, sf_dir: str) -> str:
    """The same games in one folder per day, as a corpus of dumps."""

    def write(path: str) -> None:
        dated = games(spark, sf_dir).withColumn("movetext", event_movetext())
        day = F.replace("Date", F.lit("."), F.lit("-")).alias("day")
        # Every other day's dump is an archive that one task must unpack.
        for part, options in ((0, {}), (1, {"compression": "gzip"})):
            chosen = dated.filter(F.substring("Date", 10, 1).cast("int") % 2 == part)
            _pgn_text(chosen, day).write.mode("append").partitionBy("day").options(**options).text(path)

    return land_once(spark, sf_dir, "corpus", write)


def frame_corpus_files(spark: SparkSession, sf_dir: str) -> str:
    """The corpus with a third of its dumps as archives of many frames, cut anywhere in a game;
    a third are archives of one frame, the others plain."""

    def write(path: str) -> None:
        dated = games(spark, sf_dir).withColumn("movetext", event_movetext())
        day = F.replace("Date", F.lit("."), F.lit("-")).alias("day")
        for part, options in ((0, {}), (1, {"compression": "gzip"})):
            chosen = dated.filter(F.substring("Date", 9, 2).cast("int") % 3 == part)
            _pgn_text(chosen, day).write.mode("append").partitionBy("day").options(**options).text(path)
        # Dealt out by day as events, which are shorter than their texts.
        chosen = events(spark, sf_dir).withColumn("day", F.substring(F.col("ts").cast("string"), 1, 10))
        framed = _in_files(chosen.filter(F.substring("day", 9, 2).cast("int") % 3 == 2), "day")
        framed = _pgn_text(games_of(framed).withColumn("movetext", event_movetext()), day)
        written = framed.mapInArrow(partial(_write_frames, path=path), "n_frames long")
        written.write.format("noop").mode("overwrite").save()

    return land_once(spark, sf_dir, "frame-corpus", write)


FRAME_CHARS = 8192


def _write_frames(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Writes the texts of each day to an archive whose frames end every ``FRAME_CHARS`` bytes."""
    import zstandard
    from pyspark import TaskContext

    system, folder = pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    task, frames, day, archive, held = TaskContext.get(), 0, None, None, b""
    packer = zstandard.ZstdCompressor()
    name = f"part-{task.partitionId():05d}.zst"

    def close() -> None:
        if archive is not None:
            archive.write(packer.compress(held))
            archive.close()
            # Under its name only when whole, so that a repeated attempt replaces it.
            system.move(f"{folder}/day={day}/_{task.taskAttemptId()}", f"{folder}/day={day}/{name}")

    for batch in batches:
        for row in batch.to_pylist():
            if row["day"] != day:
                close()
                day, held = row["day"], b""
                system.create_dir(f"{folder}/day={day}")
                archive = system.open_output_stream(f"{folder}/day={day}/_{task.taskAttemptId()}")
            held += row["value"].encode() + b"\n"
            while len(held) >= FRAME_CHARS:
                archive.write(packer.compress(held[:FRAME_CHARS]))
                frames, held = frames + 1, held[FRAME_CHARS:]
    close()
    yield pa.RecordBatch.from_arrays([pa.array([frames], pa.int64())], names=["n_frames"])


def conversation_files(spark: SparkSession, sf_dir: str) -> str:
    """Conversation texts as movetext, wrapped in what the move scan must drop."""

    def write(path: str) -> None:
        turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
        # Each word becomes a move by its first character and length.
        words = F.array_join(F.transform(F.regexp_extract_all("text", F.lit(r"[^ \n\t]+"), F.lit(0)), lambda w: _square(
            F.ascii(w), F.length(w))), " ")
        fields = {f: F.lit("") for f in FIELD_TAGS} | {
            "White": F.col("conv_id").cast("string"), "Round": F.col("turn").cast("string"),
        }
        text = F.concat(
            F.lit("1. e2e4 { a note (not a move) } ( 1. b4 ( 1. c4 { d4 ) } ) 1... e5 ) $14 move "),
            words, F.lit(" 2... O-O-O!? 0000 ; rest of line (\n1/2-1/2"),
        )
        _pgn_text(turns.select(*[c.alias(f) for f, c in fields.items()], text.alias("movetext"))).write.text(path)

    return land_once(spark, sf_dir, "conversations", write)


def chunked_games(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    frame = games(spark, sf_dir, *keep)
    return assign_chunk(frame, game_count(events(spark, sf_dir)), CHUNKS)


def chunk_files(spark: SparkSession, sf_dir: str) -> str:
    """Event games as CSV chunks."""
    return land_once(spark, sf_dir, "chunks", lambda path: write_chunks(chunked_games(spark, sf_dir), path))


def message_topic(spark: SparkSession, sf_dir: str) -> Topic:
    """Event games as messages in a file-backed topic."""
    return file_topic(land_once(
        spark, sf_dir, "topic", lambda path: file_topic(path).write(encode_messages(spread(games(spark, sf_dir))))
    ))


class RefusingTopic:
    """Passes batches on to a topic, but refuses some of them."""

    def __init__(self, topic: Topic, refused: set[int | None]):
        self.topic, self.refused = topic, refused

    def write(self, messages: DataFrame, batch_id: int | None = None) -> None:
        if batch_id in self.refused:
            raise ConnectionError(f"batch {batch_id} refused")
        self.topic.write(messages, batch_id)
