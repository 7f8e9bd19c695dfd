"""PGN text files as one row per game."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gameflow.functions import pgn
from gameflow.schema import FIELD_TAGS, MESSAGE_FIELDS
from gameflow.session import path_exists
from gameflow.sources.archives import FRAME_BYTES, index_frames, read_frames

FIRST_TAG = "Event"
PLACE_COLUMNS = ("source_path", "block_start")
#: Suffixes of files that one task must read whole.
UNSPLITTABLE = (".zst", ".gz", ".lz4", ".snappy", ".deflate", ".xz")


def read_records(
    spark: SparkSession, paths: str | Sequence[str], opening: str | None = FIRST_TAG, newline: str = "\n"
) -> DataFrame:
    """One row per game with its text and its place: ``record, source_path, block_start``.

    Splittable: the text source cuts at the line that opens the next game. That is a line with
    the tag ``opening``, in LF and CRLF files and after any number of blank lines. With
    ``opening=None`` games may open with any tag, also with different ones in one file; they are
    cut where a line with a tag follows an empty line, whose line ends must be ``newline``.
    A record that turns out not to be one game stops the query, also one that only counts records
    or reads their numbers: the check is a filter, which pruning of columns keeps.
    Compressed archives are read as they are, one task each; :func:`read_by_frame` splits them.
    """
    raw = (
        spark.read.option("lineSep", _separator(opening, newline))
        .text(paths if isinstance(paths, str) else list(paths))
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
    )
    return _records(raw, opening)


def read_by_frame(
    spark: SparkSession, paths: str | Sequence[str], opening: str | None = FIRST_TAG, newline: str = "\n",
    frame_bytes: int = FRAME_BYTES, only: Column | None = None, kept: str | None = None,
) -> tuple[DataFrame | None, DataFrame | None]:
    """Records as :func:`read_records` gives them, in two frames: those of files that the text source
    reads, and those of archives with several frames, a task for every ``frame_bytes`` packed bytes.

    Either is None if there are no such files. The archives are looked through when this is called;
    ``only`` is a condition on ``file_path`` that leaves archives unopened, not a filter on the rest;
    ``kept`` is a path for the index of frames, which a later call then uses as it is.
    """
    index, framed = index_frames(spark, paths, frame_bytes, only, kept)
    if not framed:
        return read_records(spark, paths, opening, newline), None
    split = {_plain(path) for path in framed}
    others = [path for path in list_files(spark, paths) if _plain(path) not in split]
    pieces = _records(read_frames(spark, index, _separator(opening, newline)), opening)
    return read_records(spark, others, opening, newline) if others else None, pieces


def _separator(opening: str | None, newline: str) -> str:
    return f"\n[{opening} " if opening else f"{newline}{newline}["


def _records(raw: DataFrame, opening: str | None) -> DataFrame:
    # A piece is a game if it starts with a tag (first in its file) or with what the separator
    # left of one; anything else is text before the first game.
    rest, lost = ('"', f"[{opening} ") if opening else (r'[^\s\["]+[ \t]+"', "[")
    games = raw.filter(F.col("value").rlike(rf"^[\s\x{{FEFF}}]*(?:\[|{rest})"))
    text = F.regexp_replace(F.replace(F.col("value"), F.lit("\r"), F.lit("")), r"^[\s\x{FEFF}]+", "")
    texts = games.select(text.alias("text"), "file_path", "file_block_start")
    record = F.when(F.startswith("text", F.lit("[")), F.col("text")).otherwise(F.concat(F.lit(lost), F.col("text")))
    # The check names the record many times. A filter cannot move below a generator, so the record
    # is made once and not again for each of these.
    records = texts.select("file_path", "file_block_start", F.inline(F.array(F.struct(record.alias("record")))))
    records = records.select("file_path", "file_block_start", F.inline(F.array(F.struct("record", pgn.movetext_start(F.col("record")).alias("start")))))
    return records.filter(pgn.one_game(F.col("record"), F.col("start"))).select(
        "record", F.col("file_path").alias("source_path"), F.col("file_block_start").alias("block_start"),
    )


def spread_archives(records: DataFrame) -> DataFrame:
    """Records of files that cannot be split, dealt out to all tasks before they are parsed.

    The conditions are on file names alone: each branch opens its own files only, and records of
    other files are parsed where they are read.
    """
    archived = F.lit(False)
    for suffix in UNSPLITTABLE:
        archived = archived | F.endswith("source_path", F.lit(suffix))
    return records.filter(~archived).union(records.filter(archived).hint("rebalance"))


def parse_records(
    records: DataFrame, defaults: Mapping[str, str] | None = None, keep: Iterable[str] = PLACE_COLUMNS
) -> DataFrame:
    """Header fields and main-line moves of each record; a missing tag gives its default or ''."""
    defaults = defaults or {}
    keep = list(keep)
    found = records.select(*keep, "record", pgn.movetext_start(F.col("record")).alias("start"))
    parts = found.select(
        *keep,
        "record",
        pgn.header_text(F.col("record"), F.col("start")).alias("header"),
    )
    tags = parts.select(
        *keep,
        "record",
        pgn.tag_names(F.col("header")).alias("names"),
        pgn.tag_values(F.col("header")).alias("values"),
    )
    fields = {
        field: pgn.tag_value(F.col("names"), F.col("values"), tag, defaults.get(tag, ""))
        for field, tag in FIELD_TAGS.items()
    }
    plain = tags.select(
        *keep,
        *[column.alias(field) for field, column in fields.items()],
        pgn.plain_movetext(F.col("record")).alias("plain"),
    )
    shallow = plain.select(*keep, *fields, pgn.without_shallow_variations(F.col("plain")).alias("plain"))
    # Deeper nesting takes a lambda, which is interpreted; a projection of its own leaves
    # the rest of the parsing in generated code.
    main = shallow.select(*keep, *fields, pgn.main_text(F.col("plain")).alias("main"))
    moves = pgn.main_moves(F.col("main")).alias("Moves")
    return main.select(*[moves if f == "Moves" else f for f in MESSAGE_FIELDS if f != "GameID"], *keep)


def read_games(
    spark: SparkSession, paths: str | Sequence[str], defaults: Mapping[str, str] | None = None,
    opening: str | None = FIRST_TAG, newline: str = "\n",
) -> DataFrame:
    return parse_records(read_records(spark, paths, opening, newline), defaults)


def read_corpus(
    spark: SparkSession,
    root: str,
    periods: Iterable[str] | None = None,
    period_pattern: str = r"(\d{4}-\d{2})",
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Games of a folder of dumps, with the ``period`` found in each file path.

    ``periods`` picks dumps; the condition is on file metadata alone, so Spark drops the
    other files when it lists the folder and never opens them. Archives of several frames
    are unpacked by a task for every ``frame_bytes`` packed bytes, others by one.
    """
    def period(path: str) -> Column:
        return F.regexp_extract(path, period_pattern, 1)

    chosen = None if periods is None else list(periods)
    only = None if chosen is None else period("file_path").isin(chosen)
    scanned, framed = read_by_frame(spark, root, frame_bytes=frame_bytes, only=only)

    def dated(records: DataFrame) -> DataFrame:
        records = records.withColumn("period", period("source_path"))
        return records if chosen is None else records.filter(F.col("period").isin(chosen))

    parts = [spread_archives(dated(scanned))] if scanned is not None else []
    if framed is not None:
        parts.append(dated(framed))
    return parse_records(reduce(DataFrame.union, parts), keep=(*PLACE_COLUMNS, "period"))


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    frame = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return [unquote(path) for path in sorted(frame.inputFiles())]


def _plain(path: str) -> str:
    """A path as it can be compared: decoded, with one slash after its scheme."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(path))


def files_between(
    spark: SparkSession, paths: str | Sequence[str], start: int, end: int,
    opening: str | None = FIRST_TAG, newline: str = "\n", index: str | None = None,
) -> tuple[list[str], int]:
    """The files, in path order, that hold the games at positions ``[start, end)``, and how many
    games lie before the first of them.

    Files are counted once, in groups of doubling length up to the one that reaches ``end``, so
    reaching into a large corpus costs one small job per doubling and leaves the rest unread. With
    ``index``, a folder, counts are kept there; a file with the length and the time of change it
    had then is not opened again.
    """
    files = list_files(spark, paths)
    known, states = known_counts(spark, files, index, _rule(opening, newline)) if index else ({}, {})
    chosen, before, seen, taken, step = [], 0, 0, 0, 1
    while taken < len(files) and seen < end:
        group = files[taken:taken + step]
        missing = [file for file in group if _plain(file) not in known]
        if missing:
            found = {
                _plain(r["source_path"]): r["count"] for r in read_records(spark, missing, opening, newline).groupBy("source_path").count().collect()
            }
            fresh = {_plain(file): found.get(_plain(file), 0) for file in missing}
            known |= fresh
            if index:
                keep_counts(spark, fresh, states, index, _rule(opening, newline))
        for file in group:
            n = known[_plain(file)]
            if seen < end and seen + n > start:
                chosen.append(file)
            elif not chosen:
                before += n
            seen += n
        taken += len(group)
        step *= 2
    return (chosen, before) if chosen else (files[:1], 0)


_COUNTS = "path string, length long, changed timestamp, rule string, games long"


def _rule(opening: str | None, newline: str) -> str:
    return f"{opening} {newline!r}"


def file_states(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, tuple[int, datetime]]:
    """Length and time of the last change of each file, without opening any."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return {_plain(r["path"]): (r["length"], r["modificationTime"]) for r in files.select("path", "length", "modificationTime").collect()}


def known_counts(
    spark: SparkSession, files: Sequence[str], index: str, rule: str
) -> tuple[dict[str, int], dict[str, tuple[int, datetime]]]:
    """Games by file, of files that are as they were when counted by this rule, and the states of all."""
    states = file_states(spark, files)
    folder = f"{index}/counts"
    rows = spark.read.schema(_COUNTS).json(folder).where(F.col("rule") == rule).collect() if path_exists(spark, folder) else []
    return {r["path"]: r["games"] for r in rows if states.get(r["path"]) == (r["length"], r["changed"])}, states


def keep_counts(spark: SparkSession, counts: Mapping[str, int], states: Mapping[str, tuple[int, datetime]], index: str, rule: str) -> None:
    rows = [(path, *states[path], rule, games) for path, games in counts.items()]
    spark.createDataFrame(rows, _COUNTS).coalesce(1).write.mode("append").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{index}/counts")


def layout_key(spark: SparkSession, paths: str | Sequence[str], *rule: object) -> str:
    """A name for the way a scan of these files is cut into tasks: files, their states and all settings it depends on."""
    settings = {name: spark.conf.get(name, None) for name in (
        "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum",
        "spark.sql.files.maxPartitionNum", "spark.sql.leafNodeDefaultParallelism",
    )}
    states = sorted((path, length, str(changed)) for path, (length, changed) in file_states(spark, paths).items())
    known = [states, sorted(settings.items()), spark.sparkContext.defaultParallelism, rule]
    return hashlib.sha256(json.dumps(known, default=str).encode()).hexdigest()
