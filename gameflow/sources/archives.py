"""Compressed archives of several frames, read by many tasks.

A zstd or gzip file may hold frames one after the other, as parallel and seekable compressors write
them. Each frame can be unpacked on its own, so a task can start at any of them. Two Spark jobs use
that: the first looks through byte ranges of the archives for the first frame in each, the second
unpacks from frame to frame and cuts the text at a separator, wherever that lies.
"""

from __future__ import annotations

import io
import json
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gameflow.session import path_exists, scratch_folders, scratch_path

#: Packed bytes for a task. Archives up to this size are left to one task without a search.
FRAME_BYTES = 64 << 20
#: A place that looks like a frame counts as one if this many packed bytes from there unpack.
TRIAL_BYTES = 1 << 20
READ_BYTES = 1 << 18
BATCH_CHARS = 4 << 20
#: Schemes of file systems that tasks can open by themselves; archives elsewhere are read whole.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}

# The first bytes of frames, as RFC 8878 and RFC 1952 give them.
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
ZSTD_SKIPPABLE = b"\x2a\x4d\x18"  # after a byte 0x50 to 0x5f
GZIP_MAGIC = b"\x1f\x8b\x08"
MAGICS = {".zst": ZSTD_MAGIC, ".gz": GZIP_MAGIC}


def _suffix(path: str) -> str:
    return path[path.rindex("."):]


def _open(path: str) -> pa.NativeFile:
    scheme, rest = path.split(":", 1)
    system, name = pyarrow.fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")
    return system.open_input_file(name)


def _unpacker(suffix: str):
    if suffix == ".gz":
        return zlib.decompressobj(wbits=31)
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj()


def _skippable(head: bytes) -> bool:
    return head[1:4] == ZSTD_SKIPPABLE and 0x50 <= head[0] <= 0x5F


def _opens_frame(head: bytes, suffix: str) -> bool:
    return head.startswith(MAGICS[suffix]) or (suffix == ".zst" and _skippable(head))


def is_frame(packed: bytes, suffix: str, at_end: bool) -> bool:
    """Whether a frame begins here: the bytes unpack, to their end or to the next frame."""
    unpacker = _unpacker(suffix)
    try:
        unpacker.decompress(packed)
    except Exception as problem:  # zlib.error or zstandard.ZstdError, by suffix
        if type(problem).__name__ not in ("error", "ZstdError"):
            raise
        return False
    if not unpacker.eof:
        return not at_end
    rest = unpacker.unused_data.lstrip(b"\0") if suffix == ".gz" else unpacker.unused_data
    return not rest or len(rest) < 4 or _opens_frame(rest, suffix)


def first_frame(file, start: int, end: int, size: int, suffix: str) -> int | None:
    """Place of the first frame that begins in ``[start, end)``."""
    magic, at, held = MAGICS[suffix], start, b""
    while at < end:
        file.seek(at)
        held = file.read(min(READ_BYTES, end - at) + len(magic) - 1)
        found = held.find(magic)
        while found >= 0:
            file.seek(at + found)
            if is_frame(file.read(TRIAL_BYTES), suffix, at + found + TRIAL_BYTES >= size):
                return at + found
            found = held.find(magic, found + 1)
        at += READ_BYTES
    return None


def unpack(file, start: int, end: int, suffix: str) -> Iterator[tuple[bytes, bool]]:
    """Text from the frame at ``start`` to the end of the file, in pieces, and whether the frame
    of a piece begins before ``end``. A frame that is cut off is an error."""
    at, held = start, b""
    file.seek(start)
    while True:
        more = True
        while more and len(held) < 8:
            more = file.read(READ_BYTES)
            held += more
            if suffix == ".gz":  # padding between members
                kept = held.lstrip(b"\0")
                at, held = at + len(held) - len(kept), kept
        if not held:
            return
        if suffix == ".zst" and _skippable(held):
            length = 8 + int.from_bytes(held[4:8], "little")
            at, held = at + length, held[length:]
            if not held:
                file.seek(at)
            continue
        own, unpacker = at < end, _unpacker(suffix)
        while not unpacker.eof:
            held = held or file.read(READ_BYTES)
            if not held:
                raise EOFError(f"the archive ends within the frame that begins at byte {at}")
            text = unpacker.decompress(held)
            at, held = at + len(held) - len(unpacker.unused_data), unpacker.unused_data
            if unpacker.eof and suffix == ".gz":
                kept = held.lstrip(b"\0")
                at, held = at + len(held) - len(kept), kept
            if text:
                yield text, own


def cut(texts: Iterator[tuple[bytes, bool]], separator: bytes, first: bool) -> Iterator[bytes]:
    """Pieces between separators. A piece belongs to the range in which the separator before it
    begins, the first of a file to the first range; its text may go on into later frames."""
    held, scanned, base, limit, open_piece = b"", 0, 0, None, first
    for text, own in texts:
        if limit is None and not own:
            limit = base + len(held)
        held += text
        start = 0
        while (at := held.find(separator, max(start, scanned))) >= 0:
            if open_piece:
                yield held[start:at]
            if limit is not None and base + at >= limit:
                return
            open_piece, start = True, at + len(separator)
        if not open_piece:
            if limit is not None and base + len(held) - len(separator) + 1 > limit:
                return  # no separator began in this range
            start = max(0, len(held) - len(separator) + 1)
        held, base = held[start:], base + start
        scanned = max(0, len(held) - len(separator) + 1)
    if open_piece:
        yield held


@dataclass
class Ranges(InputPartition):
    """Frames that begin in ``[start, end)`` of an archive, for each ``(path, start, end)``."""

    ranges: list[tuple[str, int, int]]


def dealt(ranges: Sequence[tuple[str, int, int]], tasks: int) -> list[list[tuple[str, int, int]]]:
    """Ranges, in order, as what each task reads: small ones together, as Spark deals small files, up to
    ``FRAME_BYTES`` or the share of one of ``tasks``. Neighbours in an archive become one range."""
    most = min(FRAME_BYTES, sum(end - start for _, start, end in ranges) / tasks)
    found, held = [], 0
    for path, start, end in ranges:
        if not found or held + end - start > most:
            found.append([])
            held = 0
        held += end - start
        if found[-1] and found[-1][-1][::2] == (path, start):
            start = found[-1].pop()[1]
        found[-1].append((path, start, end))
    return found


SCHEMA = "value string, file_path string, file_block_start long"


class FrameReader(DataSourceReader):
    def __init__(self, index: str, separator: str, tasks: int):
        self.index, self.separator, self.tasks = index, separator.encode(), tasks

    def partitions(self) -> Sequence[InputPartition]:
        system, folder = pyarrow.fs.FileSystem.from_uri(self.index if "://" in self.index else f"file://{self.index}")
        rows = []
        for info in system.get_file_info(pyarrow.fs.FileSelector(folder)):
            if info.base_name.endswith(".json"):
                with system.open_input_stream(info.path) as lines:
                    rows += map(json.loads, io.TextIOWrapper(lines, "utf-8"))
        ranges = sorted((r["file_path"], r["start"], r["end"]) for r in rows)
        return [Ranges(own) for own in dealt(ranges, self.tasks)]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for path, start, end in partition.ranges:
            with _open(path) as file:
                values, chars = [], 0
                for piece in cut(unpack(file, start, end, _suffix(path)), self.separator, start == 0):
                    values.append(piece.decode("utf-8", "replace"))
                    chars += len(piece)
                    if chars >= BATCH_CHARS:
                        yield self._batch(values, path, start)
                        values, chars = [], 0
                if values:
                    yield self._batch(values, path, start)

    def _batch(self, values: list[str], path: str, start: int) -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [pa.array(values, pa.string()), pa.array([path] * n, pa.string()), pa.array([start] * n, pa.int64())],
            names=["value", "file_path", "file_block_start"],
        )


class FrameSource(DataSource):
    """Pieces of archives between separators, a partition for one range of the index or several small ones."""

    @classmethod
    def name(cls) -> str:
        return "archive_frames"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FrameReader(self.options["index"], self.options["separator"], int(self.options["tasks"]))


def index_frames(
    spark: SparkSession, paths: str | Sequence[str], frame_bytes: int = FRAME_BYTES, only: Column | None = None,
    kept: str | None = None,
) -> tuple[str, list[str]]:
    """An index of places at which tasks can begin to unpack, and the archives it covers.

    The folder named first holds ``file_path, start, end`` for each range of frames, one for every
    ``frame_bytes`` of an archive at most, however many frames there are; so it has as many rows
    as a scan of the packed files has splits. Each range of bytes is looked through by a task of
    its own. An archive in which no frame but the first is found is not in the index: one task
    must unpack it. ``only`` is a condition on ``file_path``; other archives are not opened.
    ``kept`` is the folder to write to; if it is there already, nothing is searched.
    """
    index = kept or scratch_path(spark, "frame-index")
    if path_exists(spark, f"{index}/_SUCCESS"):
        return index, _covered(spark, index)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*{.zst,.gz}").load(
        paths if isinstance(paths, str) else list(paths)
    ).select("_metadata.file_path", "length")
    if only is not None:
        files = files.filter(only)
    scheme = F.substring_index("file_path", ":", 1)
    large = files.filter((F.col("length") > frame_bytes) & scheme.isin(*SCHEMES))
    ranges = large.select(
        "file_path", "length", F.explode(F.sequence(F.lit(frame_bytes).cast("long"), F.col("length") - 1, F.lit(frame_bytes).cast("long"))).alias("at")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                path, at, size = row["file_path"], row["at"], row["length"]
                with _open(path) as file:
                    start = first_frame(file, at, min(at + frame_bytes, size), size, _suffix(path))
                if start is not None:
                    found.append((path, start, size))
            if found:
                columns = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["file_path", "start", "length"])

    tasks = 4 * spark.sparkContext.defaultParallelism
    found = ranges.repartition(tasks, "file_path", "at").mapInArrow(search, "file_path string, start long, length long")
    with scratch_folders(spark, "frame-starts") as [starts]:
        found.write.parquet(starts)
        later = spark.read.parquet(starts)
        every = later.union(later.select("file_path", F.lit(0).cast("long"), "length").distinct())
        # Ranges of bytes do not overlap, so no start of a file is found twice.
        every.selectExpr(
            "file_path", "start", "lead(start, 1, length) OVER (PARTITION BY file_path ORDER BY start) AS end"
        ).write.mode("overwrite").json(index)
    return index, _covered(spark, index)


def _covered(spark: SparkSession, index: str) -> list[str]:
    rows = spark.read.schema("file_path string").json(index).distinct().collect()
    return sorted(row["file_path"] for row in rows)


def read_frames(spark: SparkSession, index: str, separator: str) -> DataFrame:
    """``value, file_path, file_block_start``: pieces between separators, in the order of the text within a task.

    Bytes that are no UTF-8 become U+FFFD.
    """
    spark.dataSource.register(FrameSource)
    tasks = str(4 * spark.sparkContext.defaultParallelism)
    return spark.read.format(FrameSource.name()).options(index=index, separator=separator, tasks=tasks).load()
