"""Streaming queries. Each takes a stream and a checkpoint and returns the started query."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gameflow.functions.codec import decode_payload
from gameflow.operators.decode import select_games, to_table_types
from gameflow.schema import GAME_COLUMNS, MESSAGE_FIELDS, SENT_ORDER
from gameflow.session import scratch_folders
from gameflow.sources.dead_letters import stream_letters, write_letter
from gameflow.sources.messages import encode_messages

log = logging.getLogger(__name__)

# Runs through what is there and stops; leave the trigger out to run until stopped.
AVAILABLE_NOW = {"availableNow": True}


def _start(writer, trigger: dict[str, Any] | None) -> StreamingQuery:
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_batches(
    frame: DataFrame, handle: Callable[[DataFrame, str, int], None], checkpoint: str,
    trigger: dict[str, Any] | None, output_mode: str = "append",
) -> StreamingQuery:
    """``handle(batch, query_id, batch_id)`` for each batch.

    The query id lives in the checkpoint: a restart keeps it, a fresh checkpoint gets a new
    one. Named by both ids, what a batch writes is replaced by its own repetition only.
    """
    started, known = [], threading.Event()

    def each(batch: DataFrame, batch_id: int) -> None:
        known.wait()
        handle(batch, started[0].id, batch_id)

    writer = frame.writeStream.outputMode(output_mode).foreachBatch(each)
    try:
        started.append(_start(writer.option("checkpointLocation", checkpoint), trigger))
    finally:
        known.set()
    return started[0]


def start_selection(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Decoded, typed games appended to a parquet folder, each message exactly once."""
    games = to_table_types(select_games(messages))
    writer = games.writeStream.format("parquet").outputMode("append")
    return _start(writer.options(path=path, checkpointLocation=checkpoint), trigger)


def start_upsert(
    messages: DataFrame, table, checkpoint: str, trigger: dict[str, Any] | None = None, rejects: str | None = None
) -> StreamingQuery:
    """Games into a keyed table, latest write wins.

    Rows whose key is no number are not stored in the table. The query's progress reports how
    many there were under the metric name ``upsert``; with ``rejects`` they are kept as JSON below
    that folder, with their key as it came.
    """
    carry = [*SENT_ORDER, "key_text"]
    games = select_games(messages, carry=SENT_ORDER).withColumn("key_text", F.col("gameid"))
    games = to_table_types(games, carry=carry).withColumn("written_at", F.current_timestamp()).observe(
        "upsert",
        F.count("*").alias("n_rows"),
        F.count_if(F.col("gameid").isNull()).alias("n_rejected"),
    )

    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        table.write_batch(batch.filter(F.col("gameid").isNotNull()), query_id, batch_id)
        if rejects:
            bad = batch.filter(F.col("gameid").isNull()).drop("gameid")
            bad.write.mode("overwrite").json(f"{rejects}/run={query_id}/batch_id={batch_id}")

    return start_batches(games, write, checkpoint, trigger)


def start_changes(
    messages: DataFrame, table, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Games into a keyed table, but only those whose latest version a batch has changed.

    The query's state holds the latest version of each game, by time of sending and place in the
    topic. A message that comes late and is older, or comes again, changes nothing and writes nothing,
    so the table grows with changes and not with messages. Rows whose key is no number are left out.
    The state grows with the games; keep it in RocksDB (``spark.sql.streaming.stateStore.providerClass``)
    when they do not fit into memory.
    """
    games = to_table_types(select_games(messages, carry=SENT_ORDER), carry=SENT_ORDER).filter("gameid is not null")
    games = games.withColumn("written_at", F.current_timestamp())
    # Of equal versions the one that came first stays.
    version = [*SENT_ORDER, (-F.unix_micros("written_at")).alias("earlier"), "written_at"]
    latest = games.groupBy("gameid").agg(F.max(F.struct(*version, *[c for c in GAME_COLUMNS if c != "gameid"])).alias("latest"))
    changed = latest.select("gameid", "latest.*").filter(F.col("written_at") == F.current_timestamp()).drop("earlier")

    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        table.write_batch(batch, query_id, batch_id)

    return start_batches(changed, write, checkpoint, trigger, "update")


def start_replay(
    spark: SparkSession, dead_letters: str, topic, checkpoint: str, archive: str, rejects: str,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Sends dead letters again as they come, each once.

    The checkpoint knows which letters were taken, and a batch that is repeated after a crash
    adds nothing to a folder topic (:meth:`gameflow.sources.messages.Topic.write_once`), wherever the
    crash was. Letters that were sent are moved below ``archive`` by a later batch or run. What is no
    record is kept as text below ``rejects``, and the rest of its letter is sent.
    """

    def send(batch: DataFrame, query_id: str, batch_id: int) -> None:
        topic.write_once(encode_messages(batch.filter("_bad is null")), f"replay-{query_id}-{batch_id}")
        bad = batch.filter("_bad is not null").select("_bad")
        if not bad.isEmpty():
            log.warning("letters of batch %s hold text that is no record", batch_id)
            bad.write.mode("overwrite").text(f"{rejects}/run={query_id}/batch_id={batch_id}")

    return start_batches(stream_letters(spark, dead_letters, archive), send, checkpoint, trigger)


def start_count(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Running count of the messages seen and of those with a key; one row, replaced per batch."""
    counts = decode_payload(messages, fields=["GameID"]).agg(
        F.count("*").alias("n"), F.count("GameID").alias("n_keyed")
    )

    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(path)

    return start_batches(counts, write, checkpoint, trigger, "complete")


def start_delivery(
    games: DataFrame, topic, dead_letters: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Sends games batch by batch. A batch the topic refuses is saved whole as a dead
    letter and the query goes on; if saving fails too, the checkpoint repeats the batch.

    Each batch is read and stored before it is sent, so an error of the source is not taken for
    a refusal but ends the query.
    """

    def send(batch: DataFrame, query_id: str, batch_id: int) -> None:
        batch = batch.select(*MESSAGE_FIELDS)
        with scratch_folders(batch.sparkSession, "delivery") as [path]:
            batch.write.parquet(path)
            landed = batch.sparkSession.read.schema(batch.schema).parquet(path)
            try:
                topic.write(encode_messages(landed), batch_id)
            except Exception as problem:
                log.warning("batch %s was not sent: %s", batch_id, problem)
                write_letter(landed, dead_letters, "batch", f"{batch_id}_{query_id}")

    return start_batches(games, send, checkpoint, trigger)
