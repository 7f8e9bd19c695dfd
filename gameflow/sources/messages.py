"""Message topics: a Kafka topic, or a folder with the same columns where Kafka is absent."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gameflow.functions.codec import encode_payload
from gameflow.schema import TOPIC_COLUMNS, TOPIC_SCHEMA
from gameflow.session import delete_path, list_paths, move_path, path_exists, touch

# Delivery settings of the message producers.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.retry.backoff.ms": "5000",
    "kafka.request.timeout.ms": "10000",
    "kafka.delivery.timeout.ms": "60000",
    "kafka.linger.ms": "1000",
    "kafka.batch.size": "16384",
}


@dataclass(frozen=True)
class Topic:
    """Where messages are read from and written to; the format and options are Spark's own."""

    format: str
    read_options: Mapping[str, str] = field(default_factory=dict)
    write_options: Mapping[str, str] = field(default_factory=dict)

    def _reader(self, reader):
        if self.format != "kafka":
            reader = reader.schema(TOPIC_SCHEMA)
        return reader.format(self.format).options(**self.read_options)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._reader(spark.read).load().select(*TOPIC_COLUMNS)

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return self._reader(spark.readStream).load().select(*TOPIC_COLUMNS)

    def write(self, messages: DataFrame, batch_id: int | None = None) -> None:
        """Appends messages. A folder stores the time of sending with them, one for each write, as
        Kafka does for each message.

        Rows may name their own ``topic`` and ``partition``; Kafka puts each where it says, and a row
        without a topic into this one. A folder is one topic and stores the partition; files are
        moved into it when they are finished, so that several writers do not disturb each other.
        """
        if self.format == "kafka":
            self._frame(messages).write.format(self.format).options(**self.write_options).mode("append").save()
            return
        spark, path = messages.sparkSession, self.write_options["path"]
        staged = f"{path}/_staged/{uuid.uuid4().hex}"
        try:
            self._frame(messages).write.format(self.format).save(staged)
            self._moved_in(spark, staged, "")
        finally:
            delete_path(spark, staged)

    def _moved_in(self, spark: SparkSession, staged: str, prefix: str) -> None:
        for file in list_paths(spark, f"{staged}/part-*"):
            move_path(spark, file, f"{self.write_options['path']}/{prefix}{file.rsplit('/', 1)[1]}")

    def _frame(self, messages: DataFrame) -> DataFrame:
        if self.format == "kafka":
            routed = {
                "topic": F.coalesce("topic", F.lit(self.write_options["topic"])) if "topic" in messages.columns else None,
                "partition": F.col("partition").cast("int") if "partition" in messages.columns else None,
            }
            return messages.select("value", *[c.alias(name) for name, c in routed.items() if c is not None])
        partition = F.col("partition").cast("int") if "partition" in messages.columns else F.lit(0)
        return messages.select(
            "value", F.coalesce(partition, F.lit(0)).alias("partition"), "offset", F.current_timestamp().alias("timestamp")
        )

    def write_once(self, messages: DataFrame, name: str) -> None:
        """Appends messages that are known by ``name``; a repetition of the call adds nothing.

        A folder gets them by moving finished files: first all are written beside the topic, then
        moved into it one by one, then the name is noted down. A call that was stopped in between is
        taken up where it stopped. Kafka has no such step, so a repetition there sends them again.
        """
        if self.format == "kafka":
            self.write(messages)
            return
        spark, path = messages.sparkSession, self.write_options["path"]
        staged, done = f"{path}/_staged/{name}", f"{path}/_sent/{name}"
        if path_exists(spark, done):
            return
        if not path_exists(spark, f"{staged}/_SUCCESS"):
            self._frame(messages).write.format(self.format).mode("overwrite").save(staged)
        self._moved_in(spark, staged, f"{name}-")
        touch(spark, done)
        delete_path(spark, staged)


def kafka_topic(
    servers: str, topic: str, producer: Mapping[str, str] | None = None, **options: str
) -> Topic:
    """A Kafka topic, read from its first offset; the client fails over along ``servers``.

    ``options`` that begin with ``kafka.`` (such as security settings) go to reader and writer,
    others (``maxOffsetsPerTrigger``, ``minPartitions``) to the reader. ``producer`` adds to or
    replaces delivery settings of the writer.
    """
    broker = {"kafka.bootstrap.servers": servers}
    shared = {k: v for k, v in options.items() if k.startswith("kafka.")}
    return Topic(
        "kafka",
        {**broker, "subscribe": topic, "startingOffsets": "earliest", **options},
        {**broker, "topic": topic, **PRODUCER_OPTIONS, **shared, **(producer or {})},
    )


def file_topic(path: str, **options: str) -> Topic:
    return Topic("parquet", {"path": path, **options}, {"path": path})


def encode_messages(games: DataFrame, offset: str = "GameID") -> DataFrame:
    """Keyless messages: the row as JSON, plus the place in the topic a file-backed one needs.

    ``offset`` orders the messages of one write; between writes the time of sending does. Where
    the games carry a ``topic`` or a ``partition``, the messages do too and are sent there.
    """
    routed = [c for c in ("topic", "partition") if c in games.columns]
    return games.select(
        encode_payload().alias("value"), F.col(offset).try_cast("bigint").alias("offset"), *routed
    )
