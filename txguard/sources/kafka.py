"""Kafka source and sink. Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txguard.operators.cap import cap_rows

# Addresses, topics, row cap and producer batching used when none are given.
BOOTSTRAP_SERVERS = "kafka:29092"
INPUT_TOPIC = "transactions"
OUTPUT_TOPIC = "fraud_predictions"
CHECKPOINT = "checkpoints/checkpoint_v2"
MAX_MESSAGES = 100_000
PRODUCER = {"kafka.compression.type": "gzip", "kafka.linger.ms": "5", "kafka.batch.size": "16384"}

PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


@dataclass(frozen=True)
class KafkaSettings:
    bootstrap_servers: str = BOOTSTRAP_SERVERS
    topic: str = INPUT_TOPIC
    output_topic: str = OUTPUT_TOPIC
    security_protocol: str = "PLAINTEXT"
    username: str | None = None
    password: str | None = None


def connection_options(settings: KafkaSettings) -> dict[str, str]:
    """Servers and, where the protocol asks for it, the login; shared by both reads and the sink."""
    servers = [server.strip() for server in settings.bootstrap_servers.split(",")]
    options = {
        "kafka.bootstrap.servers": ",".join(server for server in servers if server),
        "kafka.security.protocol": settings.security_protocol,
    }
    if settings.security_protocol == "SASL_SSL":
        if not settings.username or settings.password is None:
            raise ValueError("SASL_SSL needs a user name and a password")
        options["kafka.sasl.mechanism"] = "PLAIN"
        options["kafka.sasl.jaas.config"] = (
            f'{PLAIN_LOGIN} required username="{_escaped(settings.username)}" password="{_escaped(settings.password)}";'
        )
    return options


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"')


def stream_options(
    settings: KafkaSettings, max_offsets_per_trigger: int | None = None, min_partitions: int | None = None
) -> dict[str, str]:
    """New messages only; expired offsets are not an error."""
    options = {
        **connection_options(settings),
        "subscribe": settings.topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def batch_options(settings: KafkaSettings, min_partitions: int | None = None) -> dict[str, str]:
    """Everything stored at the time of the read. Nothing is committed to the broker."""
    options = {
        **connection_options(settings),
        "subscribe": settings.topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(settings: KafkaSettings, topic: str | None = None) -> dict[str, str]:
    return {**connection_options(settings), **PRODUCER, "topic": topic or settings.output_topic}


def read_stream(spark: SparkSession, settings: KafkaSettings, **limits) -> DataFrame:
    return spark.readStream.format("kafka").options(**stream_options(settings, **limits)).load()


def read_bounded(
    spark: SparkSession, settings: KafkaSettings, max_messages: int | None = None, keep: str = "oldest", **limits
) -> DataFrame:
    """All stored messages, or the ``max_messages`` oldest or newest by broker time.

    A cap reads the topic several times, so its end is fixed first: messages that arrive meanwhile
    are in none of the passes.
    """

    def read(options: dict[str, str]) -> DataFrame:
        return spark.read.format("kafka").options(**options).load()

    options = batch_options(settings, **limits)
    if max_messages is None:
        return read(options)
    messages = read(options)
    ends = {row.partition: row.end for row in _reached(messages).collect()}
    if not ends:
        return messages.limit(0)
    pinned = {name: value for name, value in options.items() if name != "subscribe"}
    pinned["assign"] = json.dumps({settings.topic: sorted(ends)})
    pinned["endingOffsets"] = json.dumps({settings.topic: {str(partition): end for partition, end in ends.items()}})
    return cap_rows(read(pinned), max_messages, ["timestamp", "partition", "offset"], keep)


def _reached(messages: DataFrame) -> DataFrame:
    """The offset behind the last message of every partition that has any, one row for each."""
    return messages.groupBy("partition").agg((F.max("offset") + 1).alias("end"))


def publish(messages: DataFrame, settings: KafkaSettings, topic: str | None = None) -> None:
    """Batch publish of key/value messages (raw transactions go to the input topic)."""
    messages.write.format("kafka").options(**sink_options(settings, topic or settings.topic)).save()


def alert_writer(messages: DataFrame, settings: KafkaSettings, checkpoint: str = CHECKPOINT) -> DataStreamWriter:
    """Append-mode stream writer to the output topic, not yet started."""
    return (
        messages.writeStream.format("kafka")
        .options(**sink_options(settings))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
