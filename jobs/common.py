"""Arguments and sources shared by the jobs."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from txguard.sources import kafka


def parser(description: str) -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description=description)
    args.add_argument("--files", help="folder of text files with one JSON message per line, instead of Kafka")
    args.add_argument("--bootstrap-servers", default=kafka.BOOTSTRAP_SERVERS)
    args.add_argument("--topic", default=kafka.INPUT_TOPIC)
    args.add_argument("--output-topic", default=kafka.OUTPUT_TOPIC)
    args.add_argument("--security-protocol", default="PLAINTEXT")
    args.add_argument("--package", required=True, help="model package directory")
    args.add_argument("--rejects", help="quarantine directory")
    args.add_argument("--high-risk-merchants", nargs="*", help="merchants of the risk feature, the known ones unless given")
    return args


def settings(args: argparse.Namespace) -> kafka.KafkaSettings:
    """The login comes from the environment, never from the command line."""
    return kafka.KafkaSettings(
        args.bootstrap_servers,
        args.topic,
        args.output_topic,
        args.security_protocol,
        os.environ.get("KAFKA_USERNAME"),
        os.environ.get("KAFKA_PASSWORD"),
    )


def batch_messages(
    spark: SparkSession, args: argparse.Namespace, max_messages: int | None = None, keep: str = "oldest"
) -> DataFrame:
    """Stored messages; a cap is by broker time, which files do not have, so with files it is refused."""
    if args.files:
        if max_messages is not None:
            raise ValueError("--max-messages and --keep need the broker's time, files have none")
        return spark.read.text(args.files)
    return kafka.read_bounded(spark, settings(args), max_messages, keep)


def stream_messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return spark.readStream.text(args.files)
    return kafka.read_stream(spark, settings(args), max_offsets_per_trigger=args.max_offsets_per_trigger)
