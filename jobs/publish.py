"""Publish records of a table to the input topic; invalid ones go to a quarantine.

    spark-submit --packages <kafka connector> jobs/publish.py --table /data/records --rejects /data/invalid
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from jobs import common  # noqa: E402
from txguard.plans.ingest import from_table, outgoing  # noqa: E402
from txguard.session import get_session  # noqa: E402
from txguard.sources import kafka  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Publish records")
    args.add_argument("--table", required=True, help="Parquet table with the record fields")
    args.add_argument("--rejects", required=True, help="quarantine directory")
    args.add_argument("--messages", help="output directory; without it messages go to the input topic")
    args.add_argument("--bootstrap-servers", default=kafka.BOOTSTRAP_SERVERS)
    args.add_argument("--topic", default=kafka.INPUT_TOPIC)
    args.add_argument("--output-topic", default=kafka.OUTPUT_TOPIC)
    args.add_argument("--security-protocol", default="PLAINTEXT")
    options = args.parse_args(argv)

    spark = get_session("txguard-publish")
    messages, invalid = outgoing(from_table(spark.read.parquet(options.table)))
    invalid.write.mode("append").parquet(options.rejects)
    if options.messages:
        messages.write.mode("append").parquet(options.messages)
    else:
        kafka.publish(messages, common.settings(options))


if __name__ == "__main__":
    main()
