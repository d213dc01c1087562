"""Score a stream of messages; alerts to Kafka or files, unusable messages to a quarantine.

    spark-submit --packages <kafka connector> jobs/score_stream.py --package /models/fraud/<run> \
        --checkpoint /state/alerts --rejects /data/rejects
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql.streaming import StreamingQuery  # noqa: E402

from jobs import common  # noqa: E402
from txguard.plans.scoring import alerts, model_scorer, score_messages  # noqa: E402
from txguard.session import get_session  # noqa: E402
from txguard.sources import kafka  # noqa: E402
from txguard.sources.package import load_package  # noqa: E402
from txguard.streaming.delivery import Delivery  # noqa: E402
from txguard.streaming.sinks import ProgressLog, file_writer, reject_stream  # noqa: E402

SCORING = "scoring"


def main(argv: list[str] | None = None) -> list[StreamingQuery]:
    args = common.parser("Score a stream of messages")
    args.add_argument("--checkpoint", required=True, help="folder that every executor reaches")
    args.add_argument("--alerts", help="output directory; without it alerts go to the output topic")
    args.add_argument("--deliver", help="directory for alerts, rejects and counts from one parse, each row once, instead")
    args.add_argument("--exclude", nargs="*", default=[], help="columns left out of the alerts, such as is_fraud")
    args.add_argument("--max-offsets-per-trigger", type=int)
    args.add_argument("--progress", help="directory of the progress table, one row for each batch")
    args.add_argument("--available-now", action="store_true", help="process what is there and stop")
    options = args.parse_args(argv)

    spark = get_session("txguard-score-stream")
    loaded = load_package(spark, options.package)
    loaded.require_same_list(options.high_risk_merchants)
    messages = common.stream_messages(spark, options)
    if options.deliver:
        out = Delivery(spark, options.deliver, model_scorer(loaded.model), loaded.threshold, loaded.high_risk, options.exclude)
        writer = out.writer(messages, options.checkpoint).queryName(SCORING)
        running = (writer.trigger(availableNow=True) if options.available_now else writer).start()
        running.awaitTermination()
        return [running]
    scored = score_messages(messages, model_scorer(loaded.model), loaded.threshold, loaded.high_risk, counted=True)
    found = alerts(scored, options.exclude)
    if options.alerts:
        writers = [file_writer(found, options.alerts, options.checkpoint)]
    else:
        writers = [kafka.alert_writer(found, common.settings(options), options.checkpoint)]
    if options.rejects:
        writers.append(file_writer(reject_stream(messages), options.rejects, f"{options.checkpoint}-rejects"))

    if options.available_now:
        writers = [writer.trigger(availableNow=True) for writer in writers]
    log = ProgressLog(spark, options.progress, SCORING) if options.progress else None
    running = [writer.start() for writer in [writers[0].queryName(SCORING), *writers[1:]]]
    # the first stream that ends, well or not, ends the wait; a failed one raises here
    while any(query.isActive for query in running):
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
    for query in running:
        query.awaitTermination()
    if log:
        log.table(running[0])
        log.close()
    return running


if __name__ == "__main__":
    main()
