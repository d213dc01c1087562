"""Score stored messages with a package and write the alerts.

    spark-submit jobs/score_batch.py --files /data/messages --package /models/fraud/<run> --alerts /data/alerts
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from jobs import common  # noqa: E402
from txguard.operators.featurize import add_features  # noqa: E402
from txguard.operators.scoring import apply_threshold, score_with_model  # noqa: E402
from txguard.plans.ingest import route  # noqa: E402
from txguard.plans.scoring import alerts  # noqa: E402
from txguard.session import get_session  # noqa: E402
from txguard.sources import kafka  # noqa: E402
from txguard.sources.package import load_package  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    args = common.parser("Score stored messages")
    args.add_argument("--alerts", help="output directory; without it alerts go to the output topic")
    options = args.parse_args(argv)

    spark = get_session("txguard-score-batch")
    loaded = load_package(spark, options.package)
    loaded.require_same_list(options.high_risk_merchants)
    clean, rejects = route(common.batch_messages(spark, options), for_training=False)
    if options.rejects:
        rejects.write.mode("append").parquet(options.rejects)
    scored = apply_threshold(score_with_model(add_features(clean, loaded.high_risk), loaded.model), loaded.threshold)
    if options.alerts:
        alerts(scored).write.mode("append").parquet(options.alerts)
    else:
        kafka.publish(alerts(scored), common.settings(options), options.output_topic)


if __name__ == "__main__":
    main()
