"""Train from stored messages: package, quarantine and run log.

    spark-submit jobs/train.py --files /data/messages --package /models/fraud --runs /models/runs
"""

from __future__ import annotations

import sys
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from jobs import common  # noqa: E402
from txguard.functions.features import HIGH_RISK_MERCHANTS  # noqa: E402
from txguard.plans import training  # noqa: E402
from txguard.plans.ingest import route  # noqa: E402
from txguard.session import get_session  # noqa: E402
from txguard.sources import kafka, package, run_log  # noqa: E402


def main(argv: list[str] | None = None) -> training.Trained:
    args = common.parser("Train the fraud model")
    args.add_argument("--runs", required=True, help="run log directory")
    args.add_argument("--model-name", default="fraud_model")
    args.add_argument("--max-messages", type=int, help=f"row cap of the Kafka read, {kafka.MAX_MESSAGES} unless given, 0 for none")
    args.add_argument("--keep", choices=["oldest", "newest"], default="oldest")
    args.add_argument("--seed", type=int, default=training.SEED)
    args.add_argument("--n-iter", type=int, default=training.N_ITER)
    args.add_argument("--folds", type=int, default=training.FOLDS)
    args.add_argument("--parallelism", type=int, default=training.PARALLELISM)
    args.add_argument("--test-share", type=float, default=training.TEST_SHARE)
    args.add_argument("--exact-split", action="store_true", help="exact class counts in every part")
    args.add_argument("--max-locations", type=int, default=training.MAX_LOCATIONS, help="locations the model may hold a slot for")
    args.add_argument("--max-trees", type=int, help="leave longer ensembles out of the search")
    options = args.parse_args(argv)

    spark = get_session("txguard-train")
    limit = options.max_messages
    if limit is None:
        limit = 0 if options.files else kafka.MAX_MESSAGES
    clean, rejects = route(common.batch_messages(spark, options, limit or None, options.keep))
    if options.rejects:
        rejects.write.mode("append").parquet(options.rejects)

    high_risk = HIGH_RISK_MERCHANTS if options.high_risk_merchants is None else options.high_risk_merchants
    space = dict(training.SEARCH_SPACE)
    if options.max_trees:
        space["maxIter"] = [n for n in space["maxIter"] if n <= options.max_trees] or [options.max_trees]
    trained = training.train_evaluate(
        clean,
        space=space,
        n_iter=options.n_iter,
        folds=options.folds,
        seed=options.seed,
        test_share=options.test_share,
        parallelism=options.parallelism,
        exact=options.exact_split,
        high_risk=high_risk,
        max_locations=options.max_locations,
    )

    run_id = uuid.uuid4().hex
    versioned = f"{options.package}/{run_id}"
    schema = training.labelled_features(clean).drop("transaction_id", "split", training.LABEL).schema
    package.save_package(spark, versioned, trained.model, trained.threshold, schema, high_risk)
    for name, table in training.test_tables(trained).items():
        table.coalesce(1).write.mode("overwrite").parquet(f"{versioned}/{name}")
    run_log.log_run(spark, options.runs, run_id, {**trained.params, **trained.best_params}, trained.metrics)
    version = run_log.register_model(spark, options.runs, run_id, options.model_name, versioned)
    print(f"{options.model_name} version {version} at {versioned}: {trained.metrics}")
    return trained


if __name__ == "__main__":
    main()
