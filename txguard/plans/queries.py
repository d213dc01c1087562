"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.functions import features
from txguard.operators import balance, boosting, cap, decode, featurize, metrics, patterns, quality, ranked, scoring
from txguard.operators.exact_split import assign_exact_folds, assign_exact_split
from txguard.plans import scoring as scoring_plan
from txguard.plans import training, views
from txguard.schema import FIELDS, LABEL, NUMERIC_FEATURES
from txguard.session import prepare, spread, work_path
from txguard.sources import package
from txguard.sources import run_log as runs
from txguard.sources.tables import read_table, stream_table
from txguard.streaming import bounded, delivery, sinks

Query = Callable[[SparkSession, str], DataFrame]

# Small search for the registered queries; the full lists are the default of the training plan.
QUICK_SPACE = {"maxIter": [3, 5], "maxDepth": [2, 3], "stepSize": [0.1, 0.3]}
# The nine lists of the booster as they are, but for the number of trees.
QUICK_BOOST = {**training.BOOST_SPACE, "n_estimators": [3, 5]}
FIXED_THRESHOLD = 0.5

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return function(prepare(spark), directory)

    _REGISTRY[function.__name__] = run
    return run


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six places and timestamps without a zone: the form compared with SQL."""
    columns = []
    for column in df.schema:
        kind = column.dataType.typeName()
        value = F.col(column.name)
        if kind == "double":
            value = F.round(value, digits)
        elif kind == "timestamp":
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(column.name))
    return df.select(*columns)


def _tx(spark: SparkSession, directory: str) -> DataFrame:
    return views.transactions(spark, directory)


def _spread_tx(spark: SparkSession, directory: str) -> DataFrame:
    """The same rows for the parsing and fitting queries, on all cores however few splits the table has."""
    return spread(_tx(spark, directory), scan=read_table(spark, directory, "events"))


def _messages(spark: SparkSession, directory: str) -> DataFrame:
    return views.messages(views.raw_fields(_spread_tx(spark, directory)))


def _decoded(spark: SparkSession, directory: str) -> DataFrame:
    return decode.decode_json(_messages(spark, directory))


def _scored(spark: SparkSession, directory: str) -> DataFrame:
    return views.scored(_tx(spark, directory))


def _decided(spark: SparkSession, directory: str) -> DataFrame:
    """Fixed score of the features, cut at the fixed threshold."""
    featured = featurize.add_features(_tx(spark, directory))
    scored = featured.withColumn(scoring.SCORE, views.fixed_score())
    return scoring.apply_threshold(scored, FIXED_THRESHOLD)


# ---- cleaning -----------------------------------------------------------------------------


@query
def bounded_read_cap(spark, directory):
    events = read_table(spark, directory, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return rounded(cap.cap_rows(events, 1000, ["ts", "event_id"]))


@query
def bounded_read_newest(spark, directory):
    events = read_table(spark, directory, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return rounded(cap.cap_rows(events, 1000, ["ts", "event_id"], keep="newest"))


@query
def bounded_read_ties(spark, directory):
    """A cap over keys that repeat and are missing; what a row adds to the keys tells equal ones apart."""
    events = read_table(spark, directory, "events").select(
        F.when(F.col("event_id") % 7 != 0, F.date_trunc("day", F.col("ts").cast("timestamp"))).alias("day"), "event_type"
    )
    capped = [cap.cap_rows(events, 700, ["day", "event_type"], keep).withColumn("keep", F.lit(keep)) for keep in ("oldest", "newest")]
    everything = cap.cap_rows(events, 900_000_000, ["day"]).withColumn("keep", F.lit("all"))
    rows = capped[0].union(capped[1]).union(everything)
    return rounded(rows.groupBy("keep", "day", "event_type").agg(F.count(F.lit(1)).alias("n")))


@query
def decode_whitespace(spark, directory):
    """Messages as text files and consoles hand them on: with line ends and tabs around the object."""
    k = F.pmod(F.xxhash64("value"), F.lit(4))
    padded = F.when(k == 0, F.concat("value", F.lit("\n"))).when(k == 1, F.concat("value", F.lit("\r\n")))
    padded = padded.when(k == 2, F.concat(F.lit("\t "), F.col("value"))).otherwise(F.col("value"))
    messages = _messages(spark, directory).select(padded.alias("value"))
    return decode.decode_json(messages).select(*FIELDS, "bad_json")


@query
def decode_json(spark, directory):
    return _decoded(spark, directory).select(*FIELDS, "bad_json")


@query
def coerce_types(spark, directory):
    return rounded(decode.coerce_types(_decoded(spark, directory)).select(*FIELDS))


@query
def clean_rows(spark, directory):
    return rounded(quality.clean(decode.coerce_types(_decoded(spark, directory))).select(*FIELDS))


@query
def rejected_rows(spark, directory):
    return quality.rejects(_decoded(spark, directory)).select(*FIELDS, "reason")


@query
def reject_reasons(spark, directory):
    return quality.reject_reasons(_decoded(spark, directory))


@query
def validate_rules(spark, directory):
    checked = quality.validate(_decoded(spark, directory))
    return checked.select(*FIELDS, F.concat_ws(",", "violations").alias("violations"), "valid")


@query
def validate_types(spark, directory):
    """JSON kinds: every fifth class of messages states one field as another kind."""
    messages = views.typed_messages(_tx(spark, directory))
    checked = quality.validate_types(messages)
    return checked.select("id", F.concat_ws(",", "type_violations").alias("type_violations"))


@query
def violation_counts(spark, directory):
    return quality.violation_counts(_decoded(spark, directory))


# ---- features -----------------------------------------------------------------------------


def _with_features(tx: DataFrame, columns: dict) -> DataFrame:
    return rounded(tx.select("transaction_id", *[column.alias(name) for name, column in columns.items()]))


@query
def time_features(spark, directory):
    return _with_features(_tx(spark, directory), features.time_features(F.col("timestamp")))


@query
def amount_features(spark, directory):
    columns = {"amount": F.col("amount"), **features.amount_features(F.col("amount"))}
    return _with_features(_tx(spark, directory), columns)


@query
def user_features(spark, directory):
    return _with_features(_tx(spark, directory), features.user_features(F.col("user_id")))


@query
def merchant_location_features(spark, directory):
    columns = {**features.merchant_features(F.col("merchant")), **features.location_features(F.col("location"))}
    return _with_features(_tx(spark, directory), columns)


@query
def feature_table(spark, directory):
    return rounded(featurize.feature_table(_tx(spark, directory)))


@query
def message_feature_table(spark, directory):
    """From dirty messages to the feature table, the way training reads them."""
    featured = scoring_plan.messages_to_features(_messages(spark, directory), label_required=True)
    return rounded(featured.select("transaction_id", *featurize.FEATURES, LABEL))


# ---- patterns -----------------------------------------------------------------------------


@query
def rule_account_takeover(spark, directory):
    tx = _tx(spark, directory)
    flagged = patterns.account_takeover(tx, views.watch_list(tx))
    return flagged.select("transaction_id", "user_id", "rule_account_takeover")


@query
def watch_list_spread(spark, directory):
    """The same lookup with the list treated as too long to broadcast."""
    tx = _tx(spark, directory)
    marked = patterns.mark_watch_list(tx, views.watch_list(tx), max_broadcast=0)
    return marked.select("transaction_id", "user_id", "on_watch_list")


@query
def rule_card_testing(spark, directory):
    return rounded(patterns.card_testing(_tx(spark, directory)).select("transaction_id", "amount", "rule_card_testing"))


@query
def rule_merchant_collusion(spark, directory):
    return patterns.merchant_collusion(_tx(spark, directory)).select(
        "transaction_id", "merchant", "rule_merchant_collusion"
    )


@query
def rule_geo_anomaly(spark, directory):
    return patterns.geo_anomaly(_tx(spark, directory)).select(
        "transaction_id", "user_id", "rule_geo_anomaly", "high_risk_location"
    )


def _patterned(spark, directory):
    tx = _tx(spark, directory)
    return patterns.fraud_pattern(tx, views.watch_list(tx))


@query
def fraud_pattern(spark, directory):
    return _patterned(spark, directory).select("transaction_id", "pattern")


@query
def pattern_summary(spark, directory):
    return rounded(patterns.pattern_summary(_patterned(spark, directory)))


@query
def pattern_fit(spark, directory):
    """The mix of the patterns against the stated one."""
    return rounded(patterns.pattern_fit(_patterned(spark, directory)), 4)


# ---- balance and split --------------------------------------------------------------------


@query
def fraud_rate(spark, directory):
    return rounded(balance.fraud_rate(_tx(spark, directory)))


@query
def class_balance(spark, directory):
    return rounded(balance.class_balance(_tx(spark, directory)))


@query
def class_weight(spark, directory):
    train = balance.assign_split(_tx(spark, directory)).filter(F.col("split") == "train")
    return rounded(balance.class_weight(train))


@query
def stratified_split(spark, directory):
    return balance.assign_split(_tx(spark, directory)).select("transaction_id", LABEL, "split")


@query
def exact_split(spark, directory):
    """The split with exact class counts: the same rows as a full ranking by digest."""
    return assign_exact_split(_tx(spark, directory)).select("transaction_id", LABEL, "split")


@query
def split_without_id(spark, directory):
    """Rows that have no id take part in every split and fold."""
    rows = views.nameless(_tx(spark, directory))
    hashed = balance.assign_fold(balance.assign_split(rows))
    exact = assign_exact_split(rows).withColumn("fold", F.lit(-1))

    def counted(kind: str, assigned: DataFrame) -> DataFrame:
        return assigned.groupBy(F.lit(kind).alias("kind"), "split", "fold", LABEL).agg(F.count(F.lit(1)).alias("n"))

    return counted("hashed", hashed).union(counted("exact", exact))


@query
def stratified_folds(spark, directory):
    return assign_exact_folds(_tx(spark, directory)).select("transaction_id", LABEL, "fold")


@query
def split_counts(spark, directory):
    return balance.split_counts(balance.assign_split(_tx(spark, directory)))


@query
def fold_assignment(spark, directory):
    return balance.assign_fold(_tx(spark, directory)).select("transaction_id", "fold")


@query
def location_vocab(spark, directory):
    return balance.location_vocabulary(featurize.add_features(_tx(spark, directory)))


@query
def location_onehot(spark, directory):
    """The slot every row's location takes, from an encoder fitted on the training part."""
    labelled = training.labelled_features(_tx(spark, directory))
    encoder = training.fit_preprocessing(labelled.filter(F.col("split") == "train"))
    slots = vector_to_array("location_onehot")
    encoded = encoder.transform(labelled)
    return encoded.select(
        "transaction_id",
        "location",
        F.size(slots).alias("slots"),
        (F.array_position(slots, F.lit(1.0)) - 1).cast("int").alias("slot"),
    )


# ---- ranked metrics on the fixed score ----------------------------------------------------


def _ranked(spark, directory):
    return ranked.ranked_cumulative(_scored(spark, directory))


@query
def ranked_cumulative(spark, directory):
    return _ranked(spark, directory)


@query
def pr_curve(spark, directory):
    return rounded(ranked.pr_curve(_ranked(spark, directory)))


@query
def roc_curve(spark, directory):
    return rounded(ranked.roc_curve(_ranked(spark, directory)))


@query
def best_threshold(spark, directory):
    return rounded(ranked.best_threshold(_ranked(spark, directory)))


@query
def average_precision(spark, directory):
    return rounded(ranked.average_precision(_ranked(spark, directory)))


@query
def roc_auc(spark, directory):
    return rounded(ranked.roc_auc(_ranked(spark, directory)))


def _predicted(spark, directory):
    return scoring.apply_threshold(_scored(spark, directory), FIXED_THRESHOLD, score="p")


@query
def confusion_matrix(spark, directory):
    return metrics.confusion_matrix(_predicted(spark, directory))


@query
def threshold_metrics(spark, directory):
    return rounded(metrics.threshold_metrics(_predicted(spark, directory)))


def _evaluation(spark, directory):
    """Threshold from the validation part, metrics on the test part; both from one ranked table."""
    held_out = _scored(spark, directory).filter(F.col("split") != "train")
    both = ranked.ranked_cumulative(held_out, by=["split"])
    threshold = ranked.best_threshold(both.filter(F.col("split") == "validation")).first().threshold
    return ranked.evaluation_summary(both.filter(F.col("split") == "test"), threshold)


@query
def evaluation_summary(spark, directory):
    return rounded(_evaluation(spark, directory))


# ---- scoring ------------------------------------------------------------------------------


@query
def apply_threshold(spark, directory):
    return rounded(_decided(spark, directory).select("transaction_id", scoring.SCORE, scoring.PREDICTION))


@query
def fraud_only(spark, directory):
    decided = scoring.fraud_only(_decided(spark, directory))
    return rounded(decided.select("transaction_id", "user_id", "amount", scoring.SCORE))


_ALERT_FIELDS = (
    "transaction_id string, user_id int, amount double, merchant string, location string, is_fraud int, "
    "transaction_hour int, amount_log double, fraud_probability double, prediction int"
)


def _parsed_alerts(messages: DataFrame) -> DataFrame:
    return rounded(messages.select("key", F.inline(F.array(F.from_json("value", _ALERT_FIELDS)))))


@query
def fraud_messages(spark, directory):
    return _parsed_alerts(scoring_plan.alerts(_decided(spark, directory)))


@query
def udf_score(spark, directory):
    featured = featurize.add_features(_tx(spark, directory))
    scored = scoring.score_with_python(featured, predict=views.fixed_score_model())
    decided = scoring.apply_threshold(scored, FIXED_THRESHOLD)
    return rounded(scoring.fraud_only(decided).select("transaction_id", scoring.SCORE, scoring.PREDICTION))


# ---- streams ------------------------------------------------------------------------------


def _stream_tx(spark, directory):
    return views.transactions(spark, directory, stream_table(spark, directory, "events"))


def _run_stream(df: DataFrame, name: str):
    spark = df.sparkSession
    home = work_path(spark, name)
    running = sinks.run_available(sinks.file_writer(df, f"{home}/rows", f"{home}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{home}/rows"), running


@query
def stream_decode(spark, directory):
    messages = views.messages(views.raw_fields(_stream_tx(spark, directory)))
    rows, _ = _run_stream(decode.coerce_types(decode.decode_json(messages)), "stream_decode")
    return rounded(rows.select(*FIELDS))


@query
def stream_features(spark, directory):
    messages = views.messages(views.raw_fields(_stream_tx(spark, directory)))
    featured = scoring_plan.messages_to_features(messages, label_required=True)
    rows, _ = _run_stream(featured.select("transaction_id", *featurize.FEATURES, LABEL), "stream_features")
    return rounded(rows)


def _fixed_scorer(featured: DataFrame) -> DataFrame:
    return featured.withColumn(scoring.SCORE, views.fixed_score())


@query
def stream_score_files(spark, directory):
    messages = views.clean_messages(_stream_tx(spark, directory))
    scored = scoring_plan.score_messages(messages, _fixed_scorer, FIXED_THRESHOLD)
    rows, _ = _run_stream(scoring_plan.alerts(scored), "stream_score_files")
    return _parsed_alerts(rows)


@query
def stream_rejects(spark, directory):
    """Quarantine stream beside the scoring stream."""
    messages = views.messages(views.raw_fields(_stream_tx(spark, directory)))
    rows, _ = _run_stream(quality.rejects(decode.decode_json(messages)).drop("raw_text"), "stream_rejects")
    return rows.select(*FIELDS, "reason")


def _delivered(spark, name: str, messages: DataFrame) -> delivery.Delivery:
    home = work_path(spark, name)
    out = delivery.Delivery(spark, f"{home}/out", _fixed_scorer, FIXED_THRESHOLD)
    sinks.run_available(out.writer(messages, f"{home}/checkpoint"))
    return out


@query
def stream_delivery_alerts(spark, directory):
    """Alerts of a stream that writes alerts, rejects and counts from one parse."""
    messages = views.clean_messages(_stream_tx(spark, directory))
    return _parsed_alerts(_delivered(spark, "stream_delivery_alerts", messages).read(delivery.ALERTS))


@query
def stream_delivery_rejects(spark, directory):
    """Rejects of such a stream, and beside each what its batch counted."""
    messages = views.messages(views.raw_fields(_stream_tx(spark, directory)))
    out = _delivered(spark, "stream_delivery_rejects", messages)
    counted = out.counts().agg(F.sum("messages").alias("messages"), F.sum("unusable").alias("unusable")).first()
    rows = out.read(delivery.REJECTS).select(*FIELDS, "reason")
    return rows.withColumns({"messages": F.lit(counted.messages), "unusable": F.lit(counted.unusable)})


@query
def stream_progress(spark, directory):
    """Counts over a dozen batches, where the session itself keeps the last two only."""
    folder = work_path(spark, "stream_progress_messages")
    views.messages(views.raw_fields(_tx(spark, directory))).repartition(12).write.text(folder)
    messages = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    tagged = quality.counting(quality.tag_reasons(decode.decode_json(messages)))
    log = sinks.ProgressLog(spark)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    try:
        _, running = _run_stream(tagged.select("transaction_id", "reason"), "stream_progress")
        table = log.table(running)
    finally:
        spark.conf.set(kept, before)
        log.close()
    return table.agg(
        F.sum("input_rows").alias("input_rows"), F.sum("messages").alias("messages"), F.sum("unusable").alias("unusable")
    )


def _event_stream(spark, directory, files: int):
    """The events as a stream of so many files, a file for each batch."""
    folder = work_path(spark, "event_files")
    events = read_table(spark, directory, "events").select("event_id", "ts", "user_id", "event_type", "value")
    events.repartition(files).write.parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query
def stream_until_idle(spark, directory):
    """All that a stream brings until it falls silent, by hour: a bounded read that ends by itself."""
    read = bounded.read_until_idle(_event_stream(spark, directory, 6), idle_seconds=1.0)
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")
    counted = read.rows.groupBy(hour, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return rounded(counted.withColumn("stopped_by", F.lit(read.stopped_by)))


@query
def stream_until_rows(spark, directory):
    """A stream read until a quarter of its rows have arrived: how many there are then, and how many are rows of the table."""
    events = read_table(spark, directory, "events").select("event_id", "ts", "value")
    wanted = max(1, events.count() // 4)
    read = bounded.read_until_idle(_event_stream(spark, directory, 8), 60.0, wanted, ["ts", "event_id"])
    found = read.rows.select("event_id", "ts", "value").join(events.withColumn("known", F.lit(1)), ["event_id", "ts", "value"], "left")
    return found.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("distinct_events"), F.count("known").alias("known")
    ).withColumn("stopped_by", F.lit(read.stopped_by))


# ---- learning -----------------------------------------------------------------------------


def _learnable(spark, directory):
    return views.learnable(_spread_tx(spark, directory))


_quick_training = partial(training.train_evaluate, space=QUICK_SPACE, n_iter=2, folds=2, parallelism=2)


@query
def training_table(spark, directory):
    """What the learner is given, per part: rows, weights, filled location slots, sum of every numeric input."""
    prepared = training.prepare_table(_learnable(spark, directory))
    slots = len(prepared.encoder.stages[0].labels)
    inputs = vector_to_array("features")
    flat = prepared.table.select(
        "split",
        LABEL,
        "weight",
        F.aggregate(F.slice(inputs, 1, slots), F.lit(0.0), lambda total, x: total + x).alias("located"),
        *[inputs[slots + i].alias(name) for i, name in enumerate(NUMERIC_FEATURES)],
    )
    sums = [F.sum(name).alias(name) for name in ("weight", "located", *NUMERIC_FEATURES)]
    return rounded(flat.groupBy("split").agg(F.count("*").alias("n"), F.sum(LABEL).alias("positives"), *sums), 3)


@query
def train_gbt(spark, directory):
    """Feature importances of a model fitted on the training part, by input slot."""
    prepared = training.prepare_table(_learnable(spark, directory))
    model = training.classifier(maxIter=5, maxDepth=3).fit(prepared.train)
    importances = [(slot, float(value)) for slot, value in enumerate(model.featureImportances.toArray())]
    return rounded(spark.createDataFrame(importances, "slot int, importance double"))


@query
def search_results(spark, directory):
    prepared = training.prepare_table(_learnable(spark, directory), folds=2)
    points = training.draw_params(QUICK_SPACE, 2, training.SEED)
    found = training.search(prepared.train, training.classifier(), points, folds=2, parallelism=2)
    return rounded(training.search_table(spark, found))


@query
def boost_split_gains(spark, directory):
    """The regularised gains of one level: gradients and hessians at even odds, by node, feature and bin."""
    train = training.labelled_features(_learnable(spark, directory)).filter(F.col("split") == "train")
    weighing = train.agg((F.count_if(F.col(LABEL) == 0) / F.count_if(F.col(LABEL) == 1)).alias("w")).first()
    weight = F.when(F.col(LABEL) == 1, F.lit(float(weighing.w))).otherwise(1.0)
    bins = {
        0: F.least(F.floor(F.col("amount") / 25), F.lit(63)),
        1: F.col("transaction_hour"),
        2: F.col("merchant_risk"),
        3: F.floor(F.col("user_id_mod_500") / 10),
    }
    cells = [F.struct(F.lit(k).alias("feature"), column.cast("int").alias("bin")) for k, column in bins.items()]
    found = train.select(F.col("is_weekend").cast("int").alias("node"), (weight * (0.5 - F.col(LABEL))).alias("g"), (weight * 0.25).alias("h"), F.inline(F.array(*cells)))
    sums = found.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    gains = boosting.split_gains(sums, ["node"], F.lit(0.5), F.lit(2.0), F.lit(3.0))
    return rounded(gains.select("node", "feature", "bin", "gl", "hl", "gr", "hr", "gain"))


@query
def boosted_search(spark, directory):
    """All nine search lists, points and folds side by side."""
    prepared = training.prepare_table(_learnable(spark, directory), folds=2)
    found = training.search_boosted(prepared, QUICK_BOOST, n_iter=3, folds=2)
    rows = [(rank, params, mean, std) for rank, params, mean, std in found.ranking()]
    return rounded(spark.createDataFrame(rows, "rank int, params string, mean_score double, std_score double"))


@query
def boosted_parity(spark, directory):
    """Rows scored by a saved-up booster, and how many the sums kept beside the training rows score otherwise."""
    prepared = training.prepare_table(_learnable(spark, directory))
    binned = boosting.bin_rows(prepared.train)
    (model,) = boosting.fit(binned, [(boosting.Point(4, 3, 0.3, reg_alpha=0.1), None)])
    kept = boosting.log_odds(binned, [model]).select("row", F.col("log_odds")[0].alias("kept"))
    scored = binned.with_features.select("row", model.score(F.col("x")).alias("p"))
    differs = F.abs(F.log(F.col("p") / (1 - F.col("p"))) - F.col("kept")) > 1e-6
    joined = scored.join(kept, "row", "full")
    return joined.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(differs, F.lit(True))).alias("mismatches"))


@query
def train_evaluate(spark, directory):
    return rounded(training.metrics_row(spark, _quick_training(_learnable(spark, directory))))


@query
def score_batch(spark, directory):
    """Train, save the package, load it, score every transaction with it."""
    trained = _quick_training(_learnable(spark, directory))
    path = package.save_package(spark, work_path(spark, "package"), trained.model, trained.threshold)
    loaded = package.load_package(spark, path)
    featured = featurize.add_features(_tx(spark, directory))
    scored = scoring.score_with_model(featured, loaded.model)
    decided = scoring.apply_threshold(scored, loaded.threshold)
    return rounded(decided.select("transaction_id", scoring.SCORE, scoring.PREDICTION))


def _small_model(spark, directory):
    labelled = training.labelled_features(_learnable(spark, directory))
    train = training.learner_rows(balance.add_weight(labelled.filter(F.col("split") == "train"), 1.0))
    stages = [*training.preprocessing(), training.classifier(maxIter=3, maxDepth=3)]
    return training.Pipeline(stages=stages).fit(train)


@query
def stream_score_model(spark, directory):
    """A trained pipeline inside the scoring stream."""
    scorer = scoring_plan.model_scorer(_small_model(spark, directory))
    messages = views.clean_messages(_stream_tx(spark, directory))
    scored = scoring_plan.score_messages(messages, scorer, FIXED_THRESHOLD)
    rows, _ = _run_stream(scoring_plan.alerts(scored), "stream_score_model")
    return _parsed_alerts(rows)


@query
def stream_batch_parity(spark, directory):
    """Rows scored by the stream, and how many of them the batch scores or decides otherwise."""
    model = _small_model(spark, directory)
    messages = views.clean_messages(_stream_tx(spark, directory))
    streamed = scoring_plan.score_messages(messages, scoring_plan.model_scorer(model), FIXED_THRESHOLD)
    names = ["transaction_id", scoring.SCORE, scoring.PREDICTION]
    rows, _ = _run_stream(streamed.select(*names), "stream_batch_parity")
    features = featurize.add_features(_tx(spark, directory))
    batch = scoring.apply_threshold(scoring.score_with_model(features, model), FIXED_THRESHOLD).select(*names)
    sides = rows.withColumn("side", F.lit(1)).unionByName(batch.withColumn("side", F.lit(-1)))
    matched = sides.groupBy(*names).agg(F.sum("side").alias("surplus"), F.count_if(F.col("side") == 1).alias("streamed"))
    return matched.agg(F.sum("streamed").alias("streamed"), F.sum(F.abs("surplus")).alias("mismatches"))


@query
def run_log(spark, directory):
    """A logged run: split sizes as parameters, the evaluation of the fixed score as metrics."""
    counted = balance.split_counts(balance.assign_split(_tx(spark, directory)))
    sizes = counted.groupBy("split").agg(F.sum("n").alias("n")).collect()
    path = work_path(spark, "runs")
    runs.log_run(
        spark,
        path,
        run_id="fixed-score",
        params={f"{row.split}_samples": row.n for row in sizes},
        metrics=_evaluation(spark, directory).first().asDict(),
    )
    runs.register_model(spark, path, "fixed-score", "fraud_model", "packages/fixed-score")
    logged = runs.read_runs(spark, path)
    number = F.round(F.col("value").try_cast("double"), 6)
    return logged.select("run_id", "kind", "name", number.alias("value"))
