import pytest
from pyspark.ml.feature import OneHotEncoderModel
from pyspark.sql import functions as F

from txguard.operators.balance import add_weight, assign_fold
from txguard.operators.featurize import add_features
from txguard.operators.scoring import SCORE, apply_threshold, score_with_model
from txguard.plans import training, views
from txguard.plans.scoring import alerts, model_scorer, score_messages
from txguard.schema import FEATURE_VERSION, FEATURES
from txguard.sources.package import load_package, save_package
from txguard.streaming import sinks

SPACE = {"maxIter": [3, 6], "maxDepth": [2, 4], "stepSize": [0.3]}


@pytest.fixture(scope="module")
def learnable(spark, medium):
    return views.learnable(views.transactions(spark, medium))


@pytest.fixture(scope="module")
def trained(learnable):
    return training.train_evaluate(learnable, space=SPACE, n_iter=2, folds=2, parallelism=2)


def location_rows(spark, *locations):
    rows = [(location, *([1.0] * (len(FEATURES) - 1))) for location in locations]
    names = ["location", *[name for name in FEATURES if name != "location"]]
    return spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n == 'location' else 'double'}" for n in names))


def test_draws_are_distinct_seeded_points(spark):
    points = training.draw_params(training.SEARCH_SPACE, 20, 42)
    assert len({tuple(sorted(p.items())) for p in points}) == 20
    assert points == training.draw_params(training.SEARCH_SPACE, 20, 42)
    assert points != training.draw_params(training.SEARCH_SPACE, 20, 7)
    for point in points:
        assert all(point[name] in values for name, values in training.SEARCH_SPACE.items())
    everything = training.draw_params({"a": [1, 2], "b": [3, 4]}, 100, 1)
    assert sorted((p["a"], p["b"]) for p in everything) == [(1, 3), (1, 4), (2, 3), (2, 4)]


def test_every_searched_name_belongs_to_the_learner():
    learner = training.classifier()
    assert all(learner.hasParam(name) for name in training.SEARCH_SPACE)


def test_unknown_locations_give_the_zero_vector(spark):
    encoder = training.fit_preprocessing(location_rows(spark, "RU", "CN", "US", "US"))
    vectors = [row.location_onehot for row in encoder.transform(location_rows(spark, "CN", "RU", "US", "us", "ZZ", None)).collect()]
    assert [list(v.toArray()) for v in vectors] == [[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 0], [0, 0, 0], [0, 0, 0]]
    assert any(isinstance(stage, OneHotEncoderModel) for stage in encoder.stages)


def test_vocabulary_is_bounded(spark):
    with pytest.raises(ValueError, match="more than 2 locations"):
        training.fit_preprocessing(location_rows(spark, "A", "B", "C"), max_locations=2)


def test_few_positives_stop_the_run(learnable):
    few = learnable.withColumn("is_fraud", (F.col("transaction_id").cast("int") < 19).cast("int"))
    with pytest.raises(ValueError, match="fraud rows are too few"):
        training.prepare_table(few)
    with pytest.raises(ValueError, match="other than 0 and 1"):
        training.prepare_table(learnable.withColumn("is_fraud", F.lit(2)))


def test_weight_comes_from_the_training_part(learnable):
    prepared = training.prepare_table(learnable)
    assert prepared.positive_weight == prepared.counts["train", 0] / prepared.counts["train", 1]
    assert sum(prepared.counts.values()) == 10_000
    weights = {(row.is_fraud, row.weight) for row in prepared.train.select("is_fraud", "weight").distinct().collect()}
    assert weights == {(0, 1.0), (1, prepared.positive_weight)}
    plan = prepared.train._jdf.queryExecution().executedPlan().toString()
    assert "(split" in plan.split("PartitionFilters")[1][:60] and "Python" not in plan


def test_model_learns_the_rule(learnable, trained):
    # all flipped labels fall into the test part, where they make up half of the positives
    assert trained.metrics["auc_pr"] > 0.45 > 5 * trained.params["fraud_rate"]
    assert trained.metrics["roc_auc"] > 0.65
    assert 0 < trained.threshold < 1
    assert set(trained.best_params) == set(SPACE)
    samples = [trained.params[f"{part}_samples"] for part in ("train", "validation", "test")]
    assert samples == [6031, 1977, 1992]


def test_search_keeps_the_best_mean_score(spark, trained):
    table = training.search_table(spark, trained.search).orderBy("rank").collect()
    assert len(table) == 2 and table[0].mean_score >= table[1].mean_score
    assert table[0].mean_score == max(trained.search.avgMetrics)


def test_failed_fit_fails_the_search(spark, learnable):
    prepared = training.prepare_table(learnable.limit(500))
    with pytest.raises(Exception):
        training.search(prepared.train, training.classifier(maxBins=32), [{"stepSize": 0.3, "maxDepth": 31}], 2, 1)


def test_same_seed_same_model(learnable):
    rows = add_weight(assign_fold(training.labelled_features(learnable), 2), 2.0)
    encoder = training.fit_preprocessing(rows)
    assembled = encoder.transform(rows)
    first, second = (training.classifier(maxIter=3, subsamplingRate=0.8).fit(assembled) for _ in range(2))
    assert first.toDebugString.split("\n", 1)[1] == second.toDebugString.split("\n", 1)[1]


def test_package_round_trip_and_stream_parity(spark, medium, trained, tmp_path):
    path = save_package(spark, str(tmp_path / "package"), trained.model, trained.threshold)
    package = load_package(spark, path)
    assert package.threshold == trained.threshold
    assert package.feature_version == FEATURE_VERSION
    assert list(package.feature_columns) == FEATURES

    tx = views.transactions(spark, medium)
    batch = apply_threshold(score_with_model(add_features(tx), package.model), package.threshold)
    before = score_with_model(add_features(tx), trained.model)
    assert before.select("transaction_id", SCORE).exceptAll(batch.select("transaction_id", SCORE)).count() == 0

    views.clean_messages(tx).write.text(str(tmp_path / "messages"))
    stream = spark.readStream.text(str(tmp_path / "messages"))
    scored = score_messages(stream, model_scorer(package.model), package.threshold)
    writer = sinks.file_writer(scored, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    sinks.run_available(writer)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    names = ["transaction_id", *FEATURES, SCORE, "prediction"]
    # the message keeps milliseconds only, the features do not need more
    assert streamed.select(names).exceptAll(batch.select(names)).count() == 0
    assert streamed.count() == batch.count()


def test_model_runs_once_per_row(spark, medium, trained):
    messages = views.clean_messages(views.transactions(spark, medium))
    plan = alerts(score_messages(messages, model_scorer(trained.model), 0.5))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("AS probability#") == 1
    assert plan.count("from_json(") == 1
    assert "Python" not in plan


def test_what_a_task_of_the_learner_holds_does_not_grow_with_the_rows(spark, medium, learnable, monkeypatch):
    per_row = training.row_bytes(25)
    monkeypatch.setattr(training, "TASK_BYTES", 400 * per_row)
    prepared = training.prepare_table(learnable, folds=2)
    rows = prepared.train.rdd
    assert prepared.size("train") > 4000 and rows.getNumPartitions() >= prepared.size("train") // 400
    assert max(rows.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()) <= 440
    found = training.search(prepared.train, training.classifier(), training.draw_params(SPACE, 1, 1), folds=2, parallelism=1)
    assert len(found.avgMetrics) == 1
    labelled = training.labelled_features(learnable)
    dealt = training.learner_rows(labelled)
    assert dealt.rdd.getNumPartitions() == -(-labelled.count() // 400)
    assert dealt.exceptAll(labelled).isEmpty() and labelled.exceptAll(dealt).isEmpty()
    monkeypatch.setattr(training, "TASK_BYTES", 2**40)
    assert training.learner_rows(labelled) is labelled
