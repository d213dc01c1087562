from txguard.schema import RUNS
from txguard.sources import run_log


def test_runs_append_and_versions_count_up(spark, tmp_path):
    path = str(tmp_path / "runs")
    run_log.log_run(spark, path, "r1", {"maxIter": 5}, {"f1": 0.25, "roc_auc": None})
    assert run_log.register_model(spark, path, "r1", "model", "/p/1") == 1
    run_log.log_run(spark, path, "r2", {"maxIter": 7}, {"f1": 0.5})
    assert run_log.register_model(spark, path, "r2", "model", "/p/2") == 2
    assert run_log.register_model(spark, path, "r2", "other", "/p/3") == 1

    runs = run_log.read_runs(spark, path)
    assert runs.columns == RUNS.fieldNames()
    rows = {(r.run_id, r.kind, r.name): r.value for r in runs.collect()}
    assert rows == {
        ("r1", "param", "maxIter"): "5",
        ("r1", "metric", "f1"): "0.25",
        ("r1", "model", "model/1"): "/p/1",
        ("r2", "param", "maxIter"): "7",
        ("r2", "metric", "f1"): "0.5",
        ("r2", "model", "model/2"): "/p/2",
        ("r2", "model", "other/1"): "/p/3",
    }


def test_metrics_are_read_without_the_rest(spark, tmp_path):
    path = str(tmp_path / "runs")
    run_log.log_run(spark, path, "r1", {"a": 1}, {"f1": 0.25})
    plan = run_log.read_runs(spark, path).filter("kind = 'metric'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan


def test_eight_writers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "runs")
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda k: run_log.register_model(spark, path, f"r{k}", "model", f"/p/{k}"), range(8)))
    assert sorted(versions) == list(range(1, 9))
    rows = {r.name: r.value for r in run_log.read_runs(spark, path).collect()}
    assert rows == {f"model/{version}": f"/p/{k}" for k, version in enumerate(versions)}


def test_half_a_run_is_never_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    run_log.log_run(spark, path, "r1", {"a": 1}, {"f1": 0.5})
    # entries whose writer dies before its commit, and a commit that is not finished
    run_log._write(spark, path, "r2", [("param", "a", "2")])
    entry = run_log._write(spark, path, "r3", [("param", "a", "3")])
    (tmp_path / "runs" / "commits" / f"{2:020d}").write_text(entry)
    assert {row.run_id for row in run_log.read_runs(spark, path).collect()} == {"r1"}
    run_log.log_run(spark, path, "r4", {"a": 4}, {})
    assert {row.run_id for row in run_log.read_runs(spark, path).collect()} == {"r1", "r4"}


def test_snapshots_hold_what_was_committed(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert run_log.read_runs(spark, path).collect() == [] and run_log.compact(spark, path) == 0
    for k in range(4):
        run_log.register_model(spark, path, f"r{k}", "model", f"/p/{k}")
    before = sorted(run_log.read_runs(spark, path).collect())
    assert run_log.compact(spark, path) == run_log.compact(spark, path) == 4
    assert sorted(run_log.read_runs(spark, path).collect()) == before
    assert len(run_log.read_runs(spark, path).inputFiles()) == 1
    assert run_log.register_model(spark, path, "r5", "model", "/p/5") == 5
    assert run_log.latest_version(spark, path, "model") == 5 and run_log.latest_version(spark, path, "model", upto=4) == 4
    plan = run_log.read_runs(spark, path).filter("kind = 'metric'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(kind") == 2


def test_one_commit_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from txguard.sources.commits import Commits

    folders = [Commits(spark, str(tmp_path / "c")) for _ in range(8)]
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: folders[k].put(1, f"by {k}"), range(8)))
    assert sum(won) == 1 and folders[0].read() == {1: f"by {won.index(True)}"}
    assert folders[0].append(lambda last: f"after {last}") == 2 and folders[1].read(1) == {2: "after 1"}
    assert not [name for name in (tmp_path / "c").iterdir() if name.name.startswith(".") and not name.name.endswith(".crc")]
