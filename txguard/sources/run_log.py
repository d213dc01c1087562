"""Run log: parameters, metrics and model versions as an append-only table in long form, for several writers.

The entries of a run are written first, under an id of their own, and become part of the log by a
numbered commit that names the id (see :mod:`txguard.sources.commits`). So a run is seen whole or not
at all, and two writers never get the same model version. A snapshot gathers what is committed so far,
so that readers open few files however long the log is.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.schema import RUNS
from txguard.sources.commits import Commits

_STORED = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in RUNS) + ", entry_id string"


def log_run(
    spark: SparkSession, path: str, run_id: str, params: Mapping[str, object], metrics: Mapping[str, float]
) -> None:
    """Append one run. The table is partitioned by kind, so metrics are read without parameters."""
    entries = [("param", name, str(value)) for name, value in params.items()]
    entries += [("metric", name, repr(float(value))) for name, value in metrics.items() if value is not None]
    entry_id = _write(spark, path, run_id, entries)
    _commits(spark, path).append(lambda last: entry_id)


def register_model(spark: SparkSession, path: str, run_id: str, name: str, package_path: str) -> int:
    """Give the package the next version number of ``name``; any number of writers may do so at a time.

    The version follows from the commits there are, and counts only if the next commit is still free;
    otherwise it is worked out again. What a lost attempt has written is never read.
    """
    given = {}

    def attempt(last: int) -> str:
        given["version"] = latest_version(spark, path, name, last) + 1
        return _write(spark, path, run_id, [("model", f"{name}/{given['version']}", package_path)])

    _commits(spark, path).append(attempt)
    return given["version"]


def latest_version(spark: SparkSession, path: str, name: str, upto: int | None = None) -> int:
    """The highest version of ``name``, 0 for none, in the log or in its commits ``upto`` one."""
    mine = _read(spark, path, upto).filter((F.col("kind") == "model") & F.col("name").startswith(f"{name}/"))
    number = F.substring_index("name", "/", -1).try_cast("int")
    return mine.agg(F.coalesce(F.max(number), F.lit(0))).first()[0]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All committed entries."""
    return _read(spark, path, None)


def compact(spark: SparkSession, path: str) -> int:
    """Gathers the entries of all commits so far in one snapshot and returns the number of the last of them.

    Writers and readers need not wait: a reader takes the latest finished snapshot and the commits
    behind it, and nothing is deleted.
    """
    last = max(_commits(spark, path).read(), default=0)
    snapshots = _commits(spark, path, "snapshots")
    if last and last not in snapshots.read():
        folder = f"snapshot-{last}-{uuid.uuid4().hex}"
        _read(spark, path, last).coalesce(1).write.partitionBy("kind").parquet(f"{path}/{folder}")
        snapshots.put(last, folder)  # another snapshot of the same commits is as good
    return last


def _commits(spark: SparkSession, path: str, kind: str = "commits") -> Commits:
    return Commits(spark, f"{path}/{kind}")


def _write(spark: SparkSession, path: str, run_id: str, entries: list[tuple[str, str, str]]) -> str:
    now = datetime.now(timezone.utc)
    entry_id = uuid.uuid4().hex
    rows = [(run_id, now, *entry, entry_id) for entry in entries]
    # a folder for each, so that writers share no state of the file committer
    spark.createDataFrame(rows, _STORED).coalesce(1).write.partitionBy("kind").parquet(f"{path}/entries/{entry_id}")
    return entry_id


def _read(spark: SparkSession, path: str, upto: int | None) -> DataFrame:
    names = RUNS.fieldNames()
    snapshots = {n: folder for n, folder in _commits(spark, path, "snapshots").read().items() if upto is None or n <= upto}
    start = max(snapshots, default=0)
    later = [entry for n, entry in _commits(spark, path).read(start).items() if upto is None or n <= upto]
    parts = []
    if start:
        parts.append(spark.read.schema(RUNS).parquet(f"{path}/{snapshots[start]}").select(*names))
    # the entries behind the snapshot, folder by folder, each partitioned by kind
    parts += [spark.read.schema(RUNS).parquet(f"{path}/entries/{entry}").select(*names) for entry in later]
    if not parts:
        return spark.createDataFrame([], RUNS)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
