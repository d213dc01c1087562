import pytest

from txguard import session


def test_settings_reach_a_session_of_somebody_else(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert session.prepare(spark) is spark
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in session.shared_dir(spark)
    assert session.work_path(spark, "x") != session.work_path(spark, "x")
    assert named in session.work_path(spark, "x")


def test_a_cluster_has_to_name_the_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Cluster:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_materialised_table_keeps_rows_and_prunes(spark):
    rows = spark.range(100).selectExpr("id", "id % 3 part")
    table = session.materialise(rows, "t", ["part"])
    assert sorted(map(tuple, table.select("id", "part").collect())) == sorted(map(tuple, rows.collect()))
    plan = table.filter("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 1000, 1, 16)
    assert session.spread(wide) is wide
    assert session.spread(spark.range(0, 1000, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_planning_a_spread_reads_no_row(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            read.add(1)
            yield row

    source = spark.range(100).rdd.mapPartitions(seen).toDF("id long")
    session.spread(source.orderBy("id").limit(50).repartition(3))
    assert read.value == 0


def test_only_one_process_may_do_without_a_named_folder(monkeypatch):
    class Context:
        master = "local-cluster[2,1,512]"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        session.shared_dir(Session())
