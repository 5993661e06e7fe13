"""Where intermediate tables go, and what plans may contain."""

from types import SimpleNamespace

import pytest

from fieldloom import storage
from fieldloom.plans.queries import all_queries


def fake(master, conf=None, core=None):
    get = lambda key, default=None: conf or default
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=SimpleNamespace(
        master=master, getConf=lambda: SimpleNamespace(get=lambda key: core)))


def test_configured_folder_is_used():
    assert storage.shared_root(fake("yarn", conf="hdfs:///shared/")) == "hdfs:///shared"
    assert storage.shared_root(fake("yarn", core="s3a://bucket/x")) == "s3a://bucket/x"


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_root(fake("spark://host:7077"))


def test_written_tables_keep_rows_and_column_order(spark):
    df = spark.range(100).selectExpr("CASE WHEN id % 4 = 1 THEN '' WHEN id % 4 > 0 THEN concat('p', id % 4) END AS part", "id")
    back = storage.materialize(df, "t", "part")
    assert back.columns == ["part", "id"] and back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    files = back.filter("part = 'p2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in files and "PartitionFilters: []" not in files


def test_no_plan_pairs_rows_or_runs_python(spark, root):
    for key, query in all_queries().items():
        plan = query(spark, root)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
            assert word not in plan, (key, word)
