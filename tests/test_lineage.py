import random
from collections import defaultdict
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from voxloom.operators import ranking
from voxloom.operators.lineage import checkpoint_dir, cut, remove, scratch, spread
from voxloom.operators.ranking import rank_and_running


def test_spread_and_cut(spark, tmp_path):
    few = spark.range(1000).coalesce(1)
    assert spread(few, "id").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism // 2
    many = spark.range(1000).repartition(64)
    assert spread(many, "id") is many
    grouped = few.groupBy("id").count()
    assert spread(grouped, "id") is grouped
    assert cut(few).count() == 1000 and "Range" not in cut(few)._jdf.queryExecution().executedPlan().toString()
    assert checkpoint_dir(spark) == checkpoint_dir(spark)


def test_folder_must_be_shared_off_one_machine():
    class Context:
        master = "spark://somewhere:7077"

        class _jsc:
            @staticmethod
            def sc():
                return Context

        @staticmethod
        def getCheckpointDir():
            return Context

        @staticmethod
        def isDefined():
            return False

    session = SimpleNamespace(sparkContext=Context, conf={})
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        checkpoint_dir(session)


def test_scratch_is_removed(spark):
    path = scratch(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    remove(spark, path)
    assert not Path(path.removeprefix("file:")).exists()
    remove(spark, path)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_ranks_over_ranges_and_batches(spark, partitions):
    r = random.Random(partitions)
    data = [(r.choice(["hot", "hot", None, "a", "b", "b\x00"]), r.choice([None, 1, 2]), i, r.choice([None, 0, 5, -2])) for i in range(500)]
    df = spark.createDataFrame(data, "k string, l int, i long, v int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {x.i: (x["rank"], x["running"]) for x in rank_and_running(df, ["k", "l"], [F.col("i").desc()], "v", partitions=partitions).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    n, s = defaultdict(int), defaultdict(int)
    for k, key, i, v in sorted(data, key=lambda x: -x[2]):
        n[k, key] += 1
        s[k, key] += v or 0
        assert got[i] == (n[k, key], s[k, key])
    assert rank_and_running(df.limit(0), ["k"], [F.col("i")]).count() == 0


def test_ranges_follow_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RANGE_ROWS", 100)
    asked = []
    plain = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda self, n, *c: asked.append(n) or plain(self, n, *c))
    rank_and_running(spark.range(5000).withColumn("k", F.lit(1)), ["k"], [F.col("id")])
    rank_and_running(spark.range(10).withColumn("k", F.lit(1)), ["k"], [F.col("id")])
    assert asked == [50, 1]
