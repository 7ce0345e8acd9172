"""Skew and size-bound behaviour: a hot group of copies, and dimensions over
the broadcast bound."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from derivspark.sources import store
from derivspark.sources.fixtures import fno_feed
from tests.conftest import SF001, SF01
from tests.test_plans import plan


def test_hot_copies_get_dense_ids_and_spread_over_files(spark, tmp_path):
    feed = fno_feed(spark, SF001)
    n = feed.count()
    # 4096 identical copies of one contract-day: ~40 % of all rows
    hot = feed.limit(1).withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(4096)))).drop("_k")
    skewed = feed.unionByName(hot)
    total = n + 4096
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = store.write_model(spark, skewed, str(tmp_path / "store"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert rows["trades"] == total
    t = spark.read.parquet(str(tmp_path / "store" / "trades"))
    ids = t.agg(F.count("*").alias("n"), F.countDistinct("trade_id").alias("d"),
                F.min("trade_id").alias("lo"), F.max("trade_id").alias("hi")).first()
    assert (ids.n, ids.d, ids.lo, ids.hi) == (total, total, 1, total)
    per_file = [r["count"] for r in t.groupBy(F.input_file_name()).count().collect()]
    # the hot contract-day is split by the range bounds (its trade ids differ)
    assert max(per_file) < 4096


def test_dimension_over_bound_uses_shuffle_join_with_same_result(spark):
    key = "runner_q7_active_expiries"
    expected = sorted(map(tuple, E.queries()[key](spark, SF01).collect()))
    spark.conf.set("derivspark.broadcast.maxRows", "10")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()[key](spark, SF01)
        p = plan(df)
        assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
        assert sorted(map(tuple, df.collect())) == expected
    finally:
        spark.conf.unset("derivspark.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
