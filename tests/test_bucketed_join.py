"""The lag join of bucketed stages: the same rows, and no exchange."""

from delaylens.operators import lagjoin
from delaylens.sources import io
from pyspark.sql import functions as F


def inputs(spark):
    facts = spark.range(300).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2021-01-01 00:00:00' + make_dt_interval(0, 0, id * 17)").alias("ts"),
        (F.col("id") % 4).cast("int").alias("station"),
    )
    hours = facts.select("station", lagjoin.hour_key_floor("ts", "0 hours").alias("weather_ymdh")).distinct()
    return facts, hours.filter("station <> 3").withColumn("wind", F.xxhash64("station", "weather_ymdh") % 50)


def test_same_rows_without_an_exchange(spark, tmp_path):
    facts, hours = inputs(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left"):
            left = io.stage_bucketed(lagjoin.lag_keyed(facts, "ts"), f"{tmp_path}/f_{how}", f"facts_{how}", ["station", "target_dep_ymdh_n2"], 6)
            right = io.stage_bucketed(hours, f"{tmp_path}/h_{how}", f"hours_{how}", ["station", "weather_ymdh"], 6)
            joined = lagjoin.bucketed_lag_join(left, right, ["station"], how=how)
            expected = lagjoin.lag_hour_join(facts, hours, "ts", ["station"], how=how).select(*joined.columns)
            assert sorted(map(str, joined.collect())) == sorted(map(str, expected.collect())) and joined.count() > 100
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_staging_again_replaces_the_table(spark, tmp_path):
    facts, _ = inputs(spark)
    for n in (300, 20):
        held = io.stage_bucketed(facts.limit(n), f"{tmp_path}/t", "replaced_facts", ["station"], 3)
        assert held.count() == n
    assert io.stage_bucketed(facts.limit(0), f"{tmp_path}/e", "empty_facts", ["station"], 3).count() == 0
