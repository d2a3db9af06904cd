"""What a session lets a query put on the driver."""

from pyspark.sql import functions as F

from merchlens import session
from merchlens.plans.tables import Retail


def test_a_side_that_is_small_only_in_its_file_is_not_broadcast(spark, tmp_path):
    spark.range(300_000).select(
        F.col("id").alias("p_partkey"), F.lit("ring").alias("p_name"), F.lit("Brand#1").alias("p_brand"), F.lit("SMALL").alias("p_type"),
        F.lit(1).alias("p_size"), F.lit(9.0).alias("p_retailprice")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(10).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"),
        F.col("id").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', "id").alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    raw = Retail(spark, str(tmp_path)).raw
    assert raw.count() == 10
    assert "Broadcast" not in raw._jdf.queryExecution().executedPlan().toString()


def test_a_lower_broadcast_limit_is_kept(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        for given, kept in (("256k", "256k"), ("-1", "-1"), ("10m", str(session.BROADCAST_BYTES))):
            spark.conf.set(key, given)
            assert session.tune(spark).conf.get(key) == kept
    finally:
        spark.conf.set(key, before)
