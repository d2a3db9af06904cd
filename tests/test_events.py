"""Cleaning, validation, sessions and ordering on small hand-made frames."""

import datetime as dt

import pytest
from merchlens.functions import constants as K
from merchlens.functions import scalars as S
from merchlens.operators import cleaning, ordering, quality, sampling, sessions
from merchlens.streaming import clickstream
from pyspark.sql import functions as F


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


EVENT = (
    "event_id string, user_id string, session_id string, timestamp timestamp_ntz, event_type string, product_id string, "
    "product_price double, discount_percentage double, competitor_price double, dwell_time_seconds double, page_position int, purchase_label int"
)


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def event(i, user="u", minutes=0.0, kind="view", product="p", price=10.0, discount=0.0, competitor=9.0, dwell=1.0, page=1, label=0, session="s"):
    return (i, user, session, at(minutes), kind, product, price, discount, competitor, dwell, page, label)


def test_gap_of_exactly_thirty_minutes_stays_in_the_session(spark):
    # Minutes 0, 10, 40 (gap 30) and 71 (gap 31); a second user crosses an hour and a day boundary.
    rows = [event(str(i), minutes=m) for i, m in enumerate([0, 10, 40, 71])]
    rows += [event("x", "v", 59), event("y", "v", 61), event("z", "v", 24 * 60 + 5)]
    got = {r.event_id: r.derived_session_id for r in sessions.sessionize(events(spark, rows)).collect()}
    assert got == {"0": "DS-u-0001", "1": "DS-u-0001", "2": "DS-u-0001", "3": "DS-u-0002",
                   "x": "DS-v-0001", "y": "DS-v-0001", "z": "DS-v-0002"}


def test_sessions_do_not_depend_on_the_block_width(spark):
    rows = [event(f"{i:03d}", minutes=(i * i * 7) % 4000) for i in range(120)]
    df = events(spark, rows)
    widths = [sorted((r.event_id, r.derived_session_number) for r in sessions.sessionize(df, block=b).collect()) for b in ("minute", "hour", "month")]
    assert widths[0] == widths[1] == widths[2]


def test_session_number_beyond_four_digits_is_not_cut(spark):
    n = 10_005
    df = spark.range(n).select(
        F.format_string("%06d", "id").alias("event_id"), F.lit("u").alias("user_id"),
        (F.lit(at(0)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"))
    last = sessions.sessionize(df, block="month").agg(F.max(F.struct("event_id", "derived_session_id"))["derived_session_id"]).first()[0]
    assert last == f"DS-u-{n}"


def test_cleaning_repairs_and_keeps_the_first_delivery(spark):
    rows = [
        event("2-DUP"), event("2"),
        event("3", minutes=1, discount=-0.1, competitor=None, dwell=1000.0, page=0),
        event("4", minutes=2, discount=0.95, dwell=None, page=None),
        event("5", minutes=3, discount=None), event("6", user=None), event("7", product=None),
    ]
    got = {r.event_id: r for r in cleaning.clean_events(events(spark, rows)).collect()}
    assert set(got) == {"2", "3", "4", "5"}
    assert (got["3"].discount_percentage, got["3"].competitor_price, got["3"].dwell_time_seconds, got["3"].page_position) == (0.0, 10.0, 900.0, 1)
    assert (got["4"].discount_percentage, got["4"].dwell_time_seconds, got["4"].page_position) == (0.9, 0.0, 1)
    assert got["5"].discount_percentage == 0.0


def test_bad_timestamp_is_null(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("soon",)], "t string").select(cleaning.parse_timestamp("t").alias("t"))
    assert [r.t for r in df.collect()] == [dt.datetime(2024, 1, 1, 10), None]


def test_validation_findings(spark):
    rows = [event(str(i), competitor=None if i < 6 else 1.0, dwell=None if i < 5 else 1.0, kind="teleport" if i == 0 else "view",
                  price=-1.0 if i == 1 else 1.0) for i in range(100)]
    df = events(spark, rows)
    found = {(r.severity, r.message) for r in quality.findings(df, "events").collect()}
    assert ("warning", "Column over 5% null: competitor_price") in found
    assert not any("dwell_time_seconds" in m for _, m in found)  # exactly 5% is not over 5%
    assert ("error", "event_type has unexpected value: teleport") in found
    assert ("error", "product_price contains values below 0.0") in found
    assert any(m.startswith("Missing required columns") for _, m in found)
    with pytest.raises(ValueError):
        quality.require_passed(df, "events")


def test_catalog_validation(spark):
    schema = "product_id int, category string, brand string, price double, margin double, inventory int, text_description string"
    good = spark.createDataFrame([(1, "a", "b", 1.0, 0.3, 1, "t")], schema)
    assert quality.report(good, "product_catalog").first().passed
    messages = {r.message for r in quality.findings(good.union(good), "product_catalog").collect()}
    assert messages == {"product_id must be unique"}
    assert {r.message for r in quality.findings(good.limit(0), "product_catalog").collect()} == {"Table is empty"}


def test_row_numbers_and_quantiles_with_a_hot_value(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("v"))
    numbered = ordering.number_rows(df, ["v", "id"], "n").collect()
    assert [r.n for r in sorted(numbered, key=lambda r: (r.v, r.id))] == list(range(3000))
    import numpy as np

    values = [r.v for r in df.collect()]
    got = {r.q: r.value for r in ordering.quantiles(df, "v", [0.0, 0.31, 0.82, 1.0]).collect()}
    for q, value in got.items():
        assert value == pytest.approx(np.quantile(values, q))


def test_running_total_equals_a_plain_cumulative_sum(spark):
    df = spark.range(500).select(F.lit("hot").alias("k"), F.floor(F.col("id") / 7).alias("b"), "id")
    got = ordering.running_total(df, ["k"], "b", ["id"], F.col("id"), "total").collect()
    assert all(r.total == r.id * (r.id + 1) // 2 for r in got)


def test_negatives_are_unseen_and_distinct(spark):
    catalog = spark.range(20).select(F.col("id").alias("product_id"))
    rows = [(1, p) for p in range(15)] + [(2, p) for p in range(20)] + [(3, 4)]
    seen = spark.createDataFrame(rows, "user_id bigint, product_id bigint")
    positives = seen.withColumn("event_id", F.concat_ws("-", "user_id", "product_id"))
    got = sampling.negatives(positives, seen, catalog, n=3).collect()
    assert len(got) == 3 * len(rows)
    by_event = {}
    for r in got:
        by_event.setdefault(r.event_id, set()).add(r.product_id)
        if r.user_id != 2:  # user 2 has seen everything and draws from all products
            assert (r.user_id, r.product_id) not in set(rows)
    assert all(len(v) == 3 for v in by_event.values())


def test_stockout_bucket_edges(spark):
    scores = [-0.1, 0.0, 0.8, 0.81, 1.5, 1.51, 10.0, 10.1, None]
    df = spark.createDataFrame([(s,) for s in scores], "s double").select(S.stockout_bucket("s").alias("b"))
    assert [r.b for r in df.collect()] == ["nan", "low", "low", "medium", "medium", "high", "high", "nan", "nan"]


def test_vector_parsing(spark):
    texts = ["[1,2]", "[1,2,3,4,5,6,7,8,9]", "nonsense", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(S.parse_vector("t", 8).alias("v"))
    got = [list(r.v) for r in df.collect()]
    assert got == [[1, 2, 0, 0, 0, 0, 0, 0], [1, 2, 3, 4, 5, 6, 7, 8], [0.0] * 8, [0.0] * 8]


def test_event_key_is_fixed():
    assert K.EVENT_KEY == ["user_id", "session_id", "timestamp", "event_type", "product_id"]


def test_feedback_joins_two_streams_within_the_time(spark, tmp_path):
    hours, days, users = 24, 12, 5
    served, acted = [], []
    for d in range(days):
        for u in range(users):
            shown = at(24 * 60 * d + u)
            served.append((f"u{u}", f"p{d}", u + 1, shown))
            # At once, after 3 hours, at the last moment, a minute too late, a minute too early; a view; another user's click.
            for minutes, kind, user in ((0, "click", u), (180, "purchase", u), (hours * 60, "click", u), (hours * 60 + 1, "click", u),
                                        (-1, "click", u), (5, "view", u), (7, "click", u + 1)):
                acted.append((f"{d}-{u}-{minutes}-{kind}", f"u{user}", f"p{d}", kind, shown + dt.timedelta(minutes=minutes)))
    acted.append(("none", None, "p1", "click", at(1)))
    lists = spark.createDataFrame(served, "user_id string, product_id string, rank int, served_at timestamp")
    actions = spark.createDataFrame(acted, "event_id string, user_id string, product_id string, event_type string, timestamp timestamp")
    for d in range(-1, days + 2):  # one file for each day, in the order of time
        for name, df, ts in (("served", lists, "served_at"), ("events", actions, "timestamp")):
            day = df.where((F.col(ts) >= F.lit(at(24 * 60 * d))) & (F.col(ts) < F.lit(at(24 * 60 * (d + 1)))))
            day.coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def stream(name, df, ts):
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name)).withWatermark(ts, clickstream.WATERMARK)

    joined = clickstream.feedback_within(stream("events", actions, "timestamp"), stream("served", lists, "served_at"), hours)
    query = joined.writeStream.format("memory").queryName("feedback_within").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
    query.awaitTermination()
    got = sorted((r.event_id, r.user_id, r.rank) for r in spark.table("feedback_within").collect())
    batch = sorted((r.event_id, r.user_id, r.rank) for r in clickstream.feedback_within(actions, lists, hours).collect())
    want = sorted(
        (e, u, rank) for e, u, p, kind, t in acted if kind != "view" for v, q, rank, s in served
        if (u, p) == (v, q) and s <= t <= s + dt.timedelta(hours=hours)
    )
    assert got == batch == want and len(want) > 3 * days * users
    # Rows that can no longer find a partner leave the state.
    held = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress if p.stateOperators]
    assert max(held) > 0 and held[-1] < (len(served) + len(acted)) / 3


def test_a_table_is_validated_in_one_pass_and_one_for_each_grouped_rule(spark, tmp_path):
    rows = [event(str(i), kind="teleport" if i < 2 else "view", price=-1.0 if i == 1 else 1.0, competitor=None if i < 9 else 1.0) for i in range(40)]
    events(spark, rows).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = quality.findings(df, "events").collect()
    report = quality.report(df, "events")
    r = report.first()
    assert (r.row_count, r.warnings, r.errors, r.passed) == (40, *[sum(f.severity == s for f in found) for s in ("warning", "error")], False)
    assert {"event_type has unexpected value: teleport", "product_price contains values below 0.0"} <= {f.message for f in found}
    # With a scan of its own only for the allowed values.
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 2
    nothing = quality.report(df.limit(0), "events").first()
    assert nothing.row_count == 0 and nothing.errors >= 1 and not nothing.passed
