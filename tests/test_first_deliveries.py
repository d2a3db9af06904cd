"""Exact deduplication of a stream: the smallest copy wins until the watermark has passed, later ones are counted."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from merchlens.operators import cleaning
from merchlens.streaming import clickstream
from pyspark.sql import functions as F

SCHEMA = (
    "event_id string, user_id bigint, session_id string, timestamp timestamp, event_type string, product_id bigint, "
    "product_price double, discount_percentage double, competitor_price double, dwell_time_seconds double, page_position int, purchase_label int"
)


def row(i, minute, user=1, dwell=1.0, competitor=9.0):
    at = None if minute is None else dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minute, microseconds=7)
    return dict(event_id=i, user_id=user, session_id="s", timestamp=at, event_type="view", product_id=5, product_price=10.0,
                discount_percentage=0.1, competitor_price=competitor, dwell_time_seconds=dwell, page_position=None, purchase_label=0)


def stream_of(spark, folder, batches):
    empty = spark.createDataFrame([], SCHEMA)
    types = pa.schema([pa.field(f.name, {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "int": pa.int32(),
                                          "timestamp": pa.timestamp("us", "UTC")}[f.dataType.simpleString()]) for f in empty.schema])
    for n, rows in enumerate(batches):
        path = os.path.join(folder, f"part-{n}.parquet")
        pq.write_table(pa.Table.from_pylist(rows, types), path)
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    read = spark.readStream.schema(empty.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return read.withWatermark("timestamp", clickstream.WATERMARK)


def test_smallest_copy_wins_and_late_ones_are_counted(spark, tmp_path):
    batches = [
        [row("b", 0, dwell=5.0), row("d", 5), row("x", None), row(None, 9), row("y", 9, user=None)],
        [row("c", 0), row("a", 0, dwell=None, competitor=None), row("k", 9, dwell=2000.0)],  # smaller and larger copies of the first
        [row("e", 300)],  # the watermark goes to 4 hours
        [row("a2", 0), row("f", 310)],  # the first rows go out with this batch, after its own copies are compared
        [row("0", 0), row("1", 5), row("i", 311)],  # late copies, smaller than what went out
        [row("g", 900)],
        [row("h", 901)],
    ]
    out, late = clickstream.drain_counted(clickstream.first_deliveries(stream_of(spark, tmp_path, batches)), "first-test")
    got = {r.event_id: r for r in out.collect()}
    assert {i: r.copies for i, r in got.items()} == {"a": 4, "d": 1, "k": 2, "e": 1, "f": 1, "i": 1} and late == 2
    assert got["a"].dwell_time_seconds == 0.0 and got["a"].competitor_price == 10.0 and got["k"].dwell_time_seconds == 900.0
    # The same rows as the batch keeps of what was in time.
    in_time = [r for b in batches[:4] for r in b] + [batches[4][2]]
    rows = spark.createDataFrame([tuple(r.values()) for r in in_time], SCHEMA)
    want = cleaning.clean_events(rows)
    assert out.drop("copies").exceptAll(want).count() == 0 and want.exceptAll(out.drop("copies")).count() == 0


def test_an_event_that_nobody_closes_stays_in_the_state(spark, tmp_path):
    out, late = clickstream.drain_counted(clickstream.first_deliveries(stream_of(spark, tmp_path, [[row("a", 0)], [row("b", 30)]])), "open-test")
    assert out.count() == 0 and late == 0
    assert out.where(F.col("copies") > 0).columns[-1] == "copies"


def test_every_late_copy_is_counted_and_nothing_runs_in_python(spark, tmp_path):
    batches = [[row("a", 0)], [row("e", 300)], [row("f", 310)], [row("1", 0), row("2", 0), row("3", 0)], [row("g", 900)], [row("h", 901)]]
    stream = clickstream.first_deliveries(stream_of(spark, tmp_path, batches))
    assert "Pandas" not in stream._jdf.queryExecution().analyzed().toString()
    out, late = clickstream.drain_counted(stream, "late-test")
    assert late == 3 and {r.event_id: r.copies for r in out.collect()} == {"a": 1, "e": 1, "f": 1}
