"""The streamed alert equals the batch alert on time-ordered files; rows later
than the watermark are dropped."""

from pyspark.sql import functions as F

from snapdeck.sources import fixtures as fx
from snapdeck.streaming import alerts

from conftest import SF_SMALL


def test_stream_equals_batch(spark, scratch):
    events = fx.table(spark, SF_SMALL, "events")
    batch = alerts.hourly_error_counts(events)
    stream = alerts.replay_alert_stream(spark, events, scratch("alerts"), files_per_trigger=3)
    cols = ["window_start", "window_end", "error_count", "alert"]
    assert batch.select(cols).exceptAll(stream.select(cols)).count() == 0
    assert stream.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_late_rows_are_dropped(spark, scratch):
    events = fx.table(spark, SF_SMALL, "events")
    day = F.to_date("ts")
    first_day = events.agg(F.min(day)).first()[0]
    on_time = events.filter(day > first_day)
    late = events.filter(day == first_day)
    late_errors = late.filter("event_type = 'error'").count()
    assert late_errors > 0
    work = scratch("late")
    # land the first day AFTER the rest: its rows are older than the watermark
    on_days = alerts.land_events_by_day(on_time, f"{work}/events")
    late.withColumn("day", day).write.mode("append").partitionBy("day").parquet(f"{work}/events")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{work}/events/day={first_day.isoformat()}")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(root):
        fs.setTimes(st.getPath(), 1_000_000_000_000 + (len(on_days) + 5) * 1000, -1)
    schema = events.schema.add("day", "date")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{work}/events")
    out = f"{work}/out"
    q = (
        alerts.error_alert_stream(stream).writeStream.outputMode("update").option("checkpointLocation", f"{work}/ck")
        .foreachBatch(lambda b, i: b.write.mode("append").parquet(out)).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = spark.read.parquet(out).groupBy("window_start").agg(F.max("error_count").alias("n"))
    total = got.agg(F.sum("n")).first()[0]
    assert total == events.filter("event_type = 'error'").count() - late_errors


def test_late_rows_are_counted_and_corrected(spark, scratch):
    """Events that come after the watermark: the listener counts what the state
    dropped, the corrections bring the events' windows."""
    events = fx.table(spark, SF_SMALL, "events")
    day = F.to_date("ts")
    first_day = events.agg(F.min(day)).first()[0]
    late, on_time = events.filter(day == first_day), events.filter(day > first_day)
    made = alerts.replay(spark, on_time, scratch("late"), files_per_trigger=3, late=late)
    assert 0 < made.dropped_rows <= late.count()
    fixes = alerts.corrections(events, made.alerts).collect()
    want = {r.window_start: r.error_count for r in alerts.hourly_error_counts(late).collect()}
    assert {r.window_start: r.missed for r in fixes} == want and all(r.streamed_count == 0 for r in fixes)
    assert sum(r.missed for r in fixes) == late.filter("event_type = 'error'").count() > 0
    whole = alerts.replay(spark, events, scratch("whole"))
    assert whole.dropped_rows == 0 and alerts.corrections(events, whole.alerts).count() == 0


def test_files_are_in_time_order_whatever_the_days_hold(spark, scratch):
    events = fx.table(spark, SF_SMALL, "events")
    path = scratch("ordered")
    assert alerts.land_events_in_order(events, path, 6) == 6
    spans = [spark.read.parquet(f).agg(F.min("ts"), F.max("ts")).first() for f in sorted(alerts._files(spark, path))]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
