"""ST1: count error events per aligned 1-hour window; alert when the count > 0.

The same aggregation runs on a batch DataFrame and on a stream. On a stream
it carries a watermark and runs in ``update`` mode, so an alert fires while
its hour is still open; rows arriving later than the watermark are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

WINDOW = "1 hour"
ERROR_TYPES = ("error",)  # event types at or above ERROR severity


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def hourly_error_counts(events: DataFrame, ts: str = "ts", type_col: str = "event_type", watermark: str | None = None) -> DataFrame:
    """Per 1-hour window: number of error events and whether to alert.

    Groups by the ``window`` struct itself (grouping by ``window.start``
    would drop the watermark); start/end are extracted afterwards.
    """
    ev = event_time(events.select(ts, type_col), ts)
    if watermark:
        ev = ev.withWatermark(ts, watermark)
    is_error = F.lower(F.col(type_col)).isin(*ERROR_TYPES)
    agg = ev.groupBy(F.window(ts, WINDOW).alias("w")).agg(F.count_if(is_error).cast("long").alias("error_count"))
    return agg.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "error_count",
        (F.col("error_count") > 0).alias("alert"),
    )


def error_alert_stream(stream: DataFrame, watermark: str = WINDOW) -> DataFrame:
    """Streaming form: watermark + windowed counts (use outputMode('update'))."""
    return hourly_error_counts(stream, watermark=watermark)


def _stamp_in_order(spark: SparkSession, files: list[str], first: int = 0) -> None:
    """Give files modification times in their order, which a file stream reads them in."""
    jvm = spark.sparkContext._jvm
    base = 1_000_000_000_000  # a fixed epoch-ms origin; only the order matters
    for i, f in enumerate(files, first):
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(path, base + i * 1000, -1)


def land_events_in_order(events: DataFrame, path: str, num_files: int | None = None, first: int = 0) -> int:
    """Append events as files of equal size in time order (a busy day or hour
    takes several) and stamp the files so that a file stream reads them oldest
    first, after the ``first`` files that are there. Returns how many there
    are then."""
    spark = events.sparkSession
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    there = set(_files(spark, path))
    events.repartitionByRange(n, "ts").sortWithinPartitions("ts").write.mode("append").parquet(path)
    new = sorted(set(_files(spark, path)) - there)  # part-00000 ... in the order of the ranges
    _stamp_in_order(spark, new, first)
    return first + len(new)


def _files(spark: SparkSession, path: str) -> list[str]:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    return [st.getPath().toString() for st in fs.listStatus(root) if st.getPath().getName().startswith("part-")]


def land_events_by_day(events: DataFrame, path: str) -> list[str]:
    """Write events as one folder per day (a busy day in several files) and
    stamp the files' modification times in day order, so a file stream source
    reads them oldest first."""
    spark = events.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dated = events.withColumn("day", F.to_date(F.col("ts")))
    dated.repartitionByRange(n, "day", "ts").write.mode("overwrite").partitionBy("day").parquet(path)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = sorted(st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory())
    _stamp_in_order(spark, [f for d in days for f in sorted(_files(spark, f"{path}/{d}"))])
    return days


class DroppedRows(StreamingQueryListener):
    """Counts what the watermark dropped, from the queries' progress: rows that
    reached the state after partial aggregation, by batch. How many events
    these stand for, :func:`corrections` tells."""

    def __init__(self) -> None:
        self.by_batch: dict[tuple[str, int], int] = {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.by_batch[str(p.id), p.batchId] = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def of(self, query) -> int:
        return sum(n for (q, _), n in self.by_batch.items() if q == str(query.id))


def corrections(events: DataFrame, streamed: DataFrame) -> DataFrame:
    """Windows whose count differs between all landed events and what was
    streamed: (window_start, window_end, streamed_count, error_count, missed).
    What came after the watermark is in ``missed``; the alert is that of the
    corrected count."""
    key = ["window_start", "window_end"]
    seen = streamed.select(*key, F.col("error_count").alias("streamed_count"))
    met = hourly_error_counts(events).join(seen, key, "left")
    return met.filter(~F.col("error_count").eqNullSafe(F.col("streamed_count"))).select(
        *key,
        F.coalesce("streamed_count", F.lit(0)).alias("streamed_count"),
        "error_count",
        (F.col("error_count") - F.coalesce("streamed_count", F.lit(0))).alias("missed"),
        "alert",
    )


@dataclass
class Replay:
    """What a replayed stream gave."""

    alerts: DataFrame  # the last state of each window
    dropped_rows: int  # by the watermark, after partial aggregation


def replay_alert_stream(
    spark: SparkSession, events: DataFrame, work_dir: str, files_per_trigger: int = 2, late: DataFrame | None = None
) -> DataFrame:
    """The last state of each window of :func:`replay`."""
    return replay(spark, events, work_dir, files_per_trigger, late).alerts


def replay(
    spark: SparkSession, events: DataFrame, work_dir: str, files_per_trigger: int = 2, late: DataFrame | None = None
) -> Replay:
    """Run the streaming alert over ``events`` landed as time-ordered files,
    ``late`` ones after all others (Trigger.availableNow, ``update`` mode).
    Every micro-batch's updated windows are appended to a table by
    ``foreachBatch``; the latest state of a window is its largest count
    (counts only grow)."""
    src, out, ckpt = f"{work_dir}/events", f"{work_dir}/alerts", f"{work_dir}/checkpoint"
    landed = land_events_in_order(events, src)
    if late is not None:
        land_events_in_order(late, src, 1, landed)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(src)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # idempotent per micro-batch: a batch replayed after a failure replaces
        # its own folder instead of appending its rows twice
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(out)
        )

    listener = DroppedRows()
    spark.streams.addListener(listener)
    try:
        q = (
            error_alert_stream(stream)
            .writeStream.outputMode("update")
            .option("checkpointLocation", ckpt)
            .foreachBatch(sink)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        # progress reaches listeners by the bus; what it hasn't brought yet is in the query
        for p in q.recentProgress:
            listener.by_batch[str(q.id), p["batchId"]] = sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
    finally:
        spark.streams.removeListener(listener)
    updates = spark.read.parquet(out)
    last = updates.groupBy("window_start", "window_end").agg(F.max("error_count").alias("error_count")).withColumn(
        "alert", F.col("error_count") > 0
    )
    return Replay(last, listener.of(q))
