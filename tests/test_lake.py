"""Slice loads are idempotent and touch only their slices."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapdeck.operators.joins import materialize
from snapdeck.sources import fixtures as fx
from snapdeck.sources import lake, schemas

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def month(spark):
    raw = fx.fx1_pools(spark, SF_SMALL).filter(F.col("snapshot_date").between(dt.date(1998, 3, 1), dt.date(1998, 3, 31)))
    return materialize(lake.conform(raw, schemas.RAW_POOLS))


def content(spark, path):
    return spark.read.parquet(path).select(*schemas.POOL_COLUMNS)


def test_load_twice_equals_once(spark, scratch, month):
    path = scratch("raw")
    first = lake.load_slices(month, path)
    again = lake.load_slices(month, path)
    assert first["rows_loaded"] == month.count() and again == {"rows_loaded": 0, "slices_skipped": month.select("snapshot_date", "dex_name").distinct().count()}
    got = content(spark, path)
    assert got.exceptAll(month).count() == 0 and month.exceptAll(got).count() == 0


def shared_day(month):
    """A (day, venue) slice whose day also holds another venue."""
    r = month.groupBy("snapshot_date").agg(F.countDistinct("dex_name").alias("n"), F.min("dex_name").alias("v")).filter("n >= 2").orderBy("snapshot_date").first()
    return r.snapshot_date, r.v


def test_overwrite_replaces_only_its_slice(spark, scratch, month):
    path = scratch("raw")
    lake.load_slices(month, path)
    day, venue = shared_day(month)
    newer = month.filter((F.col("snapshot_date") == day) & (F.col("dex_name") == venue)).withColumn("source_file", F.lit("new"))
    assert newer.count() > 0
    lake.load_slices(newer, path, overwrite=True)
    got = content(spark, path)
    expected = month.filter(~((F.col("snapshot_date") == day) & (F.col("dex_name") == venue))).unionByName(newer)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_skip_keeps_existing_and_appends_new(spark, scratch, month):
    path = scratch("raw")
    lake.load_slices(month.filter(F.col("dex_name") == "raydium").withColumn("source_file", F.lit("old")), path)
    m = lake.load_slices(month, path)
    got = content(spark, path)
    assert got.filter("dex_name = 'raydium'").filter("source_file <> 'old'").count() == 0
    assert got.count() == month.count() and m["rows_loaded"] == month.filter("dex_name <> 'raydium'").count()


def test_delete_slice_and_probe(spark, scratch, month):
    path = scratch("raw")
    lake.load_slices(month, path)
    day, venue = shared_day(month)
    other = month.filter((F.col("snapshot_date") == day) & (F.col("dex_name") != venue)).first().dex_name
    assert lake.slice_exists(spark, path, day, venue)
    n = month.filter((F.col("snapshot_date") == day) & (F.col("dex_name") == venue)).count()
    assert lake.delete_slice(spark, path, day, venue) == n
    assert not lake.slice_exists(spark, path, day, venue) and lake.slice_exists(spark, path, day, other)
    lake.delete_slice(spark, path, day)
    assert not lake.slice_exists(spark, path, day)
    assert content(spark, path).count() == month.filter(F.col("snapshot_date") != day).count()


def test_retention(spark):
    m = spark.createDataFrame([("orca", dt.date(2026, 1, 1)), ("orca", dt.date(2026, 3, 1))], "source string, snapshot_date date")
    # a slice ages from its landing, the day after its date
    expired = lambda frame, day: [r.snapshot_date for r in lake.expired_slices(frame, F.lit(day), 90).collect()]
    assert expired(m, dt.datetime(2026, 4, 1)) == []
    assert expired(m, dt.datetime(2026, 4, 2)) == [dt.date(2026, 1, 1)]
    late = m.withColumn("snapshot_at", F.lit(dt.datetime(2026, 1, 10, 2)))
    assert expired(late, dt.datetime(2026, 4, 2)) == []


def test_paths():
    assert lake.pool_slice_path_str("raw", "orca", dt.date(2026, 6, 3)) == "raw/dex_pools/dex=orca/date=2026-06-03/orca_20260603.json"


def test_ensure_table_and_type_labels(spark, scratch):
    from snapdeck.functions import table_type_label

    path = scratch("empty")
    assert lake.ensure_table(spark, path, schemas.RAW_POOLS) and not lake.ensure_table(spark, path, schemas.RAW_POOLS)
    assert lake.read_table(spark, path, schemas.RAW_POOLS).count() == 0 and not lake.slice_exists(spark, path, dt.date(2026, 1, 1))
    month_one = spark.createDataFrame([], schemas.RAW_POOLS)
    assert lake.load_slices(month_one, path)["rows_loaded"] == 0
    codes = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    assert [r[0] for r in codes.select(table_type_label("c")).collect()] == ["TABLE", "VIEW", "OTHER"]


def test_storage_report_counts_rows_and_bytes(spark, scratch, month):
    import os

    from snapdeck.plans.serving import storage_by_table

    path = scratch("raw")
    lake.load_slices(month, path)
    rep = storage_by_table(spark, {("raw", "raw_dex_pools"): path}, {("marts", "fct"): month}).collect()
    table = [r for r in rep if r.table_type == "TABLE"][0]
    local = path.removeprefix("file:")
    on_disk = sum(
        os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(local) for f in fs if f.endswith(".parquet")
    )
    assert table.total_rows == month.count() and table.bytes == on_disk
    assert [r.table_type for r in rep] == ["TABLE", "VIEW"]


def test_required_fields_are_enforced(spark, scratch, month):
    path = scratch("raw")
    bad = month.limit(3).withColumn("pool_address", F.when(F.col("tvl_usd").isNotNull(), F.lit(None)).cast("string"))
    with pytest.raises(Exception, match="required"):
        lake.load_slices(bad, path, schema=schemas.RAW_POOLS)
    assert not lake.has_rows_on_disk(spark, path)
    assert lake.load_slices(month.limit(3), path, schema=schemas.RAW_POOLS)["rows_loaded"] == 3


def test_market_documents_round_trip(spark, scratch):
    from snapdeck.sources import ingest

    docs = fx.fx4_market_documents(spark, SF_SMALL).filter(F.col("snapshot_date").between(dt.date(1998, 3, 1), dt.date(1998, 3, 10)))
    root = scratch("lake")
    lake.land_market_documents(docs, root)
    back = lake.read_market_documents(spark, root, F.lit(dt.datetime(2026, 1, 1)))
    cols = ["snapshot_date", "dex_name", "trailing_24h_volume_usd", "trailing_7d_volume_usd", "total_volume_usd"]
    a = ingest.parse_market_documents(back).select(cols)
    b = ingest.parse_market_documents(docs).select(cols)
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    assert back.filter(~F.col("source_file").contains("/dex_market_share/date=")).count() == 0
