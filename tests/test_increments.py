"""Incremental builds equal full ones, whatever was loaded in between."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapdeck.config import Config
from snapdeck.plans import dims, increments as inc, job, models
from snapdeck.sources import fixtures as fx, lake, schemas

from conftest import SF_SMALL

CFG = Config(staging_start=dt.date(2001, 1, 1), calendar_start=dt.date(2001, 1, 1), min_latest_rows=1, min_latest_venues=1)
AS_OF = dt.datetime(2001, 11, 6, tzinfo=dt.timezone.utc)
TABLES = ["stg_dex_pools", "int_pool_metrics", "fct_pool_trailing_24h", "dim_pool", "dim_token"]


def same(x, y):
    x = x.select(*y.columns)
    assert x.count() == y.count() and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


@pytest.fixture(scope="module")
def rows(spark):
    out = fx.fx1_pools(spark, SF_SMALL).filter((F.col("snapshot_date") >= dt.date(2001, 9, 10)) & F.col("trailing_24h_volume_usd").isNotNull())
    return out.cache()


@pytest.fixture
def built(spark, rows, scratch):
    """A raw table without its last day, built; and the paths of a full build."""
    root = scratch("inc")
    mine = job.Paths(lake=f"{root}/l", raw=f"{root}/r", models=f"{root}/inc")
    full = job.Paths(lake=f"{root}/l", raw=f"{root}/r", models=f"{root}/full")
    days = sorted(r[0] for r in rows.select("snapshot_date").distinct().collect())
    load(mine, rows.filter(F.col("snapshot_date") < days[-1]))
    job.build_models(spark, mine, CFG, AS_OF)
    return mine, full, days


def load(paths, rows, overwrite=False):
    lake.load_slices(rows, paths.raw_table("raw_dex_pools"), overwrite=overwrite, schema=schemas.RAW_POOLS)


def test_reloaded_deleted_and_new_slices(spark, rows, built):
    """An old day with other volumes, a venue gone from one day, a whole day
    gone, the first day gone, the newest day new: all in one build."""
    mine, full, days = built
    doubled = F.col("trailing_24h_volume_usd") * 2
    load(mine, rows.filter(F.col("snapshot_date") == days[20]).withColumn("trailing_24h_volume_usd", doubled), overwrite=True)
    raw = mine.raw_table("raw_dex_pools")
    venue = rows.filter(F.col("snapshot_date") == days[30]).first()["dex_name"]
    assert lake.delete_slice(spark, raw, days[30], venue) > 0
    assert lake.delete_slice(spark, raw, days[40]) > 0 and lake.delete_slice(spark, raw, days[0]) > 0
    load(mine, rows.filter(F.col("snapshot_date") == days[-1]))
    out = job.build_models(spark, mine, CFG, AS_OF, since=days[-1])
    want = job.build_models(spark, full, CFG, AS_OF)
    for name in TABLES:
        same(out[name], want[name])
    for name in ("pools", "tokens", "last_rows", "slices"):
        same(job.state_store(spark, mine).read(name), job.state_store(spark, full).read(name))
    # nothing changed since: nothing is found
    change = job.find_increment(spark, mine, spark.read.parquet(raw), CFG)
    assert change.days.count() == 0


def test_only_days_that_depend_are_written(spark, rows, built):
    mine, _, days = built
    fact = mine.model_table("fct_pool_trailing_24h")
    before = {r[0]: r[2] for r in lake.day_signatures(spark, fact).collect()}
    load(mine, rows.filter(F.col("snapshot_date") == days[-1]))
    job.build_models(spark, mine, CFG, AS_OF, since=days[-1])
    after = {r[0]: r[2] for r in lake.day_signatures(spark, fact).collect()}
    assert {d for d in after if after[d] != before.get(d)} == {days[-1]}
    # a load that writes the same rows again leaves the models as they are
    load(mine, rows.filter(F.col("snapshot_date") == days[5]), overwrite=True)
    raw = spark.read.parquet(mine.raw_table("raw_dex_pools"))
    assert job.find_increment(spark, mine, raw, CFG).days.count() == 0


def test_build_after_one_that_failed_halfway(spark, rows, built, monkeypatch):
    """The first build publishes staging and stops; the rows it replaced are in
    the journal, so the next one takes the right ones off the dimensions."""
    mine, full, days = built
    load(mine, rows.filter(F.col("snapshot_date") == days[10]).withColumn("trailing_24h_volume_usd", F.col("trailing_24h_volume_usd") + 1), True)
    stop = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    monkeypatch.setattr(inc, "token_state_after", stop)
    with pytest.raises(RuntimeError):
        job.build_models(spark, mine, CFG, AS_OF, since=days[10])
    monkeypatch.undo()
    load(mine, rows.filter(F.col("snapshot_date") == days[11]).withColumn("tvl_usd", F.col("tvl_usd") + 1), True)
    load(mine, rows.filter(F.col("snapshot_date") == days[-1]))
    out = job.build_models(spark, mine, CFG, AS_OF, since=days[-1])
    want = job.build_models(spark, full, CFG, AS_OF)
    for name in TABLES:
        same(out[name], want[name])


def test_failed_check_leaves_the_published_table(spark, rows, built):
    mine, _, days = built
    before = spark.read.parquet(mine.model_table("stg_dex_pools")).count()
    bad = rows.filter(F.col("snapshot_date") == days[-1]).withColumn("trailing_24h_volume_usd", F.lit(-1.0))
    load(mine, bad)
    for since in (days[-1], None):
        with pytest.raises(job.CheckFailed):
            job.build_models(spark, mine, CFG, AS_OF, since=since)
        assert spark.read.parquet(mine.model_table("stg_dex_pools")).count() == before
    # a full build was begun: the state is gone, the next one is full as well
    assert job.find_increment(spark, mine, spark.read.parquet(mine.raw_table("raw_dex_pools")), CFG) is None


def test_other_settings_ask_for_a_full_build(spark, built):
    mine, _, _ = built
    raw = spark.read.parquet(mine.raw_table("raw_dex_pools"))
    later = Config(staging_start=dt.date(2001, 9, 20))
    assert job.find_increment(spark, mine, raw, later) is None and job.find_increment(spark, mine, raw, CFG) is not None


POOL = "snapshot_date date, dex_name string, pool_address string, trailing_24h_volume_usd decimal(38,9)"


def test_days_carried_over_the_frames(spark):
    """Exactly the days whose metrics differ, or more by equal values only."""
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    full = [(day(k), "orca", p, Decimal(k * 10 + 1)) for p, step in (("daily", 1), ("rare", 3), ("other", 2)) for k in range(0, 60, step)]
    old = spark.createDataFrame(full, POOL)
    gone = old.filter(~((F.col("snapshot_date") == day(6)) & (F.col("pool_address") == "daily")))
    days = spark.createDataFrame([(day(6),)], "snapshot_date date")
    got = inc.carried_days(inc.of_days(old, days), inc.of_days(gone, days), gone)
    assert sorted(r[0] for r in got.collect()) == [day(k) for k in range(7, 14)]
    changed = old.withColumn("trailing_24h_volume_usd", F.when((F.col("snapshot_date") == day(6)) & (F.col("pool_address") == "rare"), 5).otherwise(F.col("trailing_24h_volume_usd")).cast("decimal(38,9)"))
    got = inc.carried_days(inc.of_days(old, days), inc.of_days(changed, days), changed)
    assert sorted(r[0] for r in got.collect()) == [day(k) for k in range(9, 28, 3)]
    assert inc.carried_days(inc.of_days(old, days), inc.of_days(old, days), old).count() == 0


def test_fingerprints_see_nulls_order_and_copies(spark):
    schema = "snapshot_date date, dex_name string, a string, b string"
    d = dt.date(2024, 1, 1)
    one = [(d, "x", None, "v"), (d, "x", "w", None), (d, "x", "w", None)]
    prints = lambda rows: inc.slice_fingerprints(spark.createDataFrame(rows, schema).repartition(3))
    base = prints(one)
    assert inc.changed_slices(base, prints(one[::-1])).count() == 0
    for other in ([*one[1:]], [(d, "x", "v", None), *one[1:]], [*one, one[0]], [one[0], one[0], one[1]]):
        assert [r.change for r in inc.changed_slices(base, prints(other)).collect()] == ["changed"]
    assert [r.change for r in inc.changed_slices(base, prints([(d, "y", "a", "b")])).orderBy("change").collect()] == ["gone", "new"]


def test_dirty_days_prune_partitions(spark, built):
    mine, _, days = built
    stg = spark.read.parquet(mine.model_table("stg_dex_pools"))
    some = spark.createDataFrame([(days[3],)], "snapshot_date date")
    plan = inc.of_days(stg, some)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "SortMergeJoin" not in plan


def test_states_carried_on_equal_states_made_new(spark, rows):
    old = models.stg_pools(rows, CFG)
    u = F.unix_date("snapshot_date")
    new = old.filter(~((u % 5 == 0) & (F.col("dex_name") == "orca"))).withColumn(
        "trailing_24h_fees_usd", F.when(u % 7 == 0, None).otherwise(F.col("trailing_24h_fees_usd"))
    )
    days = old.filter((u % 5 == 0) | (u % 7 == 0)).select("snapshot_date").distinct()
    b, a = inc.of_days(old, days), inc.of_days(new, days)
    same(inc.pool_state_after(dims.pool_state(old), b, a, days, new), dims.pool_state(new))
    same(inc.token_state_after(dims.token_state(old), b, a, days, new), dims.token_state(new))
    same(inc.last_rows_after(models.last_rows_per_pool(old), a, days, new), models.last_rows_per_pool(new))
    # and all rows gone
    none = old.filter("false")
    every = old.select("snapshot_date").distinct()
    assert inc.pool_state_after(dims.pool_state(old), old, none, every, none).count() == 0
    assert inc.last_rows_after(models.last_rows_per_pool(old), none, every, none).count() == 0
