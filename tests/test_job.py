"""The daily job end to end over landed pages (sf0.001, three days)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapdeck.config import Config
from snapdeck.plans import job
from snapdeck.sources import fixtures as fx

from conftest import SF_SMALL

DAYS = [dt.date(2001, 10, 30), dt.date(2001, 10, 31), dt.date(2001, 11, 1)]


@pytest.fixture(scope="module")
def landed(spark):
    from snapdeck.session import scratch_path

    root = scratch_path(spark, "job")
    paths = job.Paths(lake=f"{root}/lake", raw=f"{root}/raw", models=f"{root}/models")
    pages = fx.fx5_pages(spark, SF_SMALL).filter(F.col("snapshot_date").isin(*DAYS))
    for d in DAYS:
        job.land(spark, paths, pages.filter(F.col("snapshot_date") == d), dt.datetime.combine(d + dt.timedelta(days=1), dt.time(2), dt.timezone.utc))
    return paths


def test_daily_runs_and_idempotence(spark, landed):
    cfg = Config(staging_start=dt.date(2001, 1, 1), calendar_start=dt.date(2001, 10, 1), min_latest_rows=1)
    as_of = dt.datetime(2001, 11, 2, 3, tzinfo=dt.timezone.utc)
    for d in DAYS[:-1]:
        r = job.run(spark, landed, run_date=d, skip_transform=True, cfg=cfg, as_of=as_of)
        assert not r.failures
    # the 10-supplier fixture's last day keeps 2 venues after the floor: the
    # latest-snapshot gate must stop the build with the default thresholds
    with pytest.raises(job.CheckFailed) as gate:
        job.run(spark, landed, run_date=DAYS[-1], cfg=cfg, as_of=as_of)
    assert "assert_pools_all_dexes_latest" in str(gate.value)
    small = Config(staging_start=cfg.staging_start, calendar_start=cfg.calendar_start, min_latest_rows=1, min_latest_venues=2)
    r = job.run(spark, landed, run_date=DAYS[-1], cfg=small, as_of=as_of)
    assert r.checks and all((c.get("failures") or 0) == 0 for c in r.checks)
    assert sum(r.rows_loaded.values()) == 0  # loaded by the gated run already
    again = job.run(spark, landed, run_date=DAYS[-1], skip_transform=True, cfg=cfg, as_of=as_of)
    assert again.rows_loaded == {"raydium": 0, "orca": 0, "meteora": 0}
    raw = spark.read.parquet(landed.raw_table("raw_dex_pools"))
    from snapdeck.sources.ingest import quality_floor

    kept = quality_floor(fx.fx1_pools(spark, SF_SMALL).filter(F.col("snapshot_date").isin(*DAYS)), cfg)
    assert raw.count() == kept.count()
    assert {r[0] for r in raw.select("snapshot_date").distinct().collect()} == {r[0] for r in kept.select("snapshot_date").distinct().collect()}
    assert raw.filter(F.col("trailing_24h_volume_usd") < cfg.volume_floor).count() == 0
    # snapshot_at comes from the manifest of the landing run
    assert raw.filter(F.col("snapshot_at") != F.timestamp_seconds((F.unix_date("snapshot_date").cast("long") + 1) * 86400 + 7200)).count() == 0
    assert spark.table("fct_pool_trailing_24h").count() == raw.count()
    fresh = job.run_freshness(spark, landed, as_of=as_of)
    assert fresh[0]["status"] == "pass"
    with pytest.raises(job.CheckFailed):
        job.run_freshness(spark, landed, as_of=as_of + dt.timedelta(hours=30))


def test_source_failure_is_isolated(spark, landed):
    cfg = Config(staging_start=dt.date(2001, 1, 1))
    with pytest.raises(job.PipelineFailed) as e:
        job.run(spark, landed, run_date=DAYS[0], sources=["raydium", "nosuch"], skip_transform=True, overwrite=True, cfg=cfg)
    assert "nosuch" in e.value.failures and "raydium" not in e.value.failures
    manifest = spark.read.parquet(landed.manifest)
    assert manifest.filter(F.col("raw_record_count") > 0).count() == manifest.count() > 0


def test_incremental_build_equals_full(spark):
    from snapdeck.session import scratch_path

    cfg = Config(staging_start=dt.date(2001, 1, 1), calendar_start=dt.date(2001, 1, 1), min_latest_rows=1, min_latest_venues=1)
    as_of = dt.datetime(2001, 11, 6, tzinfo=dt.timezone.utc)
    # as ingest hands rows over: without a volume there is no row (the raw test gates on it)
    raw = fx.fx1_pools(spark, SF_SMALL).filter((F.col("snapshot_date") >= dt.date(2001, 6, 1)) & F.col("trailing_24h_volume_usd").isNotNull())
    from snapdeck.sources import lake, schemas

    root = scratch_path(spark, "inc")
    full = job.Paths(lake=f"{root}/l1", raw=f"{root}/r", models=f"{root}/full")
    inc = job.Paths(lake=f"{root}/l2", raw=f"{root}/r", models=f"{root}/inc")
    cut = dt.date(2001, 10, 1)
    lake.load_slices(raw.filter(F.col("snapshot_date") < cut), full.raw_table("raw_dex_pools"), schema=schemas.RAW_POOLS)
    job.build_models(spark, inc, cfg, as_of)  # full build over the older days
    lake.load_slices(raw.filter(F.col("snapshot_date") >= cut), full.raw_table("raw_dex_pools"), schema=schemas.RAW_POOLS)
    inc_out = job.build_models(spark, inc, cfg, as_of, since=cut)  # incremental: state covers the run
    full_out = job.build_models(spark, full, cfg, as_of)  # full rebuild over everything
    for d in ("dim_pool", "dim_token"):
        x, y = inc_out[d], full_out[d]
        assert x.count() == y.count() > 0 and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    # a rerun of an already covered day falls back to rebuilding the state
    rerun = job.build_models(spark, inc, cfg, as_of, since=cut - dt.timedelta(days=10))
    for d in ("dim_pool", "dim_token"):
        x, y = rerun[d], full_out[d]
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0
    a = spark.read.parquet(inc.model_table("int_pool_metrics"))
    b = spark.read.parquet(full.model_table("int_pool_metrics"))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    sa, sb = (job.state_store(spark, p).read("last_rows") for p in (inc, full))
    assert sa.exceptAll(sb).count() == 0 and sb.exceptAll(sa).count() == 0


def test_incremental_build_after_an_unbuilt_day(spark):
    """A day that was loaded and not built enters with the next build."""
    from snapdeck.session import scratch_path
    from snapdeck.sources import lake, schemas

    cfg = Config(staging_start=dt.date(2001, 1, 1), calendar_start=dt.date(2001, 1, 1), min_latest_rows=1, min_latest_venues=1)
    as_of = dt.datetime(2001, 11, 6, tzinfo=dt.timezone.utc)
    raw = fx.fx1_pools(spark, SF_SMALL).filter((F.col("snapshot_date") >= dt.date(2001, 9, 20)) & F.col("trailing_24h_volume_usd").isNotNull())
    days = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    root = scratch_path(spark, "gap")
    inc = job.Paths(lake=f"{root}/l", raw=f"{root}/r", models=f"{root}/inc")
    full = job.Paths(lake=f"{root}/l", raw=f"{root}/r", models=f"{root}/full")
    load = lambda rows: lake.load_slices(rows, inc.raw_table("raw_dex_pools"), schema=schemas.RAW_POOLS)
    load(raw.filter(F.col("snapshot_date") < days[-2]))
    job.build_models(spark, inc, cfg, as_of)
    load(raw.filter(F.col("snapshot_date") >= days[-2]))  # two days, the first never built
    out = job.build_models(spark, inc, cfg, as_of, since=days[-1])
    want = job.build_models(spark, full, cfg, as_of)
    for name in ("stg_dex_pools", "int_pool_metrics", "dim_pool", "dim_token", "fct_pool_trailing_24h"):
        x, y = out[name], want[name]
        assert x.count() == y.count() > 0 and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
    # marts are tables that another session can read
    for name in ("fct_pool_trailing_24h", "dim_pool", "dim_token", "dim_date"):
        assert spark.newSession().read.parquet(inc.model_table(name)).count() > 0


def test_landing_twice_and_failed_overwrite(spark, landed):
    """A second landing changes nothing; an overwrite that fails leaves the slice."""
    d = DAYS[0]
    pages = fx.fx5_pages(spark, SF_SMALL).filter(F.col("snapshot_date") == d)
    at = dt.datetime.combine(d + dt.timedelta(days=1), dt.time(2), dt.timezone.utc)
    from snapdeck.sources import lake

    before = lake.read_landed_pages(spark, landed.lake).count()
    listed = spark.read.parquet(landed.manifest).count()
    job.land(spark, landed, pages, at)
    lake.land_pages(pages, landed.lake)
    assert lake.read_landed_pages(spark, landed.lake).count() == before
    assert spark.read.parquet(landed.manifest).count() == listed

    cfg = Config(staging_start=dt.date(2001, 1, 1))
    job.run(spark, landed, run_date=d, sources=["raydium"], skip_transform=True, cfg=cfg)
    held = lambda: spark.read.parquet(landed.raw_table("raw_dex_pools")).filter((F.col("dex_name") == "raydium") & (F.col("snapshot_date") == d)).count()
    rows = held()
    cut = pages.filter("source = 'raydium'").withColumn("body", F.expr("left(body, length(body) - 9)"))
    lake.land_pages(cut, landed.lake, overwrite=True)
    with pytest.raises(job.PipelineFailed):
        job.run(spark, landed, run_date=d, sources=["raydium"], skip_transform=True, overwrite=True, cfg=cfg)
    assert held() == rows > 0
    lake.land_pages(pages.filter("source = 'raydium'"), landed.lake, overwrite=True)


def test_cli_run_and_freshness(spark, landed):
    """The command line drives the same job (in this test's session)."""
    import snapdeck.__main__ as cli

    stop = spark.stop
    spark.stop = lambda: None  # keep the shared test session alive
    try:
        args = ["--lake", landed.lake, "--raw", landed.raw, "--models", landed.models, "--date", DAYS[0].isoformat()]
        assert cli.main(["run", *args, "--skip-transform", "--sources", "raydium,orca"]) == 0
        assert cli.main(["freshness", *args]) == 1  # the fixture's days are long past: stale
    finally:
        spark.stop = stop


def test_market_share_path(spark):
    from snapdeck.session import scratch_path
    from snapdeck.sources import lake

    root = scratch_path(spark, "ms")
    paths = job.Paths(lake=f"{root}/lake", raw=f"{root}/raw", models=f"{root}/models")
    # an empty landing reads as an empty frame
    lake.land_market_documents(fx.fx4_market_documents(spark, SF_SMALL).limit(0), f"{root}/empty")
    assert lake.read_market_documents(spark, f"{root}/empty").count() == 0
    day = dt.date(2001, 7, 31)  # the orders table ends on 2001-08-01
    pages = fx.fx5_pages(spark, SF_SMALL).filter(F.col("snapshot_date") == day)
    job.land(spark, paths, pages, dt.datetime.combine(day + dt.timedelta(days=1), dt.time(2), dt.timezone.utc))
    docs = fx.fx4_market_documents(spark, SF_SMALL).filter(F.col("snapshot_date") == day)
    lake.land_market_documents(docs, paths.lake)
    cfg = Config(staging_start=dt.date(2001, 1, 1), calendar_start=dt.date(2001, 10, 1), min_latest_rows=1, min_latest_venues=1)
    as_of = dt.datetime(2001, 11, 2, 3, tzinfo=dt.timezone.utc)
    market = lake.read_market_documents(spark, paths.lake, F.lit(as_of))
    r = job.run(spark, paths, run_date=day, market_docs=market, cfg=cfg, as_of=as_of)
    assert r.rows_loaded["market_share"] > 0
    fct = spark.table("fct_dex_market_share_daily")
    assert fct.count() > 0 and set(x[0] for x in fct.select("dex_name").distinct().collect()) <= {"raydium", "orca", "meteora"}


def test_tables_are_found_by_name(spark, landed):
    """Names are bound to settings and found by another session."""
    from snapdeck.plans import catalog

    cfg = Config(staging_start=dt.date(2001, 1, 1), calendar_start=dt.date(2001, 10, 1), min_latest_rows=1, min_latest_venues=1,
                 raw_namespace="t_raw", staging_namespace="t_staging", marts_namespace="t_marts")
    as_of = dt.datetime(2001, 11, 2, 3, tzinfo=dt.timezone.utc)
    job.run(spark, landed, run_date=DAYS[0], cfg=cfg, as_of=as_of)
    other = spark.newSession()
    for name in ("raw_dex_pools", "stg_dex_pools", "int_pool_metrics", "fct_pool_trailing_24h", "dim_pool", "dim_token", "dim_date"):
        found = catalog.table(other, name, cfg)
        path = landed.raw_table(name) if name.startswith("raw") else landed.model_table(name)
        assert found.count() == spark.read.parquet(path).count() > 0, name
    # a later build's days are there too
    job.run(spark, landed, run_date=DAYS[1], cfg=cfg, as_of=as_of, incremental=True)
    assert other.table("t_marts.fct_pool_trailing_24h").select("snapshot_date").distinct().count() == len(
        {r[0] for r in spark.read.parquet(landed.raw_table("raw_dex_pools")).select("snapshot_date").distinct().collect()}
    )


def test_cli_lands_and_retains(spark, scratch):
    import json

    import snapdeck.__main__ as cli
    from snapdeck.sources import lake

    root = scratch("cli")
    day = dt.date(2026, 6, 2)
    body = json.dumps({"data": {"data": [{"id": "a", "day": {"volume": 5000, "volumeFee": 1}, "tvl": 9000}], "hasNextPage": False}})
    lake.land_pages(spark.createDataFrame([("raydium", day, 0, body)], "source string, snapshot_date date, page_no long, body string"), f"{root}/inbox")
    lake.land_market_documents(spark.createDataFrame([(day, '{"protocols": [{"name": "orca", "total24h": 3}]}')], "snapshot_date date, body string"), f"{root}/inbox")
    stop = spark.stop
    spark.stop = lambda: None  # keep the shared test session alive
    try:
        args = ["--lake", f"{root}/lake", "--raw", f"{root}/raw", "--models", f"{root}/models"]
        assert cli.main(["land", *args, "--inbox", f"{root}/inbox"]) == 0
        assert lake.landed_slices(spark, f"{root}/lake").count() == 2
        assert cli.main(["run", *args, "--inbox", f"{root}/inbox", "--date", day.isoformat(), "--skip-transform", "--sources", "raydium"]) == 0
        assert spark.read.parquet(f"{root}/raw/raw_dex_pools").count() == 1 == spark.read.parquet(f"{root}/raw/raw_dex_market_share").count()
        assert spark.read.parquet(f"{root}/lake/_manifest").count() == 2  # the second landing listed nothing again
        assert cli.main(["retain", *args, "--dry-run"]) == 0 and lake.landed_slices(spark, f"{root}/lake").count() == 2
    finally:
        spark.stop = stop
