"""The daily job (R1-R5): load landed slices per source, build the models
layer by layer with check gates, and the separate freshness job.

HTTP fetching is outside the library: the job starts from pages already
landed in the lake (``sources.lake.land_pages``) and their manifest.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapdeck.config import DEFAULT, Config
from snapdeck.operators import checks as ck
from snapdeck.operators.joins import join_small, materialize
from snapdeck.plans import catalog, declared, dims, models, tables
from snapdeck.plans import increments as inc
from snapdeck.sources import ingest, lake, schemas

log = logging.getLogger("snapdeck.job")


class CheckFailed(RuntimeError):
    """A data-quality check failed; downstream models were not built."""

    def __init__(self, results: list[dict]):
        self.results = results
        super().__init__(f"{len(results)} check(s) failed: {results}")


class PipelineFailed(RuntimeError):
    def __init__(self, failures: dict[str, str]):
        self.failures = failures
        super().__init__(f"sources failed: {sorted(failures)}")


@dataclass
class Paths:
    """Where the lake and the tables live (shared storage on a cluster)."""

    lake: str  # landed pages: <lake>/dex_pools/dex=/date=/
    raw: str  # raw tables: <raw>/raw_dex_pools, <raw>/raw_dex_market_share
    models: str  # model tables: <models>/<name>

    @property
    def manifest(self) -> str:
        return f"{self.lake}/_manifest"

    @property
    def market_docs(self) -> str:
        return f"{self.lake}/{lake.MARKET_DIR}"

    def raw_table(self, name: str) -> str:
        return f"{self.raw}/{name}"

    def model_table(self, name: str) -> str:
        return f"{self.models}/{name}"


@dataclass
class RunResult:
    """What a run did, per source."""

    rows_loaded: dict[str, int] = field(default_factory=dict)
    slices_skipped: dict[str, int] = field(default_factory=dict)
    rows_deleted: dict[str, int] = field(default_factory=dict)
    rejects: dict[str, dict[str, int]] = field(default_factory=dict)  # rows, kept, a count for each reason
    failures: dict[str, str] = field(default_factory=dict)
    checks: list[dict] = field(default_factory=list)


def snapshot_stamp(run_at: dt.datetime) -> tuple[dt.datetime, dt.date]:
    """(snapshot_at, snapshot_date = the day before the run, UTC)."""
    run_at = run_at.astimezone(dt.timezone.utc)
    return run_at, (run_at - dt.timedelta(days=1)).date()


def land(
    spark: SparkSession,
    paths: Paths,
    pages: DataFrame,
    snapshot_at: dt.datetime,
    overwrite: bool = False,
) -> DataFrame:
    """Land pages and append their manifest rows. Without ``overwrite``
    slices that the lake holds are left untouched (write-once). A slice that
    was landed by a run that ended before its manifest row gets it now."""
    slices = materialize(pages.select("source", "snapshot_date").distinct())
    lake.land_pages(pages, paths.lake, overwrite=overwrite)
    slices = _unlisted(spark, paths, slices, overwrite)
    landed = join_small(lake.read_landed_pages(spark, paths.lake), slices, ["source", "snapshot_date"], "left_semi")
    rows = landed.groupBy("source", "snapshot_date").agg(
        F.count(F.lit(1)).cast("long").alias("pages"),
        F.sum(lake.page_record_count(F.col("source"), F.col("body"))).cast("long").alias("raw_record_count"),
    )
    return _list(spark, paths, rows, snapshot_at)


def land_market(spark: SparkSession, paths: Paths, docs: DataFrame, snapshot_at: dt.datetime, overwrite: bool = False) -> DataFrame:
    """S3/S6 for the market feed: land documents (snapshot_date, body), and
    list each day with its documents and protocols."""
    source = F.lit(lake.MARKET_FILE_PREFIX).alias("source")
    slices = materialize(docs.select(source, "snapshot_date").distinct())
    lake.land_market_documents(docs, paths.lake, overwrite=overwrite)
    slices = _unlisted(spark, paths, slices, overwrite)
    landed = join_small(lake.read_market_documents(spark, paths.lake).withColumn("source", source), slices, ["source", "snapshot_date"], "left_semi")
    rows = landed.groupBy("source", "snapshot_date").agg(
        F.count(F.lit(1)).cast("long").alias("pages"),
        F.sum(F.json_array_length(F.get_json_object("body", "$.protocols"))).cast("long").alias("raw_record_count"),
    )
    return _list(spark, paths, rows, snapshot_at)


def _unlisted(spark: SparkSession, paths: Paths, slices: DataFrame, overwrite: bool) -> DataFrame:
    """Of the slices of a landing, those that need a manifest row."""
    if overwrite:
        return slices
    listed = lake.manifest_current(lake.read_manifest(spark, paths.manifest)).select("source", "snapshot_date")
    return materialize(join_small(slices, listed, ["source", "snapshot_date"], "left_anti"))


def _list(spark: SparkSession, paths: Paths, rows: DataFrame, snapshot_at: dt.datetime) -> DataFrame:
    rows = materialize(rows.withColumn("snapshot_at", F.lit(snapshot_at)))
    lake.log_manifest(rows, paths.manifest, "landed")
    return rows


def land_inbox(spark: SparkSession, paths: Paths, inbox: str, snapshot_at: dt.datetime, overwrite: bool = False) -> dict[str, int]:
    """R1's first step: land what a fetcher left in ``inbox``, a folder of the
    lake's own layout (dex_pools/dex=/date=, dex_market_share/date=). Returns
    how many slices of each feed were listed."""
    listed = {}
    if lake.has_rows_on_disk(spark, f"{inbox}/{lake.POOLS_DIR}"):
        listed["pools"] = land(spark, paths, lake.read_landed_pages(spark, inbox), snapshot_at, overwrite).count()
    if lake.has_rows_on_disk(spark, f"{inbox}/{lake.MARKET_DIR}"):
        docs = lake.read_market_documents(spark, inbox).select("snapshot_date", "body")
        listed["market_share"] = land_market(spark, paths, docs, snapshot_at, overwrite).count()
    return listed


def market_documents(spark: SparkSession, paths: Paths) -> DataFrame:
    """S2/S5 for the market feed: the landed documents, stamped by the run that
    landed them (the current time where no manifest row is)."""
    docs = lake.read_market_documents(spark, paths.lake)
    listed = lake.manifest_current(lake.read_manifest(spark, paths.manifest)).filter(F.col("source") == lake.MARKET_FILE_PREFIX)
    met = join_small(docs, listed.select("snapshot_date", F.col("snapshot_at").alias("_at")), ["snapshot_date"], "left")
    return met.withColumn("snapshot_at", F.coalesce("_at", "snapshot_at")).drop("_at")


def apply_retention(spark: SparkSession, paths: Paths, as_of: dt.datetime, cfg: Config = DEFAULT, dry_run: bool = False) -> DataFrame:
    """Drop landed slices that reached the retention, and return them as
    (source, snapshot_date, folder).

    Tasks delete the folders, then the log gets a tombstone for each. A run
    that ended in between is repeated without harm: folders that are gone
    count as deleted. With ``dry_run`` nothing is touched. A slice that is
    landed again after its tombstone is current again.
    """
    current = lake.manifest_current(lake.read_manifest(spark, paths.manifest))
    root = F.lit(lake.qualified(spark, paths.lake))
    expired = lake.expired_slices(current, F.lit(as_of), cfg.retention_days)
    expired = materialize(expired.withColumn("folder", lake.slice_folder(root)))
    if not dry_run and not expired.isEmpty():
        lake.delete_folders(expired)
        lake.log_manifest(expired, paths.manifest, "dropped")
    return expired.select("source", "snapshot_date", "folder")


def compact_manifest(spark: SparkSession, paths: Paths) -> int:
    """Rewrite the log as the newest record of each live slice; returns how
    many. Readers see the old log until the new one takes its place."""
    rows = materialize(lake.manifest_current(lake.read_manifest(spark, paths.manifest)))
    tables.write_beside(rows, paths.manifest, ["source", "snapshot_date"])
    tables.swap_in(spark, paths.manifest)
    return rows.count()


def load_source(spark: SparkSession, paths: Paths, source: str, run_date: dt.date, overwrite: bool, cfg: Config = DEFAULT) -> dict:
    """S11 for one venue and day: landed pages -> raw rows -> slice load.

    The load re-reads the lake (the lake is the source of truth), so a load
    can be replayed without fetching. Rows that aren't loaded are kept with
    their reason in ``raw_dex_pools_rejects`` and counted (R5)."""
    raw_path = paths.raw_table("raw_dex_pools")
    if lake.slice_exists(spark, raw_path, run_date, source) and not overwrite:
        return {"rows_loaded": 0, "slices_skipped": 1, "rows_deleted": 0, "rejects": {}}
    pages = lake.read_landed_pages(spark, paths.lake).filter((F.col("source") == source) & (F.col("snapshot_date") == F.lit(run_date)))
    # newest landing of each slice wins (a re-landing appends a manifest row)
    manifest = lake.manifest_current(lake.read_manifest(spark, paths.manifest))
    found = ingest.ingest_with_rejects(pages, manifest, cfg, (source,))
    counts = found.counts.get(source, {})
    if counts.get("missing_id"):
        log.warning("rows_without_id source=%s date=%s n=%d", source, run_date, counts["missing_id"])
    deleted = 0
    if overwrite and lake.has_rows_on_disk(spark, raw_path):
        old = spark.read.parquet(raw_path)
        deleted = old.filter((F.col("snapshot_date") == F.lit(run_date)) & (F.col("dex_name") == source)).count()
    # replaces the slice when the write commits; a failure before leaves it as it was
    m = lake.load_slices(found.rows, raw_path, overwrite=overwrite, schema=schemas.RAW_POOLS, cfg=cfg)
    if deleted and not m["rows_loaded"]:
        # a feed that parsed and holds no rows clears the slice
        lake.delete_slice(spark, raw_path, run_date, source)
    _write_rejects(spark, paths, found.rejects, source, run_date, sum(counts.get(r, 0) for r in ingest.REASONS))
    return {**m, "rows_deleted": deleted, "rejects": counts}


def _write_rejects(spark: SparkSession, paths: Paths, rejects: DataFrame, source: str, day: dt.date, n: int) -> None:
    """The slice's rejects take the place of those of an earlier load."""
    path = paths.raw_table("raw_dex_pools_rejects")
    if n:
        writer = rejects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("snapshot_date", "source").parquet(path)
    else:
        lake.delete_path(spark, f"{path}/snapshot_date={day.isoformat()}/source={source}")


def load_market_share(spark: SparkSession, paths: Paths, docs: DataFrame, overwrite: bool, cfg: Config = DEFAULT) -> dict:
    """Market feed: documents -> filtered protocol rows -> slice load by date.
    Protocols of venues that aren't tracked and measures that aren't numbers
    are counted in the pass that parses (R5)."""
    path = paths.raw_table("raw_dex_market_share")
    obs = Observation("market")
    tracked = ingest.contains_any("protocol_name", cfg.tracked_venues)
    protocols = materialize(
        ingest.market_protocols(docs).observe(
            obs,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(tracked).alias("kept"),
            F.count_if(~tracked).alias("untracked"),
            F.coalesce(F.sum(F.when(tracked, F.col("n_unparsable"))), F.lit(0)).alias("unparsable_values"),
        )
    )
    counts = {k: int(v) for k, v in obs.get.items()}
    rows = ingest.market_rows_from_protocols(protocols, cfg)
    deleted = 0
    if overwrite and lake.has_rows_on_disk(spark, path):
        deleted = join_small(spark.read.parquet(path), rows.select("snapshot_date").distinct(), ["snapshot_date"], "left_semi").count()
    m = lake.load_slices(
        rows, path, overwrite=overwrite, slice_keys=("snapshot_date",), cluster=("dex_name",), schema=schemas.RAW_MARKET_SHARE, cfg=cfg
    )
    return {**m, "rows_deleted": deleted, "rejects": counts}


def _gate(results: DataFrame, into: list[dict]) -> None:
    """Collect a check result (a handful of rows) and stop on failures."""
    rows = [r.asDict() for r in results.collect()]
    into.extend(rows)
    bad = [r for r in rows if (r.get("failures") or 0) > 0]
    if bad:
        raise CheckFailed(bad)


#: Cluster keys of the model tables. Days are partitions where a day is named;
#: the address is part of the key, so a hot venue spreads over several writers.
DAY_TABLES = {
    "stg_dex_pools": ["dex_name", "pool_address"],
    "int_pool_metrics": ["dex_name", "pool_address"],
    "fct_pool_trailing_24h": ["dex_name", "pool_address"],
}
WHOLE_TABLES = {
    "stg_dex_market_share": ["snapshot_date", "dex_name"],
    "int_market_share_metrics": ["snapshot_date", "dex_name"],
    "fct_dex_market_share_daily": ["snapshot_date", "dex_name"],
    "dim_pool": ["pool_address"],
    "dim_token": ["token_address"],
    "dim_date": ["calendar_date"],
}
STATE = "_state"  # versions of: slices, files, settings, pools, tokens, last_rows


def state_store(spark: SparkSession, paths: Paths) -> tables.StateStore:
    return tables.StateStore(spark, paths.model_table(STATE))


def _settings(spark: SparkSession, cfg: Config) -> DataFrame:
    """What staging depends on besides its rows: a state of other settings
    isn't carried on."""
    return spark.createDataFrame([(cfg.staging_start.isoformat(),)], "staging_start string")


def _staged(raw_pools: DataFrame, cfg: Config) -> DataFrame:
    """The raw rows that staging looks at."""
    return raw_pools.select(*schemas.POOL_COLUMNS).filter(F.col("snapshot_date") >= F.lit(cfg.staging_start))


@dataclass
class Increment:
    """Days that a build does again, and what staging held there before."""

    days: DataFrame
    before: DataFrame
    slices: DataFrame  # fingerprints of all slices now
    files: DataFrame  # file signatures of all days now


def find_increment(spark: SparkSession, paths: Paths, raw_pools: DataFrame, cfg: Config = DEFAULT) -> Increment | None:
    """What changed in the raw table since the last build; None asks for a full one.

    Days whose files are those of the last build aren't read. Of the others,
    slices with the fingerprint of the last build are not dirty (a load of one
    venue rewrites the day's files with the other venues' rows as they were).
    """
    store = state_store(spark, paths)
    have = all(lake.has_rows_on_disk(spark, paths.model_table(t)) for t in DAY_TABLES)
    if store.current() is None or not have or store.read("settings").collect() != _settings(spark, cfg).collect():
        return None
    staged = _staged(raw_pools, cfg)
    files, built_files = materialize(lake.day_signatures(spark, paths.raw_table("raw_dex_pools"))), store.read("files")
    mark = ["snapshot_date", "n_files", "signature"]
    touched = materialize(files.select(*mark).exceptAll(built_files.select(*mark)).unionByName(
        built_files.select(*mark).exceptAll(files.select(*mark))
    ).select("snapshot_date").distinct())
    built = store.read("slices")
    now = inc.slice_fingerprints(inc.of_days(staged, touched, cfg=cfg))
    slices = materialize(inc.of_days(built, touched, "left_anti", cfg).unionByName(now.select(*built.columns)))
    days = inc.changed_slices(built, slices).select("snapshot_date").distinct()
    stg = tables.read_days(spark, paths.model_table("stg_dex_pools"), schemas.POOL_COLUMNS)
    unfinished = store.journal()
    if unfinished is None:
        days = materialize(days)
        before = inc.of_days(stg, days, cfg=cfg)
    else:  # that build may have published days which the state doesn't know
        old_days, old_rows = unfinished
        days = materialize(days.unionByName(old_days).distinct())
        before = inc.of_days(inc.of_days(stg, days, cfg=cfg), old_days, "left_anti", cfg).unionByName(old_rows.select(*stg.columns))
    days, before = store.write_journal(days, before)
    return Increment(days, before.select(*schemas.POOL_COLUMNS), slices, files)


def _publish(
    spark: SparkSession,
    paths: Paths,
    name: str,
    rows: DataFrame,
    days: DataFrame | None,
    check: Callable[[DataFrame], DataFrame] | None,
    results: list[dict],
) -> DataFrame:
    """Write ``rows`` beside, check them, publish them: the whole table, or
    ``days`` of it. Returns the table."""
    path = paths.model_table(name)
    if days is not None:
        written = materialize(rows)
        if check is not None:
            _gate(check(written), results)
        tables.publish_days(written, path, days, DAY_TABLES[name])
    else:
        partition = "snapshot_date" if name in DAY_TABLES else None
        written = tables.write_beside(rows, path, DAY_TABLES.get(name) or WHOLE_TABLES[name], partition)
        if check is not None:
            _gate(check(written), results)
        tables.swap_in(spark, path)
    return tables.read_days(spark, path, rows.columns)


def build_models(
    spark: SparkSession, paths: Paths, cfg: Config = DEFAULT, as_of: dt.datetime | None = None, since: dt.date | None = None
) -> dict:
    """Staging -> intermediate -> marts, checks before each table is published.

    With ``since`` (the day that was just loaded) the build is incremental:
    slices that differ from the last build are found by their fingerprints,
    whichever day they belong to, and only days that depend on them are
    computed, checked and replaced. It equals a full build. Without a state of
    an earlier build, or with other settings, the build is a full one.

    A failing check raises CheckFailed before its table is published and
    before the next layer.
    """
    as_of_ts = F.lit(as_of) if as_of else F.current_timestamp()
    results: list[dict] = []
    raw_pools = spark.read.parquet(paths.raw_table("raw_dex_pools"))
    raw_ms_path = paths.raw_table("raw_dex_market_share")
    has_market = lake.path_exists(spark, raw_ms_path)
    store = state_store(spark, paths)
    change = find_increment(spark, paths, raw_pools, cfg) if since is not None else None
    days = change.days if change else None
    if days is None:
        tables.drop_state(spark, store.root)  # it won't describe the tables from here on
        slices, files = materialize(inc.slice_fingerprints(_staged(raw_pools, cfg))), materialize(lake.day_signatures(spark, paths.raw_table("raw_dex_pools")))
    else:
        slices, files = change.slices, change.files
        raw_pools = inc.of_days(raw_pools, days, cfg=cfg)

    # raw tables are tested before anything is built from them
    raw_tables = {"raw_dex_pools": raw_pools}
    if has_market:
        raw_tables["raw_dex_market_share"] = spark.read.parquet(raw_ms_path)
    _gate(declared.not_null_results(raw_tables), results)

    def staging_checks(rows: DataFrame) -> DataFrame:
        suite = ck.not_null(declared.NOT_NULL["stg_dex_pools"]) + [
            ck.accepted_values("dex_name", cfg.pool_venues),
            ck.no_future("snapshot_date", F.to_date(as_of_ts)),
            ck.no_negative("trailing_24h_volume_usd"),
        ]
        # the key holds the day: checked on the days written
        unique = ck.unique_suite(rows, "stg_dex_pools", [["snapshot_date", "dex_name", "pool_address"]])
        return ck.row_level_suite(rows, "stg_dex_pools", suite).unionByName(unique)

    stg = _publish(spark, paths, "stg_dex_pools", models.stg_pools(raw_pools, cfg), days, staging_checks, results)
    out: dict[str, DataFrame] = {"stg_dex_pools": stg}
    if has_market:
        out["stg_dex_market_share"] = _publish(
            spark, paths, "stg_dex_market_share", models.stg_market_share(spark.read.parquet(raw_ms_path), cfg), None,
            lambda rows: ck.unique_suite(rows, "stg_dex_market_share", [["snapshot_date", "dex_name"]]).unionByName(
                declared.not_null_results({"stg_dex_market_share": rows})
            ),
            results,
        )

    # intermediate
    if days is None:
        metric_days, metrics = None, models.pool_metrics(stg, cfg)
    else:
        after = materialize(inc.of_days(stg, days, cfg=cfg))
        carried = inc.carried_days(change.before, after, stg, cfg=cfg)
        metric_days = materialize(days.unionByName(carried).distinct())
        metrics = inc.metrics_of_days(stg, metric_days, cfg)
    metrics = materialize(metrics) if days is not None else metrics
    pm = _publish(spark, paths, "int_pool_metrics", metrics, metric_days, None, results)
    out["int_pool_metrics"] = pm
    if has_market:
        out["int_market_share_metrics"] = _publish(
            spark, paths, "int_market_share_metrics", models.market_share_metrics(out["stg_dex_market_share"]), None, None, results
        )

    # marts: tables, so that they outlive the session that built them, and views of this session
    if days is None:
        pools, tokens, last = dims.pool_state(stg), dims.token_state(stg), models.last_rows_per_pool(stg)
    else:
        pools = inc.pool_state_after(store.read("pools"), change.before, after, days, stg, cfg)
        tokens = inc.token_state_after(store.read("tokens"), change.before, after, days, stg, cfg)
        last = inc.last_rows_after(store.read("last_rows"), after, days, stg, cfg)
    pools, tokens = materialize(pools), materialize(tokens)
    today = (as_of or dt.datetime.now(dt.timezone.utc)).date()
    marts: dict[str, tuple[DataFrame, DataFrame | None]] = {
        "fct_pool_trailing_24h": (models.fct_pool(pm if days is None else metrics), metric_days),
        "dim_pool": (dims.dim_pool_from_state(pools), None),
        "dim_token": (dims.dim_token_from_state(tokens), None),
        "dim_date": (dims.date_dim(spark, cfg.calendar_start, today, cfg.calendar_days_ahead), None),
    }
    if has_market:
        marts["fct_dex_market_share_daily"] = (models.fct_market_share(out["int_market_share_metrics"]), None)

    def mart_checks(name: str) -> Callable[[DataFrame], DataFrame]:
        def check(rows: DataFrame) -> DataFrame:
            made = declared.unique_results({name: rows}).unionByName(declared.not_null_results({name: rows}))
            if name == "fct_pool_trailing_24h":
                made = made.unionByName(ck.row_level_suite(rows, name, [ck.accepted_values("dex_name", cfg.pool_venues)]))
            return made

        return check

    for name, (rows, its_days) in marts.items():
        out[name] = _publish(spark, paths, name, rows, its_days, mart_checks(name), results)
        out[name].createOrReplaceTempView(name)
    # the tables are what this state describes from here on
    store.commit({"slices": slices, "files": files, "settings": _settings(spark, cfg), "pools": pools, "tokens": tokens, "last_rows": last})

    if cfg.bind_tables:
        catalog.bind(spark, paths, cfg)

    # singular tests on the latest snapshot (a returned row is a failure)
    latest = [
        ("assert_pools_all_dexes_latest", ck.latest_min_distinct(stg, "dex_name", cfg.min_latest_venues)),
        ("assert_pools_min_rows_latest", ck.latest_min_rows(stg, cfg.min_latest_rows)),
    ]
    if has_market:
        market = out["fct_dex_market_share_daily"]
        latest.append(("assert_market_share_all_dexes_latest", ck.latest_min_distinct(market, "dex_name", cfg.min_latest_venues)))
    bad = []
    for name, df in latest:
        rows = [r.asDict() for r in df.collect()]
        results.append({"model": name, "test": "singular", "column_name": "", "failures": len(rows)})
        if rows:
            bad.append({"test": name, "rows": rows})
    if bad:
        raise CheckFailed(bad)
    out["_checks"] = results
    return out


def run(
    spark: SparkSession,
    paths: Paths,
    run_date: dt.date | None = None,
    sources: list[str] | None = None,
    overwrite: bool = False,
    skip_transform: bool = False,
    skip_market_share: bool = False,
    market_docs: DataFrame | None = None,
    cfg: Config = DEFAULT,
    as_of: dt.datetime | None = None,
    incremental: bool = False,
) -> RunResult:
    """Each source loads in isolation; the transform runs on whatever
    loaded; the run fails at the end if any source failed."""
    _, yesterday = snapshot_stamp(as_of or dt.datetime.now(dt.timezone.utc))
    day = run_date or yesterday
    result = RunResult()
    loads = {src: lambda src=src: load_source(spark, paths, src, day, overwrite, cfg) for src in sources or cfg.pool_venues}
    if not skip_market_share and market_docs is not None:
        docs = market_docs.filter(F.col("snapshot_date") == F.lit(day))
        loads["market_share"] = lambda: load_market_share(spark, paths, docs, overwrite, cfg)
    for src, load in loads.items():
        try:
            m = load()
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            log.error("source_failed source=%s error=%s", src, exc)
            result.failures[src] = str(exc)
            continue
        result.rows_loaded[src], result.slices_skipped[src] = m["rows_loaded"], m["slices_skipped"]
        result.rows_deleted[src], result.rejects[src] = m["rows_deleted"], m["rejects"]
    log.info("rows_loaded %s rejects %s", result.rows_loaded, result.rejects)
    if not skip_transform:
        built = build_models(spark, paths, cfg, as_of, since=day if incremental else None)
        result.checks = list(built.get("_checks") or [])
    if result.failures:
        raise PipelineFailed(result.failures)
    return result


def run_freshness(spark: SparkSession, paths: Paths, as_of: dt.datetime | None = None, cfg: Config = DEFAULT) -> list[dict]:
    """C10 over both raw tables; raises on WARN as well as ERROR."""
    tables = {"raw_dex_pools": spark.read.parquet(paths.raw_table("raw_dex_pools"))}
    ms = paths.raw_table("raw_dex_market_share")
    if lake.path_exists(spark, ms):
        tables["raw_dex_market_share"] = spark.read.parquet(ms)
    as_of_col = F.lit(as_of) if as_of else F.current_timestamp()
    rows = [r.asDict() for r in ck.freshness(tables, as_of_col, cfg.fresh_warn_hours, cfg.fresh_error_hours).collect()]
    stale = [r for r in rows if r["status"] != "pass"]
    if stale:
        raise CheckFailed(stale)
    return rows
