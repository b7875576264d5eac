"""Registered queries of loads and builds that change what is there: slices
loaded again, rejected rows, files with several documents, retention, keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdeck import config as _c
from snapdeck.functions import uri_parts
from snapdeck.operators import checks as ck
from snapdeck.operators.by_range import row_frames
from snapdeck.operators.joins import materialize
from snapdeck.plans import catalog, dims, job, models, oracle as O
from snapdeck.plans import increments as inc
from snapdeck.plans import serving as sv
from snapdeck.plans.registry import (
    AS_OF_TS,
    PM_DOUBLES,
    _cfg,
    _PAGES_CTES,
    fct_ms,
    raw_market,
    raw_pools,
    register,
    stg,
)
from snapdeck.session import scratch_path
from snapdeck.sources import fixtures as fx
from snapdeck.sources import ingest as ing
from snapdeck.sources import lake
from snapdeck.sources import schemas as sch
from snapdeck.streaming import alerts

# --- slices loaded again (S11, R3, M3, D3, D4) ------------------------------


def _reload(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Staging before and after (FX7)."""
    raw = materialize(raw_pools(spark, sf_dir))
    # projections of the stored rows, which aren't stored twice more
    return models.stg_pools(fx.fx7_before(raw), _cfg()), models.stg_pools(fx.fx7_after(raw), _cfg())


def _changes(before: DataFrame, after: DataFrame) -> DataFrame:
    return inc.changed_slices(inc.slice_fingerprints(before), inc.slice_fingerprints(after))


def _dirty(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dirty days, their old rows, their new rows)."""
    days = materialize(_changes(before, after).select("snapshot_date").distinct())
    return days, materialize(inc.of_days(before, days)), materialize(inc.of_days(after, days))


def _hit(kind: str) -> str:
    every, venue = fx.RELOADED[kind]
    return f"((snapshot_date - DATE '1970-01-01') % {every} = 0 AND dex_name = '{venue}')"


_FX7 = f"""old_stg AS (
  SELECT * REPLACE (CASE WHEN {_hit('changed')} THEN CAST(trailing_24h_volume_usd * 2 AS DECIMAL(38,9))
                         ELSE trailing_24h_volume_usd END AS trailing_24h_volume_usd)
  FROM stg_all WHERE NOT {_hit('new')}
),
stg AS (SELECT * FROM stg_all WHERE NOT {_hit('gone')})"""
_RELOAD_CTES = (O.FX1, O.STG.replace("stg AS (", "stg_all AS (", 1), _FX7)
_DIRTY_CTE = """diff AS (
  (SELECT * FROM old_stg EXCEPT ALL SELECT * FROM stg) UNION ALL (SELECT * FROM stg EXCEPT ALL SELECT * FROM old_stg)
),
dirty AS (SELECT DISTINCT snapshot_date, dex_name FROM diff)"""


@register(
    "dirty_slices",
    O.with_ctes(
        """SELECT d.snapshot_date, d.dex_name,
             CASE WHEN coalesce(o.n, 0) = 0 THEN 'new' WHEN coalesce(c.n, 0) = 0 THEN 'gone' ELSE 'changed' END AS change,
             CAST(coalesce(o.n, 0) AS BIGINT) AS rows_before, CAST(coalesce(c.n, 0) AS BIGINT) AS rows_after
           FROM dirty d
           LEFT JOIN (SELECT snapshot_date, dex_name, COUNT(*) AS n FROM old_stg GROUP BY ALL) o USING (snapshot_date, dex_name)
           LEFT JOIN (SELECT snapshot_date, dex_name, COUNT(*) AS n FROM stg GROUP BY ALL) c USING (snapshot_date, dex_name)""",
        *_RELOAD_CTES, _DIRTY_CTE,
    ),
)
def q_dirty_slices(spark, sf_dir):
    """Slices that differ from those of the last build, by fingerprints."""
    return _changes(*_reload(spark, sf_dir))


_CARRIED_CTE = """touched AS (SELECT DISTINCT pool_address, snapshot_date FROM diff),
carried AS (
  SELECT DISTINCT r.snapshot_date
  FROM (SELECT pool_address, snapshot_date, ROW_NUMBER() OVER (PARTITION BY pool_address ORDER BY snapshot_date) AS k FROM stg) r
  JOIN (SELECT t.pool_address, t.snapshot_date,
               (SELECT COUNT(*) FROM stg s WHERE s.pool_address = t.pool_address AND s.snapshot_date <= t.snapshot_date) AS k
        FROM touched t) c
    ON r.pool_address = c.pool_address AND r.snapshot_date > c.snapshot_date AND r.k - c.k <= 7
)"""


@register(
    "rebuild_days",
    O.with_ctes(
        "SELECT snapshot_date, bool_or(dirty) AS dirty FROM (SELECT snapshot_date, TRUE AS dirty FROM dirty "
        "UNION ALL SELECT snapshot_date, FALSE FROM carried) GROUP BY snapshot_date",
        *_RELOAD_CTES, _DIRTY_CTE, _CARRIED_CTE,
    ),
)
def q_rebuild_days(spark, sf_dir):
    """M3: the days whose metrics an incremental build computes again: dirty
    ones, and those that the 7-row frames carry a change on to."""
    old, new = _reload(spark, sf_dir)
    days, before, after = _dirty(old, new)
    both = days.withColumn("dirty", F.lit(True)).unionByName(inc.carried_days(before, after, new).withColumn("dirty", F.lit(False)))
    return both.groupBy("snapshot_date").agg(F.bool_or("dirty").alias("dirty"))


@register("pool_metrics_reloaded", O.with_ctes("SELECT * FROM pm", *_RELOAD_CTES, O.PM), PM_DOUBLES + [
    "trailing_24h_volume_usd", "trailing_24h_fees_usd", "tvl_usd", "dex_total_24h_volume", "market_total_24h_volume"])
def q_pool_metrics_reloaded(spark, sf_dir):
    """M3 after slices were loaded again: the old metrics of all other days,
    the days to rebuild computed again. Equals a full build."""
    old, new = _reload(spark, sf_dir)
    days, before, after = _dirty(old, new)
    again = materialize(days.unionByName(inc.carried_days(before, after, new)).distinct())
    kept = inc.of_days(models.pool_metrics(old, _cfg()), again, "left_anti")
    return kept.select(*models.POOL_METRIC_COLUMNS).unionByName(
        inc.metrics_of_days(new, again, _cfg()).select(*models.POOL_METRIC_COLUMNS)
    )


@register(
    "dim_pool_reloaded",
    O.with_ctes("SELECT * FROM dim_pool", *_RELOAD_CTES, O.DIM_POOL),
    ["lifetime_observed_volume_usd", "lifetime_observed_fees_usd"],
)
def q_dim_pool_reloaded(spark, sf_dir):
    """D3 carried on from the state before: the dirty days' old rows taken off,
    their new rows added."""
    old, new = _reload(spark, sf_dir)
    days, before, after = _dirty(old, new)
    state = materialize(dims.pool_state(old))
    return dims.dim_pool_from_state(inc.pool_state_after(state, before, after, days, new, _cfg()))


@register("dim_token_reloaded", O.with_ctes("SELECT * FROM dim_token", *_RELOAD_CTES, O.DIM_TOKEN))
def q_dim_token_reloaded(spark, sf_dir):
    """D4 carried on from the state before."""
    old, new = _reload(spark, sf_dir)
    days, before, after = _dirty(old, new)
    state = materialize(dims.token_state(old))
    return dims.dim_token_from_state(inc.token_state_after(state, before, after, days, new, _cfg()))


# --- rejected rows (I7, I8, I9, R5) -------------------------------------------

_DEFECT = "((CAST(substr(pool_address, 5) AS BIGINT) + (snapshot_date - DATE '1970-01-01')) % {} = 0)"
_REJECT_CTES = f"""bad_items AS (
  SELECT source, snapshot_date, page_no, pos, vol, tvl, {_DEFECT.format(23)} AS no_id,
    {_DEFECT.format(29)} AS bad_vol, {_DEFECT.format(31)} AS bad_tvl, pool_address
  FROM pg_items
),
bad_pages AS (
  SELECT source, snapshot_date, page_no, arg_max(CASE WHEN bad_vol THEN 0 ELSE vol END, pos) < 1000 AS below,
    COUNT(*) FILTER (WHERE NOT no_id) = 0 AS nameless
  FROM bad_items GROUP BY ALL
),
bad_stop AS (
  SELECT p.source, p.snapshot_date, MIN(p.page_no) AS stop FROM bad_pages p JOIN pg_slices s USING (source, snapshot_date)
  WHERE below OR (source <> 'orca' AND page_no = last_page) OR (source = 'orca' AND nameless) GROUP BY ALL
),
bad_all AS (
  SELECT * FROM bad_items
  UNION ALL
  SELECT * REPLACE (page_no + 1 AS page_no) FROM bad_items JOIN pg_slices USING (source, snapshot_date)
    WHERE source = 'orca' AND page_no = last_page AND no_id
),
tagged AS (
  SELECT i.source, i.snapshot_date, i.page_no, i.pos, bad_vol, bad_tvl,
    CASE WHEN NOT no_id THEN pool_address WHEN i.source = 'orca' THEN '' END AS pool_address,
    CASE WHEN no_id THEN 'missing_id'
         WHEN (bad_vol OR vol < 1000 OR bad_tvl OR tvl < 1000) AND (bad_vol OR bad_tvl) THEN 'unparsable_measure'
         WHEN vol < 1000 OR tvl < 1000 THEN 'below_floor' END AS reason
  FROM bad_all i LEFT JOIN bad_stop s USING (source, snapshot_date) WHERE s.stop IS NULL OR i.page_no <= s.stop
)""".replace("SELECT * REPLACE (page_no + 1 AS page_no) FROM bad_items JOIN", "SELECT bad_items.* REPLACE (page_no + 1 AS page_no) FROM bad_items JOIN")


def _ingested(spark, sf_dir) -> ing.Ingested:
    pages = materialize(fx.fx5_pages(spark, sf_dir, defects=True))
    return ing.ingest_with_rejects(pages, fx.manifest_from_pages(pages), _cfg())


@register(
    "ingest_rejects",
    O.with_ctes(
        "SELECT source, snapshot_date, CAST(page_no AS BIGINT) AS page_no, CAST(pos AS BIGINT) AS pos, pool_address, reason "
        "FROM tagged WHERE reason IS NOT NULL",
        *_PAGES_CTES, _REJECT_CTES,
    ),
)
def q_ingest_rejects(spark, sf_dir):
    """Pool records of the kept pages that aren't loaded, with the reason (FX8)."""
    rows = _ingested(spark, sf_dir).rejects
    return rows.select("source", "snapshot_date", F.col("page_no").cast("long").alias("page_no"), F.col("pos").cast("long").alias("pos"), "pool_address", "reason")


@register(
    "ingest_reject_counts",
    O.with_ctes(
        "SELECT source, what, CAST(n AS BIGINT) AS n FROM (SELECT source, COUNT(*) AS \"rows\", COUNT(*) FILTER (WHERE reason IS NULL) AS kept, "
        "COUNT(*) FILTER (WHERE reason = 'missing_id') AS missing_id, COUNT(*) FILTER (WHERE reason = 'unparsable_measure') AS unparsable_measure, "
        "COUNT(*) FILTER (WHERE reason = 'below_floor') AS below_floor, "
        "SUM(CAST(bad_vol AS INT) + CAST(bad_tvl AS INT)) AS unparsable_values FROM tagged GROUP BY source) "
        "UNPIVOT (n FOR what IN (\"rows\", kept, missing_id, unparsable_measure, below_floor, unparsable_values))",
        *_PAGES_CTES, _REJECT_CTES,
    ),
)
def q_ingest_reject_counts(spark, sf_dir):
    """What the ingest counted in the write of its rows (a few rows a source)."""
    counts = _ingested(spark, sf_dir).counts
    return spark.createDataFrame([(s, what, n) for s, c in counts.items() for what, n in c.items()], "source string, what string, n long")


# --- files with several documents (S2, I6) --------------------------------------


@register(
    "parse_market_files",
    O.with_ctes(
        "SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_date, dex_name, "
        "CAST(trailing_24h_volume_usd AS DOUBLE) AS trailing_24h_volume_usd, CAST(trailing_7d_volume_usd AS DOUBLE) AS trailing_7d_volume_usd, "
        "CAST(total_volume_usd AS DOUBLE) AS total_volume_usd FROM raw_ms",
        O.FX2, O.RAW_MS,
    ),
    ["trailing_24h_volume_usd", "trailing_7d_volume_usd", "total_volume_usd"],
)
def q_parse_market_files(spark, sf_dir):
    """A month's documents (at most 31) one after the other in one
    file, on one line or several, read back document by document."""
    docs = fx.fx4_market_documents(spark, sf_dir)
    month = F.trunc("snapshot_date", "month").alias("snapshot_date")
    spaced = F.when(F.dayofmonth("snapshot_date") % 2 == 0, F.regexp_replace("body", r"([{,])", "$1\n  ")).otherwise(F.col("body"))
    files = docs.groupBy(month).agg(F.array_join(F.sort_array(F.collect_list(spaced)), "\n").alias("body"))
    root = scratch_path(spark, "market")
    lake.land_market_documents(files, root)
    rows = ing.parse_market_documents(lake.read_market_documents(spark, root), _cfg())
    return rows.drop("snapshot_at", "source_file")


# --- retention (S14, S4, S6) ------------------------------------------------------


@register(
    "retention_applied",
    O.with_ctes(
        "SELECT source, snapshot_date, snapshot_date + 1 <= CAST(({as_of}) AS DATE) - 90 AS missing FROM pg_slices".format(
            as_of="SELECT MAX(snapshot_date) + 1 FROM pg_slices"
        ),
        *_PAGES_CTES,
    ),
)
def q_retention_applied(spark, sf_dir):
    """Land every slice, drop those that reached the retention on the
    day after the newest one, and ask which of the slices are not landed (by
    the manifest and by the lake alike)."""
    root = scratch_path(spark, "retention")
    paths = job.Paths(lake=f"{root}/lake", raw=f"{root}/raw", models=f"{root}/models")
    pages = materialize(fx.fx5_pages(spark, sf_dir))
    lake.land_pages(pages, paths.lake)
    listed = materialize(fx.manifest_from_pages(pages))
    lake.log_manifest(listed, paths.manifest, "landed", F.col("snapshot_at"))
    newest = listed.agg(F.max("snapshot_at")).first()[0]
    job.apply_retention(spark, paths, newest.replace(tzinfo=AS_OF_TS.tzinfo), _cfg())
    requested = listed.select("source", "snapshot_date")
    by_log = lake.missing_slices(requested, lake.manifest_current(lake.read_manifest(spark, paths.manifest)))
    by_lake = lake.missing_slices(requested, lake.landed_slices(spark, paths.lake))
    keys = ["source", "snapshot_date"]
    both = by_log.withColumn("_log", F.lit(True)).join(by_lake.withColumn("_lake", F.lit(True)), keys, "full_outer")
    agreed = both.select(*keys, (F.col("_log") & F.col("_lake")).alias("missing"))
    return requested.join(agreed, keys, "left").select(*keys, F.coalesce("missing", F.lit(False)).alias("missing"))


# --- keys (C2, C4) ------------------------------------------------------------------

_PLANTED = """planted AS (
  SELECT * FROM stg UNION ALL
  SELECT * FROM stg WHERE (snapshot_date - DATE '1970-01-01') % 31 = 0 AND dex_name = 'orca' UNION ALL
  SELECT * REPLACE ('raydium' AS dex_name) FROM stg WHERE (snapshot_date - DATE '1970-01-01') % 37 = 0 AND dex_name = 'orca'
)"""
_PLANTED_KEYS = [["snapshot_date", "dex_name", "pool_address"], ["snapshot_date", "pool_address"], ["source_file"], ["base_token_address"]]


@register(
    "check_unique_planted",
    O.with_ctes("\nUNION ALL\n".join(O.unique_sql("planted", "planted", k) for k in _PLANTED_KEYS), O.FX1, O.STG, _PLANTED),
)
def q_check_unique_planted(spark, sf_dir):
    """Four keys of one table in one exchange, with repeated rows planted."""
    s = materialize(models.stg_pools(raw_pools(spark, sf_dir), _cfg()))
    u, orca = F.unix_date("snapshot_date"), F.col("dex_name") == "orca"
    planted = s.unionByName(s.filter((u % 31 == 0) & orca)).unionByName(s.filter((u % 37 == 0) & orca).withColumn("dex_name", F.lit("raydium")))
    return ck.unique_suite(planted, "planted", _PLANTED_KEYS, _c.DEFAULT.broadcast_max_bytes)


# --- row frames by ranges (W3, W4) ---------------------------------------------------


@register(
    "rolling_by_range",
    O.with_ctes(
        """SELECT snapshot_date, series, pool_address, CAST(trailing_24h_volume_usd AS DOUBLE) AS volume,
             CAST(AVG(trailing_24h_volume_usd) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS volume_7_avg,
             CAST(LAG(trailing_24h_volume_usd, 7) OVER w AS DOUBLE) AS volume_7_ago
           FROM (SELECT *, CASE WHEN dex_name = 'raydium' THEN 'hot' ELSE pool_address END AS series FROM stg) s
           WINDOW w AS (PARTITION BY series ORDER BY snapshot_date, pool_address)""",
        O.FX1, O.STG,
    ),
    ["volume", "volume_7_avg", "volume_7_ago"],
)
def q_rolling_by_range(spark, sf_dir):
    """W3, W4 where one series holds a third of all rows: its rows are cut into
    ranges, and each range is handed the seven rows before it."""
    s = materialize(stg(spark, sf_dir))
    s = s.withColumn("series", F.when(F.col("dex_name") == "raydium", "hot").otherwise(F.col("pool_address")))
    volume = "trailing_24h_volume_usd"
    made = {
        "volume_7_avg": lambda w: F.avg(volume).over(w.rowsBetween(-6, Window.currentRow)).cast("double"),
        "volume_7_ago": lambda w: F.lag(volume, 7).over(w).cast("double"),
    }
    framed = row_frames(s, ["series"], ["snapshot_date", "pool_address"], 7, made)
    return framed.select("snapshot_date", "series", "pool_address", F.col(volume).cast("double").alias("volume"), *made)


# --- late rows of the alert stream (ST1, A10) --------------------------------------------


@register(
    "error_alert_corrections",
    "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, "
    "CAST(0 AS BIGINT) AS streamed_count, CAST(COUNT(*) FILTER (WHERE lower(event_type) = 'error') AS BIGINT) AS error_count, "
    "CAST(COUNT(*) FILTER (WHERE lower(event_type) = 'error') AS BIGINT) AS missed, "
    "COUNT(*) FILTER (WHERE lower(event_type) = 'error') > 0 AS alert "
    "FROM events WHERE CAST(ts AS DATE) = (SELECT MIN(CAST(ts AS DATE)) FROM events) GROUP BY 1, 2",
)
def q_error_alert_corrections(spark, sf_dir):
    """ST1: the first day's events arrive after all others, behind the
    watermark. The stream drops them; the corrections bring their windows."""
    events = fx.table(spark, sf_dir, "events")
    first = events.select(F.min(F.to_date("ts"))).scalar()
    late, on_time = events.filter(F.to_date("ts") == first), events.filter(F.to_date("ts") > first)
    made = alerts.replay(spark, on_time, scratch_path(spark, "late_stream"), late=late)
    return alerts.corrections(events, made.alerts)


# --- status of stored tables (V2) ----------------------------------------------------------


@register(
    "status_tables_stored",
    O.with_ctes(
        "SELECT * FROM (SELECT 'stg_dex_pools' AS tbl, MAX(snapshot_date) AS last_snapshot, COUNT(*) AS rows_total FROM stg "
        "UNION ALL SELECT 'raw_dex_market_share', MAX(snapshot_date), COUNT(*) FROM raw_ms "
        "UNION ALL SELECT 'fct_dex_market_share_daily', MAX(snapshot_date), COUNT(*) FROM fct_ms) AS _t ORDER BY tbl",
        O.FX1, O.STG, O.FX2, O.RAW_MS, O.STG_MS, O.MSM, O.FCT_MS,
    ),
)
def q_status_tables_stored(spark, sf_dir):
    """V2 (A8, U2, O3) over stored tables: counts and newest days from the
    Parquet footers."""
    root = scratch_path(spark, "stored")
    made = {"stg_dex_pools": stg(spark, sf_dir), "raw_dex_market_share": raw_market(spark, sf_dir), "fct_dex_market_share_daily": fct_ms(spark, sf_dir)}
    for name, df in made.items():
        df.write.parquet(f"{root}/{name}")
    return sv.stored_status(spark, {name: f"{root}/{name}" for name in made})


# --- storage paths and names (F19, S12, S13) -----------------------------------------------


@register(
    "split_uri",
    O.with_ctes(
        "SELECT uri, CASE WHEN contains(uri, '://') THEN lower(split_part(uri, '://', 1)) END AS scheme, "
        "CASE WHEN contains(uri, '://') THEN nullif(split_part(split_part(uri, '://', 2), '/', 1), '') END AS root, "
        "ltrim(CASE WHEN NOT contains(uri, '://') THEN uri WHEN contains(split_part(uri, '://', 2), '/') "
        "THEN substr(split_part(uri, '://', 2), strpos(split_part(uri, '://', 2), '/') + 1) ELSE '' END, '/') AS path "
        "FROM (SELECT DISTINCT CASE dex_name WHEN 'raydium' THEN 'GS://lake-a/' || source_file WHEN 'orca' THEN 'file:///srv/' || source_file "
        "ELSE '/srv/' || source_file END AS uri FROM fx1 UNION ALL SELECT DISTINCT 's3a://' || dex_name FROM fx1)",
        O.FX1,
    ),
)
def q_split_uri(spark, sf_dir):
    """storage URIs into scheme, root and path, in the forms that stores use."""
    raw = raw_pools(spark, sf_dir)
    file, dex = F.col("source_file"), F.col("dex_name")
    uri = F.when(dex == "raydium", F.concat(F.lit("GS://lake-a/"), file)).when(dex == "orca", F.concat(F.lit("file:///srv/"), file))
    uris = raw.select(uri.otherwise(F.concat(F.lit("/srv/"), file)).alias("uri")).distinct()
    uris = uris.unionByName(raw.select(F.concat(F.lit("s3a://"), dex).alias("uri")).distinct())
    return uris.select("uri", uri_parts("uri").alias("p")).select("uri", "p.*")


@register(
    "tables_by_name",
    O.with_ctes(
        "SELECT 'snap_raw' AS namespace, 'raw_dex_market_share' AS name, CAST(COUNT(*) AS BIGINT) AS n_rows FROM raw_ms UNION ALL "
        "SELECT 'snap_staging', 'stg_dex_market_share', COUNT(*) FROM stg_ms UNION ALL "
        "SELECT 'snap_staging', 'int_market_share_metrics', COUNT(*) FROM msm UNION ALL "
        "SELECT 'snap_marts', 'fct_dex_market_share_daily', COUNT(*) FROM fct_ms",
        O.FX2, O.RAW_MS, O.STG_MS, O.MSM, O.FCT_MS,
    ),
)
def q_tables_by_name(spark, sf_dir):
    """Each layer's market tables, bound to their namespaces and read
    by name in another session."""
    root = scratch_path(spark, "bound")
    paths = job.Paths(lake=f"{root}/lake", raw=f"{root}/raw", models=f"{root}/models")
    raw = materialize(raw_market(spark, sf_dir))
    raw.write.parquet(paths.raw_table("raw_dex_market_share"))
    staged = materialize(models.stg_market_share(raw, _cfg()))
    metrics = materialize(models.market_share_metrics(staged))
    made = {"stg_dex_market_share": staged, "int_market_share_metrics": metrics, "fct_dex_market_share_daily": models.fct_market_share(metrics)}
    for name, df in made.items():
        df.write.parquet(paths.model_table(name))
    other = spark.newSession()
    counts = [(*full.split("."), other.table(full).count()) for full in catalog.bind(spark, paths, _cfg())]
    return spark.createDataFrame(counts, "namespace string, name string, n_rows long")


# --- probes and deletions of slices (S9, S10) -------------------------------------------------


@register(
    "slice_delete",
    O.with_ctes(
        "SELECT f.snapshot_date, f.dex_name, COUNT(*) AS n_rows, TRUE AS whole "
        "FROM fx1 f, (SELECT MIN(snapshot_date) AS first_day, MAX(snapshot_date) AS last_day, "
        "MIN(dex_name) FILTER (WHERE snapshot_date = (SELECT MIN(snapshot_date) FROM fx1)) AS first_dex FROM fx1) b "
        "WHERE f.snapshot_date <> last_day AND NOT (f.snapshot_date = first_day AND f.dex_name = first_dex) "
        "GROUP BY f.snapshot_date, f.dex_name",
        O.FX1,
    ),
)
def q_slice_delete(spark, sf_dir):
    """The first day loses one venue, the last day goes whole; what is
    left, by slice. ``whole``: the probe agrees with the rows."""
    raw = materialize(raw_pools(spark, sf_dir))
    path = scratch_path(spark, "raw_dex_pools")
    lake.load_slices(raw, path, schema=sch.RAW_POOLS, stored=True)
    first, last = raw.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    venue = raw.filter(F.col("snapshot_date") == F.lit(first)).agg(F.min("dex_name")).first()[0]
    had = lake.slice_exists(spark, path, first, venue) and lake.slice_exists(spark, path, last)
    lake.delete_slice(spark, path, first, venue)
    lake.delete_slice(spark, path, last)
    left = lake.slice_exists(spark, path, first, venue) or lake.slice_exists(spark, path, last)
    rest = spark.read.parquet(path).groupBy("snapshot_date", "dex_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return rest.withColumn("whole", F.lit(had and not left))


# --- a check that fires, and exact measures (C7, M1, D3) -----------------------------------------


@register(
    "check_latest_without_a_venue",
    O.with_ctes(
        O.latest_distinct_sql("gap", "dex_name", 3),
        O.FX1, O.STG,
        "gap AS (SELECT * FROM stg WHERE NOT (dex_name = 'orca' AND snapshot_date > (SELECT MAX(snapshot_date) FROM stg) - 30))",
    ),
)
def q_check_latest_without_a_venue(spark, sf_dir):
    """Orca's feed stopped 30 days ago, so the latest snapshot misses it."""
    s = materialize(stg(spark, sf_dir))
    since = F.date_sub(s.select(F.max("snapshot_date")).scalar(), 30)
    return ck.latest_min_distinct(s.filter(~((F.col("dex_name") == "orca") & (F.col("snapshot_date") > since))), "dex_name", 3)


@register(
    "exact_measures",
    O.with_ctes(
        "SELECT pool_address, snapshot_date, CAST(trailing_24h_volume_usd AS VARCHAR) AS volume, CAST(trailing_24h_fees_usd AS VARCHAR) AS fees, "
        "CAST(tvl_usd AS VARCHAR) AS tvl FROM stg UNION ALL "
        "SELECT pool_address, NULL, CAST(lifetime_observed_volume_usd AS VARCHAR), CAST(lifetime_observed_fees_usd AS VARCHAR), NULL FROM dim_pool",
        O.FX1, O.STG, O.DIM_POOL,
    ),
)
def q_exact_measures(spark, sf_dir):
    """M1, D3: decimal(38,9) measures and lifetime sums digit by digit."""
    s = materialize(stg(spark, sf_dir))
    text = lambda c: F.col(c).cast("string")
    rows = s.select("pool_address", "snapshot_date", text("trailing_24h_volume_usd").alias("volume"), text("trailing_24h_fees_usd").alias("fees"), text("tvl_usd").alias("tvl"))
    life = dims.dim_pool(s).select(
        "pool_address",
        F.lit(None).cast("date").alias("snapshot_date"),
        text("lifetime_observed_volume_usd").alias("volume"),
        text("lifetime_observed_fees_usd").alias("fees"),
        F.lit(None).cast("string").alias("tvl"),
    )
    return rows.unionByName(life)
