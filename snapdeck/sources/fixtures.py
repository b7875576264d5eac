"""Raw-table fixtures derived from the driver tables (see FIXTURES.md).

The venue feeds are not available offline, so the raw pool and market
tables are projected from ``lineitem``/``supplier`` and ``orders``. Each
projection is a single aggregation whose expressions the DuckDB oracle
repeats verbatim, so every model downstream can be checked end to end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapdeck.config import Config

# Fixture parameters: staging keeps dates from here on (the driver data ends in 2001).
FIXTURE_STAGING_START = "1996-01-01"
# "Now" for freshness/future checks over the fixtures.
FIXTURE_AS_OF = "2001-11-06 12:00:00"
# Fixed values of the fixture design: supplier key mod 3 -> venue.
FIXTURE_VENUES = ["raydium", "orca", "meteora"]
# Fixed values of the fixture design: customer key mod 8 -> protocol name of the market feed.
FIXTURE_PROTOCOLS = [
    "Raydium AMM",
    "raydium clmm",
    "Orca DEX",
    "Meteora DLMM",
    "meteora damm v2",
    "Phoenix",
    "Lifinity",
    "Orca Wavebreak",
]


def fixture_config() -> Config:
    import datetime as dt

    return Config(staging_start=dt.date(1996, 1, 1), calendar_start=dt.date(1996, 1, 1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c: Column | str, p: int, s: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(f"decimal({p},{s})")


def run_stamp(snapshot_date: Column) -> Column:
    """The run that covers day D lands at D + 1 day 02:00 UTC (an absolute instant)."""
    secs = (F.unix_date(snapshot_date).cast("long") + 1) * 86400 + 7200
    return F.timestamp_seconds(secs)


def _pick(index: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = (F.when if expr is None else expr.when)(index == i, F.lit(v))
    return expr


def _fx1_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, snapshot_date) groups of line items with their sums, and the
    supplier's columns that FX1 is made from: a few numbers a row.

    Pre-aggregates lineitem to (supplier, day) before the supplier join, so
    the join sees one row per group instead of one per line item.
    """
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax")
    price = _dec("l_extendedprice", 18, 2)
    disc = _dec("l_discount", 4, 2)
    tax = _dec("l_tax", 4, 2)
    daily = li.groupBy(F.col("l_suppkey"), F.to_date("l_shipdate").alias("snapshot_date")).agg(
        F.sum(price * disc).alias("_vol"),
        F.sum(price * disc * tax).alias("_fees"),
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return daily.join(sup, daily.l_suppkey == sup.s_suppkey).drop("l_suppkey")


#: What ``_fx1_columns`` reads besides the day.
_FX1_FROM = ["s_suppkey", "s_nationkey", "s_acctbal", "_vol", "_fees"]


def _fx1_columns(c: Callable[[str], Column]) -> dict[str, Column]:
    """The FX1 columns over the ones of ``_fx1_measured``, which ``c`` names."""
    d, k = c("snapshot_date"), c("s_suppkey")
    yr = F.year(d).cast("string")
    dex = _pick(k % 3, FIXTURE_VENUES)
    nation = c("s_nationkey").cast("string")
    qmod = (k % 5).cast("string")
    return {
        "snapshot_at": run_stamp(d),
        "snapshot_date": d,
        "dex_name": dex,
        "pool_address": F.concat(F.lit("POOL"), k.cast("string")),
        "base_token_symbol": F.concat(F.lit("SYM"), nation, F.lit("_"), yr),
        "base_token_address": F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("MINT"), nation)),
        "quote_token_symbol": F.concat(F.lit("SYM"), qmod, F.lit("_"), yr),
        "quote_token_address": F.concat(F.lit("MINT"), qmod),
        "trailing_24h_volume_usd": F.when((k % 10 == 9) & (F.dayofmonth(d) == 15), F.lit(None)).otherwise(_dec(c("_vol"), 38, 9)).cast("decimal(38,9)"),
        "trailing_24h_fees_usd": _dec(c("_fees"), 38, 9),
        "tvl_usd": _dec(_dec(c("s_acctbal"), 18, 2), 38, 9),
        "source_file": F.concat(F.lit("fx/dex="), dex, F.lit("/date="), d.cast("string")),
    }


def fx1_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1: one raw pool row per (supplier, ship date), measures decimal(38,9)."""
    return _fx1_measured(spark, sf_dir).select(*[c.alias(n) for n, c in _fx1_columns(F.col).items()])


def fx2_protocols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2: the market feed, one row per (day, protocol) with the feed's names."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    daily = o.groupBy(F.to_date("o_orderdate").alias("snapshot_date"), (F.col("o_custkey") % 8).alias("_p")).agg(
        F.sum(_dec("o_totalprice", 18, 2)).alias("_v")
    )
    name = _pick(F.col("_p"), FIXTURE_PROTOCOLS)
    v = _dec("_v", 38, 9)
    d = F.col("snapshot_date")
    return daily.select(
        run_stamp(d).alias("snapshot_at"),
        d.alias("snapshot_date"),
        name.alias("protocol_name"),
        v.alias("total24h"),
        F.when(name == "Orca Wavebreak", F.lit(None)).otherwise(v * 7).cast("decimal(38,9)").alias("total7d"),
        (v * 100).cast("decimal(38,9)").alias("totalAllTime"),
        F.concat(F.lit("fx/market/date="), d.cast("string")).alias("source_file"),
    )


# ---------------------------------------------------------------------------
# FX4/FX5: the feeds as landed JSON (market documents, pool pages)
# ---------------------------------------------------------------------------

FIXTURE_PAGE_SIZE = 5


#: Rows up to which a slice is ranked and cut into pages by one task.
FIXTURE_SLICE_ROWS = 1 << 20


def _venue_item(venue: str, c: dict[str, Column], defects: bool = False) -> Column:
    """One FX1 row as the venue's API pool object (FX3 encoding: Orca sends
    measures as strings, Raydium as numbers, Meteora TVL as a string).

    FX8 (``defects``): some rows have no address, some a volume or a TVL that
    is no number (all measures are strings then)."""
    vol, fees, tvl = c["trailing_24h_volume_usd"], c["trailing_24h_fees_usd"], c["tvl_usd"]
    address = c["pool_address"]
    if defects:
        # marks one row in so many, by its supplier and day
        marked = lambda every: (F.substring(c["pool_address"], 5, 20).cast("long") + F.unix_date(c["snapshot_date"])) % every == 0
        vol = F.when(marked(29), F.lit("n/a")).otherwise(vol.cast("string"))
        tvl = F.when(marked(31), F.lit("1,000,000")).otherwise(tvl.cast("string"))
        address = F.when(~marked(23), address).otherwise(F.lit("" if venue == "orca" else None).cast("string"))

    def tok(sym: str, addr: str) -> Column:
        return F.struct(c[sym].alias("symbol"), c[addr].alias("address"))

    if venue == "raydium":
        return F.struct(
            address.alias("id"),
            tok("base_token_symbol", "base_token_address").alias("mintA"),
            tok("quote_token_symbol", "quote_token_address").alias("mintB"),
            F.struct(vol.alias("volume"), fees.alias("volumeFee")).alias("day"),
            tvl.alias("tvl"),
        )
    if venue == "orca":
        return F.struct(
            address.alias("address"),
            tok("base_token_symbol", "base_token_address").alias("tokenA"),
            tok("quote_token_symbol", "quote_token_address").alias("tokenB"),
            F.struct(F.struct(vol.cast("string").alias("volume"), fees.cast("string").alias("fees")).alias("24h")).alias("stats"),
            tvl.cast("string").alias("tvlUsdc"),
        )
    return F.struct(
        address.alias("pool_address"),
        F.concat(c["base_token_symbol"], F.lit("-"), c["quote_token_symbol"]).alias("pool_name"),
        F.array(c["base_token_address"], c["quote_token_address"]).alias("pool_token_mints"),
        vol.alias("trading_volume"),
        fees.alias("fee_volume"),
        tvl.cast("string").alias("pool_tvl"),
    )


def _page_body(venue: str, defects: bool) -> Column:
    """A page's JSON with its feed's paging metadata, from (snapshot_date,
    page_no, n_pools, last_page, items of ``_FX1_FROM``)."""

    def item(x: Column) -> Column:
        return _venue_item(venue, _fx1_columns(lambda n: F.col(n) if n == "snapshot_date" else x.getField(n)), defects)

    data = F.transform("items", item).alias("data")
    if venue == "raydium":
        return F.to_json(F.struct(F.struct(data, (F.col("page_no") < F.col("last_page")).alias("hasNextPage")).alias("data")))
    if venue == "orca":
        cursor = F.struct(F.struct(F.concat(F.lit("c"), (F.col("page_no") + 1).cast("string")).alias("next")).alias("cursor"))
        return F.to_json(F.struct(data, cursor.alias("meta")))
    return F.to_json(F.struct(data, F.col("n_pools").alias("total_count")))


def fx5_pages(
    spark: SparkSession, sf_dir: str, page_size: int = FIXTURE_PAGE_SIZE, defects: bool = False, slice_rows: int = FIXTURE_SLICE_ROWS
) -> DataFrame:
    """FX5: landed pool pages (source, snapshot_date, page_no, body); FX8 with ``defects``.

    FX1 without NULL volumes, ordered per (venue, day) by volume desc then
    address, cut into pages of ``page_size``; each page carries its feed's
    paging metadata, and Orca's last page is landed twice (the API repeats
    its last cursor).

    The rows are shuffled once, as the few numbers that FX1 is made from: a
    slice's rows are ranked and each page's first row gathers the next ones.
    Slices of more than ``slice_rows`` rows get their positions from the
    skew-safe ranking instead, and a page is collected from at most
    ``page_size`` rows.
    """
    from snapdeck.operators.joins import bounded_broadcast, materialize
    from snapdeck.operators.ranking import row_number_within

    made = _fx1_columns(F.col)
    there = made["trailing_24h_volume_usd"].isNotNull() & made["dex_name"].isNotNull() & F.col("snapshot_date").isNotNull()
    # read by the slice counts and the ranking: compute once
    pools = materialize(_fx1_measured(spark, sf_dir).filter(there)).withColumn("dex_name", made["dex_name"])
    keys = ["snapshot_date", "dex_name"]
    # as doubles first: the same order, and few rows are left to compare as decimals
    volume = made["trailing_24h_volume_usd"]
    order = [volume.cast("double").desc(), volume.desc(), made["pool_address"].asc()]
    row = F.struct(*_FX1_FROM)
    page_no = F.floor((F.col("rn") - 1) / page_size).cast("long").alias("page_no")

    big = materialize(pools.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pools")).filter(F.col("n_pools") > slice_rows))
    split = not big.isEmpty()
    side = bounded_broadcast(big)[0] if split else None
    in_slice = Window.partitionBy(*keys).orderBy(*order)
    # laid out before the structs and sort keys are made, so that they don't travel
    laid = (pools.join(side, keys, "left_anti") if split else pools).repartition(*keys)
    ranked = laid.select(
        *keys,
        F.row_number().over(in_slice).alias("rn"),
        F.count(F.lit(1)).over(in_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_pools"),
        row.alias("_i0"),
        *[F.lead(row, i).over(in_slice).alias(f"_i{i}") for i in range(1, page_size)],
    )
    following = F.array(*[F.col(f"_i{i}") for i in range(page_size)])
    pages = ranked.filter((F.col("rn") - 1) % page_size == 0).select(
        *keys, page_no, "n_pools", F.filter(following, lambda x: x.isNotNull()).alias("items")
    )
    if split:
        rows = row_number_within(pools.join(side, keys, "left_semi"), keys, order)
        found = rows.groupBy(*keys, page_no).agg(F.sort_array(F.collect_list(F.struct("rn", row.alias("item")))).alias("_pi"))
        found = found.join(side, keys).withColumn("items", F.transform("_pi", lambda x: x.getField("item")))
        pages = pages.unionByName(found.select(*pages.columns))
    pages = pages.withColumn("last_page", F.floor((F.col("n_pools") - 1) / page_size).cast("long"))
    body = None
    for venue in FIXTURE_VENUES:
        body = (F.when if body is None else body.when)(F.col("dex_name") == venue, _page_body(venue, defects))
    # Orca's repeated last page: same items and cursor, next page number
    repeated = (F.col("dex_name") == "orca") & (F.col("page_no") == F.col("last_page"))
    numbers = F.when(repeated, F.array("page_no", F.col("page_no") + 1)).otherwise(F.array("page_no"))
    landed = pages.select(F.col("dex_name").alias("source"), "snapshot_date", body.alias("body"), numbers.alias("_numbers"))
    return landed.select("source", "snapshot_date", F.explode("_numbers").alias("page_no"), "body")


def manifest_from_pages(pages: DataFrame) -> DataFrame:
    """The manifest a landing run records for FX5 pages: one row per slice
    with the run's snapshot_at and the number of pool records landed."""
    from snapdeck.sources.lake import page_record_count

    items = page_record_count(F.col("source"), F.col("body"))
    m = pages.groupBy("source", "snapshot_date").agg(F.sum(items).cast("long").alias("raw_record_count"))
    return m.select("source", "snapshot_date", run_stamp(F.col("snapshot_date")).alias("snapshot_at"), "raw_record_count")


def fx5_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the FX5 slices: the landing run's snapshot_at and pool count."""
    pools = fx1_pools(spark, sf_dir).filter(F.col("trailing_24h_volume_usd").isNotNull())
    m = pools.groupBy(F.col("dex_name").alias("source"), "snapshot_date").agg(F.count(F.lit(1)).alias("raw_record_count"))
    return m.select("source", "snapshot_date", run_stamp(F.col("snapshot_date")).alias("snapshot_at"), "raw_record_count")


def fx4_market_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4: one market document per day, ``{"protocols": [...]}``.

    A day holds at most one row per protocol (8 by construction), so the
    collected document is bounded. 24h as a number, 7d as a string.
    """
    from snapdeck.sources.lake import market_slice_path

    p = fx2_protocols(spark, sf_dir)
    proto = F.struct(
        F.col("protocol_name").alias("name"),
        F.col("total24h").alias("total24h"),
        F.col("total7d").cast("string").alias("total7d"),
        F.col("totalAllTime").alias("totalAllTime"),
    )
    docs = p.groupBy("snapshot_date").agg(F.max("snapshot_at").alias("snapshot_at"), F.collect_list(proto).alias("protocols"))
    return docs.select(
        "snapshot_at",
        "snapshot_date",
        market_slice_path(F.lit("raw"), F.col("snapshot_date")).alias("source_file"),
        F.to_json(F.struct("protocols")).alias("body"),
    )


# ---------------------------------------------------------------------------
# FX7: the pool table before and after some slices were loaded again
# ---------------------------------------------------------------------------

# Fixed values of the fixture design: a slice of the venue on every so many
# days is new, loaded again with other volumes, or gone.
RELOADED = {"new": (499, "orca"), "changed": (503, "raydium"), "gone": (509, "meteora")}


def _reloaded(kind: str) -> Column:
    every, venue = RELOADED[kind]
    return (F.unix_date("snapshot_date") % every == 0) & (F.col("dex_name") == venue)


def fx7_before(pools: DataFrame) -> DataFrame:
    """FX1 without the new slices, and with twice the volume in the changed ones."""
    volume = F.col("trailing_24h_volume_usd")
    return pools.filter(~_reloaded("new")).withColumn(
        "trailing_24h_volume_usd", F.when(_reloaded("changed"), volume * 2).otherwise(volume).cast("decimal(38,9)")
    )


def fx7_after(pools: DataFrame) -> DataFrame:
    """FX1 without the slices that are gone."""
    return pools.filter(~_reloaded("gone"))
