"""Feed ingest: landed JSON pages/documents -> normalized raw rows.

Pipeline per venue: parse the landed page bodies with a declared schema,
cut the feed at its stop page (I1), drop repeated pools (I2, Orca), explode
to one row per pool, normalize to the raw schema (I3-I6), drop rows without
an id (I7) and below the quality floor (I8), stamp the run (I12), and union
the venues (I13). All of it is per-row or per-group DataFrame work, so
executors parse pages in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from snapdeck.config import DEFAULT, Config
from snapdeck.functions import contains_any, safe_double, split_pair
from snapdeck.operators.joins import bounded_broadcast, join_small, materialize
from snapdeck.sources import schemas

def strict_json(body: str, schema, message: str) -> Column:
    """Parse a landed body; an empty or malformed one fails the source instead
    of reading as a page without rows."""
    blank = F.trim(F.coalesce(F.col(body), F.lit(""))) == ""
    return F.from_json(F.when(blank, F.raise_error(F.lit(message))).otherwise(F.col(body)), schema, {"mode": "FAILFAST"})


# ---------------------------------------------------------------------------
# Market feed (relational form and JSON form)
# ---------------------------------------------------------------------------


def market_rows_from_protocols(protocols: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Keep protocols whose lower-cased name contains a tracked venue;
    ``dex_name`` is the lower-cased protocol name (canonical labels come in staging).

    Input columns: snapshot_at, snapshot_date, protocol_name, total24h, total7d,
    totalAllTime, source_file.
    """
    kept = protocols.filter(contains_any("protocol_name", cfg.tracked_venues))
    return kept.select(
        "snapshot_at",
        "snapshot_date",
        F.lower("protocol_name").alias("dex_name"),
        F.col("total24h").alias("trailing_24h_volume_usd"),
        F.col("total7d").alias("trailing_7d_volume_usd"),
        F.col("totalAllTime").alias("total_volume_usd"),
        "source_file",
    )


def parse_market_documents(docs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """I6 from JSON: one ``{"protocols": [...]}`` document per row.

    Input columns: body, snapshot_at, snapshot_date, source_file. Measures
    may be numbers or strings; both coerce through ``safe_double``.
    """
    return market_rows_from_protocols(market_protocols(docs), cfg)


def market_protocols(docs: DataFrame) -> DataFrame:
    """All protocols of the documents, tracked or not; ``n_unparsable`` counts
    a protocol's measures that hold something other than a number."""
    document = strict_json("body", schemas.MARKET_DOCUMENT, "unparsable market document")
    p = docs.select("snapshot_at", "snapshot_date", "source_file", F.explode(document.protocols).alias("p"))
    measures = ["total24h", "total7d", "totalAllTime"]
    return p.select(
        "snapshot_at",
        "snapshot_date",
        F.coalesce(F.col("p.name"), F.lit("")).alias("protocol_name"),
        *[safe_double(f"p.{m}").alias(m) for m in measures],
        "source_file",
        sum((_unparsable(F.col(f"p.{m}"), safe_double(f"p.{m}")).cast("int") for m in measures), F.lit(0)).alias("n_unparsable"),
    )


def _unparsable(text: Column, number: Column) -> Column:
    """A measure that is there and isn't a number (it counts as null)."""
    return text.isNotNull() & number.isNull()


# ---------------------------------------------------------------------------
# Pool feeds: landed pages -> assembled items
# ---------------------------------------------------------------------------

SLICE = ["source", "snapshot_date"]


def _last_volume(source: str, items: Column) -> Column:
    last = F.get(items, F.size(items) - 1)  # null of a page without items
    if source == "raydium":
        v = last.getField("day").getField("volume")
    elif source == "orca":
        v = last.getField("stats").getField("24h").getField("volume")
    else:
        v = last.getField("trading_volume")
    return F.coalesce(safe_double(v), F.lit(0.0))


def parse_pages(pages: DataFrame, source: str) -> DataFrame:
    """Parse page bodies of one feed: (source, snapshot_date, page_no, items, meta...)."""
    # the condition stands in the expression too: filters that Spark infers from
    # the items may run before the one on the source, over other feeds' pages
    body = strict_json("body", schemas.POOL_PAGE[source], f"unparsable {source} page")
    pg = F.when(F.col("source") == source, body).alias("pg")
    # the file that a page was read from, where the pages come from files
    file = F.col("source_file") if "source_file" in pages.columns else F.lit(None).cast("string").alias("source_file")
    p = pages.filter(F.col("source") == source).select("source", "snapshot_date", "page_no", file, pg)
    page = [*SLICE, "page_no", "source_file"]
    if source == "raydium":
        return p.select(*page, F.col("pg.data.data").alias("items"), F.col("pg.data.hasNextPage").alias("has_next"))
    if source == "orca":
        return p.select(*page, F.col("pg.data").alias("items"), F.col("pg.meta.cursor.next").alias("cursor"))
    return p.select(*page, F.col("pg.data").alias("items"), F.col("pg.total_count").alias("total_count"))


def page_heads(parsed: DataFrame, source: str) -> DataFrame:
    """What the stop rules need of a page: its key, number of items and last
    volume, and what the feed says about going on (Orca: its addresses too)."""
    n_items = F.coalesce(F.size("items"), F.lit(0)).alias("n_items")
    more = {"raydium": ["has_next"], "orca": ["cursor", F.col("items.address").alias("addresses")], "meteora": ["total_count"]}
    return parsed.select(*SLICE, "page_no", n_items, _last_volume(source, F.col("items")).alias("last_volume"), *more[source])


def page_meta(parsed: DataFrame, source: str, cfg: Config = DEFAULT, floor: float | None = None) -> DataFrame:
    """Per-page stop flags of one feed's parsed pages (see ``page_flags``)."""
    # Orca's heads are read twice there: pages are parsed once
    return page_flags(materialize(page_heads(parsed, source)), source, cfg, floor)


def page_flags(heads: DataFrame, source: str, cfg: Config = DEFAULT, floor: float | None = None) -> DataFrame:
    """Per-page stop flags of one feed: (source, snapshot_date, page_no, n_items, is_stop).

    A feed stops after the first page whose last pool is below the volume
    floor, or that has no next page (Raydium), reaches the advertised total
    (Meteora), has no cursor or adds no new pool (Orca).
    """
    floor = cfg.volume_floor if floor is None else floor
    below = (F.col("n_items") > 0) & (F.col("last_volume") < floor)

    if source == "orca":
        # first page where each address appears; a page's "new" count is the
        # number of addresses first seen on it (prefix-consistent with a
        # page-by-page seen-set). Only addresses and page numbers are shuffled.
        addresses = heads.select(*SLICE, "page_no", F.explode("addresses").alias("_addr"))
        first = addresses.filter(F.col("_addr") != "").groupBy(*SLICE, "_addr").agg(F.min("page_no").alias("page_no"))
        new_per_page = first.groupBy(*SLICE, "page_no").agg(F.count(F.lit(1)).alias("_new"))
        meta = heads.select(*SLICE, "page_no", "n_items", below.alias("_below"), "cursor").join(
            new_per_page, [*SLICE, "page_no"], "left"
        )
        stop = F.col("_below") | F.col("cursor").isNull() | (F.col("cursor") == "") | (F.coalesce(F.col("_new"), F.lit(0)) == 0)
        return meta.withColumn("is_stop", stop).drop("_below", "cursor", "_new")
    if source == "meteora":
        # page-level rows only (one per page): the running count is cheap
        w = Window.partitionBy(*SLICE).orderBy("page_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        meta = heads.select(*SLICE, "page_no", "n_items", below.alias("_below"), "total_count")
        meta = meta.withColumn("_seen", F.sum("n_items").over(w))
        return meta.withColumn("is_stop", F.col("_below") | (F.col("_seen") >= F.coalesce(F.col("total_count"), F.lit(0)))).drop(
            "_below", "total_count", "_seen"
        )
    return heads.select(*SLICE, "page_no", "n_items", (below | ~F.coalesce(F.col("has_next"), F.lit(False))).alias("is_stop"))


def page_status(meta: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """``kept`` = page at or before its feed's first stop page; a feed
    without one is kept whole. ``meta`` may hold several feeds."""
    # page-level rows (one per page, not per pool): written once so the
    # page bodies are not parsed again for the stop decision
    meta = materialize(meta)
    # first stop page per feed: one small aggregate over page-level rows
    stops = meta.groupBy(*SLICE).agg(F.min(F.when(F.col("is_stop"), F.col("page_no"))).alias("_stop"))
    # stops has one row per (source, day): checked broadcast, no shuffle of pages by day
    return join_small(meta, stops, SLICE, "left", max_bytes=cfg.broadcast_max_bytes).withColumn(
        "kept", F.col("_stop").isNull() | (F.col("page_no") <= F.col("_stop"))
    ).drop("_stop")


def kept_pages(status: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Keys of the kept pages, broadcast where their measured size allows."""
    return bounded_broadcast(status.filter("kept").select(*SLICE, "page_no"), cfg.broadcast_max_bytes)[0]


def pages_with_copies(heads: DataFrame, kept: DataFrame) -> DataFrame:
    """(slice, page_no) of one Orca feed's kept pages that hold an address which
    is there more than once, or that are there more than once themselves. From
    the pages' heads: keys are shuffled, not the items."""
    page = [*SLICE, "page_no"]
    heads = heads.join(kept, page, "left_semi")
    named = heads.select(*page, F.explode("addresses").alias("_addr")).filter(F.col("_addr") != "")
    found = named.groupBy(*SLICE, "_addr").agg(F.count(F.lit(1)).alias("_n"), F.collect_set("page_no").alias("_pages")).filter(F.col("_n") > 1)
    twice = heads.groupBy(*page).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return found.select(*SLICE, F.explode("_pages").alias("page_no")).unionByName(twice.select(*page)).distinct()


def kept_items(
    parsed: DataFrame, kept: DataFrame, source: str, nameless: bool = False, heads: DataFrame | None = None, cfg: Config = DEFAULT
) -> DataFrame:
    """Items (source, snapshot_date, page_no, pos, source_file, item) of one
    feed's kept pages: pages are dropped before their items unfold. Orca's are
    reduced to the first occurrence of each address (I2); kept pages are a
    prefix, so that is the first of all pages. Items without an address are
    nobody's copy: they stay with ``nameless`` (to be counted), else go.

    With Orca's ``heads`` only pages that hold copies have their items shuffled."""
    pages = parsed.join(kept, [*SLICE, "page_no"], "left_semi")
    where = [*SLICE, "page_no", "pos", "source_file"]

    def unfold(pages: DataFrame) -> DataFrame:
        # outer: of the inner form Spark infers a filter on the items that parses
        # every page below the join, dropped or not; rows without an item go here
        return pages.select(*SLICE, "page_no", "source_file", F.posexplode_outer("items").alias("pos", "item")).filter(F.col("item").isNotNull())

    if source != "orca":
        return unfold(pages).select(*where, "item")
    # copies of one address combine map-side; an item without one has a key of its own
    address = F.col("item").getField("address")
    named = address.isNotNull() & (address != "")

    def wanted(pages: DataFrame) -> DataFrame:
        return unfold(pages) if nameless else unfold(pages).filter(named)

    def first(items: DataFrame) -> DataFrame:
        keys = [F.when(named, address).alias("_addr"), *[F.when(~named, F.col(c)).alias(f"_{c}") for c in ("page_no", "pos")]]
        found = items.groupBy(*SLICE, *keys).agg(
            F.min_by(F.struct("page_no", "pos", "source_file", "item"), F.struct("page_no", "pos")).alias("_f")
        )
        return found.select(*SLICE, *[F.col(f"_f.{c}").alias(c) for c in ("page_no", "pos", "source_file", "item")])

    if heads is None:
        return first(wanted(pages))
    copies, _ = bounded_broadcast(pages_with_copies(heads, kept), cfg.broadcast_max_bytes)
    page = [*SLICE, "page_no"]
    once, some = wanted(pages.join(copies, page, "left_anti")), wanted(pages.join(copies, page, "left_semi"))
    return once.select(*where, "item").unionByName(first(some))


def assemble_pages(pages: DataFrame, source: str, cfg: Config = DEFAULT, floor: float | None = None) -> tuple[DataFrame, DataFrame]:
    """I1 (+ I2 for Orca) for one feed: (page_status, kept items)."""
    parsed = parse_pages(pages, source)
    # all pages are parsed for their heads (a few bytes a page are written);
    # the kept ones again for their items, which are not written in between
    heads = materialize(page_heads(parsed, source))
    status = page_status(page_flags(heads, source, cfg, floor), cfg)
    return status, kept_items(parsed, kept_pages(status, cfg), source, heads=heads, cfg=cfg)


# ---------------------------------------------------------------------------
# Normalization to the raw table
# ---------------------------------------------------------------------------


MEASURES = {"trailing_24h_volume_usd": "volume_text", "trailing_24h_fees_usd": "fees_text", "tvl_usd": "tvl_text"}


def _pool_columns(it: Column, source: str) -> dict[str, Column]:
    """The common columns of a venue's pool object; measures as they were sent."""
    if source == "raydium":
        base, quote, day = it.getField("mintA"), it.getField("mintB"), it.getField("day")
        sent = (it.getField("id"), day.getField("volume"), day.getField("volumeFee"), it.getField("tvl"))
    elif source == "orca":
        base, quote, day = it.getField("tokenA"), it.getField("tokenB"), it.getField("stats").getField("24h")
        sent = (it.getField("address"), day.getField("volume"), day.getField("fees"), it.getField("tvlUsdc"))
    else:
        base = quote = None
        sent = (it.getField("pool_address"), it.getField("trading_volume"), it.getField("fee_volume"), it.getField("pool_tvl"))
    if base is not None:
        tokens = [t.getField(f) for t in (base, quote) for f in ("symbol", "address")]
    else:
        symbols, mints = split_pair(it.getField("pool_name")), it.getField("pool_token_mints")
        tokens = [symbols[0], F.get(mints, 0), symbols[1], F.get(mints, 1)]
    names = ["base_token_symbol", "base_token_address", "quote_token_symbol", "quote_token_address"]
    return {"pool_address": sent[0], **dict(zip(names, tokens)), **dict(zip(MEASURES, sent[1:]))}


def normalize_items(items: DataFrame, source: str, keep: list[str] | None = None, texts: bool = False) -> DataFrame:
    """Venue pool objects -> the common pool columns (measures as DOUBLE; with
    ``texts`` also as they were sent)."""
    cols = _pool_columns(F.col("item"), source)
    out = [(safe_double(c) if n in MEASURES else c).alias(n) for n, c in cols.items()]
    if texts:
        out += [cols[n].cast("string").alias(t) for n, t in MEASURES.items()]
    return items.select(*SLICE, *(keep or []), *out)


def has_id(c: str = "pool_address") -> Column:
    """Rows without an id (NULL or '') are dropped."""
    return F.col(c).isNotNull() & (F.col(c) != "")


def quality_floor(df: DataFrame, cfg: Config = DEFAULT, volume: str = "trailing_24h_volume_usd", tvl: str = "tvl_usd") -> DataFrame:
    """I8: keep rows with volume >= floor AND tvl >= floor; NULL counts as 0."""
    return df.filter(above_floor(cfg, volume, tvl))


def above_floor(cfg: Config = DEFAULT, volume: str = "trailing_24h_volume_usd", tvl: str = "tvl_usd") -> Column:
    return (F.coalesce(F.col(volume), F.lit(0)) >= F.lit(cfg.volume_floor)) & (F.coalesce(F.col(tvl), F.lit(0)) >= F.lit(cfg.tvl_floor))


# ---------------------------------------------------------------------------
# Rejected rows
# ---------------------------------------------------------------------------

REASONS = ("missing_id", "unparsable_measure", "below_floor")
REJECT_COLUMNS = [*SLICE, "page_no", "pos", "pool_address", "reason", *MEASURES.values(), "source_file"]


def tag_rejects(rows: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds ``reason``, why a row is not loaded (null: it is loaded), and
    ``n_unparsable``, how many of its measures are there and not a number.

    missing_id: the row has none. unparsable_measure: it falls below the floor
    with a volume or TVL that couldn't be read. below_floor: it falls below
    the floor by its numbers.
    """
    bad = {m: _unparsable(F.col(t), F.col(m)) for m, t in MEASURES.items()}
    under = ~above_floor(cfg)
    reason = (
        F.when(~has_id(), "missing_id")
        .when(under & (bad["trailing_24h_volume_usd"] | bad["tvl_usd"]), "unparsable_measure")
        .when(under, "below_floor")
    )
    return rows.withColumns({"reason": reason, "n_unparsable": sum((b.cast("int") for b in bad.values()), F.lit(0))})


def reject_metrics(sources: Sequence[str]) -> list[Column]:
    """Counts of tagged rows by source, for an Observation: rows, kept, one per
    reason, and unparsable measures (kept rows' too)."""
    out = []
    for s in sources:
        mine = F.col("source") == s
        out.append(F.count_if(mine).alias(f"{s}.rows"))
        out.append(F.count_if(mine & F.col("reason").isNull()).alias(f"{s}.kept"))
        out += [F.count_if(mine & (F.coalesce("reason", F.lit("")) == r)).alias(f"{s}.{r}") for r in REASONS]
        out.append(F.coalesce(F.sum(F.when(mine, F.col("n_unparsable"))), F.lit(0)).alias(f"{s}.unparsable_values"))
    return out


@dataclass
class Ingested:
    """What an ingest made of landed pages."""

    rows: DataFrame  # raw rows
    rejects: DataFrame  # REJECT_COLUMNS
    counts: dict[str, dict[str, int]]  # by source


def ingest_with_rejects(
    pages: DataFrame, manifest: DataFrame, cfg: Config = DEFAULT, sources: tuple[str, ...] | None = None, source_file: Column | None = None
) -> Ingested:
    """I1-I5, I7-I9, I12, I13 with an account of every row: rows are tagged and
    written once, counted in that same write, and read back as loaded rows and
    as rejects."""
    srcs = sources or tuple(cfg.pool_venues)
    tagged = tag_rejects(_normalized(pages, srcs, cfg, ["page_no", "pos", "source_file"], texts=True), cfg)
    obs = Observation("ingest")
    tagged = materialize(tagged.observe(obs, *reject_metrics(srcs)))
    counts: dict[str, dict[str, int]] = {s: {} for s in srcs}
    for name, n in obs.get.items():
        source, _, what = name.rpartition(".")
        counts[source][what] = int(n)
    kept = tagged.filter(F.col("reason").isNull())
    rejects = tagged.filter(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)
    return Ingested(_stamped(kept, manifest, source_file, cfg), rejects, counts)


def stamp(rows: DataFrame, manifest: DataFrame, source_file: Column, max_bytes: int = DEFAULT.broadcast_max_bytes) -> DataFrame:
    """snapshot_at from the slice manifest (the run that landed it),
    venue literal and source path: the row's own file, or ``source_file``
    where pages don't come from files. The manifest has one row per slice."""
    m = manifest.select(*SLICE, F.col("snapshot_at").alias("_mat"))
    # one row per slice: broadcast after a size check, so a hot day's rows never shuffle
    j = join_small(rows, m, SLICE, "left", max_bytes=max_bytes)
    return j.select(
        F.coalesce(F.col("_mat"), F.current_timestamp()).alias("snapshot_at"),
        F.col("snapshot_date"),
        F.col("source").alias("dex_name"),
        *[F.col(c) for c in schemas.POOL_COLUMNS[3:11]],
        (F.coalesce("source_file", source_file) if "source_file" in rows.columns else source_file).alias("source_file"),
    )


def ingest_pool_pages(pages: DataFrame, manifest: DataFrame, source: str, cfg: Config = DEFAULT, source_file: Column | None = None) -> DataFrame:
    """I1-I5, I7, I8, I12 for one venue: landed pages -> raw pool rows."""
    return ingest_all_pools(pages, manifest, cfg, (source,), source_file)


def ingest_all_pools(
    pages: DataFrame, manifest: DataFrame, cfg: Config = DEFAULT, sources: tuple[str, ...] | None = None, source_file: Column | None = None
) -> DataFrame:
    """Every venue's pages -> one raw table.

    Stop pages of all feeds are decided in one pass over page-level rows;
    items of the kept pages are normalized to the common columns, unioned,
    filtered (id, floor) and stamped once.
    """
    srcs = sources or tuple(cfg.pool_venues)
    kept = quality_floor(_normalized(pages, srcs, cfg, ["source_file"]).filter(has_id()), cfg)
    return _stamped(kept, manifest, source_file, cfg)


def _normalized(pages: DataFrame, sources: Sequence[str], cfg: Config, keep: list[str], texts: bool = False) -> DataFrame:
    """All items of the kept pages of all feeds, in the common columns."""
    parsed = {s: parse_pages(pages, s) for s in sources}
    # all pages are parsed for their heads, the kept ones again for their items
    heads = {s: materialize(page_heads(p, s)) for s, p in parsed.items()}
    metas = [page_flags(h, s, cfg) for s, h in heads.items()]
    pages_kept = kept_pages(page_status(reduce(DataFrame.unionByName, metas), cfg), cfg)
    items = {s: kept_items(p, pages_kept, s, nameless=texts, heads=heads[s], cfg=cfg) for s, p in parsed.items()}
    return reduce(DataFrame.unionByName, [normalize_items(rows, s, keep, texts) for s, rows in items.items()])


def _stamped(rows: DataFrame, manifest: DataFrame, source_file: Column | None, cfg: Config) -> DataFrame:
    from snapdeck.sources.lake import pool_slice_path

    path = source_file if source_file is not None else pool_slice_path(F.lit("raw"), F.col("source"), F.col("snapshot_date"))
    return stamp(rows, manifest, path, cfg.broadcast_max_bytes)
