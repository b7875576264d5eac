"""Feed ingest on hand-made pages: string/number measures, NaN, missing ids,
NULL structs, stop rules, Orca's repeated page, landings without a cap."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from snapdeck.config import Config
from snapdeck.sources import ingest, lake

D = dt.date(2026, 6, 2)


def pages_df(spark, source, bodies):
    rows = [(source, D, i, json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "source string, snapshot_date date, page_no long, body string")


def manifest(spark, source):
    return spark.createDataFrame([(source, D, dt.datetime(2026, 6, 3, 2, tzinfo=dt.timezone.utc))], "source string, snapshot_date date, snapshot_at timestamp")


def ray(pid, vol, tvl=5000, fee=1, mint_a=True):
    p = {"id": pid, "mintB": {"symbol": "USDC", "address": "M2"}, "day": {"volume": vol, "volumeFee": fee}, "tvl": tvl}
    if mint_a:
        p["mintA"] = {"symbol": "SOL", "address": "M1"}
    return p


def test_raydium_stop_floor_and_coercion(spark):
    p0 = {"data": {"data": [ray("a", 9000), ray("b", "8000.5"), ray("", 7000), ray("n", "NaN"), ray("c", 5000, mint_a=False)], "hasNextPage": True}}
    p1 = {"data": {"data": [ray("d", 4000, tvl="999.99"), ray("e", 500)], "hasNextPage": True}}
    p2 = {"data": {"data": [ray("f", 400000)], "hasNextPage": False}}
    pages = pages_df(spark, "raydium", [p0, p1, p2])
    status, items = ingest.assemble_pages(pages, "raydium")
    assert [(r.page_no, r.is_stop, r.kept) for r in status.orderBy("page_no").collect()] == [(0, False, True), (1, True, True), (2, True, False)]
    rows = {r.pool_address: r for r in ingest.ingest_pool_pages(pages, manifest(spark, "raydium"), "raydium").collect()}
    # '' has no id; NaN and 500 fall under the floor; d's TVL is below; f is past the stop page
    assert set(rows) == {"a", "b", "c"}
    assert rows["b"].trailing_24h_volume_usd == 8000.5
    assert rows["c"].base_token_address is None and rows["c"].quote_token_symbol == "USDC"
    assert rows["a"].snapshot_at == dt.datetime(2026, 6, 3, 2) and rows["a"].dex_name == "raydium"


def orca(addr, vol):
    return {"address": addr, "tokenA": {"symbol": "A", "address": "MA"}, "tokenB": {"symbol": "B", "address": "MB"},
            "stats": {"24h": {"volume": vol, "fees": "1.5"}}, "tvlUsdc": "12000.25"}


def test_orca_dedup_and_repeated_last_page(spark):
    p0 = {"data": [orca("A", "3000"), orca("B", "2000")], "meta": {"cursor": {"next": "c1"}}}
    p1 = {"data": [orca("C", "1500"), orca("", "1400"), orca("A", "1300")], "meta": {"cursor": {"next": "c2"}}}
    pages = pages_df(spark, "orca", [p0, p1, p1])
    status, items = ingest.assemble_pages(pages, "orca")
    assert [(r.page_no, r.is_stop, r.kept) for r in status.orderBy("page_no").collect()] == [(0, False, True), (1, False, True), (2, True, True)]
    got = sorted((r.item.address, r.page_no, r.pos) for r in items.collect())
    assert got == [("A", 0, 0), ("B", 0, 1), ("C", 1, 0)]
    rows = ingest.ingest_pool_pages(pages, manifest(spark, "orca"), "orca").collect()
    assert sorted(r.pool_address for r in rows) == ["A", "B", "C"]
    assert all(r.tvl_usd == 12000.25 and r.trailing_24h_fees_usd == 1.5 for r in rows)


def met(addr, vol, name="SOL-USDC", mints=("m1", "m2"), tvl="5000"):
    return {"pool_address": addr, "pool_name": name, "pool_token_mints": list(mints), "trading_volume": vol, "fee_volume": 2, "pool_tvl": tvl}


def test_meteora_total_count_and_pairs(spark):
    p0 = {"data": [met("x", 9000, "-USDC", ()), met("y", 8000, "SOL", ["only"])], "total_count": 3}
    p1 = {"data": [met("z", 7000, "A-B-C")], "total_count": 3}
    p2 = {"data": [met("w", 6000)], "total_count": 3}
    pages = pages_df(spark, "meteora", [p0, p1, p2])
    rows = {r.pool_address: r for r in ingest.ingest_pool_pages(pages, manifest(spark, "meteora"), "meteora").collect()}
    assert set(rows) == {"x", "y", "z"}
    assert (rows["x"].base_token_symbol, rows["x"].quote_token_symbol, rows["x"].base_token_address) == ("UNKNOWN", "USDC", None)
    assert (rows["y"].base_token_symbol, rows["y"].base_token_address, rows["y"].quote_token_address) == (None, "only", None)
    assert (rows["z"].base_token_symbol, rows["z"].quote_token_symbol) == ("A", "B-C")


def test_landed_pages_are_not_capped(spark):
    bodies = [{"data": {"data": [ray(f"p{i}", 10000 - i)], "hasNextPage": i < 79}} for i in range(80)]
    _, items = ingest.assemble_pages(pages_df(spark, "raydium", bodies), "raydium", Config())
    assert sorted(r.item.id for r in items.collect()) == sorted(f"p{i}" for i in range(80))


def test_cut_page_fails_the_source(spark):
    good = json.dumps({"data": {"data": [ray("p", 5000)], "hasNextPage": True}})
    for bad in (good[:-20], "", None):
        rows = [("raydium", D, 0, bad), ("raydium", D, 1, good)]
        pages = spark.createDataFrame(rows, "source string, snapshot_date date, page_no long, body string")
        with pytest.raises(Exception):
            ingest.assemble_pages(pages, "raydium", Config())[1].collect()


def test_market_documents_whole_and_once(spark, scratch):
    doc = {"protocols": [{"name": "Raydium AMM", "total24h": 100}]}
    root = scratch("market-lake")
    docs = spark.createDataFrame([(D, json.dumps(doc, indent=2))], "snapshot_date date, body string")
    for _ in range(2):  # the second landing changes nothing
        lake.land_market_documents(docs, root)
    rows = ingest.parse_market_documents(lake.read_market_documents(spark, root)).collect()
    assert [(r.dex_name, r.trailing_24h_volume_usd) for r in rows] == [("raydium amm", 100.0)]
    cut = spark.createDataFrame([(dt.datetime(2026, 6, 3), D, "f", json.dumps(doc)[:-3])], "snapshot_at timestamp, snapshot_date date, source_file string, body string")
    with pytest.raises(Exception):
        ingest.parse_market_documents(cut).collect()


def test_market_documents(spark):
    doc = {"protocols": [
        {"name": "Raydium AMM", "total24h": 100.5, "total7d": "700", "totalAllTime": None},
        {"name": "Phoenix", "total24h": 5},
        {"name": None, "total24h": 1},
        {"name": "meteora DLMM", "total24h": "abc"},
    ]}
    docs = spark.createDataFrame([(dt.datetime(2026, 6, 3, 2), D, "f.json", json.dumps(doc))], "snapshot_at timestamp, snapshot_date date, source_file string, body string")
    rows = {r.dex_name: r for r in ingest.parse_market_documents(docs).collect()}
    assert set(rows) == {"raydium amm", "meteora dlmm"}
    assert rows["raydium amm"].trailing_24h_volume_usd == 100.5 and rows["raydium amm"].trailing_7d_volume_usd == 700.0
    assert rows["meteora dlmm"].trailing_24h_volume_usd is None


def test_quality_floor_literals(spark):
    df = spark.createDataFrame([(1000.0, 1000.0), (999.99, 1000.0), (None, 5000.0), (5000.0, None)], "trailing_24h_volume_usd double, tvl_usd double")
    assert ingest.quality_floor(df).collect() == [(1000.0, 1000.0)]
    ids = spark.createDataFrame([(None,), ("",), ("x",)], "pool_address string")
    assert [r[0] for r in ids.filter(ingest.has_id()).collect()] == ["x"]
