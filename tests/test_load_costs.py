"""What loads at size depend on: rows shuffled once, pages parsed once, files compressed."""

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from snapdeck.config import Config
from snapdeck.sources import fixtures as fx
from snapdeck.sources import ingest, lake
from snapdeck.sources import schemas

D = dt.date(2026, 6, 3)


@pytest.fixture()
def sf(spark, tmp_path):
    """Two days of 13 and 4 pools a venue, equal volumes among them."""
    rows = [(k, dt.datetime(2001, 5, d, 7), 100.0 * (k % 4 + 1), 0.5, 0.1) for d, n in ((3, 39), (4, 12)) for k in range(n)]
    rows.append((1, None, 5.0, 0.5, 0.1))
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, l_discount double, l_tax double").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    spark.createDataFrame([(k, k % 25, 10.0 * k) for k in range(39)], "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(
        f"{tmp_path}/supplier.parquet"
    )
    return str(tmp_path)


def test_pages_of_ranked_and_of_split_slices_are_the_same(spark, sf):
    page = ["source", "snapshot_date", "page_no", "body"]
    whole = sorted(map(tuple, fx.fx5_pages(spark, sf).select(*page).collect()))
    split = sorted(map(tuple, fx.fx5_pages(spark, sf, slice_rows=5).select(*page).collect()))
    assert whole == split
    assert len(whole) == 2 * (3 + 1) + (3 + 1 + 2)  # Orca's last page of each day twice
    orca = {p: json.loads(b) for s, d, p, b in whole if s == "orca" and d.day == 3}
    assert [len(orca[p]["data"]) for p in sorted(orca)] == [5, 5, 3, 3] and orca[2] == orca[3]
    sent = [(float(i["stats"]["24h"]["volume"]), i["address"]) for p in range(3) for i in orca[p]["data"]]
    assert sent == sorted(sent, key=lambda x: (-x[0], x[1])) and len(set(sent)) == 13


def _orca(spark, pages):
    item = lambda a: {"address": a, "stats": {"24h": {"volume": "5000", "fees": "1"}}, "tvlUsdc": "9000"}
    rows = [("orca", D, n, json.dumps({"data": [item(a) for a in names], "meta": {"cursor": {"next": "c"}}})) for n, names in pages]
    return spark.createDataFrame(rows, "source string, snapshot_date date, page_no long, body string")


def test_dropped_pages_are_not_parsed_for_items(spark):
    _, items = ingest.assemble_pages(_orca(spark, [(0, ["a", "b"]), (1, ["c"])]), "orca")
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "from_json" in line]


@pytest.mark.parametrize("nameless", [False, True])
def test_only_pages_with_copies_are_shuffled(spark, nameless):
    # an address twice on a page, on two pages, a page that is there twice, and items without one
    pages = _orca(spark, [(0, ["a", "b", "a"]), (1, ["c", "", "b"]), (2, ["d", None]), (3, ["e", ""]), (3, ["e", ""])])
    parsed = ingest.parse_pages(pages, "orca")
    kept, heads = pages.select(*ingest.SLICE, "page_no").distinct(), ingest.page_heads(parsed, "orca")
    got = lambda **k: sorted((r.page_no, r.pos, r.item.address or "") for r in ingest.kept_items(parsed, kept, "orca", nameless, **k).collect())
    assert got(heads=heads) == got()
    assert [a for *_, a in got(heads=heads) if a] == ["a", "b", "c", "d", "e"]
    copies = {r.page_no for r in ingest.pages_with_copies(heads, kept).collect()}
    assert copies == {0, 1, 3}


def test_landed_pages_are_compressed(spark, tmp_path):
    pages = _orca(spark, [(n, [f"p{n}"]) for n in range(4)])
    lake.land_pages(pages, str(tmp_path))
    files = glob.glob(f"{tmp_path}/dex_pools/dex=orca/date={D}/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    back = lake.read_landed_pages(spark, str(tmp_path)).select("page_no", "body").collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, pages.select("page_no", "body").collect()))


def test_stored_rows_are_loaded_without_another_copy(spark, tmp_path, monkeypatch):
    row = (dt.datetime(2026, 6, 4, 2), D, "orca", "a", "S", "M", "T", "N", 2000.0, 1.0, 3000.0, "f")
    src, path = f"{tmp_path}/src", f"{tmp_path}/raw"
    spark.createDataFrame([row], schemas.RAW_POOLS).write.parquet(src)
    rows = spark.read.parquet(src)

    def no_copy(df):
        raise AssertionError("written again")

    monkeypatch.setattr(lake, "materialize", no_copy)
    assert lake.load_slices(rows, path, schema=schemas.RAW_POOLS, stored=True, cfg=Config()) == {"rows_loaded": 1, "slices_skipped": 0}
    assert spark.read.parquet(path).filter(F.col("pool_address") == "a").count() == 1
