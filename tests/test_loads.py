"""Rejected rows, files with several documents, the manifest log, retention,
and keys checked together."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from snapdeck.config import Config
from snapdeck.operators import checks as ck
from snapdeck.plans import job
from snapdeck.sources import ingest, lake

D = dt.date(2026, 6, 2)
AT = dt.datetime(2026, 6, 3, 2, tzinfo=dt.timezone.utc)
CFG = Config(staging_start=dt.date(2026, 1, 1), calendar_start=dt.date(2026, 1, 1), min_latest_rows=1, min_latest_venues=1)


def ray(pid, vol, tvl=5000, fee=1):
    return {"id": pid, "mintA": {"symbol": "A", "address": "MA"}, "mintB": {"symbol": "B", "address": "MB"},
            "day": {"volume": vol, "volumeFee": fee}, "tvl": tvl}


def orca(addr, vol, tvl="12000"):
    return {"address": addr, "tokenA": {"symbol": "A", "address": "MA"}, "tokenB": {"symbol": "B", "address": "MB"},
            "stats": {"24h": {"volume": vol, "fees": "x"}}, "tvlUsdc": tvl}


def pages_df(spark, bodies):
    rows = [(s, D, i, json.dumps(b)) for s, pages in bodies.items() for i, b in enumerate(pages)]
    return spark.createDataFrame(rows, "source string, snapshot_date date, page_no long, body string")


@pytest.fixture
def pages(spark):
    return pages_df(spark, {
        "raydium": [{"data": {"data": [ray("a", 9000), ray(None, 8000), ray("", 7000), ray("n", "NaN"), ray("t", 6000, tvl="1,000"),
                                       ray("l", 5000, tvl=3), ray("f", 4000, fee="?"), ray("z", 2000)], "hasNextPage": False}}],
        "orca": [{"data": [orca("A", "3000"), orca("", "2000"), orca(None, "2000")], "meta": {"cursor": {"next": "c"}}},
                 {"data": [orca("A", "3000"), orca("", "2000")], "meta": {"cursor": {"next": "c"}}}],
    })


@pytest.fixture
def paths(scratch):
    root = scratch("loads")
    return job.Paths(lake=f"{root}/lake", raw=f"{root}/raw", models=f"{root}/models")


def test_rejects_have_a_reason_and_a_count(spark, pages):
    manifest = spark.createDataFrame([], "source string, snapshot_date date, snapshot_at timestamp")
    found = ingest.ingest_with_rejects(pages, manifest, CFG, ("raydium", "orca"))
    got = sorted((r.source, r.pool_address or "", r.reason, r.page_no, r.pos) for r in found.rejects.collect())
    assert got == [
        ("orca", "", "missing_id", 0, 1), ("orca", "", "missing_id", 0, 2), ("orca", "", "missing_id", 1, 1),
        ("raydium", "", "missing_id", 0, 1), ("raydium", "", "missing_id", 0, 2),
        ("raydium", "l", "below_floor", 0, 5), ("raydium", "n", "unparsable_measure", 0, 3), ("raydium", "t", "unparsable_measure", 0, 4),
    ]
    assert found.counts["raydium"] == {"rows": 8, "kept": 3, "missing_id": 2, "unparsable_measure": 2, "below_floor": 1, "unparsable_values": 3}
    assert found.counts["orca"]["rows"] == 4 and found.counts["orca"]["unparsable_values"] == 4
    texts = {r.pool_address: (r.volume_text, r.tvl_text) for r in found.rejects.filter("source = 'raydium'").collect()}
    assert texts["n"] == ("NaN", "5000") and texts["t"] == ("6000", "1,000")
    plain = ingest.ingest_all_pools(pages, manifest, CFG, ("raydium", "orca"))
    cols = [c for c in plain.columns if c != "snapshot_at"]
    assert found.rows.select(cols).exceptAll(plain.select(cols)).count() == 0 == plain.select(cols).exceptAll(found.rows.select(cols)).count()


def test_run_reports_rejects_and_real_files(spark, pages, paths):
    job.land(spark, paths, pages, AT)
    job.land_market(spark, paths, spark.createDataFrame(
        [(D, json.dumps({"protocols": [{"name": "Orca", "total24h": "n/a"}, {"name": "Phoenix", "total24h": "n/a"}, {"name": "raydium", "total24h": 7}]}))],
        "snapshot_date date, body string"), AT)
    run = lambda **k: job.run(spark, paths, run_date=D, sources=["raydium", "orca"], skip_transform=True, cfg=CFG,
                              market_docs=job.market_documents(spark, paths), **k)
    r = run()
    assert r.rows_loaded == {"raydium": 3, "orca": 1, "market_share": 2}
    assert r.rejects["raydium"]["missing_id"] == 2 and r.rejects["market_share"] == {"rows": 3, "kept": 2, "untracked": 1, "unparsable_values": 1}
    rejects = spark.read.parquet(paths.raw_table("raw_dex_pools_rejects"))
    assert rejects.groupBy("source").count().orderBy("source").collect() == [("orca", 3), ("raydium", 5)]
    raw = spark.read.parquet(paths.raw_table("raw_dex_pools"))
    for f in [x[0] for x in raw.select("source_file").distinct().collect()]:
        assert spark.read.text(f).count() > 0  # leads to the page's file
    market = spark.read.parquet(paths.raw_table("raw_dex_market_share"))
    assert {x[0] for x in market.select("snapshot_at").distinct().collect()} == {AT.replace(tzinfo=None)}
    assert raw.filter(F.col("snapshot_at") != F.lit(AT)).count() == 0
    # again: skipped; overwriting: the market's deletions are counted, the slice's rejects replaced
    again = run()
    assert again.slices_skipped == {"raydium": 1, "orca": 1, "market_share": 1} and sum(again.rows_loaded.values()) == 0
    over = run(overwrite=True)
    assert over.rows_deleted == {"raydium": 3, "orca": 1, "market_share": 2} and over.rows_loaded == r.rows_loaded
    assert spark.read.parquet(paths.raw_table("raw_dex_pools_rejects")).count() == 8


def doc(*names, **kw):
    return json.dumps({"protocols": [{"name": n, "total24h": i} for i, n in enumerate(names)]}, **kw)


@pytest.mark.parametrize("text, n", [
    (doc("orca"), 1),
    (doc("orca") + "\n" + doc("raydium"), 2),
    (doc("orca") + doc("raydium") + "\r\n\r\n " + doc("meteora") + "\n", 3),
    (doc("orca", indent=2) + "\n" + doc("raydium a", "raydium b", indent="\t"), 2),
    (doc('} {"protocols": [', "}{", '\\"} {', "orca\\") + " " + doc("raydium"), 2),
    ('{"protocols": []}\n' * 3, 3),
    (" \n", 1),
    ("", 1),
])
def test_documents_that_follow_each_other(spark, text, n):
    docs = spark.createDataFrame([(text,)], "t string").select(F.explode(lake.json_documents(F.col("t"))).alias("d")).collect()
    assert len(docs) == n
    if text.strip():
        decoder, at, want = json.JSONDecoder(), 0, []
        while at < len(text.rstrip()):
            value, at = decoder.raw_decode(text, at + len(text[at:]) - len(text[at:].lstrip()))
            want.append(value)
        assert [json.loads(d.d) for d in docs] == want


@pytest.mark.parametrize("text", [
    doc("orca") + "\n" + doc("raydium")[:-1], doc("orca") + "\n" + doc("raydium")[:-2], doc("orca") + "\n" + doc("raydium")[:9],
    doc("orca") + " tail", "head " + doc("orca"), doc("orca") + ',"x', '{"protocols": [{"name": "a} {', "[" + doc("orca") + "]",
])
def test_cut_or_foreign_text_fails(spark, text):
    at = dt.datetime(2026, 6, 3)
    docs = spark.createDataFrame([(at, D, "f", text)], "snapshot_at timestamp, snapshot_date date, source_file string, t string")
    with pytest.raises(Exception):
        ingest.parse_market_documents(docs.withColumn("body", F.explode(lake.json_documents(F.col("t"))))).collect()


def test_large_market_files_are_split_in_linear_time(spark):
    big = "\n".join(doc(*[f"p{i}" for i in range(4000)]) for _ in range(60))  # about 8 MB
    quotes = '{"a": "' + "} {" * 400_000 + '"}'
    df = spark.createDataFrame([(big,), (quotes,), ("{" * 500_000 + "}" * 499_999 + "}",)], "t string")
    assert [r.n for r in df.select(F.size(lake.json_documents(F.col("t"))).alias("n")).collect()] == [60, 1, 1]


def test_two_documents_in_a_landed_file(spark, paths):
    both = doc("orca", indent=1) + "\n" + doc("raydium")
    rows = job.land_market(spark, paths, spark.createDataFrame([(D, both)], "snapshot_date date, body string"), AT).collect()
    assert [(r.source, r.pages, r.raw_record_count) for r in rows] == [("defillama", 2, 2)]
    got = ingest.parse_market_documents(job.market_documents(spark, paths), CFG).collect()
    assert sorted(r.dex_name for r in got) == ["orca", "raydium"]


def days(spark, n):
    rows = [(s, D + dt.timedelta(days=k), 0, json.dumps({"data": {"data": [], "hasNextPage": False}})) for s in ("raydium", "orca") for k in range(n)]
    return spark.createDataFrame(rows, "source string, snapshot_date date, page_no long, body string")


def test_retention_drops_once_and_landing_brings_back(spark, paths):
    pages = days(spark, 5)
    for k in range(5):
        day = D + dt.timedelta(days=k)
        job.land(spark, paths, pages.filter(F.col("snapshot_date") == day), AT + dt.timedelta(days=k))
    job.land_market(spark, paths, spark.createDataFrame([(D, doc("orca"))], "snapshot_date date, body string"), AT)
    as_of = AT + dt.timedelta(days=CFG.retention_days + 1)  # the first two days are old enough
    current = lambda: {(r.source, r.snapshot_date) for r in lake.manifest_current(lake.read_manifest(spark, paths.manifest)).collect()}
    before = current()
    dry = job.apply_retention(spark, paths, as_of, CFG, dry_run=True)
    assert dry.count() == 5 and current() == before and lake.landed_slices(spark, paths.lake).count() == 11
    gone = {(r.source, r.snapshot_date) for r in job.apply_retention(spark, paths, as_of, CFG).collect()}
    old = {D, D + dt.timedelta(days=1)}
    assert gone == {(s, d) for s in ("raydium", "orca") for d in old} | {("defillama", D)}
    assert current() == before - gone == {(r.source, r.snapshot_date) for r in lake.landed_slices(spark, paths.lake).collect()}
    assert job.apply_retention(spark, paths, as_of, CFG).count() == 0  # a rerun drops nothing
    requested = pages.select("source", "snapshot_date")
    missing = lake.missing_slices(requested, lake.manifest_current(lake.read_manifest(spark, paths.manifest)))
    assert {(r.source, r.snapshot_date) for r in missing.collect()} == {g for g in gone if g[0] != "defillama"}
    # landed again: current again, and not old before its own time has come
    job.land(spark, paths, pages.filter((F.col("snapshot_date") == D) & (F.col("source") == "orca")), as_of)
    assert ("orca", D) in current() and job.apply_retention(spark, paths, as_of, CFG).count() == 0
    live = current()
    assert job.compact_manifest(spark, paths) == len(live) and current() == live
    assert lake.read_manifest(spark, paths.manifest).count() == len(live)


def test_retention_repeats_what_was_cut_off(spark, paths):
    """The folder is gone and the tombstone isn't there yet."""
    job.land(spark, paths, days(spark, 1), AT)
    assert lake.delete_path(spark, f"{paths.lake}/dex_pools/dex=orca/date={D.isoformat()}")
    assert job.apply_retention(spark, paths, AT + dt.timedelta(days=400), CFG).count() == 2
    assert lake.landed_slices(spark, paths.lake).count() == 0


def test_keys_checked_together(spark):
    rows = [(1, "a", "x"), (2, "a", None), (3, None, "x"), (4, None, "x"), (5, "b", "x"), (6, "b", "y"), (6, "c", "y")]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    keys = [["k"], ["a"], ["a", "b"], ["b", "a"], ["k", "a", "b"]]
    got = [tuple(r) for r in ck.unique_suite(df, "m", keys).collect()]
    want = [tuple(ck.unique_combination(df, "m", k).first()) for k in keys]
    assert got == want and [g[3] for g in got] == [1, 2, 1, 1, 0]
    plan = ck.repeated_key_hashes(df, keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
    assert [r.failures for r in ck.unique_suite(df.filter("false"), "m", keys).collect()] == [0] * 5


def test_equal_hashes_of_different_keys_are_no_repeat(spark, monkeypatch):
    """Hits are compared by value: with hashes that all collide, nothing changes."""
    monkeypatch.setattr(ck, "_key_hashes", lambda cols: (F.lit(1), F.lit(2)))
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    assert [r.failures for r in ck.unique_suite(df, "m", [["k"]]).collect()] == [1]
