"""Command line: landing, the daily run, the freshness check, retention.

    python -m snapdeck land --lake L --raw R --models M --inbox I [--overwrite]
    python -m snapdeck run --lake L --raw R --models M [--date YYYY-MM-DD]
        [--sources raydium,orca] [--overwrite] [--skip-transform]
        [--skip-market-share] [--incremental] [--inbox I]
    python -m snapdeck freshness --lake L --raw R --models M
    python -m snapdeck retain --lake L --raw R --models M [--dry-run]

``run`` with ``--inbox`` lands first.

Under spark-submit the session takes the cluster's settings; run directly
it starts a local session. Exit code 1 on a failed source, check or
stale table.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import os
import sys

from pyspark import SparkConf
from pyspark.sql import SparkSession


def session() -> SparkSession:
    b = SparkSession.builder.appName("snapdeck")
    if "spark.master" not in dict(SparkConf().getAll()):
        b = b.master(os.environ.get("SNAPDECK_MASTER", "local[*]")).config(
            "spark.ui.enabled", os.environ.get("SNAPDECK_UI", "false")
        )
    spark = b.getOrCreate()
    from snapdeck.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    from snapdeck.plans import job
    from snapdeck.sources import lake

    ap = argparse.ArgumentParser(prog="snapdeck")
    ap.add_argument("command", choices=["land", "run", "freshness", "retain"])
    ap.add_argument("--lake", required=True)
    ap.add_argument("--raw", required=True)
    ap.add_argument("--models", required=True)
    ap.add_argument("--date", help="snapshot date YYYY-MM-DD (default: yesterday, UTC)")
    ap.add_argument("--sources", help="comma-separated venues (default: all)")
    ap.add_argument("--overwrite", action="store_true")
    ap.add_argument("--skip-transform", action="store_true")
    ap.add_argument("--skip-market-share", action="store_true")
    ap.add_argument("--incremental", action="store_true", help="rebuild only the run day's staging and metrics")
    ap.add_argument("--inbox", help="folder of fetched pages and documents, in the lake's layout")
    ap.add_argument("--dry-run", action="store_true", help="retain: list what would be dropped")
    a = ap.parse_args(argv)
    if a.command == "land" and not a.inbox:
        ap.error("land needs --inbox")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = session()
    paths = job.Paths(lake=a.lake, raw=a.raw, models=a.models)
    try:
        if a.command == "freshness":
            for row in job.run_freshness(spark, paths):
                logging.info("freshness %s", row)
            return 0
        now = dt.datetime.now(dt.timezone.utc)
        if a.command == "retain":
            for r in job.apply_retention(spark, paths, now, dry_run=a.dry_run).toLocalIterator():
                logging.info("%s %s", "expired" if a.dry_run else "dropped", r["folder"])
            return 0
        if a.inbox:
            logging.info("landed %s", job.land_inbox(spark, paths, a.inbox, now, a.overwrite))
        if a.command == "land":
            return 0
        day = dt.date.fromisoformat(a.date) if a.date else None
        docs = None
        if not a.skip_market_share and lake.path_exists(spark, f"{a.lake}/{lake.MARKET_DIR}"):
            docs = job.market_documents(spark, paths)
        result = job.run(
            spark,
            paths,
            run_date=day,
            sources=a.sources.split(",") if a.sources else None,
            overwrite=a.overwrite,
            skip_transform=a.skip_transform,
            skip_market_share=a.skip_market_share,
            market_docs=docs,
            incremental=a.incremental,
        )
        logging.info("rows_loaded %s skipped %s deleted %s rejects %s", result.rows_loaded, result.slices_skipped, result.rows_deleted, result.rejects)
        return 0
    except (job.PipelineFailed, job.CheckFailed) as exc:
        logging.error("run failed: %s", exc)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
