"""Run-time parameters of the snapshot pipeline.

Everything that the models treat as a constant (floors, tracked venues,
freshness thresholds, staging cut-off) lives here so a deployment can change
it without touching a model, and tests can pin ``as_of`` instead of reading
the wall clock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
VOLUME_FLOOR = 1000.0  # USD, trailing 24h volume a pool needs to be kept
TVL_FLOOR = 1000.0  # USD, liquidity a pool needs to be kept
TRACKED_VENUES = ("raydium", "orca", "meteora")  # canonical venues, in label order
POOL_VENUES = ("raydium", "orca", "meteora")  # accepted values of dex_name on pool tables
STAGING_START = dt.date(2026, 6, 1)  # first snapshot date the staging layer keeps
CALENDAR_START = dt.date(2026, 6, 1)  # first day of the date dimension
CALENDAR_DAYS_AHEAD = 365  # the date dimension runs this many days past as_of
FRESH_WARN_HOURS = 26  # source freshness: warn after this age
FRESH_ERROR_HOURS = 48  # source freshness: error after this age
BAND_YELLOW_HOURS = 26  # status panel: green below, yellow from here
BAND_RED_HOURS = 48  # status panel: red from here
MIN_LATEST_ROWS = 50  # rows the latest pool snapshot must hold
MIN_LATEST_VENUES = 3  # venues the latest snapshot must cover
RETENTION_DAYS = 90  # raw lake retention
UNKNOWN_BASE = "UNKNOWN"  # base symbol of a pair name that starts with '-'
# ---------------------------------------------------------------------------

# Our own choice (the key macro's byte form is external): stands in for NULL
# inside a surrogate key so that NULL inputs still hash to a stable key.
KEY_NULL_SENTINEL = "__snapdeck_null__"
KEY_SEPARATOR = "-"


@dataclass(frozen=True)
class Config:
    """Parameters of one pipeline deployment."""

    volume_floor: float = VOLUME_FLOOR
    tvl_floor: float = TVL_FLOOR
    tracked_venues: tuple[str, ...] = TRACKED_VENUES
    pool_venues: tuple[str, ...] = POOL_VENUES
    staging_start: dt.date = STAGING_START
    calendar_start: dt.date = CALENDAR_START
    calendar_days_ahead: int = CALENDAR_DAYS_AHEAD
    fresh_warn_hours: int = FRESH_WARN_HOURS
    fresh_error_hours: int = FRESH_ERROR_HOURS
    min_latest_rows: int = MIN_LATEST_ROWS
    min_latest_venues: int = MIN_LATEST_VENUES
    retention_days: int = RETENTION_DAYS
    # Largest number of rows a join side may have to be broadcast. Sides are
    # counted after materialization (see operators.joins.bounded_broadcast).
    broadcast_max_bytes: int = 64 << 20
    # Table namespaces, which a build binds its tables to (see plans.catalog).
    bind_tables: bool = True
    raw_namespace: str = "snap_raw"
    staging_namespace: str = "snap_staging"
    marts_namespace: str = "snap_marts"


DEFAULT = Config()
