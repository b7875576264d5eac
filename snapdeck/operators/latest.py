"""Latest-value-per-key as an aggregate, not a window.

``min(struct(order keys..., values...))`` is partially aggregated on the map
side, so a hot key (a token quoted in a third of all pools) reduces to one
row per task before the shuffle. A ``row_number() = 1`` window would instead
sort the whole hot key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def newest_first(date_col: Column | str) -> Column:
    """Sort key under which the latest date is smallest."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return -F.unix_date(c)


def nulls_last(c: Column | str) -> list[Column]:
    """Sort keys for ascending order with NULLs after every value."""
    c = F.col(c) if isinstance(c, str) else c
    return [c.isNull(), c]


def first_by(order_keys: Sequence[Column], values: Sequence[str]) -> Column:
    """Aggregate: the ``values`` of the row that sorts first under ``order_keys``.

    Returns a struct with one field per value; ties on every order key fall
    back to the values themselves (ascending, NULLs first), so the pick is
    deterministic.
    """
    fields = [k.alias(f"__o{i}") for i, k in enumerate(order_keys)]
    fields += [F.col(v).alias(v) for v in values]
    return F.min(F.struct(*fields))
