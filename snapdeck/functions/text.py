"""String predicates and splitters used by ingest and staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapdeck.config import UNKNOWN_BASE
from snapdeck.functions._util import col


def contains_any(c: Column | str, needles: Sequence[str]) -> Column:
    """lower(c) contains any needle; NULL input is treated as '' (never matches)."""
    low = F.lower(F.coalesce(col(c), F.lit("")))
    out = F.lit(False)
    for n in needles:
        out = out | low.contains(F.lit(n))
    return out


def canonical_label(c: Column | str, ordered: Sequence[str]) -> Column:
    """First needle contained in lower(c) wins; otherwise lower(c) itself."""
    low = F.lower(col(c))
    expr = None
    for n in ordered:
        expr = (F.when if expr is None else expr.when)(low.contains(F.lit(n)), F.lit(n))
    return low if expr is None else expr.otherwise(low)


def split_pair(c: Column | str) -> tuple[Column, Column]:
    """Split a pair name on the first '-' into (base, quote).

    No '-' (or NULL/empty) gives (NULL, NULL); an empty base becomes UNKNOWN,
    an empty quote NULL; the rest after the first '-' stays joined.
    """
    s = col(c)
    parts = F.split(s, "-", 2)
    has_dash = s.isNotNull() & (F.instr(s, "-") > 0)
    head = F.get(parts, 0)
    tail = F.get(parts, 1)
    base = F.when(has_dash, F.when(head == "", F.lit(UNKNOWN_BASE)).otherwise(head))
    quote = F.when(has_dash, F.nullif(tail, F.lit("")))
    return base, quote


def uri_parts(c: Column | str) -> Column:
    """a storage URI as struct(scheme, root, path): the store, its bucket
    or host, and the object's path below it without a leading slash. A plain
    path has no scheme and no root; NULL gives NULL fields."""
    s = col(c)
    scheme = F.nullif(F.regexp_extract(s, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1), F.lit(""))
    rest = F.when(scheme.isNull(), s).otherwise(F.substr(s, F.length(scheme) + 4))
    root = F.when(scheme.isNotNull(), F.split(rest, "/", 2)[0])
    path = F.when(scheme.isNull(), rest).otherwise(F.coalesce(F.get(F.split(rest, "/", 2), F.lit(1)), F.lit("")))
    return F.struct(
        F.lower(scheme).alias("scheme"), F.nullif(root, F.lit("")).alias("root"), F.regexp_replace(path, "^/+", "").alias("path")
    )


# Storage listing type codes -> labels (anything else is OTHER).
TABLE_TYPE_LABELS = {1: "TABLE", 2: "VIEW"}


def table_type_label(code: Column | str) -> Column:
    """integer table-type code to its label."""
    c = col(code)
    expr = None
    for k, v in TABLE_TYPE_LABELS.items():
        expr = (F.when if expr is None else expr.when)(c == k, F.lit(v))
    return expr.otherwise(F.lit("OTHER"))
