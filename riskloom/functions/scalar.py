"""Scalar functions of the reference, as Spark column expressions.

All of them are compositions of built-in ``pyspark.sql.functions`` so they compile into
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "safe_divide",
    "days_since",
    "capped_min",
    "risk_band",
    "clip_ln",
    "last_segment",
    "is_stale",
    "ci_contains",
    "hash_order_key",
    "arrays_close",
    "threshold_label",
    "as_date",
    "format_indicator_value",
    "safe_corr",
    "composite_key",
    "ntz_literal",
]


def as_date(value) -> Column:
    """Literal DATE from a ``datetime.date`` or ISO string (run parameters are literals)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def safe_divide(num: Column, den: Column) -> Column:
    """SAFE_DIVIDE: NULL when the denominator is 0 or NULL (ANSI ``/`` would raise)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def days_since(as_of, ts: Column) -> Column:
    """DATE_DIFF(as_of, DATE(ts), DAY); future events give negative days (kept, as in SQL)."""
    return F.datediff(as_date(as_of), F.to_date(ts))


def capped_min(values_min: Column, cap: int) -> Column:
    """LEAST(MIN(x), cap) that keeps NULL for an empty group.

    Spark's ``least`` skips NULLs (``least(NULL, 30) = 30``); the reference only ever applies
    LEAST to a group that has rows, so "no row" must stay NULL.
    """
    return F.when(values_min.isNotNull(), F.least(values_min, F.lit(cap)))


def risk_band(p: Column, high: float = 0.7, medium: float = 0.4) -> Column:
    """Lower-inclusive bands [-inf, medium) Low, [medium, high) Medium, [high, inf) High."""
    return F.when(p >= high, "High").when(p >= medium, "Medium").when(p.isNotNull(), "Low")


def clip_ln(x: Column, floor: float = 1e-4) -> Column:
    """ln(max(x, floor)) — the PSI bucket floor."""
    return F.ln(F.greatest(x, F.lit(floor)))


def last_segment(path: Column) -> Column:
    """Last '/'-separated segment of a resource name."""
    return F.element_at(F.split(path, "/"), -1)


def is_stale(as_of, d: Column, max_age_days: int = 1) -> Column:
    return F.datediff(as_date(as_of), d) > max_age_days


def ci_contains(c: Column, pattern: str) -> Column:
    """Case-insensitive regex containment; NULL input counts as no match."""
    return F.coalesce(c.rlike("(?i)" + pattern), F.lit(False))


def hash_order_key(key: Column, seed: str | None = None) -> Column:
    """Deterministic pseudo-random order key: hex md5 of the (seeded) key as text.

    md5 is used rather than a 64-bit hash so the same order is reproducible in any SQL
    engine (the oracle checks it against DuckDB); lower-case hex sorts like its value.
    """
    text = key.cast("string") if seed is None else F.concat(F.lit(str(seed)), key.cast("string"))
    return F.md5(text)


def arrays_close(a: Column, b: Column, rtol: float = 1e-3, atol: float = 1e-4) -> Column:
    """Element-wise |a-b| <= atol + rtol*|b| with equal infinities treated as equal."""
    return (F.size(a) == F.size(b)) & F.forall(
        F.arrays_zip(a.alias("x"), b.alias("y")),
        lambda z: (z["x"] == z["y"]) | (F.abs(z["x"] - z["y"]) <= F.lit(atol) + F.lit(rtol) * F.abs(z["y"])),
    )


def threshold_label(p: Column, threshold: float | Column) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return p >= t


def format_indicator_value(v: Column, fmt: str) -> Column:
    """Render a driver value: percent (no decimals), int (thousands), float (1 decimal)."""
    if fmt == "percent":
        return F.when(v.isNull(), "—").otherwise(F.concat(F.format_number(F.bround(v * 100, 0), 0), F.lit("%")))
    if fmt == "int":
        return F.when(v.isNull(), "—").otherwise(F.format_number(F.bround(v, 0), 0))
    return F.when(v.isNull(), "—").otherwise(F.format_number(v, 1))


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson r as an aggregate that is NULL (not an ANSI divide-by-zero error) when either
    side is constant or has fewer than two pairs.  Pairs with a NULL on either side are
    skipped, as ``corr`` does."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def composite_key(*cols: Column | str, sep: str = "|") -> Column:
    """FN8: text key of several columns, e.g. customer_id|snapshot_date."""
    return F.concat_ws(sep, *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


def ntz_literal(value) -> Column:
    """TIMESTAMP_NTZ literal from text or a naive ``datetime`` (formatted as text first, so
    the session time zone never shifts it)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")
