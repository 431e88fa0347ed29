"""Registry of the queries checked by the driver: Spark callable + DuckDB oracle text.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
driver tables (or data Spark derives from them).  For the comparison of the two engines
double columns are rounded to 6 decimals on both sides (summation order differs);
``full_precision()`` gives the same queries unrounded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Entry:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...] = ()
    exact: Callable[[SparkSession, str], DataFrame] | None = None


REGISTRY: dict[str, Entry] = {}


def _stable_round(c):
    """floor(x*1e6 + 0.5)/1e6 after the same step at 1e-9: plain IEEE arithmetic, so Spark
    and DuckDB produce identical bits (their ROUND functions break ties differently).  The
    floor is ``v - v mod 1`` in doubles, so it holds at any size; infinities and NaN pass."""
    def step(x, scale):
        v = x * scale + 0.5
        return F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise((v - F.pmod(v, F.lit(1.0))) / scale)

    return step(step(c, 1e9), 1e6)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(_stable_round(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _wrap_sql(sql: str, doubles: tuple[str, ...]) -> str:
    if not doubles:
        return sql
    # The inner text may start with WITH; DuckDB accepts it as a subquery.
    repl = ", ".join(f"{_sql_round(c)} AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS _q"


def _sql_round(c: str) -> str:
    def step(x, scale):
        return f"(CASE WHEN isfinite({x}) THEN floor({x} * {scale} + 0.5) / {scale} ELSE {x} END)"

    return step(step(c, "1e9"), "1e6")


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] | list[str] = ()):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Dates are UTC calendar days; pin the zone for sessions we did not build.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return round_doubles(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(run, sql if sql is None else _wrap_sql(sql, tuple(doubles)), tuple(doubles), fn)
        return fn

    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: v.fn for k, v in REGISTRY.items()}


def full_precision() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries as a user gets them: doubles as computed."""
    _load()
    return {k: v.exact for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}


def _load() -> None:
    # Importing the query modules fills REGISTRY.
    from riskloom.plans import queries_contracts, queries_drift, queries_explore, queries_features, queries_metrics, queries_ml, queries_quality, queries_risk, queries_splits, queries_streaming  # noqa: F401
