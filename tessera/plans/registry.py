"""Slug registry: each registered query has a Spark builder and, when the
operator is SQL-expressible, an independently written DuckDB twin.

Both sides round double columns to 6 decimals the same way (half away from
zero on ``x * 1e6``) so that summation order cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import BASE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SCALE = 1e6


def round6(c):
    """``round(x * 1e6) / 1e6`` with half away from zero, as DuckDB rounds doubles."""
    v = c * F.lit(SCALE)
    r = F.when(F.abs(v) >= F.lit(4503599627370496.0), v).otherwise(
        F.signum(v) * F.floor(F.abs(v) + F.lit(0.5)).cast("double")
    )
    return r / F.lit(SCALE)


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(F.col(f"`{f.name}`").cast("double")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def wrap_sql(sql: str, doubles: Sequence[str] = ()) -> str:
    body = sql.strip().rstrip(";")
    if not doubles:
        return f"WITH {BASE_SQL.strip()}\nSELECT * FROM (\n{body}\n) q"
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    return f"WITH {BASE_SQL.strip()}\nSELECT * REPLACE ({repl}) FROM (\n{body}\n) q"


def register(name: str, sql: str | None = None, doubles: Sequence[str] = ()):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
            return finish(_fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = wrap_sql(sql, doubles)
        return fn

    return deco
