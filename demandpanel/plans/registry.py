"""Queries with their SQL, both held to the same column types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

#: Type by letter: Spark, DuckDB.
TYPES = {"i": ("bigint", "BIGINT"), "d": ("double", "DOUBLE"), "s": ("string", "VARCHAR"), "t": ("date", "DATE"), "b": ("boolean", "BOOLEAN")}


def rounded(x: Column) -> Column:
    """To six places as the SQL's engine does it, by arithmetic: Spark's ``round`` goes by way of decimal text, at the cost of all else in a row of
    features. Numbers too large for that, and NaN, take ``round``."""
    size = F.abs(x)
    near = F.signum(x) * F.floor(size * 1e6 + 0.5) / 1e6
    return F.when(size < 1e9, near).otherwise(F.round(x, 6)) + F.lit(0.0)


def query(columns: str, sql: str | None = None, ctes: str = ""):
    """Registers a query under its function's name. ``columns`` names the result's columns with a type letter each; doubles
    are rounded to six places. Without SQL only the rows are checked."""
    kinds = [c.split(":") for c in columns.split()]

    def register(f: Callable) -> Callable:
        def run(spark, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            cast = lambda c, k: F.col(c).cast(TYPES[k][0])
            return df.select(*((rounded(cast(c, k)) if k == "d" else cast(c, k)).alias(c) for c, k in kinds))

        QUERIES[f.__name__] = run
        if sql:
            cast = lambda c, k: f"CAST({c} AS {TYPES[k][1]})"
            picked = ", ".join(f"{f'round({cast(c, k)}, 6) + 0.0' if k == 'd' else cast(c, k)} AS {c}" for c, k in kinds)
            ORACLES[f.__name__] = f"WITH {ctes}\nSELECT {picked} FROM ({sql})" if ctes else f"SELECT {picked} FROM ({sql})"
        return f

    return register
