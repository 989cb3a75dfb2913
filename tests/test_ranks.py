"""Exact quantiles by selection against DuckDB's."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandpanel.operators.ranks import exact_quantiles

PS = [0.0, 0.25, 0.5, 0.9, 0.995, 0.999, 1.0]
RNG = random.Random(4)
CASES = {
    "ties": [RNG.choice([1, 1, 1, 2, 3, 50]) for _ in range(3000)],
    "one": [7],
    "two": [1, 2],
    "long tail": [int(RNG.paretovariate(0.7)) for _ in range(4000)],
    "third equal": [5] * 1000 + list(range(2000)),
    "negative": [RNG.randint(-500, 500) for _ in range(1500)] + [None] * 9,
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_against_sql(spark, name, ranges):
    df, pdf = spark.createDataFrame([(v,) for v in CASES[name]], "v long").repartition(5), pd.DataFrame({"v": pd.array(CASES[name], dtype="Int64")})  # noqa: F841
    for linear, f in ((True, "quantile_cont"), (False, "quantile_disc")):
        got = exact_quantiles(df, F.col("v"), PS, linear, ranges).first()["q"]
        want = duckdb.sql(f"SELECT {f}(v, {PS}) FROM pdf").fetchall()[0][0]
        assert got == pytest.approx(want, rel=1e-12)


def test_doubles_and_no_rows(spark):
    df = spark.createDataFrame([(RNG.gauss(0, 1),) for _ in range(2000)], "v double")
    assert exact_quantiles(df, F.col("v"), [0.1, 0.7]).first()["q"] == pytest.approx(df.agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.7)))).first()[0])
    assert exact_quantiles(df.limit(0), F.col("v"), [0.5]).first()["q"] is None


def test_no_task_sorts_all_values(spark, capsys):
    """The one sort of values runs on the range of a rank, joined to it; no aggregate keeps all values."""
    exact_quantiles(spark.range(10_000), F.col("id"), [0.5], linear=False).explain("formatted")
    plan = capsys.readouterr().out.lower()
    assert "percentile_disc" not in plan and "percentile(" not in plan
    assert "broadcastnestedloopjoin" in plan
