"""A query of each family against its SQL in DuckDB, and the shape of the registry."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SAMPLE = ["p3_p6_clean", "c6_c8_closure_proximity", "j4_gap_fill_join", "a1_a5_series_stats", "a19_abc", "w22_seasonal_lift", "w13_capped_recency", "f4_f6_croston", "f19_tune_scale", "m2_metrics_by_dormancy", "m9_accuracy_levels", "q5_gate_panel", "e8_time_profiles"]


def rows(df: pd.DataFrame) -> list:
    plain = lambda v: None if pd.isna(v) else round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)[:10] if hasattr(v, "year") else v
    return sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = entry.queries()[name](spark, SF).toPandas(), con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
