"""Each gate on a table that it must fail."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from demandpanel.config import Config
from demandpanel.operators import gates as Q
from demandpanel.operators import panel as J
from demandpanel.operators import stats as A
from demandpanel.operators import windows as W

CFG = Config(data_start=date(2024, 1, 1), data_end=date(2024, 1, 5))


def days(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def failed(gate):
    return {r["gate"] for r in gate.collect() if r["status"] == "FAIL"}


FACT = "store_id string, sku_id string, date date, sales_raw long, sales_clean long, was_negative int, is_covid_period int, is_covid_panic_spike int, is_extreme_spike int"
D = [date(2024, 1, d) for d in range(1, 6)]


@pytest.fixture(scope="module")
def facts(spark):
    return days(spark, FACT, ("s", "a", D[0], 5, 5, 0, 0, 0, 0), ("s", "a", D[2], -1, 0, 1, 0, 0, 0), ("s", "b", D[1], 2, 2, 0, 0, 0, 0))


@pytest.fixture(scope="module")
def panel(facts):
    return J.dense_panel(facts, D[4]).withColumn("y", F.col("sales_filled"))


def test_keys(spark, facts):
    assert not failed(Q.gate_nulls(facts)) and not failed(Q.gate_unique(facts))
    assert failed(Q.gate_nulls(facts.withColumn("sku_id", F.when(F.col("sku_id") == "a", F.col("sku_id"))))) == {"null_sku_id"}
    assert failed(Q.gate_unique(facts.unionByName(facts.limit(1)))) == {"duplicate_keys"}


def test_clean(facts):
    assert not failed(Q.gate_clean(facts))
    assert failed(Q.gate_clean(facts.withColumn("sales_clean", F.col("sales_raw")))) == {"negative_clean"}
    assert failed(Q.gate_clean(facts.withColumn("sales_clean", F.col("sales_clean") + 1))) == {"clean_above_raw"}


def test_spine(facts, panel):
    pairs = J.active_pairs(facts)
    assert not failed(Q.gate_spine(panel, pairs, D[4]))
    assert failed(Q.gate_spine(panel.filter(F.col("date") != D[3]), pairs, D[4])) == {"row_count_difference", "pairs_with_gaps"}
    assert failed(Q.gate_spine(panel.filter(F.col("date") != D[4]), pairs, D[4])) == {"row_count_difference"}


def test_panel(facts, panel):
    assert not failed(Q.gate_panel(panel, facts))
    assert failed(Q.gate_panel(panel.withColumn("sales_clean", F.col("sales_clean") + 1), facts)) == {"observed_value_differs"}
    assert failed(Q.gate_panel(panel.withColumn("sales_filled", F.when(F.col("date") != D[0], F.col("sales_filled"))), facts)) == {"filled_null_or_negative"}
    assert failed(Q.gate_panel(panel.withColumn("sales_filled", F.when(F.col("is_observed") == 0, 1).otherwise(F.col("sales_filled"))), facts)) == {"unobserved_contract"}


def test_calendar(spark):
    dim, closed = days(spark, "date date, dow int", *((d, 1) for d in D)), days(spark, "closure_date date", (D[0],), (D[3],))
    rows = dim.withColumn("is_store_closed", F.lit(0))
    assert not failed(Q.gate_calendar(dim, closed, rows))
    assert failed(Q.gate_calendar(dim.filter(F.col("date") != D[2]), closed, rows)) == {"missing_days"}
    assert "duplicate_days" in failed(Q.gate_calendar(dim.unionByName(dim.limit(1)), closed, rows))
    assert failed(Q.gate_calendar(dim, closed.unionByName(closed.limit(1)), rows)) == {"duplicate_closures"}
    assert failed(Q.gate_calendar(dim, closed, rows.withColumn("dow", F.when(F.col("date") != D[0], F.col("dow"))))) == {"rows_without_calendar"}


def test_tiers(spark):
    schema = "tier_name string, t0_reason string, n_pos long, days_since_last_sale int, history_days int"
    good = [("T0_EXCLUDED", "NEVER_SOLD", 0, None, 900), ("T1_MATURE", None, 3, 10, 728), ("T2_GROWING", None, 3, 10, 182), ("T3_COLD_START", None, 3, 10, 181)]
    gate = lambda *rows, n=None: failed(Q.gate_tiers(days(spark, schema, *rows), CFG, n))
    assert not gate(*good, n=4) and gate(*good, n=5) == {"series_count_difference"}
    assert gate(("T0_EXCLUDED", None, 0, None, 900)) == {"t0_without_reason"}
    assert gate(("T1_MATURE", "NEVER_SOLD", 3, 1, 800)) == {"reason_without_t0"}
    assert gate(("T1_MATURE", None, 3, 183, 800)) == {"t0_logic"}
    assert gate(("T1_MATURE", None, 3, 1, 727)) == gate(("T2_GROWING", None, 3, 1, 181)) == gate(("T3_COLD_START", None, 3, 1, 182)) == {"threshold_logic"}


def test_lags(panel):
    df = W.lags(panel)
    assert not failed(Q.gate_lags(df, J.audit_lag1(df)))
    wrong = df.withColumn("lag_1", F.when(F.col("date") == D[4], F.col("lag_1") + 1).otherwise(F.col("lag_1")))
    assert failed(Q.gate_lags(wrong, J.audit_lag1(wrong))) == {"lag_1_violations"}


def test_features(spark):
    schema = "sin_doy double, cos_doy double, sin_dow double, cos_dow double, days_to_next_closure int, days_from_prev_closure int, is_closure_week int, dormancy_bucket string"
    gate = lambda *row: failed(Q.gate_features(days(spark, schema, row)))
    assert not gate(0.6, 0.8, 0.0, 1.0, 0, 60, 1, "D0_7")
    assert gate(0.6, 0.7, 0.0, 1.0, 0, 60, 1, "D0_7") == {"sin_cos_doy"}
    assert gate(0.6, 0.8, 0.5, 1.0, 0, 60, 1, "D0_7") == {"sin_cos_dow"}
    assert gate(0.6, 0.8, 0.0, 1.0, 61, 60, 1, "D0_7") == gate(0.6, 0.8, 0.0, 1.0, 0, -1, 1, "D0_7") == {"closure_range"}


def test_spikes(spark):
    schema = "store_id string, date date, is_spike int, is_promo_day int, seasonal_lift double, spike_prob double"
    gate = lambda lift, prob: failed(Q.gate_spikes(days(spark, schema, ("s", D[0], 1, 1, lift, prob))))
    assert not gate(3.0, 1.0) and gate(3.1, 0.0) == gate(0.4, 0.0) == {"lift_range"} and gate(1.0, 1.1) == {"prob_range"}


def test_folds(spark):
    schema = "fold_id string, train_end date, val_start date, val_end date"
    gate = lambda *row: failed(Q.gate_folds(days(spark, schema, row)))
    assert not gate("F", date(2024, 1, 1), date(2024, 1, 8), date(2024, 6, 23))
    assert gate("F", date(2024, 1, 2), date(2024, 1, 8), date(2024, 6, 23)) == {"short_embargo"}
    assert gate("F", date(2024, 1, 1), date(2024, 1, 8), date(2024, 6, 24)) == {"wrong_horizon"}


def test_closures_and_predictions(spark):
    schema = "store_id string, sku_id string, date date, is_store_closed int, y long, yhat double"
    good = days(spark, schema, ("s", "a", D[0], 1, 0, 0.0), ("s", "a", D[1], 0, 2, 1.5))
    open_ = good.withColumn("yhat", F.lit(1.0))
    assert not failed(Q.gate_closure(good)) and failed(Q.gate_closure(open_)) == {"forecast_when_closed"}
    assert not failed(Q.gate_predictions(good, good)) and failed(Q.gate_predictions(good, open_)) == {"forecast_when_closed"}
    assert failed(Q.gate_predictions(good, good.withColumn("yhat", F.col("yhat") - 1))) == {"negative"}


def test_forecast(spark):
    schema = "store_id string, sku_id string, date date, predicted_sales double"
    rows = [("s", k, d, 1.0) for k in "ab" for d in D]
    gate = lambda rows, n=2, h=5, start=D[0]: failed(Q.gate_forecast(days(spark, schema, *rows), n, h, start))
    assert not gate(rows)
    assert gate(rows[:-1]) == {"row_count_difference"} and gate(rows, start=date(2023, 12, 31)) == {"first_day_difference", "last_day_difference"}
    assert gate([*rows[:-1], ("s", "b", D[4], None)]) == gate([*rows[:-1], ("s", "b", D[4], float("nan"))]) == {"null_or_nan"}
    assert gate([*rows[:-1], ("s", "b", D[4], -0.1)]) == {"negative"}


def test_velocity_is_reported(facts):
    assert {r["status"] for r in Q.gate_velocity(A.velocity(facts, y="sales_clean")).collect()} == {"INFO"}
