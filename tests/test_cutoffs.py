"""Tiers of all cutoffs in one pass against a pass for each."""

from datetime import date, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.config import Config, Fold
from demandpanel.operators.stats import tier_counts_by_fold, tiers_asof, tiers_by_cutoff

START = date(2020, 1, 1)
CUTOFFS = [START + timedelta(d) for d in (900, 300, 100, -5, 300)]
COLUMNS = ["store_id", "sku_id", "spine_start", "first_sale_date", "last_sale_date", "n_pos", "sum_sales", "history_days", "days_since_last_sale", "tier_name", "t0_reason"]
SCHEMA = "store_id string, sku_id string, date date, sales_clean long"


@pytest.fixture(scope="module")
def facts(spark):
    """Series that begin at odd times, some without a sale, some dormant, some after the last cutoff."""
    rows = [(f"s{s}", f"k{k}", START + timedelta(40 * s * k + 13 * i), (i * (s + k)) % 4 if s else 0) for s in range(5) for k in range(8) for i in range(1 + 9 * k)]
    return spark.createDataFrame(rows, SCHEMA)


def test_equal_to_a_pass_for_each(facts):
    got = tiers_by_cutoff(facts, CUTOFFS)
    want = reduce(DataFrame.unionByName, [tiers_asof(facts, c).select(*COLUMNS).withColumn("cutoff", F.lit(c)) for c in set(CUTOFFS)])
    a, b = (sorted(map(repr, (tuple(r) for r in df.select(*COLUMNS, "cutoff").collect()))) for df in (got, want))
    assert a == b and len(a) > 50


def test_folds_of_one_cutoff_and_no_rows(spark, facts):
    cfg = Config(folds=(Fold("A", CUTOFFS[0]), Fold("B", CUTOFFS[1]), Fold("C", CUTOFFS[1])))
    got = sorted(tuple(r) for r in tier_counts_by_fold(facts, cfg).select("fold_id", "tier_name", "n_series").collect())
    want = sorted((f.fold_id, r["tier_name"], r["count"]) for f in cfg.folds for r in tiers_asof(facts, f.train_end, cfg).groupBy("tier_name").count().collect())
    assert got == want
    assert tiers_by_cutoff(spark.createDataFrame([], SCHEMA), CUTOFFS).count() == 0


def test_one_shuffle_and_one_scan(spark, facts, tmp_path):
    facts.write.parquet(str(tmp_path / "facts"))
    table = spark.read.parquet(str(tmp_path / "facts"))
    for n in (1, 6):
        plan = tiers_by_cutoff(table, [START + timedelta(100 * i) for i in range(n)])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1
