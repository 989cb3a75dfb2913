"""Feature queries return every day of the panel, as their SQL does."""

import pytest

import __spark_entry__ as entry
from demandpanel.sources import testdata as T

SF = "/root/testdata/sf0.001"
NAMES = ["p11_fill_features", "p16_feature_set", "w14b_dormancy_extra", "w15_w16_transforms", "w26_w29_j8_spike_features", "w33_gap_features", "w37_week_features"]


@pytest.mark.parametrize("name", NAMES)
def test_every_day(spark, name):
    assert f"{name}_all" not in entry.queries() and name in entry.oracle_sql()
    assert entry.queries()[name](spark, SF).count() == T.panel(spark, SF).count()
