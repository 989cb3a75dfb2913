"""Daily grain from a stream of sales rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.config import KEYS


def daily_grain_stream(sales: DataFrame, event_time: str = "ts", qty: str = "sales", delay: str = "2 days", keys=KEYS) -> DataFrame:
    """Sums of each series and day, emitted once no row of the day can arrive any more; later rows are dropped.

    State is bounded by the series that sell within the delay.
    """
    day = F.window(event_time, "1 day")
    out = sales.withWatermark(event_time, delay).groupBy(*(F.col(k).cast("string").alias(k) for k in keys), day).agg(F.sum(qty).cast("long").alias("saleqty"))
    return out.select(*keys, F.to_date("window.start").alias("date"), "saleqty")
