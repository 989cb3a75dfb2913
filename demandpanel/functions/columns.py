"""Column expressions that several operators use."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a, b) -> Column:
    """a / b as double, null where b is 0 or either is null."""
    return F.try_divide(F.col(a).cast("double") if isinstance(a, str) else a.cast("double"), F.col(b) if isinstance(b, str) else b)


def week_of_year(d: Column) -> Column:
    """Weeks from Sunday, 0 to 53."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def cyclical(c: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a cyclical number."""
    angle = c * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def bool_to_int(c: Column) -> Column:
    """1 for true, 't', 'yes', '1'; 0 for anything else, null included."""
    return F.when(F.lower(F.trim(c.cast("string"))).isin("true", "t", "yes", "y", "1"), 1).otherwise(0)


def clip(c: Column, low: float, high: float) -> Column:
    """c held between low and high; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def flag(condition: Column) -> Column:
    """1 where the condition is true, else 0."""
    return F.when(condition, 1).otherwise(0)


def rank_of(c: Column, ranks: list) -> Column:
    """Place of a value in a list, for ordering; unknown values come last."""
    out = F.lit(len(ranks))
    for i, value in reversed(list(enumerate(ranks))):
        out = F.when(c == value, i).otherwise(out)
    return out


def key_hash(*keys) -> Column:
    """A number of 48 bits from the MD5 of keys, which other engines compute alike."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *keys)), 1, 12), 16, 10).cast("long")
