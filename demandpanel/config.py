"""Settings of a panel: dates, thresholds and folds. Each has the value of the retail case; callers override them."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

KEYS = ("store_id", "sku_id")


def good_friday(year: int) -> date:
    """Two days before Easter Sunday of the Gregorian calendar."""
    century, golden = year // 100, year % 19
    moon = (19 * golden + century - century // 4 - (century - (century + 8) // 25 + 1) // 3 + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * (year % 100 // 4) - moon - year % 4) % 7
    shift = moon + weekday - 7 * ((golden + 11 * moon + 22 * weekday) // 451) + 114
    return date(year, shift // 31, shift % 31 + 1) - timedelta(2)


def closures(first_year: int, last_year: int) -> list[tuple[date, str]]:
    """Days on which all stores are closed."""
    days = [(d, name) for y in range(first_year, last_year + 1) for d, name in ((date(y, 1, 1), "New Year"), (good_friday(y), "Good Friday"), (date(y, 12, 25), "Christmas"))]
    return sorted(days)


@dataclass(frozen=True)
class Fold:
    fold_id: str
    train_end: date
    embargo_days: int = 7
    val_days: int = 168

    @property
    def val_start(self) -> date:
        return self.train_end + timedelta(self.embargo_days)

    @property
    def val_end(self) -> date:
        return self.val_start + timedelta(self.val_days - 1)


@dataclass(frozen=True)
class Config:
    data_start: date = date(2019, 1, 2)
    data_end: date = date(2025, 12, 17)
    disruption: tuple[date, date] = (date(2020, 3, 15), date(2021, 6, 30))
    panic_quantile: float = 0.999
    extreme: int = 10_000
    mature_days: int = 728
    growing_days: int = 182
    dormant_days: int = 182
    intermittent_adi: float = 1.32
    closure_cap: int = 60
    closure_years: tuple[int, int] = (2019, 2026)
    horizon: int = 168
    folds: tuple[Fold, ...] = field(default=(Fold("F1", date(2025, 6, 26)), Fold("F2", date(2025, 1, 2)), Fold("F3", date(2024, 7, 11))))
