"""no rule is lost for the length of the URLs that it stands in."""

import random
from itertools import combinations

import pytest

from demandpanel.llm import url_filter

Z = url_filter.Z95


def rules_of(baskets, least=5):
    """All rules, by counting every combination of up to four tokens plainly."""
    n, base = len(baskets), sum(b for _, b in baskets) / len(baskets)
    held = {}
    for size in range(1, 5):
        for rule in combinations(sorted({t for items, _ in baskets for t in items}), size):
            inside = [b for items, b in baskets if set(rule) <= set(items)]
            if sum(inside) >= max(least, 0.002 * n):
                p, m = sum(inside) / len(inside), len(inside)
                lower = (p + Z * Z / (2 * m) - Z * (p * (1 - p) / m + Z * Z / (4 * m * m)) ** 0.5) / (1 + Z * Z / m)
                if p >= 0.6 and p / base >= 1.2 and lower >= 0.5:
                    held[rule] = p
    return {r: p for r, p in held.items() if not any(set(q) < set(r) and held[q] >= p for q in held)}


def mined(spark, baskets, **how):
    df = spark.createDataFrame([(sorted(items), b) for items, b in baskets], "items array<string>, block boolean")
    return {tuple(r["rule"]): r["confidence"] for r in url_filter.mine(df, **how).collect()}


def test_short_lists_lose_no_rule(spark):
    rng = random.Random(6)
    baskets = [({t for t in "abcdef" if rng.random() < 0.45} | {"z"}, rng.random()) for _ in range(160)]
    baskets = [(items, r < (0.95 if {"a", "c"} <= items else 0.8 if {"b", "d", "e"} <= items else 0.15)) for items, r in baskets]
    want = rules_of(baskets)
    assert any(len(r) > 1 for r in want)
    for most in (2, 12):  # grown, and by FP-growth
        assert mined(spark, baskets, most_tokens=most) == pytest.approx(want)


def test_a_rule_of_tokens_that_tell_nothing_alone(spark):
    """Of sixteen tokens fourteen tell more by themselves than the two of the rule; URLs have more tokens than FP-growth takes."""
    rng = random.Random(2)
    baskets = []
    for i in range(160):
        u, v = rng.random() < 0.5, rng.random() < 0.5
        block = u == v
        items = {"u" if u else "nu", "v" if v else "nv"}
        items |= {f"t{k:02d}" for k in range(14) if (i + 3 * k) % 17 != 0 and rng.random() < (0.5 if block else 0.42)}
        baskets.append((items, block))
    got = mined(spark, baskets, most_tokens=6)
    assert got.get(("u", "v")) == got.get(("nu", "nv")) == 1.0
    for rule, p in got.items():
        inside = [b for items, b in baskets if set(rule) <= items]
        assert p == pytest.approx(sum(inside) / len(inside))
