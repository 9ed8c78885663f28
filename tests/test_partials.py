import math

from barlake.operators.facts import daily_ohlcv
from barlake.operators.partials import changed, daily_partials, fold

BARS = "symbol string, date string, high double, low double, close double, volume bigint, load string"


def test_partials_put_together_are_the_bars(spark):
    rows = [("A", "2026-01-01", 2.0 + i, 1.0 - i, 1.5 * i, i, f"L{i % 3}") for i in range(9)]
    rows += [("B", "2026-01-01", None, None, None, None, "L0"), ("B", "2026-01-01", 1.0, 1.0, 4.0, 2, "L1"),
             ("C", "odd", 1.0, 1.0, 1.0, 1, "L1"), (None, "2026-01-02", 1.0, 1.0, 1.0, 1, None)]
    bars = spark.createDataFrame(rows, BARS)
    partials = daily_partials(bars)
    assert partials.count() == 6
    assert sorted(map(str, fold(partials).collect())) == sorted(map(str, daily_ohlcv(bars).collect()))
    assert fold(daily_partials(bars.limit(0))).count() == 0


def test_sums_do_not_depend_on_the_order(spark):
    """Closes that lose digits when added as doubles, and closes that no decimal holds."""
    closes = [1e12, 0.125, -1e12, 0.1] * 50
    rows = [("A", "2026-01-01", 1.0, 1.0, c, 1, f"L{i % 7}") for i, c in enumerate(closes)]
    rows += [("N", "2026-01-01", 1.0, 1.0, c, 1, f"L{i}") for i, c in enumerate([1.0, math.nan, 2.0])]
    rows += [("I", "2026-01-01", 1.0, 1.0, c, 1, f"L{i}") for i, c in enumerate([1.0, math.inf, 1e300])]
    for parts in (1, 5):
        got = {r.symbol: r.avg_close for r in fold(daily_partials(spark.createDataFrame(rows, BARS).repartition(parts))).collect()}
        assert got["A"] == (0.125 * 50 + 5) / 200 and math.isnan(got["N"]) and got["I"] == math.inf


def test_changed_loads(spark):
    rows = [("A", "2026-01-01", 2.0, 1.0, 1.5, 1, load) for load in ("same", "gone", "other", None)]
    old = daily_partials(spark.createDataFrame(rows, BARS))
    fresh = [rows[0], (*rows[2][:4], 9.0, 1, "other"), rows[3], (*rows[0][:6], "new")]
    assert {r.load for r in changed(old, daily_partials(spark.createDataFrame(fresh, BARS))).collect()} >= {"gone", "other", "new"}
