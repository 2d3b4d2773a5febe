"""Later-bar fill flag and first fill date against a brute-force scan."""

from __future__ import annotations

import datetime as dt
import random

from candlegap.operators import detect_gaps, gap_fill_future, gap_first_fill
from tests.helpers import silver_bars


def _random_bars(seed, pairs=6, days=120):
    rnd = random.Random(seed)
    data = {}
    for p in range(pairs):
        price, rows = 1.0 + p, []
        start = dt.date(2024, 1, 1)
        n, day = rnd.randint(0, days), 0
        for _ in range(n):
            day += rnd.choice((1, 1, 2))
            o = price
            c = max(0.01, o + rnd.uniform(-0.05, 0.05))
            h = max(o, c) + rnd.uniform(0, 0.02)
            lo = max(0.00001, min(o, c) - rnd.uniform(0, 0.02))
            rows.append(((start + dt.timedelta(days=day)).isoformat(),
                         f"{o:.5f}", f"{h:.5f}", f"{lo:.5f}", f"{c:.5f}"))
            price = c
        data[(f"P{p}", "USD")] = rows
    return data


def _brute(rows, gap):
    """First later bar (by date) that trades through the gap zone."""
    later = [r for r in rows if r[0] > str(gap["date"])]
    for i, r in enumerate(sorted(later)):
        lo, hi = float(r[3]), float(r[2])
        if gap["fvg_type"] == "bullish" and lo <= float(gap["fvg_low"]) + 1e-12:
            return r[0], i + 1
        if gap["fvg_type"] == "bearish" and hi >= float(gap["fvg_high"]) - 1e-12:
            return r[0], i + 1
    return None, None


def test_first_fill_matches_brute_force(spark):
    for seed in (1, 2, 3):
        data = _random_bars(seed)
        frames = [silver_bars(spark, rows, pair=pair) for pair, rows in data.items()]
        bars = frames[0]
        for f in frames[1:]:
            bars = bars.unionByName(f)
        bars = bars.repartition(3)
        got = gap_first_fill(bars).collect()
        assert len(got) == detect_gaps(bars).count()
        fut = {(r["from_symbol"], str(r["date"])): r["is_filled"]
               for r in gap_fill_future(bars).collect()}
        for g in got:
            rows = data[(g["from_symbol"], g["to_symbol"])]
            want_date, want_bars = _brute(rows, g)
            have = None if g["first_fill_date"] is None else str(g["first_fill_date"])
            assert have == want_date, (seed, g)
            assert g["bars_to_fill"] == want_bars
            assert g["is_filled"] == (want_date is not None)
            assert fut[(g["from_symbol"], str(g["date"]))] == g["is_filled"]
            if want_date:
                assert g["days_to_fill"] == (dt.date.fromisoformat(want_date) - g["date"]).days


def test_first_fill_across_arrow_batches(spark):
    # tiny Arrow batches: instruments are cut across batch boundaries
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        data = _random_bars(11, pairs=4, days=60)
        frames = [silver_bars(spark, rows, pair=pair) for pair, rows in data.items()]
        bars = frames[0]
        for f in frames[1:]:
            bars = bars.unionByName(f)
        got = gap_first_fill(bars).collect()
        for g in got:
            want_date, want_bars = _brute(data[(g["from_symbol"], g["to_symbol"])], g)
            have = None if g["first_fill_date"] is None else str(g["first_fill_date"])
            assert (have, g["bars_to_fill"]) == (want_date, want_bars)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_first_fill_ignores_null_prices(spark):
    rows = [("2024-01-01", 1.0, 1.1, 0.9, 1.0), ("2024-01-02", 1.1, 1.5, 1.0, 1.4), ("2024-01-03", 1.5, 1.8, 1.3, 1.6),
            ("2024-01-04", 1.6, 1.9, None, 1.7), ("2024-01-05", 1.7, 1.9, 1.5, 1.8)]
    bars = spark.createDataFrame(rows, "date string, open double, high double, low double, close double").selectExpr(
        "cast(date AS date) date", "'EUR' from_symbol", "'USD' to_symbol",
        *[f"cast({c} AS decimal(10,5)) {c}" for c in ("open", "high", "low", "close")])
    first = {r["date"]: r["is_filled"] for r in gap_first_fill(bars).collect()}
    future = {r["date"]: r["is_filled"] for r in gap_fill_future(bars).collect()}
    assert first == future and 0 in first.values()
