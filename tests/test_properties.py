"""Property tests: detection and fill against a plain-Python model."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candlegap.operators import detect_gaps, gap_fill_close, gap_fill_future
from tests.helpers import silver_bars

UNIT = Decimal("0.00001")

bar = st.tuples(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60)).map(
    lambda t: (t[0] + t[1], t[0] - min(t[2], t[0] - 1)))   # (high, low) in price units
series = st.lists(bar, min_size=0, max_size=25)


def model(highs_lows):
    """Gaps of one instrument as {index: (type, top, bottom, close-filled, future-filled)}."""
    out = {}
    for i in range(1, len(highs_lows) - 1):
        (ph, pl), (nh, nl) = highs_lows[i - 1], highs_lows[i + 1]
        h, lo = highs_lows[i]
        close = lo  # bars close at their low in this model
        later = highs_lows[i + 1:]
        if ph < nl:
            out[i] = ("bullish", nl, ph, int(close <= nl), int(min(x[1] for x in later) <= ph))
        elif pl > nh:
            out[i] = ("bearish", pl, nh, int(close >= nh), int(max(x[0] for x in later) >= pl))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(series, min_size=1, max_size=3))
def test_detection_matches_model(spark, pairs):
    frames, want = [], {}
    start = dt.date(2024, 1, 1)
    for p, hl in enumerate(pairs):
        rows = [((start + dt.timedelta(days=2 * i)).isoformat(), str(lo * UNIT), str(h * UNIT),
                 str(lo * UNIT), str(lo * UNIT)) for i, (h, lo) in enumerate(hl)]
        if rows:
            frames.append(silver_bars(spark, rows, pair=(f"P{p}", "USD")))
        for i, g in model(hl).items():
            want[(f"P{p}", (start + dt.timedelta(days=2 * i)))] = g
    if not frames:
        return
    bars = frames[0]
    for f in frames[1:]:
        bars = bars.unionByName(f)
    got = {(r["from_symbol"], r["date"]): (r["fvg_type"], int(r["fvg_high"] / UNIT),
                                          int(r["fvg_low"] / UNIT), r["is_filled"])
           for r in gap_fill_close(detect_gaps(bars)).collect()}
    assert got == {k: v[:4] for k, v in want.items()}
    fut = {(r["from_symbol"], r["date"]): r["is_filled"] for r in gap_fill_future(bars).collect()}
    assert fut == {k: v[4] for k, v in want.items()}


from candlegap.operators import dedup_latest, upsert_bars  # noqa: E402
from candlegap.schemas import BRONZE_SCHEMA  # noqa: E402

T0 = dt.datetime(2024, 1, 1)
row_st = st.tuples(st.integers(1, 4), st.integers(0, 2), st.integers(0, 3), st.integers(1, 5))


def _bronze(spark, rows, src):
    return spark.createDataFrame(
        [(f"2024-01-0{d}", str(p), str(p), str(p), str(p), f"P{k}", "USD",
          T0 + dt.timedelta(hours=h), src) for d, k, h, p in rows], BRONZE_SCHEMA)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_st, max_size=20), st.lists(row_st, max_size=20))
def test_dedup_and_upsert_laws(spark, old_rows, new_rows):
    old, new = _bronze(spark, old_rows, "old"), _bronze(spark, new_rows, "new")
    # dedup does not depend on how the rows are partitioned
    assert sorted(dedup_latest(old.repartition(1)).collect()) == \
        sorted(dedup_latest(old.repartition(4)).collect())
    once = upsert_bars(old, new)
    assert sorted(upsert_bars(once, new).collect()) == sorted(once.collect())   # idempotent
    got = {(r["date"], r["from_symbol"]): r["_source"] for r in once.collect()}
    new_keys = {(f"2024-01-0{d}", f"P{k}") for d, k, _, _ in new_rows}
    old_keys = {(f"2024-01-0{d}", f"P{k}") for d, k, _, _ in old_rows}
    assert set(got) == new_keys | old_keys                                    # nothing lost
    assert all(got[k] == "new" for k in new_keys)                             # incoming wins
