"""The reference's nine gap checks, in both level modes, plus filled cases."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlegap.operators import detect_gaps, detect_gaps_union, gap_fill_close
from tests.helpers import BEARISH_ROWS, BULLISH_ROWS, NO_GAP_ROWS, silver_bars


@pytest.fixture
def bullish(spark):
    return silver_bars(spark, BULLISH_ROWS)


@pytest.fixture
def bearish(spark):
    return silver_bars(spark, BEARISH_ROWS)


@pytest.fixture
def no_gap(spark):
    return silver_bars(spark, NO_GAP_ROWS)


@pytest.mark.parametrize("levels", ["ordered", "positional"])
def test_detects_bullish(bullish, levels):
    rows = detect_gaps(bullish, levels=levels).filter(F.col("fvg_type") == "bullish").collect()
    assert len(rows) == 1


@pytest.mark.parametrize("levels", ["ordered", "positional"])
def test_bullish_levels_and_size(bullish, levels):
    row = detect_gaps(bullish, levels=levels).first()
    assert row["fvg_low"] == Decimal("1.10000")
    assert row["fvg_high"] == Decimal("1.10500")
    assert row["fvg_size_pips"] == Decimal("50.00")


@pytest.mark.parametrize("levels", ["ordered", "positional"])
def test_detects_bearish(bearish, levels):
    rows = detect_gaps(bearish, levels=levels).filter(F.col("fvg_type") == "bearish").collect()
    assert len(rows) == 1


def test_bearish_levels_ordered(bearish):
    row = detect_gaps(bearish).first()
    assert (row["fvg_high"], row["fvg_low"]) == (Decimal("1.11000"), Decimal("1.10500"))
    assert row["fvg_size_pips"] == Decimal("50.00")


def test_bearish_levels_positional(bearish):
    # what a positional union of differently ordered branches yields
    row = detect_gaps(bearish, levels="positional").first()
    assert (row["fvg_high"], row["fvg_low"]) == (Decimal("1.10500"), Decimal("1.11000"))
    assert row["fvg_size_pips"] == Decimal("-50.00")


@pytest.mark.parametrize("levels", ["ordered", "positional"])
def test_no_gap_when_bars_overlap(no_gap, levels):
    assert detect_gaps(no_gap, levels=levels).count() == 0


def test_gap_dated_by_middle_bar(bullish):
    assert str(detect_gaps(bullish).first()["date"]) == "2024-01-02"


@pytest.mark.parametrize("levels", ["ordered", "positional"])
def test_unfilled_bullish(bullish, levels):
    assert gap_fill_close(detect_gaps(bullish, levels=levels)).first()["is_filled"] == 0


@pytest.mark.parametrize("levels", ["ordered", "positional"])
def test_unfilled_bearish(bearish, levels):
    assert gap_fill_close(detect_gaps(bearish, levels=levels)).first()["is_filled"] == 0


def test_filled_by_own_close(spark):
    # bullish gap 1.10000..1.10500 whose middle bar closes back inside it
    bull = silver_bars(spark, [
        ("2024-01-01", "1.09500", "1.10000", "1.09000", "1.09800"),
        ("2024-01-02", "1.09800", "1.11000", "1.09700", "1.10400"),
        ("2024-01-03", "1.10800", "1.11500", "1.10500", "1.11200"),
    ])
    assert gap_fill_close(detect_gaps(bull)).first()["is_filled"] == 1
    # bearish gap 1.10500..1.11000, middle close 1.10600 is above the bottom
    bear = silver_bars(spark, [
        ("2024-01-01", "1.11500", "1.12000", "1.11000", "1.11200"),
        ("2024-01-02", "1.11200", "1.11300", "1.10200", "1.10600"),
        ("2024-01-03", "1.10400", "1.10500", "1.09800", "1.10000"),
    ])
    assert gap_fill_close(detect_gaps(bear)).first()["is_filled"] == 1
    # positional levels compare against the zone top (1.11000): not filled
    assert gap_fill_close(detect_gaps(bear, levels="positional")).first()["is_filled"] == 0


def test_pairs_do_not_mix(spark):
    # the same three bars under two pairs, interleaved dates: one gap each
    a = silver_bars(spark, BULLISH_ROWS, pair=("EUR", "USD"))
    b = silver_bars(spark, BEARISH_ROWS, pair=("GBP", "USD"))
    out = detect_gaps(a.unionByName(b)).orderBy("from_symbol").collect()
    assert [(r["from_symbol"], r["fvg_type"]) for r in out] == [("EUR", "bullish"),
                                                                ("GBP", "bearish")]


def test_short_pairs_have_no_gaps(spark):
    one = silver_bars(spark, BULLISH_ROWS[:1], pair=("AAA", "USD"))
    two = silver_bars(spark, BULLISH_ROWS[:2], pair=("BBB", "USD"))
    assert detect_gaps(one.unionByName(two)).count() == 0


def test_single_pass_equals_union(spark):
    bars = silver_bars(spark, BULLISH_ROWS + [
        ("2024-01-04", "1.11200", "1.11300", "1.09000", "1.09100"),
        ("2024-01-05", "1.09100", "1.09200", "1.08000", "1.08500"),
    ])
    assert sorted(detect_gaps(bars).collect()) == sorted(detect_gaps_union(bars).collect())


def test_pip_factor_parameter(bullish):
    assert detect_gaps(bullish, pip_factor=100).first()["fvg_size_pips"] == Decimal("0.50")


def test_per_quote_pip_factor(spark):
    from candlegap.functions import quote_pip_factor

    jpy = silver_bars(spark, [("2024-01-01", "150.000", "150.500", "149.500", "150.200"),
                              ("2024-01-02", "150.200", "152.000", "150.100", "151.800"),
                              ("2024-01-03", "151.800", "152.500", "151.000", "152.300")],
                      pair=("USD", "JPY"))
    eur = silver_bars(spark, BULLISH_ROWS)
    rows = {r["to_symbol"]: r["fvg_size_pips"] for r in
            detect_gaps(jpy.unionByName(eur), pip_factor=quote_pip_factor()).collect()}
    assert rows == {"JPY": Decimal("50.00"), "USD": Decimal("50.00")}


def test_invariants_on_event_bars(spark):
    from candlegap.catalog import silver

    s = silver(spark, "/root/testdata/sf0.01")
    g = detect_gaps(s).collect()
    keys = [(r["from_symbol"], r["to_symbol"], r["date"]) for r in g]
    assert len(keys) == len(set(keys))                          # at most one gap per bar
    assert all(r["fvg_high"] > r["fvg_low"] for r in g)           # ordered levels
    assert all(r["fvg_size_pips"] > 0 for r in g)
    pos = detect_gaps(s, levels="positional").collect()
    assert sorted(abs(r["fvg_size_pips"]) for r in pos) == sorted(r["fvg_size_pips"] for r in g)
