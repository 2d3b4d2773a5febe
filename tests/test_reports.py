"""Reports: values on hand-made tables, named tables = DataFrame versions."""

from __future__ import annotations

from decimal import Decimal

import pytest

from candlegap.catalog import gaps_ordered, silver
from candlegap.plans import reports
from candlegap.plans.named_reports import NAMED_REPORTS, register_views, run_named_report
from candlegap.operators import detect_gaps, gap_fill_close
from tests.helpers import silver_bars
from candlegap.operators.enrich import derive_fields

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark):
    s = silver(spark, SF).cache()
    g = gap_fill_close(detect_gaps(s)).cache()
    yield s, g
    s.unpersist()
    g.unpersist()


@pytest.mark.parametrize("name", sorted(NAMED_REPORTS))
def test_named_tables_equal_dataframe_report(spark, layers, name):
    s, g = layers
    df_fn = getattr(reports, name)
    want = df_fn(s, g) if name == "report_volatility" else (
        df_fn(s) if name == "report_largest_moves" else df_fn(g))
    got = run_named_report(spark, name, *register_views(s, g, prefix="test"))
    assert got.columns == want.columns
    assert got.collect() == want.collect()


def test_volatility_single_pass_equals_join(layers):
    s, g = layers
    one = reports.report_volatility(s)
    assert "Join" not in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(one.collect()) == sorted(reports.report_volatility(s, g).collect())


def test_flagship_counts_at_smallest_scale(spark):
    rows = {r["fvg_type"]: r for r in reports.report_fill_rate(gaps_ordered(spark, SF)).collect()}
    assert rows["bullish"]["total_fvgs"] == 60 and rows["bearish"]["total_fvgs"] == 55
    assert rows["bullish"]["filled_count"] == 28 and rows["bearish"]["filled_count"] == 34


def test_largest_moves_keeps_ties(spark):
    bars = silver_bars(spark, [(f"2024-01-{d:02d}", "1.0", "1.2", "0.9", c) for d, c in
                               enumerate(["1.0", "1.1", "1.0", "1.1", "1.0", "1.2"], 1)])
    moves = reports.report_largest_moves(derive_fields(bars), top=2).collect()
    # 1.0 -> 1.2 (+20%) ranks 1; 10% and -9.09% follow, the two +10% tie at rank 2
    assert [r["move_rank"] for r in moves] == [1, 2, 2]


def test_fill_rate_rounding(spark):
    g = spark.createDataFrame(
        [("bullish", 1), ("bullish", 0), ("bullish", 0), ("bearish", 1), ("bearish", 1),
         ("bearish", 0)], "fvg_type string, is_filled int")
    rows = {r["fvg_type"]: r for r in reports.report_fill_rate(g).collect()}
    assert (rows["bullish"]["total_fvgs"], rows["bullish"]["filled_count"],
            rows["bullish"]["unfilled_count"]) == (3, 1, 2)
    assert rows["bullish"]["fill_rate_pct"] == Decimal("33.33")
    assert rows["bearish"]["fill_rate_pct"] == Decimal("66.67")


def test_summary_is_one_aggregate(spark, layers):
    _, g = layers
    r = reports.gap_summary(g).first()
    assert r["total_fvgs"] == r["bullish_fvgs"] + r["bearish_fvgs"] == \
        r["filled_fvgs"] + r["unfilled_fvgs"]
