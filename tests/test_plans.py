"""Physical plan shape: shuffles, windows, group limits, pushdown."""

from __future__ import annotations

import re

from candlegap.catalog import QUERIES, silver
from candlegap.operators import detect_gaps, gap_first_fill
from candlegap.plans import reports

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return plan(df)


def _count(text, pattern):
    return len(re.findall(pattern, text))


def test_detection_is_one_window_one_pair_shuffle(spark):
    s = silver(spark, SF)
    base = plan(s)
    p = plan(detect_gaps(s))
    # detection adds no exchange beyond silver's own (dedup + the pair window)
    assert _count(p, r"Exchange hashpartitioning") == _count(base, r"Exchange hashpartitioning")
    # all four lag/lead columns live in one Window node; silver's unused
    # lag(close) for daily_return is pruned away
    assert _count(p, r"\bWindow \[") == 1


def test_events_scan_is_pruned(spark):
    p = plan(QUERIES["detect_gaps"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_first_fill_adds_no_shuffle_after_window(spark):
    s = silver(spark, SF)
    p = plan(gap_first_fill(s))
    assert _count(p, r"Exchange hashpartitioning") == _count(plan(detect_gaps(s)),
                                                               r"Exchange hashpartitioning")
    # the order restated for mapInPandas is already provided by the window
    mip = p[p.index("MapInPandas"):]
    assert mip.split("\n")[1].strip().startswith(("+- Project", "+- Window"))


def test_largest_moves_uses_group_limit(spark):
    p = plan(reports.report_largest_moves(silver(spark, SF)))
    assert "WindowGroupLimit" in p


def test_future_fill_has_no_shrinking_frame(spark):
    p = plan(QUERIES["gap_fill_future"](spark, SF))
    assert "UnboundedFollowing" not in p and "unboundedfollowing" not in p


def test_dedup_combines_map_side(spark):
    p = plan(QUERIES["dedup_latest"](spark, SF))
    assert "partial_max(" in p


def test_recommended_settings_scale_with_input():
    from candlegap.plans.settings import recommended_settings

    small = recommended_settings(10 << 20)
    big = recommended_settings(100 << 40)          # 100 TB
    assert small["spark.sql.shuffle.partitions"] == "1"
    assert big["spark.sql.shuffle.partitions"] == str((100 << 40) // (128 << 20))
    assert recommended_settings(1 << 40)["spark.sql.shuffle.partitions"] == "8192"
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_volatility_join_reuses_pair_partitioning(spark):
    from candlegap.operators import detect_gaps, gap_fill_close

    s = silver(spark, SF)
    g = gap_fill_close(detect_gaps(s))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = plan(reports.report_volatility(s, g)).count("Exchange hashpartitioning")
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        after = plan(reports.report_volatility(s, g)).count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    assert after == before - 2
