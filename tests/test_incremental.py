"""Refresh from the first changed day with halo rows, and the mergeable report state."""

from __future__ import annotations

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from candlegap.operators import rolling_volatility
from candlegap.plans import incremental, pipeline, reports
from candlegap.plans.incremental import Roots
from candlegap.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA
from candlegap.sources import scan_layer

TS = "2024-06-01T00:00:00Z"
T0 = dt.datetime(2024, 5, 1)
DAY0 = dt.date(2023, 12, 20)


def made(rnd, days, pairs=4):
    rows = []
    for p in range(pairs):
        for d in days:
            if rnd.random() < 0.7:
                low = rnd.uniform(1, 3)
                o, h, c = low + rnd.random() / 5, low + rnd.random(), low + rnd.random() / 5
                bad = rnd.random()
                rows.append((str(DAY0 + dt.timedelta(days=d)) if bad > 0.02 else "soon", f"{o:.5f}", f"{h:.5f}" if bad < 0.9 else "0.5",
                             f"{low:.5f}", "x" if bad > 0.97 else f"{c:.5f}", f"P{p}", "USD", T0, "t"))
    return rows


def merged(history, batch):
    return {**{(r[0], r[5]): r for r in history}, **{(r[0], r[5]): r for r in batch}}


def rows_of(df, schema, leave=()):
    keep = [c for c in schema.fieldNames() if c not in leave]
    return sorted((tuple(r) for r in df.select(*keep).collect()), key=str)


@pytest.mark.parametrize("seed, fill", [(1, "close"), (3, "future")])
def test_refresh_equals_a_full_rebuild_after_random_corrections(spark, tmp_root, seed, fill):
    rnd = random.Random(seed)
    roots = Roots(*(f"{tmp_root}/{x}" for x in ("b", "s", "g", "state")))
    held = {}
    deliveries = [made(rnd, range(60)), made(rnd, [70, 71], pairs=6), made(rnd, [33, 41], pairs=2),
                  [(r[0], "0", "0", "0", "0", *r[5:]) for r in made(rnd, range(20, 45), pairs=1)],
                  made(rnd, [-9], pairs=2), [("soon", "1", "1", "1", "1", "P1", "USD", T0, "t")]]
    for rows in deliveries:
        rows = list({(r[0], r[5]): r for r in rows}.values())
        held = merged(held.values(), rows)
        incoming = pipeline.stamp_ingest(spark.createDataFrame(rows, BRONZE_SCHEMA), TS)
        incremental.refresh_layers(spark, incoming, roots, run_ts=TS, fill=fill)
        whole = pipeline.stamp_ingest(spark.createDataFrame(list(held.values()), BRONZE_SCHEMA), TS)
        silver = pipeline.build_silver(whole).cache()
        gold = pipeline.build_gold(silver, run_ts=TS, fill=fill).cache()
        assert rows_of(scan_layer(spark, roots.bronze), BRONZE_SCHEMA) == rows_of(whole, BRONZE_SCHEMA)
        assert rows_of(scan_layer(spark, roots.silver, schema=SILVER_SCHEMA), SILVER_SCHEMA) == rows_of(silver, SILVER_SCHEMA)
        stamp = ("_updated_at",)
        assert rows_of(scan_layer(spark, roots.gold, schema=GOLD_SCHEMA), GOLD_SCHEMA, stamp) == rows_of(gold, GOLD_SCHEMA, stamp)
        state = scan_layer(spark, roots.state)
        assert incremental.state_fill_rate(state).collect() == reports.report_fill_rate(gold).collect()
        assert incremental.state_summary(state).collect() == reports.gap_summary(gold).collect()
        for by_pair in (True, False):
            assert incremental.state_monthly_activity(state, by_pair=by_pair).collect() == \
                reports.report_monthly_activity(gold, by_pair=by_pair).collect()
        silver.unpersist()
        gold.unpersist()


def test_earlier_partitions_are_neither_read_for_bars_nor_rewritten(spark, tmp_root):
    roots = Roots(*(f"{tmp_root}/{x}" for x in ("b", "s", "g", "state")))
    days = [DAY0 + dt.timedelta(days=d) for d in range(120)]
    rows = [(str(d), "2", "3", "1", "2", f"P{p}", "USD", T0, "t") for p in range(3) for d in days]
    for batch in (rows, [(str(days[-1]), "2", "9", "1", "2", "P1", "USD", T0, "t")]):
        before = {f: f.stat().st_mtime_ns for f in pathlib.Path(tmp_root).rglob("*.parquet")}
        incremental.refresh_layers(spark, pipeline.stamp_ingest(spark.createDataFrame(batch, BRONZE_SCHEMA), TS), roots, run_ts=TS)
    after = set(pathlib.Path(tmp_root).rglob("*.parquet"))
    assert len({f.parent for f in after - set(before)}) == 2      # one month of bronze and of silver
    assert {f.parent.name for f in after - set(before)} == {"month=202404"}


def test_frames_asked_for_again_come_in_as_many_tasks_as_their_rows_ask_for(spark, tmp_root):
    roots = Roots(*(f"{tmp_root}/{x}" for x in ("b", "s", "g", "state")))
    rows = list({(r[0], r[5]): r for r in made(random.Random(4), range(60))}.values())
    sc, before, most = spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions"), 0
    spark.conf.set("spark.sql.shuffle.partitions", "150")  # more than the cores, and than these rows are worth
    try:
        for group, batch in (("refresh-all", rows), ("refresh-late", rows[-9:])):
            incoming = pipeline.stamp_ingest(spark.createDataFrame(batch, BRONZE_SCHEMA), TS)
            sc.setJobGroup(group, group)
            incremental.refresh_layers(spark, incoming, roots, run_ts=TS)
            seen = sc.statusTracker()
            stages = [seen.getStageInfo(i) for j in seen.getJobIdsForGroup(group) for i in seen.getJobInfo(j).stageIds]
            most = max(most, *(i.numTasks for i in stages if i is not None and i.numCompletedTasks))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert 1 <= most < 150


def test_volatility_from_the_first_changed_day(spark):
    rnd = random.Random(8)
    silver = pipeline.build_silver(spark.createDataFrame(made(rnd, range(90), pairs=3), BRONZE_SCHEMA)).cache()
    starts = spark.createDataFrame([("P0_USD", "P0", "USD", DAY0 + dt.timedelta(days=50)),
                                    ("P2_USD", "P2", "USD", DAY0 + dt.timedelta(days=3))],
                                   "pair string, from_symbol string, to_symbol string, start date")
    for days in (1, 20):
        full = rolling_volatility(silver, days, name=f"volatility_{days}d")
        want = full.join(starts, ["from_symbol", "to_symbol"]).where("date >= start").select(full.columns)
        got = incremental.volatility_since(silver, starts, days).select(full.columns)
        assert sorted(got.collect()) == sorted(want.collect()) and want.count() > 50
    silver.unpersist()
