"""Instrument windows in blocks equal the window forms; first fill by block extremes."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from candlegap.operators import blocks, gaps
from candlegap.operators.enrich import derive_fields, rolling_volatility

DAY0 = dt.date(2020, 1, 1)
SCHEMA = ("date date, open decimal(10,5), high decimal(10,5), low decimal(10,5), close decimal(10,5), "
          "from_symbol string, to_symbol string")


def random_bars(seed: int, lengths: dict, nulls: float = 0.0) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for name, n in lengths.items():
        day, level = DAY0, 50.0
        for _ in range(n):
            day += dt.timedelta(days=rnd.randint(1, 40 if rnd.random() < 0.02 else 2))
            level = max(5, level + rnd.uniform(-1.5, 1.6))
            low, high = level, level + rnd.random()
            price = [f"{x:.5f}" for x in (level, high, low, rnd.uniform(low, high))]
            price = [None if rnd.random() < nulls else Decimal(p) for p in price]
            rows.append((day, *price, name, "USD"))
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def bars(spark):
    df = spark.createDataFrame(random_bars(5, {"A": 700, "B": 1, "C": 2, "D": 64, None: 65}), SCHEMA).cache()
    yield df
    df.unpersist()


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def same(got, want):
    assert set(got.columns) == set(want.columns)
    assert rows_of(got, want.columns) == rows_of(want, want.columns)


@pytest.mark.parametrize("block", [2, 64, 5000])
def test_windows_in_blocks_equal_whole_windows(bars, block):
    same(blocks.neighbour_bars_in_blocks(bars, block), gaps.neighbour_bars(bars))
    same(blocks.future_extremes_in_blocks(bars, block), gaps._future_extremes(bars))
    silver = derive_fields(bars)
    same(blocks.derive_fields_in_blocks(bars, block), silver)
    same(blocks.rolling_volatility_in_blocks(silver, 20, block_bars=block), rolling_volatility(silver, 20))
    same(blocks.gap_fill_future_in_blocks(bars, block_bars=block), gaps.gap_fill_future(bars))


def brute_first_fill(rows):
    held, out = {}, {}
    for r in sorted(rows, key=lambda r: (str(r[5]), r[0])):
        held.setdefault(r[5], []).append(r)
    for name, bars in held.items():
        for i in range(1, len(bars) - 1):
            (_, _, ph, pl, *_), (_, _, nh, nl, *_) = bars[i - 1], bars[i + 1]
            if ph is not None and nl is not None and ph < nl:
                hits = [k for k in range(i + 1, len(bars)) if bars[k][3] is not None and bars[k][3] <= ph]
            elif pl is not None and nh is not None and pl > nh:
                hits = [k for k in range(i + 1, len(bars)) if bars[k][2] is not None and bars[k][2] >= pl]
            else:
                continue
            out[(name, bars[i][0])] = (bars[hits[0]][0], hits[0] - i) if hits else (None, None)
    return out


@pytest.mark.parametrize("fanout, nulls", [(2, 0.0), (4, 0.2), (32, 0.05)])
def test_first_fill_by_block_extremes(spark, fanout, nulls):
    rows = random_bars(fanout, {"A": 300, "B": 3, "C": 16, None: 40}, nulls)
    got = blocks.gap_first_fill_in_blocks(spark.createDataFrame(rows, SCHEMA), fanout=fanout, block_bars=50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    found = {(r["from_symbol"], r["date"]): (r["first_fill_date"], r["bars_to_fill"]) for r in got.collect()}
    want = brute_first_fill(rows)
    assert found == want and any(d for d, _ in want.values()) and not all(d for d, _ in want.values())


def test_first_fill_equals_the_search_in_python(bars, spark):
    same(blocks.gap_first_fill_in_blocks(bars, fanout=8), gaps.gap_first_fill(bars))
    assert blocks.gap_first_fill_in_blocks(bars.limit(0)).count() == 0


def test_one_instrument_runs_in_many_tasks(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(random_bars(3, {"A": 3000}), SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = blocks.neighbour_bars_in_blocks(rows, 100).withColumn("task", F.spark_partition_id())
        spread = [r["n"] for r in out.groupBy("task").agg(F.count("*").alias("n"), F.max("next_low")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 4 and sum(spread) == 3000
