"""Distributed positions and global top-k with ties."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlegap.catalog import gaps_ordered, silver
from candlegap.operators.positions import top_with_ties, with_positions
from candlegap.plans import reports

SF = "/root/testdata/sf0.001"


def test_positions_are_those_of_a_global_sort(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 1, 1, 2, 5]), k) for k in range(5000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "v int, k int").repartition(7)
    out = with_positions(df, F.col("v").desc(), F.col("k"), name="place")
    got = [(r["v"], r["k"]) for r in sorted(out.collect(), key=lambda r: r["place"])]
    assert got == sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted(r["place"] for r in out.collect()) == list(range(1, 5001))
    assert with_positions(df.limit(0), "v", "k").count() == 0


def test_reports_carry_their_order_as_a_column(spark):
    gold, bars = gaps_ordered(spark, SF), silver(spark, SF)
    for name in reports.ORDERS:
        layer = bars if name in ("report_volatility", "report_largest_moves") else gold
        report = getattr(reports, name)(layer)
        listed = [tuple(r) for r in report.collect()]
        placed = sorted(reports.positioned(report, name).collect(), key=lambda r: r["position"])
        assert [tuple(r)[:-1] for r in placed] == listed and len(listed) > 1, name


def rank_rows(df, top):
    w = Window.orderBy(F.col("v").desc_nulls_last())
    return sorted(map(tuple, df.withColumn("rank", F.rank().over(w)).where(F.col("rank") <= top).collect()), key=str)


def test_top_with_ties_equals_a_global_rank(spark):
    rnd = random.Random(9)
    for values in ([None] * 20 + [3, 3, 1], [7] * 500, list(range(50)) * 3, [], [None] * 5, [2, None, 1]):
        rows = [(v, k) for k, v in enumerate(values)]
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "v int, k int").repartition(3)
        for top in (1, 4, 10):
            got = top_with_ties(df, F.col("v"), top)
            assert sorted(map(tuple, got.collect()), key=str) == rank_rows(df, top)


def test_a_table_of_equal_returns_stays_in_its_tasks(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day, f"P{k}", "USD", *["1"] * 5, "0.5" if k % 3 else None) for k in range(900)]
    cols = ["date", "from_symbol", "to_symbol", "open", "high", "low", "close", "daily_range", "daily_return"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'date' if c == 'date' else 'string'}" for c in cols))
    df = df.withColumn("daily_return", F.col("daily_return").cast("decimal(10,5)")).repartition(6)
    out = reports.report_largest_moves_in_parallel(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert out.count() == 600 and {r["move_rank"] for r in out.collect()} == {1}
    assert rank_rows(df.select(F.abs("daily_return").alias("v"), "from_symbol"), 10) == sorted(
        ((r["daily_return"], r["from_symbol"], r["move_rank"]) for r in out.collect()), key=str)
