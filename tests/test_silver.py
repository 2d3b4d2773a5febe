"""Cast, clean/reject, dedup and derived fields on small edge tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from candlegap.operators import (
    cast_bars,
    clean_bars,
    daily_return,
    dedup_latest,
    rejected_bars,
    valid_symbols,
)
from candlegap.plans import build_silver
from candlegap.schemas import BRONZE_SCHEMA, SILVER_SCHEMA

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)
T1 = dt.datetime(2024, 1, 11, 12, 0, 0)


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def row(date, o, h, lo, c, pair=("EUR", "USD"), ts=T0, src="test"):
    return (date, o, h, lo, c, pair[0], pair[1], ts, src)


def test_cast_malformed_to_null(spark):
    out = cast_bars(bronze(spark, [row("2024-01-01", "bad", "1.2", "1.1", None),
                                   row("not a date", "1", "2", "0.5", "1.5")])).collect()
    assert out[0]["open"] is None and out[0]["close"] is None
    assert out[0]["high"] == Decimal("1.20000")
    assert out[1]["date"] is None


def test_clean_and_rejects_partition_the_input(spark):
    rows = [
        row("2024-01-01", "1.1", "1.2", "1.0", "1.15"),   # good
        row("2024-01-02", "bad", "1.2", "1.0", "1.15"),   # missing_open
        row("2024-01-03", "1.1", "1.0", "1.2", "1.15"),   # high_below_low
        row("2024-01-04", "1.1", "1.2", "0", "1.15"),     # non_positive_low
        row("2024-01-05", "-1", "1.2", "1.0", "1.15"),    # non_positive_open
        row("2024-01-06", "1.1", "1.2", "1.0", None),     # missing_close
        row(None, "1.1", "1.2", "1.0", "1.1"),            # missing_date
    ]
    typed = cast_bars(bronze(spark, rows))
    good, bad = clean_bars(typed), rejected_bars(typed)
    assert good.count() + bad.count() == len(rows)
    reasons = {r["date"]: r["reject_reason"] for r in bad.collect()}
    assert sorted(reasons.values()) == sorted([
        "missing_open", "high_below_low", "non_positive_low", "non_positive_open",
        "missing_close", "missing_date"])


def test_dedup_latest_stamp_wins_and_ties_are_deterministic(spark):
    rows = [
        row("2024-01-01", "1.1", "1.2", "1.0", "1.15", ts=T0),
        row("2024-01-01", "2.1", "2.2", "2.0", "2.15", ts=T1),   # later stamp wins
        row("2024-01-02", "1.1", "1.2", "1.0", "1.15", ts=T0),
        row("2024-01-02", "1.3", "1.4", "1.0", "1.35", ts=T0),   # same stamp: tie-break
    ]
    typed = cast_bars(bronze(spark, rows))
    runs = [sorted(dedup_latest(typed.repartition(n)).collect()) for n in (1, 3, 4)]
    assert runs[0] == runs[1] == runs[2]
    by_date = {str(r["date"]): r for r in runs[0]}
    assert by_date["2024-01-01"]["open"] == Decimal("2.10000")
    assert by_date["2024-01-02"]["open"] == Decimal("1.30000")


def test_dedup_before_return(spark):
    # a duplicated day must not take its own twin as previous close
    rows = [
        row("2024-01-01", "1.0", "1.1", "0.9", "1.0", ts=T0),
        row("2024-01-02", "1.0", "1.3", "0.9", "1.2", ts=T0),
        row("2024-01-02", "1.0", "1.3", "0.9", "1.1", ts=T1),
    ]
    out = {str(r["date"]): r for r in build_silver(bronze(spark, rows)).collect()}
    assert len(out) == 2
    assert out["2024-01-01"]["daily_return"] is None
    assert out["2024-01-02"]["daily_return"] == Decimal("10.00000")
    assert out["2024-01-02"]["daily_range"] == Decimal("0.40000")


def test_silver_schema(spark):
    out = build_silver(bronze(spark, [row("2024-01-01", "1", "2", "0.5", "1.5")]))
    assert [f.name for f in out.schema.fields] == SILVER_SCHEMA.fieldNames()
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in SILVER_SCHEMA.fields]


def test_return_overflow_is_null(spark):
    rows = [row("2024-01-01", "0.00001", "0.00002", "0.00001", "0.00001"),
            row("2024-01-02", "9000", "9000", "9000", "9000")]
    out = {str(r["date"]): r for r in build_silver(bronze(spark, rows)).collect()}
    assert out["2024-01-02"]["daily_return"] is None     # 89,999,900 % does not fit


def test_return_rounds_half_up(spark):
    typed = cast_bars(bronze(spark, [row("2024-01-01", "3", "3", "3", "3"),
                                     row("2024-01-02", "1", "4", "1", "4")]))
    out = {str(r["date"]): r for r in daily_return(typed).collect()}
    assert out["2024-01-02"]["daily_return"] == Decimal("33.33333")


def test_valid_symbols_default_list(spark):
    rows = [row("2024-01-01", "1", "2", "0.5", "1.5", pair=p)
            for p in (("EUR", "USD"), ("EUR", "XXX"), ("JPY", "CHF"), ("BTC", "USD"))]
    out = valid_symbols(bronze(spark, rows)).select("from_symbol", "to_symbol").collect()
    assert sorted(tuple(r) for r in out) == [("EUR", "USD"), ("JPY", "CHF")]


def test_clean_filter_reaches_parquet_scan(spark, tmp_root):
    typed = cast_bars(bronze(spark, [row("2024-01-01", "1", "2", "0.5", "1.5")]))
    typed.write.parquet(tmp_root + "/t")
    plan = clean_bars(spark.read.parquet(tmp_root + "/t"))._jdf.queryExecution() \
        .executedPlan().toString()
    for pushed in ("GreaterThan(open,0.00000)", "GreaterThan(close,0.00000)", "IsNotNull(date)",
                   "IsNotNull(close)"):
        assert pushed in plan


def test_dedup_of_key_only_frame(spark):
    df = spark.createDataFrame([("2024-01-01", "A", "B")] * 3, "date string, from_symbol string, "
                               "to_symbol string")
    assert dedup_latest(df).count() == 1
