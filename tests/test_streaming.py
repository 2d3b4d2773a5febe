"""Incremental refresh stream: re-deliveries win, untouched pairs stay."""

from __future__ import annotations

import datetime as dt
import glob
import os

from candlegap.schemas import BRONZE_SCHEMA
from candlegap.sinks import write_raw_json
from candlegap.sources import scan_layer
from candlegap.streaming import start_refresh

T0 = dt.datetime(2024, 1, 10)


def bars(spark, pair, closes, start=1):
    rows = []
    for i, c in enumerate(closes, start):
        c = float(c)
        rows.append((f"2024-01-{i:02d}", f"{c:.5f}", f"{c + 0.01:.5f}", f"{c - 0.01:.5f}",
                     f"{c:.5f}", pair[0], pair[1], T0, "test"))
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def test_refresh_stream(spark, tmp_root):
    raw, ck = f"{tmp_root}/raw", f"{tmp_root}/ck"
    roots = [f"{tmp_root}/{x}" for x in ("bronze", "silver", "gold")]
    # a rising EUR_USD (bullish gaps) and a flat USD_JPY (none)
    eur = bars(spark, ("EUR", "USD"), [1.0, 1.1, 1.2, 1.3, 1.4])
    jpy = bars(spark, ("USD", "JPY"), [150.0] * 5)
    write_raw_json(eur.unionByName(jpy), raw)
    start_refresh(spark, raw, *roots, checkpoint=ck).awaitTermination()
    gold = scan_layer(spark, roots[2])
    assert {(r["pair"], str(r["date"])) for r in gold.collect()} == {
        ("EUR_USD", "2024-01-02"), ("EUR_USD", "2024-01-03"), ("EUR_USD", "2024-01-04")}
    jpy_files = sorted(glob.glob(f"{roots[1]}/pair=USD_JPY/*.parquet"))
    jpy_mtimes = [os.path.getmtime(f) for f in jpy_files]

    # re-deliver EUR_USD from the 3rd flat: the later delivery must win
    write_raw_json(bars(spark, ("EUR", "USD"), [1.2, 1.2, 1.2], start=3), raw, mode="append")
    start_refresh(spark, raw, *roots, checkpoint=ck).awaitTermination()
    silver = {str(r["date"]): r["close"] for r in
              scan_layer(spark, roots[1], pairs=["EUR_USD"]).collect()}
    assert [float(silver[f"2024-01-0{i}"]) for i in range(1, 6)] == [1.0, 1.1, 1.2, 1.2, 1.2]
    gold = scan_layer(spark, roots[2], pairs=["EUR_USD"]).collect()
    # bar 4's gap (1.31 < 1.39 before) is gone; bars 2 and 3 keep theirs
    assert sorted(str(r["date"]) for r in gold) == ["2024-01-02", "2024-01-03"]
    # the untouched pair was not rewritten
    assert sorted(glob.glob(f"{roots[1]}/pair=USD_JPY/*.parquet")) == jpy_files
    assert [os.path.getmtime(f) for f in jpy_files] == jpy_mtimes

    # nothing new: the stream has nothing to do and changes nothing
    start_refresh(spark, raw, *roots, checkpoint=ck).awaitTermination()
    assert len(scan_layer(spark, roots[1]).collect()) == 10


def test_refresh_stamps_are_consistent(spark, tmp_root):
    raw, ck = f"{tmp_root}/raw", f"{tmp_root}/ck"
    roots = [f"{tmp_root}/{x}" for x in ("bronze", "silver", "gold")]
    write_raw_json(bars(spark, ("EUR", "USD"), [1.0, 1.1, 1.2, 1.3]), raw)
    start_refresh(spark, raw, *roots, checkpoint=ck).awaitTermination()
    b = {r["_ingest_timestamp"] for r in scan_layer(spark, roots[0]).collect()}
    s = {r["_ingest_timestamp"] for r in scan_layer(spark, roots[1]).collect()}
    g = {r["_updated_at"] for r in scan_layer(spark, roots[2]).collect()}
    assert len(b) == 1 and b == s == g
