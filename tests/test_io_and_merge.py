"""Sources, sinks, upsert and schema evolution."""

from __future__ import annotations

import datetime as dt
import json
import os
import pathlib
import re

from pyspark.sql import functions as F

from candlegap.operators import evolve_schema, upsert_bars
from candlegap.plans import pipeline
from candlegap.schemas import BRONZE_SCHEMA, conform, null_violations
from candlegap.sinks import write_layer, write_raw_json
from candlegap.sinks.files import write_raw_json_arrays
from candlegap.sources import classify_documents, flatten_documents, read_documents, scan_layer
from candlegap.sources import scan_raw_json

T0 = dt.datetime(2024, 1, 10, 12, 0, 0, 123456)


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def b(date, price, pair=("EUR", "USD"), ts=T0):
    return (date, price, price, price, price, pair[0], pair[1], ts, "test")


def read_files(df):
    """Files that rows of a frame come from."""
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def folders(root):
    return {str(p.relative_to(root)) for p in pathlib.Path(root).rglob("*") if p.is_dir()}


def test_raw_json_array_files_round_trip(spark, tmp_root):
    # the provider-file layout: one JSON array per pair folder
    os.makedirs(f"{tmp_root}/raw/pair=EUR_USD")
    recs = [{"date": "2024-01-02", "open": "1.1", "high": "1.2", "low": "1.0", "close": 1.15,
             "from_symbol": "EUR", "to_symbol": "USD",
             "_ingest_timestamp": "2024-01-10T12:00:00.123456+00:00"},
            {"date": "2024-01-01", "open": "1.0", "from_symbol": "EUR", "to_symbol": "USD"},
            # isoformat() drops the fraction when microseconds are zero
            {"date": "2024-01-03", "open": "1.2", "from_symbol": "EUR", "to_symbol": "USD",
             "_ingest_timestamp": "2024-01-10T12:00:00+00:00"}]
    with open(f"{tmp_root}/raw/pair=EUR_USD/data.json", "w") as f:
        json.dump(recs, f, indent=2)
    out = sorted(scan_raw_json(spark, f"{tmp_root}/raw", multi_line=True).collect())
    assert len(out) == 3
    assert out[2]["_ingest_timestamp"] == dt.datetime(2024, 1, 10, 12, 0, 0)
    assert out[0]["high"] is None and out[0]["pair"] == "EUR_USD"   # missing -> NULL
    assert out[1]["close"] == "1.15"                                # number kept as text
    assert out[1]["_ingest_timestamp"] == T0


def test_written_arrays_and_lines_read_back(spark, tmp_root):
    df = bronze(spark, [b("2024-01-01", "1.1"), b("2024-01-02", "1.2"),
                        b("2024-01-01", "150.1", pair=("USD", "JPY"))])
    write_raw_json_arrays(df, f"{tmp_root}/arr")
    write_raw_json(df, f"{tmp_root}/lines")
    want = sorted(tuple(r) for r in df.collect())
    for root, multi in ((f"{tmp_root}/arr", True), (f"{tmp_root}/lines", False)):
        got = scan_raw_json(spark, root, multi_line=multi).drop("pair").collect()
        assert sorted(tuple(r) for r in got) == want


def test_dynamic_overwrite_replaces_only_its_pairs(spark, tmp_root):
    root = f"{tmp_root}/bronze"
    write_layer(bronze(spark, [b("2024-01-01", "1.1"), b("2024-01-01", "150", ("USD", "JPY"))]),
                root)
    write_layer(bronze(spark, [b("2024-01-02", "1.3")]), root)    # EUR_USD only
    got = {(r["pair"], r["date"]) for r in scan_layer(spark, root).collect()}
    assert got == {("EUR_USD", "2024-01-02"), ("USD_JPY", "2024-01-01")}


def test_pair_selection_prunes_partitions(spark, tmp_root):
    root = f"{tmp_root}/layer"
    write_layer(bronze(spark, [b("2024-01-01", "1.1"), b("2024-01-01", "150", ("USD", "JPY"))]),
                root)
    df = scan_layer(spark, root, pairs=["usd_jpy"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the hash of the symbols is folded to a literal bucket, the key reaches the Parquet scan
    assert re.search(r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = \d+\)\]", plan)
    assert "EqualTo(pair,USD_JPY)" in plan
    assert [r["pair"] for r in df.collect()] == ["USD_JPY"]
    assert len(read_files(df)) == 1


def test_load_bronze_stamps_and_skips_empty(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    write_raw_json(bronze(spark, [b("2024-01-01", "1.1"), b("2024-01-02", "1.2")]), raw)
    n = pipeline.run_bronze(spark, raw, f"{tmp_root}/bronze", run_ts="2024-02-01T00:00:00Z")
    assert n == 2
    stamps = {r["_ingest_timestamp"] for r in scan_layer(spark, f"{tmp_root}/bronze").collect()}
    assert stamps == {dt.datetime(2024, 2, 1)}
    os.makedirs(f"{tmp_root}/empty")
    assert pipeline.run_bronze(spark, f"{tmp_root}/empty", f"{tmp_root}/b2",
                               run_ts="2024-02-01T00:00:00Z") == 0
    assert not os.path.exists(f"{tmp_root}/b2")


def test_full_pipeline_jobs(spark, tmp_root):
    rows = [b(f"2024-01-0{i}", p) for i, p in enumerate(["1.0", "1.2", "1.5", "1.3"], 1)]
    rows = [(d, o, str(float(o) + 0.05), str(float(o) - 0.05), o, *rest)
            for d, o, _h, _l, _c, *rest in rows]
    write_raw_json(bronze(spark, rows), f"{tmp_root}/raw")
    assert pipeline.run_bronze(spark, f"{tmp_root}/raw", f"{tmp_root}/bronze",
                               run_ts="2024-02-01T00:00:00Z") == 4
    assert pipeline.run_silver(spark, f"{tmp_root}/bronze", f"{tmp_root}/silver") == 4
    n = pipeline.run_gold(spark, f"{tmp_root}/silver", f"{tmp_root}/gold",
                          run_ts="2024-02-01T00:00:00Z")
    gold = scan_layer(spark, f"{tmp_root}/gold").collect()
    assert n == len(gold) >= 1


def test_upsert_incoming_wins_and_is_idempotent(spark):
    t1 = T0 + dt.timedelta(days=1)
    existing = bronze(spark, [b("2024-01-01", "1.0"), b("2024-01-02", "1.0")])
    incoming = bronze(spark, [b("2024-01-02", "2.0", ts=t1), b("2024-01-03", "2.0", ts=t1)])
    once = upsert_bars(existing, incoming)
    twice = upsert_bars(once, incoming)
    got = {r["date"]: r["close"] for r in once.collect()}
    assert got == {"2024-01-01": "1.0", "2024-01-02": "2.0", "2024-01-03": "2.0"}
    assert sorted(once.collect()) == sorted(twice.collect())


def test_evolve_schema_adds_columns(spark, tmp_root):
    first = bronze(spark, [b("2024-01-01", "1.0")])
    second = bronze(spark, [b("2024-01-02", "1.1")]).withColumn("note", F.lit("x"))
    merged = evolve_schema(first, second)
    assert merged.columns == BRONZE_SCHEMA.fieldNames() + ["note"]
    assert {r["date"]: r["note"] for r in merged.collect()} == {"2024-01-01": None,
                                                               "2024-01-02": "x"}
    root = f"{tmp_root}/ev"
    write_layer(first, root)
    write_layer(second, root, mode="append")
    assert "note" in scan_layer(spark, root, merge_schema=True).columns


def test_conform_and_null_violations(spark):
    df = bronze(spark, [b("2024-01-01", "1.0")]).withColumn("_x", F.lit(1)).drop("_source")
    out = conform(df, "bronze")
    assert out.columns == BRONZE_SCHEMA.fieldNames()
    assert out.first()["_source"] is None
    nulls = null_violations(df.withColumn("_ingest_timestamp", F.lit(None).cast("timestamp")),
                            "bronze").first()
    assert nulls["null__ingest_timestamp"] == 1


def test_documents_classify_and_flatten(spark, tmp_root):
    docs = [
        {"Meta Data": {"2. From Symbol": "EUR", "3. To Symbol": "USD"},
         "Time Series FX (Daily)": {
             "2024-01-02": {"1. open": "1.1", "2. high": "1.2", "3. low": "1.0", "4. close": "1.15"},
             "2024-01-01": {"1. open": "1.0", "2. high": "1.1", "3. low": "0.9", "4. close": "1.05"}}},
        {"Meta Data": {"2. From Symbol": "GBP", "3. To Symbol": "USD"}, "Note": "slow down",
         "Time Series FX (Daily)": {
             "2024-01-01": {"1. open": "1.3", "2. high": "1.4", "3. low": "1.2", "4. close": "1.35"}}},
        {"Error Message": "Invalid API call"},
        {"Meta Data": {"2. From Symbol": "NOK", "3. To Symbol": "USD"}},
        {"Time Series FX (Daily)": {
            "2024-01-01": {"1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1"}}},
    ]
    with open(f"{tmp_root}/docs.json", "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs))
    d = read_documents(spark, f"{tmp_root}/docs.json")
    status = sorted((r["from_symbol"] or "", r["status"], r["n_days"])
                    for r in classify_documents(d).collect())
    assert status == [("", "rejected", 0), ("", "rejected", 1), ("EUR", "accepted", 2),
                      ("GBP", "warning", 1), ("NOK", "rejected", 0)]
    counts = pipeline.run_documents(spark, f"{tmp_root}/docs.json", f"{tmp_root}/raw",
                                    ingest_ts="2024-02-01T00:00:00Z", source="provider")
    assert counts == {"documents": 5, "rejected": 3, "warnings": 1, "rows": 3}
    assert scan_raw_json(spark, f"{tmp_root}/raw").count() == 3
    flat = flatten_documents(d, ingest_ts="2024-02-01T00:00:00Z", source="provider")
    assert flat.columns == BRONZE_SCHEMA.fieldNames()
    rows = sorted((r["from_symbol"], r["date"], r["close"]) for r in flat.collect())
    assert rows == [("EUR", "2024-01-01", "1.05"), ("EUR", "2024-01-02", "1.15"),
                    ("GBP", "2024-01-01", "1.35")]


def test_unpartitioned_layer_is_clustered_by_pair(spark, tmp_root):
    rows = [b(f"2024-01-0{d}", "1.1", pair=(f"P{p}", "USD")) for p in range(6) for d in (1, 2)]
    root = f"{tmp_root}/flat"
    write_layer(bronze(spark, rows).repartition(3), root, partition_by=())
    df = scan_layer(spark, root).filter("pair = 'P3_USD'")
    assert "EqualTo(pair,P3_USD)" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["date"] for r in df.collect()) == ["2024-01-01", "2024-01-02"]
    assert not any(name.startswith("pair=") for name in os.listdir(root))


def test_layer_format_is_a_parameter(spark, tmp_root):
    df = bronze(spark, [b("2024-01-01", "1.1"), b("2024-01-01", "150", ("USD", "JPY"))])
    write_layer(df, f"{tmp_root}/orc", fmt="orc")
    back = scan_layer(spark, f"{tmp_root}/orc", fmt="orc", pairs=["EUR_USD"]).collect()
    assert [(r["pair"], r["close"]) for r in back] == [("EUR_USD", "1.1")]


def test_bronze_merge_keeps_history(spark, tmp_root):
    full = [b(f"2024-01-0{d}", "1.0") for d in range(1, 6)] + [b("2024-01-01", "150", ("USD", "JPY"))]
    write_raw_json(bronze(spark, full), f"{tmp_root}/raw1")
    root = f"{tmp_root}/bronze"
    assert pipeline.run_bronze(spark, f"{tmp_root}/raw1", root, run_ts="2024-02-01T00:00:00Z") == 6
    # a short delivery for EUR_USD: two days updated, one day new
    short = [b("2024-01-04", "2.0"), b("2024-01-05", "2.0"), b("2024-01-06", "2.0")]
    write_raw_json(bronze(spark, short), f"{tmp_root}/raw2")
    n = pipeline.run_bronze(spark, f"{tmp_root}/raw2", root, run_ts="2024-02-02T00:00:00Z",
                            merge=True)
    assert n == 6                                   # EUR_USD now holds 6 days
    got = {(r["pair"], r["date"]): r["close"] for r in scan_layer(spark, root).collect()}
    assert got == {("EUR_USD", "2024-01-01"): "1.0", ("EUR_USD", "2024-01-02"): "1.0",
                   ("EUR_USD", "2024-01-03"): "1.0", ("EUR_USD", "2024-01-04"): "2.0",
                   ("EUR_USD", "2024-01-05"): "2.0", ("EUR_USD", "2024-01-06"): "2.0",
                   ("USD_JPY", "2024-01-01"): "150"}
    # without merge the short delivery replaces the pair's history
    pipeline.run_bronze(spark, f"{tmp_root}/raw2", root, run_ts="2024-02-03T00:00:00Z")
    assert sorted(r["date"] for r in scan_layer(spark, root, pairs=["EUR_USD"]).collect()) == \
        ["2024-01-04", "2024-01-05", "2024-01-06"]


def test_array_files_when_pairs_span_many_splits(spark, tmp_root):
    rows = [b(f"2024-01-{d:02d}", f"1.{d}", pair=(f"P{p}", "USD")) for p in range(3)
            for d in range(1, 21)]
    df = bronze(spark, rows).repartition(5)           # every pair spread over 5 splits
    write_raw_json_arrays(df, f"{tmp_root}/arr")
    files = list(pathlib.Path(f"{tmp_root}/arr").rglob("*.txt"))
    assert len(files) > 3                               # one array per (pair, split)
    for f in files:
        assert len({r["from_symbol"] for r in json.loads(f.read_text())}) == 1
    back = scan_raw_json(spark, f"{tmp_root}/arr", multi_line=True).drop("pair").collect()
    assert sorted(tuple(r) for r in back) == sorted(tuple(r) for r in df.collect())


def test_array_files_grow_with_instruments_and_not_with_splits(spark, tmp_root):
    rows = [b(f"2024-01-{d:02d}", f"1.{d}", pair=(f"P{p}", "USD")) for p in range(40) for d in range(1, 9)]
    rows += [b(f"2024-02-{d:02d}", f"2.{d}", pair=("HOT", "USD")) for d in range(1, 29) for _ in range(10)]
    df = bronze(spark, rows).repartition(8)             # every pair spread over 8 splits of 75 rows
    write_raw_json_arrays(df, f"{tmp_root}/arr")
    held = [[r["from_symbol"] for r in json.loads(f.read_text())] for f in pathlib.Path(f"{tmp_root}/arr").rglob("*.txt")]
    assert all(len(set(h)) == 1 for h in held)
    assert sorted(h[0] for h in held if h[0] != "HOT") == sorted(f"P{p}" for p in range(40))   # one file each
    assert len([h for h in held if h[0] == "HOT"]) > 1 and max(map(len, held)) < 280           # a large one in several
    back = scan_raw_json(spark, f"{tmp_root}/arr", multi_line=True).drop("pair").collect()
    assert sorted(tuple(r) for r in back) == sorted(tuple(r) for r in df.collect())


def test_array_files_of_null_symbols_and_no_rows(spark, tmp_root):
    df = bronze(spark, [b("2024-01-01", "1.1"), b("2024-01-02", "1.2", pair=(None, "USD")),
                        b("2024-01-03", "1.3", pair=(None, None)), b("2024-01-04", "1.4", pair=(None, "USD"))])
    write_raw_json_arrays(df, f"{tmp_root}/arr")
    back = scan_raw_json(spark, f"{tmp_root}/arr", multi_line=True).drop("pair").collect()
    assert sorted(map(str, back)) == sorted(map(str, df.collect()))
    write_raw_json_arrays(df.limit(0), f"{tmp_root}/none")


def test_jobs_end_cleanly_on_no_rows_and_drop_what_is_gone(spark, tmp_root):
    from candlegap.plans import pipeline
    from candlegap.schemas import GOLD_SCHEMA, SILVER_SCHEMA

    bronze_root, silver_root, gold_root = (f"{tmp_root}/{x}" for x in ("b", "s", "g"))
    write_layer(bronze(spark, [b(f"2024-01-0{d}", f"{d}.0") for d in (1, 2, 3, 4)]), bronze_root)
    assert pipeline.run_silver(spark, bronze_root, silver_root) == 4
    assert pipeline.run_gold(spark, silver_root, gold_root, run_ts=T0.isoformat()) > 0
    write_layer(bronze(spark, [b(f"2024-01-0{d}", "0") for d in (1, 2, 3, 4)]), bronze_root)
    assert pipeline.run_silver(spark, bronze_root, silver_root) == 0
    assert pipeline.run_gold(spark, silver_root, gold_root, run_ts=T0.isoformat()) == 0
    assert scan_layer(spark, silver_root, schema=SILVER_SCHEMA).count() == 0
    assert scan_layer(spark, gold_root, schema=GOLD_SCHEMA).count() == 0


def test_pair_keys_do_not_collide(spark):
    from candlegap.sinks.files import with_pair

    rows = [("AB", "CUSD"), ("ABC", "USD"), ("abc", "usd"), ("A_B", "C"), ("A", "B_C")]
    keys = [r["pair"] for r in with_pair(spark.createDataFrame(rows, "from_symbol string, to_symbol string")).collect()]
    assert len(set(keys)) == 4 and keys[1] == keys[2] == "ABC_USD"


def test_later_delivery_wins_before_the_run_stamps(spark):
    from datetime import timedelta

    from candlegap.plans.pipeline import stamp_ingest

    rows = [b("2024-01-01", "2.0"), b("2024-01-01", "1.0", ts=T0 + timedelta(days=1))]
    out = stamp_ingest(bronze(spark, rows), "2024-02-01T00:00:00Z").collect()
    assert [r["close"] for r in out] == ["1.0"]


def test_merge_keeps_columns_that_came_later(spark, tmp_root):
    from candlegap.plans.pipeline import merge_into_bronze

    root = f"{tmp_root}/bronze"
    write_layer(bronze(spark, [b("2024-01-01", "1.0")]).withColumn("note", F.lit("kept")), root)
    out = merge_into_bronze(spark, bronze(spark, [b("2024-01-02", "1.1")]), root)
    assert {(r["date"], r["note"]) for r in out.collect()} == {("2024-01-01", "kept"), ("2024-01-02", None)}


# -- bucketed layout -----------------------------------------------------------

def many(spark, pairs=40, days=("2024-01-30", "2024-02-01", "2024-02-02")):
    return bronze(spark, [b(d, "1.1", pair=(f"P{p}", "USD")) for p in range(pairs) for d in days])


def test_folders_grow_with_buckets_and_months_not_with_instruments(spark, tmp_root):
    from candlegap.sinks import layout

    for writer, name in ((write_layer, "layer"), (write_raw_json, "raw")):
        root = f"{tmp_root}/{name}"
        writer(many(spark), root, buckets=4)
        assert folders(root) == {"n_buckets=4"} | {f"n_buckets=4/bucket={k}" for k in range(4)} | {
            f"n_buckets=4/bucket={k}/month={m}" for k in range(4) for m in (202401, 202402)}
        assert layout.stored_buckets(spark, root) == 4
        # later writers keep the number of buckets that the table has
        writer(bronze(spark, [b("2024-03-01", "2.0", pair=("P7", "USD"))]), root, buckets=16)
        assert layout.stored_buckets(spark, root) == 4
    got = scan_layer(spark, f"{tmp_root}/layer").groupBy("pair").count().collect()
    assert {r["pair"]: r["count"] for r in got} == {f"P{p}_USD": 1 if p == 7 else 3 for p in range(40)}
    raw = scan_raw_json(spark, f"{tmp_root}/raw", pairs=[("p7", "usd"), "P8_USD"])
    assert sorted((r["pair"], r["date"]) for r in raw.collect()) == [
        ("P7_USD", "2024-03-01"), ("P8_USD", "2024-01-30"), ("P8_USD", "2024-02-01"), ("P8_USD", "2024-02-02")]


def test_instruments_are_named_by_symbols_or_key(spark, tmp_root):
    import pytest

    root = f"{tmp_root}/layer"
    write_layer(bronze(spark, [b("2024-01-01", "1.1"), b("2024-01-01", "2", ("A_B", "c%")),
                               b("2024-01-01", "3", (None, "USD")), b("2024-01-01", "4", ("USD", None))]), root)
    assert scan_layer(spark, root, pairs=[("a_b", "C%")]).first()["close"] == "2"
    assert scan_layer(spark, root, pairs=["a%5Fb_C%25"]).first()["close"] == "2"
    assert scan_layer(spark, root, pairs=[]).count() == 0
    assert len({r["pair"] for r in scan_layer(spark, root).collect()}) == 4
    for wrong in ("EURUSD", "A_B_C", ("EUR",)):
        with pytest.raises(ValueError):
            scan_layer(spark, root, pairs=[wrong])


def test_replaced_instruments_lose_months_that_they_no_longer_have(spark, tmp_root):
    root = f"{tmp_root}/layer"
    write_layer(many(spark, pairs=6), root, buckets=2)
    write_layer(bronze(spark, [b("2024-02-05", "9", pair=(f"P{p}", "USD")) for p in range(6)]), root)
    assert not any("202401" in f for f in folders(root))
    assert {(r["date"], r["close"]) for r in scan_layer(spark, root).collect()} == {("2024-02-05", "9")}


def test_a_one_bar_batch_reads_and_rewrites_one_partition(spark, tmp_root):
    from candlegap.plans.pipeline import merge_into_bronze, write_merged

    root = f"{tmp_root}/bronze"
    write_layer(many(spark), root, buckets=4)
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(root).rglob("*.parquet")}
    batch = bronze(spark, [b("2024-02-01", "5.0", pair=("P7", "USD"))])
    merged = merge_into_bronze(spark, batch, root)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ = \d+.*month#\d+ = 202402", plan)
    scans = re.findall(r"Location: InMemoryFileIndex\((\d+) paths?\)", plan)
    assert scans and merged.count() < 30
    write_merged(spark, batch, root)
    after = {p: p.stat().st_mtime_ns for p in pathlib.Path(root).rglob("*.parquet")}
    gone, new = set(before) - set(after), set(after) - set(before)
    assert len({p.parent for p in gone}) == len({p.parent for p in new}) == 1
    assert {p.parent for p in gone} == {p.parent for p in new}
    rows = {(r["pair"], r["date"]): r["close"] for r in scan_layer(spark, root).collect()}
    assert len(rows) == 120 and rows[("P7_USD", "2024-02-01")] == "5.0"
    assert set(rows.values()) == {"1.1", "5.0"}


def test_a_failing_run_leaves_stored_rows(spark, tmp_root):
    import pytest

    bronze_root, silver_root = f"{tmp_root}/b", f"{tmp_root}/s"
    write_layer(bronze(spark, [b(f"2024-01-0{d}", f"{d}.0") for d in (1, 2, 3, 4)]), bronze_root)
    assert pipeline.run_silver(spark, bronze_root, silver_root) == 4
    for path in pathlib.Path(bronze_root).rglob("*.parquet"):
        path.write_bytes(b"broken")
    with pytest.raises(Exception):
        pipeline.run_silver(spark, bronze_root, silver_root, pairs=[("EUR", "USD")])
    assert scan_layer(spark, silver_root).count() == 4


def test_one_pair_end_to_end_and_empty_layers(spark, tmp_root):
    roots = [f"{tmp_root}/{x}" for x in ("b", "s", "g")]
    good = [b(f"2024-01-0{d}", f"{d}.0") for d in (1, 2, 3, 4)]
    write_layer(bronze(spark, [*good, *[b(f"2024-01-0{d}", "0", ("USD", "JPY")) for d in (1, 2, 3)]]), roots[0])
    pair = [("usd", "jpy")]
    run = pipeline.run_silver(spark, *roots[:2], pairs=pair)          # all bars rejected
    assert (run, run.read, run.rejected, run.written) == (0, 3, 3, 0)
    assert pipeline.run_gold(spark, *roots[1:], run_ts=T0.isoformat(), pairs=pair) == 0
    run = pipeline.run_silver(spark, *roots[:2], pairs=["EUR_USD"])
    assert (run, run.read, run.rejected, run.unique) == (4, 4, 0, 4)
    run = pipeline.run_gold(spark, *roots[1:], run_ts=T0.isoformat(), pairs=[("EUR", "USD")])
    assert run == 2 and run.read == 4
    assert pipeline.run_silver(spark, *roots[:2], pairs=pair) == 0     # the other pair stays
    # a table that lost all its rows is read and written like any other
    write_layer(bronze(spark, [b("2024-01-01", "0")]), roots[0], whole_table=True)
    assert pipeline.run_silver(spark, *roots[:2], pairs=["EUR_USD"]) == 0
    assert pipeline.run_gold(spark, *roots[1:], run_ts=T0.isoformat(), pairs=["EUR_USD"]) == 0
    write_layer(bronze(spark, good), roots[0], whole_table=True)
    assert pipeline.run_silver(spark, *roots[:2], pairs=["EUR_USD"]) == 4
    assert scan_layer(spark, roots[1], pairs=[("EUR", "USD")]).count() == 4


def test_checked_sinks_count_and_keep_what_they_refuse(spark, tmp_root):
    roots = [f"{tmp_root}/{x}" for x in ("b", "s", "rejects")]
    rows = [b("2024-01-01", "1.0"), b("2024-01-01", "1.0"), b("2024-01-02", "bad"), b("2024-01-03", "-1"),
            b("soon", "1.0"), b("2024-01-04", "2.0", (None, "USD"))]
    write_layer(bronze(spark, rows), roots[0])
    run = pipeline.run_silver(spark, *roots[:2], rejects_root=roots[2])
    assert run.counts == {"read": 6, "rejected": 3, "unique": 2, "violating": 1, "written": 1}
    kept = {(r["date"], r["open"], r["reject_reason"]) for r in scan_layer(spark, roots[2]).collect()}
    assert kept == {("2024-01-02", "bad", "missing_open"), ("2024-01-03", "-1", "non_positive_open"),
                    ("soon", "1.0", "missing_date"), ("2024-01-04", "2.0", "null_from_symbol")}
    write_layer(bronze(spark, [b("2024-01-01", "1.0")]), roots[0], whole_table=True)
    assert pipeline.run_silver(spark, *roots[:2], rejects_root=roots[2]).rejected == 0
    assert scan_layer(spark, roots[2], schema=BRONZE_SCHEMA).count() == 0


def test_raw_files_are_in_date_order_with_several_documents_a_pair(spark, tmp_root):
    rows = [b(f"2024-01-{d:02d}", "1.1", pair=(f"P{p}", "USD")) for d in range(28, 0, -1) for p in range(3)]
    write_raw_json(bronze(spark, rows).repartition(7), f"{tmp_root}/raw", buckets=2)
    for f in pathlib.Path(f"{tmp_root}/raw").rglob("*.json"):
        held = [json.loads(line) for line in f.read_text().splitlines()]
        assert [(r["from_symbol"], r["date"]) for r in held] == sorted((r["from_symbol"], r["date"]) for r in held)
