"""The whole run order through the public API, on the smallest driver tables:
documents -> raw zone -> bronze -> silver -> gold -> SQL reports."""

from __future__ import annotations

from candlegap import catalog
from candlegap.plans import pipeline, reports
from candlegap.plans.named_reports import NAMED_REPORTS, register_views, run_named_report
from candlegap.sources import scan_layer

SF = "/root/testdata/sf0.001"
TS = "2024-02-01T00:00:00Z"


def test_documents_to_reports(spark, tmp_root):
    docs, raw = f"{tmp_root}/docs", f"{tmp_root}/raw"
    bronze, silver, gold = (f"{tmp_root}/{x}" for x in ("bronze", "silver", "gold"))
    # provider documents for every instrument (no bad documents here)
    catalog.bronze_to_documents(catalog.bronze(spark, SF)).write.json(docs)
    counts = pipeline.run_documents(spark, docs, raw, ingest_ts=TS, source="events")
    assert counts["rejected"] == 0 and counts["rows"] == 397
    assert pipeline.run_bronze(spark, raw, bronze, run_ts=TS) == 397
    assert pipeline.run_silver(spark, bronze, silver) == 397
    n_gold = pipeline.run_gold(spark, silver, gold, run_ts=TS)
    assert n_gold == 115                                   # 60 bullish + 55 bearish
    s = scan_layer(spark, silver).drop("pair")
    g = scan_layer(spark, gold).drop("pair")
    want = {r["fvg_type"]: tuple(r) for r in catalog.q_report_fill_rate(spark, SF).collect()}
    views = register_views(s, g, prefix="end_to_end")
    got = {r["fvg_type"]: tuple(r) for r in run_named_report(spark, "report_fill_rate", *views)
           .collect()}
    assert got == want
    for name in NAMED_REPORTS:
        assert run_named_report(spark, name, *views).count() > 0
    assert reports.gap_summary(g).first()["total_fvgs"] == n_gold
