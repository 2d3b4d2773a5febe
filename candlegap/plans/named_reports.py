"""The six reports over layers that the session knows by name (views or catalog tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlegap.plans import reports

SILVER_NAME, GOLD_NAME = "silver_bars", "gold_gaps"

#: report -> what it computes from the (silver, gold) tables
NAMED_REPORTS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "report_gaps_by_size": lambda silver, gold: reports.report_gaps_by_size(gold),
    "report_active_gaps": lambda silver, gold: reports.report_active_gaps(gold),
    "report_fill_rate": lambda silver, gold: reports.report_fill_rate(gold),
    "report_monthly_activity": lambda silver, gold: reports.report_monthly_activity(gold),
    "report_volatility": lambda silver, gold: reports.report_volatility(silver, gold),
    "report_largest_moves": lambda silver, gold: reports.report_largest_moves(silver),
}


def register_views(silver: DataFrame, gold: DataFrame, *, prefix: str = "") -> tuple[str, str]:
    """Temporary views of the layers; returns their names. ``prefix`` keeps them apart from
    views of the session's own."""
    names = tuple(f"{prefix}_{n}" if prefix else n for n in (SILVER_NAME, GOLD_NAME))
    silver.createOrReplaceTempView(names[0])
    gold.createOrReplaceTempView(names[1])
    return names


def run_named_report(spark: SparkSession, name: str, silver: str = SILVER_NAME,
                     gold: str = GOLD_NAME) -> DataFrame:
    return NAMED_REPORTS[name](spark.table(silver), spark.table(gold))
