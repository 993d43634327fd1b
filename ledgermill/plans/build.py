"""The layered build: writes every table and reports what was written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgermill.operators import gold
from ledgermill.plans.layers import Layers
from ledgermill.session import scratch_path

STAGES = ("silver", "gold", "dimensions", "facts")

# tables that grow with time are laid out by month, so a date filter prunes folders
MONTH_OF = {"silver_transactions": "year(tx_date) * 100 + month(tx_date)", "fact_transactions": "date_sk div 100"}


def _plan(layers: Layers) -> dict[str, tuple[str, Callable[[], DataFrame]]]:
    """Table name to (stage, frame); later stages read what earlier ones wrote."""
    return {
        "silver_stocks": ("silver", lambda: layers.silver_stocks),
        "silver_forex": ("silver", lambda: layers.silver_forex),
        "silver_financials": ("silver", lambda: layers.silver_financials),
        "silver_transactions": ("silver", lambda: layers.silver_transactions),
        "gold_daily_market": ("gold", lambda: layers.gold_daily_market),
        "gold_tx_summary": ("gold", lambda: layers.gold_tx_summary),
        "dim_company": ("dimensions", lambda: layers.dim_company),
        "dim_currency": ("dimensions", lambda: gold.dim_currency_history(layers.silver_forex)),
        "dim_date": ("dimensions", lambda: layers.dim_date),
        "fact_transactions": ("facts", lambda: layers.fact_transactions),
    }


def build_tables(layers: Layers, target: str | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """Write each layer as parquet below ``target``; one status row per table.

    A failing table is reported and does not stop the others. Row counts are
    observed while writing, so no table is scanned again to count it, and a silver
    table is read back from its files by the stages above it.
    """
    spark = layers.spark
    target = target or scratch_path(spark, "layers")
    report = []
    for name, (stage, frame) in _plan(layers).items():
        if stage in skip:
            report.append((name, "skipped", 0))
            continue
        seen = Observation(name)
        path = f"{target}/{stage}/{name}"
        try:
            rows = frame().observe(seen, F.count(F.lit(1)).alias("rows"))
            if name in MONTH_OF:
                # rebalance keeps a month together but splits one that is too large for a task
                by_month = rows.withColumn("month_key", F.expr(MONTH_OF[name]).cast("int")).hint("rebalance", "month_key")
                by_month.write.mode("overwrite").partitionBy("month_key").parquet(path)
            else:
                rows.write.mode("overwrite").parquet(path)
            report.append((name, "success", seen.get["rows"]))
            if stage == "silver":
                layers.__dict__[name] = spark.read.parquet(path)
        except Exception as error:  # one broken table must not stop the rest
            report.append((name, f"failed: {type(error).__name__}", 0))
    return spark.createDataFrame(report, "table_name string, status string, record_count long")
