"""Data-quality rules, profiles and metric tables: one aggregate per table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class QualityRule:
    """``expression`` is a SQL predicate over the rows of ``table``; for uniqueness, the key columns."""

    rule_id: str
    table: str
    rule_type: str
    expression: str
    threshold: float = 100.0
    is_active: bool = True


# The default governance rules.
DEFAULT_RULES = (
    QualityRule("price_positive", "stocks", "validity", "price > 0", 100.0),
    QualityRule("amount_not_null", "transactions", "completeness", "amount IS NOT NULL", 100.0),
    QualityRule("currency_iso", "transactions", "validity", "length(currency) = 3", 100.0),
    QualityRule("rate_positive", "forex", "validity", "rate > 0", 100.0),
    QualityRule("ticker_unique", "companies", "uniqueness", "ticker", 100.0),
)


def _passed(rule: QualityRule) -> Column:
    if rule.rule_type == "uniqueness":
        return F.count_distinct(*[F.col(c.strip()) for c in rule.expression.split(",")])
    return F.count_if(F.expr(rule.expression))


def run_quality_rules(tables: dict[str, DataFrame], rules: Iterable[QualityRule] = DEFAULT_RULES) -> DataFrame:
    """Score of each active rule; all rules of a table share one scan of it.

    A rule that cannot be evaluated (missing table or column) is reported as failed
    and does not affect the others.
    """
    parts, broken = [], []
    active = [r for r in rules if r.is_active]
    for table in dict.fromkeys(r.table for r in active):
        usable = []
        for rule in (r for r in active if r.table == table):
            try:
                tables[table].agg(_passed(rule))  # resolves the names, runs nothing
                usable.append(rule)
            except Exception as error:
                broken.append((rule.rule_id, table, rule.rule_type, 0, 0, 0.0, rule.threshold, False, type(error).__name__))
        if not usable:
            continue
        row = tables[table].agg(
            F.count(F.lit(1)).alias("total"), *[F.coalesce(_passed(r), F.lit(0)).alias(f"r{i}") for i, r in enumerate(usable)]
        )
        outcomes = F.array(
            *[
                F.struct(
                    F.lit(r.rule_id).alias("rule_id"), F.lit(table).alias("table_name"), F.lit(r.rule_type).alias("rule_type"),
                    F.col("total").alias("total_records"), F.col(f"r{i}").alias("passed_records"),
                    F.lit(float(r.threshold)).alias("threshold"),
                )
                for i, r in enumerate(usable)
            ]
        )
        parts.append(row.select(F.inline(outcomes)))
    score = F.coalesce(F.try_divide(F.col("passed_records") * 100.0, F.col("total_records")), F.lit(100.0))
    columns = ["rule_id", "table_name", "rule_type", "total_records", "passed_records", "score", "threshold", "passed", "error"]
    results = []
    if parts:
        scored = reduce(DataFrame.unionByName, parts).withColumns(
            {"passed": score >= F.col("threshold"), "score": F.round(score, 2), "error": F.lit(None).cast("string")}
        )
        results.append(scored.select(*columns))
    if broken:
        schema = (
            "rule_id string, table_name string, rule_type string, total_records long, passed_records long, "
            "score double, threshold double, passed boolean, error string"
        )
        results.append(next(iter(tables.values())).sparkSession.createDataFrame(broken, schema))
    return reduce(DataFrame.unionByName, results)


def quality_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if("passed").alias("passed_rules"),
        F.count_if(~F.col("passed")).alias("failed_rules"),
        F.round(F.avg("score"), 2).alias("overall_score"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, as rows."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in df.columns])
    return row.select(F.inline(pairs))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys are equal to each other."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))


def freshness(df: DataFrame, ts: str, as_of: Column) -> DataFrame:
    """Whole seconds between the newest ``ts`` and ``as_of``."""
    newest = F.max(ts).cast("timestamp")
    return df.agg(F.timestamp_diff("SECOND", newest, as_of.cast("timestamp")).alias("seconds_since_update"))


def schema_violations(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Values per column that do not convert to the expected type."""
    def broken(column, kind):
        return F.count_if(F.col(column).isNotNull() & F.expr(f"try_cast({column} as {kind})").isNull())

    row = df.agg(*[broken(c, k).alias(c) for c, k in expected.items()])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("expected_type"), F.col(c).alias("violations")) for c, k in expected.items()]
    )
    return row.select(F.inline(pairs))


# Upper bounds in seconds of the stage and query duration histograms.
STAGE_BUCKETS = (0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0, 120.0)
DURATION_BUCKETS = (0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)


def duration_histogram(df: DataFrame, value: str, buckets: tuple[float, ...] = DURATION_BUCKETS, by: list[str] | None = None) -> DataFrame:
    """Cumulative bucket counts with sum and count, the +Inf bucket included; one pass, no row explosion."""
    bounds = [*buckets, float("inf")]
    keys = by or []
    row = df.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
        F.sum(value).alias("value_sum"),
        F.count(value).alias("value_count"),
    )
    label = lambda b: "+Inf" if b == float("inf") else str(b)
    pairs = F.array(*[F.struct(F.lit(label(b)).alias("le"), F.col(f"b{i}").alias("cumulative_count")) for i, b in enumerate(bounds)])
    return row.select(*keys, F.inline(pairs), "value_sum", "value_count")


def labelled_metrics(df: DataFrame, labels: list[str], measures: dict[str, Column]) -> DataFrame:
    """Gauges per label set as rows ``(metric, labels, value)``."""
    row = df.groupBy(*labels).agg(*[m.cast("double").alias(n) for n, m in measures.items()])
    text = F.concat_ws(",", *[F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit(""))) for name in labels])
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), text.alias("labels"), F.col(n).alias("value")) for n in measures])
    return row.select(F.inline(pairs))


def business_gauges(transactions: DataFrame, stocks: DataFrame, forex: DataFrame, companies: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    parts = [
        labelled_metrics(
            transactions, ["transaction_type", "status"],
            {"transaction_count": rows, "transaction_volume_eur": F.sum("amount_eur"), "transaction_avg_eur": F.avg("amount_eur")},
        ),
        labelled_metrics(stocks, ["symbol", "exchange"], {"stock_price": F.max_by("price", F.struct("timestamp", "price"))}),
        labelled_metrics(forex, ["currency_pair"], {"fx_rate": F.max_by("rate", "reference_date")}),
        labelled_metrics(companies, ["sector", "country"], {"company_count": F.count_distinct("ticker")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def stage_metrics(run_log: DataFrame) -> DataFrame:
    """Records, duration and status counts per stage and source of a run log."""
    return run_log.groupBy("stage", "source").agg(
        F.count(F.lit(1)).alias("run_count"),
        F.sum("records").alias("total_records"),
        F.sum("duration_seconds").alias("total_duration_seconds"),
        F.max("duration_seconds").alias("max_duration_seconds"),
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
    )


def change_log(before: DataFrame, after: DataFrame, key: str, table: str) -> DataFrame:
    """INSERT, UPDATE and DELETE rows between two snapshots, with old and new values as JSON."""
    def packed(df, side):
        columns = F.struct(*[F.col(c) for c in df.columns])
        return df.select(F.col(key), columns.alias(side))

    joined = packed(before, "old").join(packed(after, "new"), key, "full_outer")
    # structs compare field by field, nulls being equal
    changed = joined.filter(~F.col("old").eqNullSafe(F.col("new")))
    return changed.select(
        F.lit(table).alias("table_name"),
        F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "DELETE").otherwise("UPDATE").alias("operation"),
        F.col(key).cast("string").alias("record_id"),
        F.to_json("old").alias("old_values"),
        F.to_json("new").alias("new_values"),
    )
