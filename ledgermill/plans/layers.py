"""The layered build: staging, silver, gold, dimensions and facts."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.operators import gold, silver
from ledgermill.plans.inputs import Inputs

_STAMPS = ("_extracted_at", "_source", "_loaded_at", "_transformed_at", "_layer")


class Layers(Inputs):
    """Every layer as a lazy DataFrame over one data folder."""

    @cached_property
    def silver_stocks(self) -> DataFrame:
        # event_id rides along as the tie-breaker of equal timestamps
        return silver.silver_stocks(self.quotes).drop(*_STAMPS)

    @cached_property
    def silver_forex(self) -> DataFrame:
        return silver.silver_forex(self.forex).drop(*_STAMPS)

    @cached_property
    def silver_financials(self) -> DataFrame:
        return silver.silver_financials(self.listings).drop(*_STAMPS)

    @cached_property
    def silver_transactions(self) -> DataFrame:
        return silver.silver_transactions(self.transactions).drop(*_STAMPS)

    @cached_property
    def gold_daily_market(self) -> DataFrame:
        return gold.daily_market(self.silver_stocks)

    @cached_property
    def gold_tx_summary(self) -> DataFrame:
        return gold.tx_summary(self.silver_transactions)

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(gold.covering_years(self.orders, "o_orderdate"))

    @cached_property
    def dim_company(self) -> DataFrame:
        return gold.dim_company(self.silver_financials)

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return gold.fact_transactions(self.silver_transactions)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for reporting, other columns untouched."""
    return df.select(*[F.round(n, digits).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])
