"""Registration of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgermill.plans.layers import Layers
from ledgermill.plans.oracle import assemble

RUNNERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(layers) -> DataFrame`` under ``name`` with its reference SQL."""

    def add(fn: Callable[[Layers], DataFrame]):
        if name in RUNNERS:
            raise ValueError(f"query {name} is already registered")
        RUNNERS[name] = lambda spark, folder: fn(Layers(spark, folder))
        if sql is not None:
            ORACLES[name] = assemble(sql)
        return fn

    return add
