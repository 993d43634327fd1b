"""Detectors and cooldown over unbounded streams, as the batch operators on micro-batches.

Each runs in ``foreachBatch``: what later batches need of earlier ones (the last rows of each key, or the moment a
rule is free again) is a small table in a folder named by the batch id. A batch reads its predecessor's table, so a
replayed batch gives the same rows and overwrites its own folders. The frames come from ``carried_frames``, which splits
a hot key over tasks. Across batches rows count in order of arrival, inside a batch by time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from ledgermill.operators import anomaly
from ledgermill.operators.cooldown import cooldown
from ledgermill.operators.ordered import carried_frames


class _Folders:
    """Results and carried rows of the micro-batches under one root."""

    def __init__(self, root: str):
        self.root = root

    def carried(self, spark: SparkSession, batch_id: int, schema: str) -> DataFrame:
        """What the batch before ``batch_id`` left; nothing before the first."""
        if batch_id == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.root}/carried/{batch_id - 1}")

    def write(self, batch_id: int, out: DataFrame, carry: DataFrame) -> None:
        out.write.mode("overwrite").parquet(f"{self.root}/out/batch={batch_id}")
        carry.write.mode("overwrite").parquet(f"{self.root}/carried/{batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/out").drop("batch")


class RollingDetector(_Folders):
    """Hits of each batch, judged by frames over its rows and the ``preceding`` rows of every key before it.

    Only the batch is sorted. Carried rows are attached to the rows that can see them, and the next ones follow from the
    numbers that sorting gave, so a batch costs its own rows and one pass over the carried table.
    """

    def __init__(
        self, root: str, keys: list[str], order: list[str], columns: list[str], preceding: int, include_current: bool,
        frames: Callable[[WindowSpec], dict[str, Column]], hits: Callable[[DataFrame], DataFrame],
    ):
        super().__init__(root)
        self.keys, self.order, self.columns = keys, order, [*dict.fromkeys([*keys, *order, *columns])]
        self.preceding, self.include_current, self.frames, self.hits = preceding, include_current, frames, hits

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*self.columns).persist()
        try:
            schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "_back long"])
            before = self.carried(batch.sparkSession, batch_id, schema)
            frames, tail = carried_frames(
                rows, before, self.keys, self.order, self.preceding, self.frames, self.include_current
            )
            self.write(batch_id, self.hits(frames), tail)
        finally:
            rows.unpersist()


def price_and_volume_anomalies(root: str, window: int = 50, minimum: int = 10, limit: float = 2.5, times: float = 3.0) -> RollingDetector:
    """Price and volume anomalies against the previous ``window`` quotes of the symbol."""

    def hits(stats: DataFrame) -> DataFrame:
        return anomaly.price_and_volume_hits(stats, minimum, limit, times)

    columns = ["current_price", "volume"]
    return RollingDetector(root, ["symbol"], ["ts", "event_id"], columns, window, False, anomaly.quote_frames(), hits)


def transaction_anomalies(root: str, key: str, window: int = 200, minimum: int = 20, sigmas: float = 3.0, limit: float = 10000.0) -> RollingDetector:
    """Large payments against the last ``window`` payments of the key, the current one included."""
    order = ["created_at", "tx_key"]

    def hits(stats: DataFrame) -> DataFrame:
        return anomaly.large_amounts(stats, minimum, sigmas, limit, order, keep=(key,))

    return RollingDetector(root, [key], order, ["transaction_id", "amount"], window - 1, True, anomaly.amount_frames, hits)


class CooledAlerts(_Folders):
    """Rule hits ``(rule, point_id, ts)`` that fire; carried is the moment each rule may fire again."""

    def __init__(self, root: str, minutes: int = 5):
        super().__init__(root)
        self.minutes = minutes

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        hits = batch.select("rule", "point_id", "ts")
        schema = f"rule string, free {hits.schema['ts'].dataType.simpleString()}"
        free = self.carried(batch.sparkSession, batch_id, schema)  # one row per rule
        ready = hits.join(free, "rule", "left").filter(F.col("free").isNull() | (F.col("ts") >= F.col("free"))).drop("free")
        fired = cooldown(ready, self.minutes, tie=["point_id"]).persist()
        try:
            wait = F.expr(f"interval {self.minutes} minutes")
            moments = fired.select("rule", (F.col("ts") + wait).alias("free")).unionByName(free)
            self.write(batch_id, fired, moments.groupBy("rule").agg(F.max("free").alias("free")))
        finally:
            fired.unpersist()
