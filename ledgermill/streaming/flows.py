"""Stateless and windowed stream operators; the row logic is the batch expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import market, money
from ledgermill.session import STATE_ON_DISK, scratch_path, settings
from ledgermill.sources import raw

Handler = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Route:
    """How the messages of a topic become rows: their JSON schema, the projection, and a field whose values are unique over all time.

    The projection must keep the key under its name.
    """

    schema: str
    rows: Handler
    key: str | None = None


def table_stream(spark: SparkSession, folder: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table of a data folder as a stream of its files."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # the trailing star makes a single file and a folder of files look alike
    return reader.parquet(f"{folder}/{table}.parquet*")


def stock_stream(messages: DataFrame) -> DataFrame:
    """JSON quotes to typed, enriched rows; malformed messages are left to the dead-letter route."""
    rows = raw.good(raw.parse_messages(messages, raw.STOCK_SCHEMA))
    return rows.withColumns(
        {
            "processing_time": F.current_timestamp(),
            "price_eur": money.fx_normalize(F.col("current_price"), F.col("currency")),
            "trend": market.trend(F.col("change_percent")),
            "is_anomaly": market.is_anomaly(F.col("change_percent"), F.col("volume")),
        }
    )


def transaction_stream(messages: DataFrame) -> DataFrame:
    rows = raw.good(raw.parse_messages(messages, raw.TRANSACTION_SCHEMA))
    amount = F.col("amount")
    return rows.withColumns(
        {
            "processing_time": F.current_timestamp(),
            "amount_eur": money.fx_normalize(amount, F.col("currency")),
            "risk_level": money.risk_level(amount, with_critical=True),
            "requires_aml_check": F.col("is_cross_border") & (amount > 5000),
        }
    )


def windowed_quotes(quotes: DataFrame, time: str = "processing_time", window: str = "1 minute", delay: str = "30 seconds") -> DataFrame:
    """Tumbling statistics per symbol and exchange; rows behind the watermark are dropped."""
    return (
        quotes.withWatermark(time, delay)
        .groupBy(F.window(time, window).alias("window"), "symbol", "exchange")
        .agg(
            F.avg("current_price").alias("avg_price"),
            F.max("current_price").alias("high_price"),
            F.min("current_price").alias("low_price"),
            F.sum("volume").alias("total_volume"),
            F.count(F.lit(1)).alias("quote_count"),
            F.avg("change_percent").alias("avg_change_pct"),
        )
    )


def throughput(rows: DataFrame, time: str, amount: str, seconds: int = 10, delay: str = "30 seconds") -> DataFrame:
    count = F.count(F.lit(1))
    return (
        rows.withWatermark(time, delay)
        .groupBy(F.window(time, f"{seconds} seconds").alias("window"))
        .agg(count.alias("tx_count"), F.sum(amount).alias("total_amount"), (count / F.lit(float(seconds))).alias("rate_per_second"))
    )


def unique_stream(rows: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """First arrival of each key; state is forgotten once the watermark has passed it."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


# ---- sinks -----------------------------------------------------------------------


def to_parquet(stream: DataFrame, path: str, checkpoint: str, name: str | None = None, available_now: bool = False):
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _started(writer, stream.sparkSession, available_now)


def _started(writer, spark: SparkSession, available_now: bool):
    with settings(spark, STATE_ON_DISK):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def to_console(stream: DataFrame, name: str = "output"):
    return stream.writeStream.outputMode("append").format("console").option("truncate", False).queryName(name).start()


def to_memory(stream: DataFrame, name: str, available_now: bool = True):
    """Small debugging sink: the rows end up on the driver."""
    writer = stream.writeStream.outputMode("append").format("memory").queryName(name)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def for_each_batch(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False):
    return _started(stream.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint), stream.sparkSession, available_now)


class Dispatcher:
    """Routes a message stream by topic to registered routes, each with its own table.

    :meth:`start` runs it. A batch is written once per route from one cached copy. Part folders are named by
    batch id and overwritten, so a batch replayed after a failure does not add rows twice.
    A malformed message goes to the table ``dead`` and counts as an error of its topic; a
    message of an unknown topic, or of none, goes to ``other``. So each message is found in one table,
    except that a route with a key keeps the first row of each key over all batches.

    Which keys came before is state of the stream itself: one entry per topic and key in the state store on disk, without
    expiry. A batch looks up its own keys and logs the new ones, so its work does not grow with the tables, which
    are never read, and a replayed batch starts from the state before it.
    """

    def __init__(self, root: str, default: Handler | None = None):
        self.root = root
        self.routes: dict[str, Route] = {}
        self.default = default

    def on(self, topic: str, route: Route) -> Dispatcher:
        self.routes[topic] = route
        return self

    def table(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def start(self, messages: DataFrame, checkpoint: str, available_now: bool = False):
        """Run on a stream of ``topic``, ``key`` and ``value``."""
        return for_each_batch(self.marked(messages), self, checkpoint, available_now)

    def marked(self, messages: DataFrame) -> DataFrame:
        """All messages, and once more, marked as ``_first``, each that brings a new key to its route."""
        columns = [F.col(c).cast("string").alias(c) for c in ("topic", "key", "value")]
        every = messages.select(*columns, F.lit(False).alias("_first"))
        ids = [
            F.when(F.col("topic") == topic, raw.message_field(F.col("value"), route.schema, route.key))
            for topic, route in self.routes.items() if route.key
        ]
        if not ids:
            return every
        keyed = messages.select(*columns, F.coalesce(*ids).alias("_id")).filter(F.col("_id").isNotNull())
        first = keyed.dropDuplicates(["topic", "_id"]).select("topic", "key", "value", F.lit(True).alias("_first"))
        return every.unionByName(first)

    def __call__(self, marked: DataFrame, batch_id: int) -> None:
        marked = marked.persist()
        try:
            batch, first = marked.filter(~F.col("_first")).drop("_first"), marked.filter("_first")
            dead = []
            for topic, route in self.routes.items():
                parsed = self._parsed(batch, topic)
                rows = route.rows(raw.good(parsed))
                if route.key:
                    new = route.rows(raw.good(self._parsed(first, topic)))
                    rows = new.unionByName(rows.filter(F.col(route.key).isNull()))
                rows.write.mode("overwrite").parquet(f"{self.table(topic)}/batch={batch_id}")
                dead.append(raw.dead_letters(parsed).withColumn("topic", F.lit(topic)))
            letters = reduce(DataFrame.unionByName, dead) if dead else batch.filter("false").select("topic", F.col("value").alias("message"))
            letters.write.mode("overwrite").parquet(f"{self.table('dead')}/batch={batch_id}")
            if self.default is not None:
                known = F.coalesce(F.col("topic").isin(*self.routes), F.lit(False))
                self.default(batch.filter(~known)).write.mode("overwrite").parquet(f"{self.table('other')}/batch={batch_id}")
            errors = batch.sparkSession.read.parquet(f"{self.table('dead')}/batch={batch_id}").groupBy("topic").agg(F.count(F.lit(1)).alias("errors"))
            counts = batch.groupBy("topic").agg(F.count(F.lit(1)).alias("messages")).join(errors, "topic", "left")
            counts = counts.withColumn("errors", F.coalesce("errors", F.lit(0)))
            counts.write.mode("overwrite").parquet(f"{self.table('counts')}/batch={batch_id}")
        finally:
            marked.unpersist()

    def _parsed(self, batch: DataFrame, topic: str) -> DataFrame:
        return raw.parse_messages(batch.filter(F.col("topic") == topic).select("key", "value"), self.routes[topic].schema)

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return spark.read.parquet(self.table(topic)).drop("batch")


def fan_out(outputs: dict[str, Handler], root: str) -> Callable[[DataFrame, int], None]:
    """One source, several outputs: every output writes its own view of the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, view in outputs.items():
                view(batch).write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def _moment():
    """The message's own time, else now."""
    return F.coalesce("timestamp", F.current_timestamp().cast("string")).alias("timestamp")


def _stock_rows(rows: DataFrame) -> DataFrame:
    """Missing provenance counts as live market data."""
    return rows.select(
        "symbol", F.col("current_price").alias("price"), "previous_close", "change", "change_percent", "volume", "currency",
        "exchange", "market_state", F.coalesce("_source", F.lit("kafka")).alias("source"),
        F.coalesce("_real_data", F.lit(True)).alias("is_real_data"), _moment(),
    )


def _transaction_rows(rows: DataFrame) -> DataFrame:
    """Missing provenance counts as simulated."""
    return rows.select(
        "transaction_id", "amount", "currency", "transaction_type", "status", "sender_id", "receiver_id",
        F.coalesce("_source", F.lit("kafka")).alias("source"), F.coalesce("_real_data", F.lit(False)).alias("is_real_data"), _moment(),
    )


def _anomaly_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("type").alias("anomaly_type"), "symbol", "value", "severity", "message", "z_score", F.col("mean").alias("mean_value"),
        "threshold", "detection_method", _moment(),
    )


def _forex_rows(rows: DataFrame) -> DataFrame:
    return rows.select("base_currency", "target_currency", "rate", "reference_date", F.coalesce("_source", F.lit("kafka")).alias("source"), _moment())


stock_route = Route(f"{raw.STOCK_SCHEMA}, market_state string, _real_data boolean", _stock_rows)
transaction_route = Route(
    f"{raw.TRANSACTION_SCHEMA}, sender_id string, receiver_id string, _source string, _real_data boolean", _transaction_rows, "transaction_id"
)
anomaly_route = Route(
    "type string, symbol string, value double, severity string, message string, z_score double, mean double, threshold double, "
    "detection_method string, timestamp string",
    _anomaly_rows,
)
forex_route = Route("base_currency string, target_currency string, rate double, reference_date string, _source string, timestamp string", _forex_rows)


def drain(stream: DataFrame, label: str, checkpoint: str | None = None, path: str | None = None, name: str | None = None) -> DataFrame:
    """Run a stream over everything available, into parquet, and return the table."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    query = to_parquet(stream, path, checkpoint or scratch_path(spark, f"{label}-checkpoint"), name, available_now=True)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def drain_batches(stream: DataFrame, action: Callable[[DataFrame, int], None], label: str) -> None:
    for_each_batch(stream, action, scratch_path(stream.sparkSession, f"{label}-checkpoint"), available_now=True).awaitTermination()

