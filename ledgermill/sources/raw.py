"""Parsers of raw quote and rate documents, one document per row, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _once(parsed: Column, name: str) -> Column:
    """``parsed`` as a generated column.

    Filters on a projected column are pushed below the projection and would parse
    every document a second time; they are not pushed below a generator.
    """
    return F.explode_outer(F.array(parsed)).alias(name)


_META = (
    "symbol:string, previousClose:double, currency:string, exchangeName:string, longName:string, shortName:string, marketCap:bigint, "
    "fiftyTwoWeekHigh:double, fiftyTwoWeekLow:double"
)
CHART_SCHEMA = (
    f"chart struct<result:array<struct<meta:struct<{_META}>,"
    "indicators:struct<quote:array<struct<close:array<double>,volume:array<bigint>>>>>>>"
)


def parse_chart_quotes(raw: DataFrame, document: str = "raw", interval: str = "1d") -> DataFrame:
    """One quote per chart document; documents without a close price give no row.

    Without a stated previous close, daily charts use the second-to-last close and
    minute charts the first one. Daily figures have 2 digits, minute figures 4.
    """
    daily = interval == "1d"
    digits = 2 if daily else 4
    kept = [c for c in raw.columns if c != document]
    result = F.try_element_at(F.from_json(document, CHART_SCHEMA)["chart"]["result"], F.lit(1))
    docs = raw.select(*kept, _once(result, "_doc")).withColumns(
        {
            "_meta": F.col("_doc.meta"),
            "_quote": F.try_element_at(F.col("_doc.indicators.quote"), F.lit(1)),
        }
    )
    docs = docs.withColumns(
        {
            "_closes": F.filter("_quote.close", lambda x: x.isNotNull()),
            "_volumes": F.filter("_quote.volume", lambda x: x.isNotNull()),
        }
    ).filter(F.size("_closes") > 0)
    last = F.try_element_at("_closes", F.lit(-1))
    fallback = F.coalesce(F.try_element_at("_closes", F.lit(-2)), last) if daily else F.try_element_at("_closes", F.lit(1))
    docs = docs.withColumns({"_last": last, "_previous": F.coalesce("_meta.previousClose", fallback)})
    change = F.col("_last") - F.col("_previous")
    # a minute chart without a positive previous close reports no change at all
    usable = F.col("_previous") != 0 if daily else F.col("_previous") > 0
    percent = F.when(usable, F.try_divide(change, F.col("_previous")) * 100).otherwise(0.0)
    return docs.select(
        *kept,
        F.coalesce("_meta.longName", "_meta.shortName", "_meta.symbol").alias("company_name"),
        F.coalesce("_meta.exchangeName", F.lit("Unknown")).alias("exchange"),
        F.coalesce("_meta.currency", F.lit("USD")).alias("currency"),
        F.round("_last", digits).alias("current_price"),
        F.round("_previous", digits).alias("previous_close"),
        F.round(change if daily else F.when(usable, change).otherwise(0.0), digits).alias("change"),
        F.round(percent, digits).alias("change_percent"),
        F.coalesce(F.try_element_at("_volumes", F.lit(-1)), F.lit(0)).alias("volume"),
        F.col("_meta.marketCap").alias("market_cap"),
        F.col("_meta.fiftyTwoWeekHigh").alias("fifty_two_week_high"),
        F.col("_meta.fiftyTwoWeekLow").alias("fifty_two_week_low"),
    )


def _number(fields: Column, key: str, kind: str = "double") -> Column:
    text = F.coalesce(F.try_element_at(fields, F.lit(key)), F.lit("0"))
    return F.regexp_replace(text, "%", "").cast(kind)


def parse_global_quote(raw: DataFrame, document: str = "raw") -> DataFrame:
    """Flat quote with numbered keys; a missing number is 0 and percent signs are dropped."""
    q = F.col("_q")
    kept = [c for c in raw.columns if c != document]
    return raw.select(*kept, _once(F.from_json(document, "map<string,string>"), "_q")).select(
        *kept,
        F.try_element_at(q, F.lit("01. symbol")).alias("symbol"),
        _number(q, "02. open").alias("open_price"),
        _number(q, "03. high").alias("high_price"),
        _number(q, "04. low").alias("low_price"),
        _number(q, "05. price").alias("current_price"),
        _number(q, "06. volume", "bigint").alias("volume"),
        _number(q, "08. previous close").alias("previous_close"),
        _number(q, "09. change").alias("change"),
        _number(q, "10. change percent").alias("change_percent"),
    )


def explode_time_series(raw: DataFrame, interval: str = "5min", document: str = "raw") -> DataFrame:
    """Rows of an object keyed by timestamp: open, high, low, close, volume per moment."""
    series = F.get_json_object(document, f"$['Time Series ({interval})']")
    kept = [c for c in raw.columns if c != document]
    moments = F.from_json(series, "map<string,map<string,string>>")
    rows = raw.select(*kept, F.explode_outer(moments).alias("moment", "v")).filter(F.col("moment").isNotNull())
    names = ("open", "high", "low", "close", "volume")
    return rows.select(
        *kept,
        F.col("moment").cast("timestamp_ntz").alias("timestamp"),
        *[F.try_element_at("v", F.lit(f"{i}. {n}")).cast("double").alias(n) for i, n in enumerate(names, 1)],
    )


def parse_fx_pair(raw: DataFrame, document: str = "raw") -> DataFrame:
    fields = F.from_json(
        F.get_json_object(document, "$['Realtime Currency Exchange Rate']"), "map<string,string>"
    )
    q = F.col("_q")
    kept = [c for c in raw.columns if c != document]
    return raw.select(*kept, _once(fields, "_q")).filter(q.isNotNull()).select(
        *kept,
        F.try_element_at(q, F.lit("1. From_Currency Code")).alias("from_currency"),
        F.try_element_at(q, F.lit("3. To_Currency Code")).alias("to_currency"),
        _number(q, "5. Exchange Rate").alias("exchange_rate"),
        _number(q, "8. Bid Price").alias("bid_price"),
        _number(q, "9. Ask Price").alias("ask_price"),
    )


STOCK_SCHEMA = (
    "symbol string, company_name string, exchange string, currency string, current_price double, price double, previous_close double, "
    "change double, change_percent double, volume bigint, market_cap bigint, timestamp string, _source string, _timestamp string"
)
TRANSACTION_SCHEMA = (
    "transaction_id string, amount double, currency string, sender_country string, receiver_country string, transaction_type string, "
    "status string, is_cross_border boolean, timestamp string, _timestamp string"
)


def parse_messages(raw: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Typed columns of JSON messages plus ``_malformed`` (the text, when it is not valid JSON of that shape).

    Works on a batch or a stream. Producers name the price differently, so
    ``current_price`` falls back to ``price``.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    kept = [c for c in raw.columns if c != value]
    text = F.col(value).cast("string")
    parsed = _once(F.from_json(text, f"{schema}, _malformed string", options), "data")
    rows = raw.select(*kept, parsed).select(*kept, "data.*")
    if "current_price" in rows.columns and "price" in rows.columns:
        rows = rows.withColumn("current_price", F.coalesce("current_price", "price")).drop("price")
    return rows


def message_field(value: Column, schema: str, field: str) -> Column:
    """One field of a JSON message as text; null where the message is not of that shape or has no such value."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    data = F.from_json(value.cast("string"), f"{schema}, _malformed string", options)
    return F.when(data["_malformed"].isNull(), data[field].cast("string"))


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_malformed").isNull()).drop("_malformed")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_malformed").isNotNull()).select(F.col("_malformed").alias("message"))
