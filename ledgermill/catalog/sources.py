"""Readers, raw-document parsers and sinks: written to scratch, read back, compared with their origin."""

from pyspark.sql import functions as F

from ledgermill.catalog.registry import query
from ledgermill.operators import silver
from ledgermill.plans.layers import rounded
from ledgermill.plans.oracle import view
from ledgermill.plans.triples import graph_quads
from ledgermill.session import scratch_path
from ledgermill.sources import raw, readers, writers


def _chart(d, previous=True):
    meta = F.struct(
        *([F.col("previous_close").alias("previousClose")] if previous else []),
        "symbol", F.upper("currency").alias("currency"), F.col("exchange").alias("exchangeName"),
        # some documents name the company in one field or the other, some not at all
        F.when(F.col("event_id") % 5 < 3, F.col("company_name")).alias("longName"),
        F.when(F.col("event_id") % 5 == 3, F.lower("company_name")).alias("shortName"),
        F.col("market_cap").alias("marketCap"), (F.col("current_price") + 10).alias("fiftyTwoWeekHigh"),
        (F.col("current_price") - 10).alias("fiftyTwoWeekLow"),
    )
    price, older = F.col("current_price"), F.col("previous_close")
    closes = F.when(F.col("event_id") % 89 == 0, F.array(F.lit(None).cast("double"))).otherwise(
        F.array(price + 1, older, F.lit(None).cast("double"), price, F.lit(None).cast("double"))
    )
    quote = F.struct(closes.alias("close"), F.array(F.lit(None).cast("long"), F.col("volume")).alias("volume"))
    result = F.struct(meta.alias("meta"), F.struct(F.array(quote).alias("quote")).alias("indicators"))
    document = F.struct(F.struct(F.array(result).alias("result")).alias("chart"))
    return d.quotes.select("event_id", "symbol", F.to_json(document, {"ignoreNullFields": "false"}).alias("raw"))


def _chart_sql(digits, previous):
    return f"""SELECT event_id, symbol, CASE WHEN mod(event_id, 5) < 3 THEN company_name WHEN mod(event_id, 5) = 3 THEN lower(company_name) ELSE symbol END AS company_name,
    round(current_price + 10, 4) AS fifty_two_week_high, round(current_price - 10, 4) AS fifty_two_week_low, exchange, upper(currency) AS currency, round(current_price, {digits}) AS current_price,
    round(prev, {digits}) AS previous_close, round(current_price - prev, {digits}) AS change,
    round(CASE WHEN prev <> 0 THEN (current_price - prev) / prev * 100 ELSE 0 END, {digits}) AS change_percent, volume, market_cap
    FROM (SELECT *, {previous} AS prev FROM quotes WHERE mod(event_id, 89) <> 0) q"""


@query("src_01_chart_daily", _chart_sql(2, "coalesce(previous_close, current_price + 1)"))
def _(d):
    return rounded(raw.parse_chart_quotes(_chart(d)))


@query("src_01_chart_daily_fallback", _chart_sql(2, "coalesce(previous_close, current_price + 1)"))
def _(d):
    return rounded(raw.parse_chart_quotes(_chart(d, previous=False)))


@query("src_01_chart_minute", _chart_sql(4, "current_price + 1"))
def _(d):
    return rounded(raw.parse_chart_quotes(_chart(d, previous=False), interval="1m"))


@query(
    "src_02_global_quote",
    """SELECT event_id, symbol, CAST(0 AS DOUBLE) AS open_price, current_price AS high_price, CAST(0 AS DOUBLE) AS low_price, current_price,
    volume, coalesce(previous_close, 0) AS previous_close, round(coalesce(change, 0), 4) AS change,
    round(coalesce(change_percent, 0), 4) AS change_percent FROM (SELECT * REPLACE (round(current_price, 4) AS current_price,
    round(previous_close, 4) AS previous_close) FROM quotes) q""",
)
def _(d):
    fields = F.create_map(
        F.lit("01. symbol"), F.col("symbol"), F.lit("03. high"), F.col("current_price").cast("string"),
        F.lit("05. price"), F.col("current_price").cast("string"), F.lit("06. volume"), F.col("volume").cast("string"),
        F.lit("08. previous close"), F.col("previous_close").cast("string"), F.lit("09. change"), F.col("change").cast("string"),
        F.lit("10. change percent"), F.concat(F.col("change_percent").cast("string"), F.lit("%")),
    )
    present = F.map_filter(fields, lambda k, v: v.isNotNull())
    parsed = raw.parse_global_quote(d.quotes.select("event_id", F.to_json(present).alias("raw")))
    return rounded(parsed)


@query(
    "src_03_time_series",
    """SELECT symbol, ts AS "timestamp", round(current_price, 4) AS open, round(current_price + 1, 4) AS high, round(current_price - 1, 4) AS low,
    round(current_price, 4) AS close, CAST(volume AS DOUBLE) AS volume FROM quotes
    UNION ALL SELECT symbol, ts + INTERVAL 1 SECOND, 1.0, 2.0, 0.5, 1.5, 10.0 FROM quotes""",
)
def _(d):
    price = F.col("current_price")

    def bar(values):
        pairs = [x for name, v in zip(("open", "high", "low", "close", "volume"), values) for x in (name, v)]
        keys = [F.lit(f"{i // 2 + 1}. {x}") if i % 2 == 0 else x.cast("string") for i, x in enumerate(pairs)]
        return F.create_map(*keys)

    second = (F.col("ts") + F.expr("interval 1 second")).cast("string")
    series = F.create_map(
        F.col("ts").cast("string"), bar([price, price + 1, price - 1, price, F.col("volume")]),
        second, bar([F.lit(1.0), F.lit(2.0), F.lit(0.5), F.lit(1.5), F.lit(10)]),
    )
    document = F.to_json(F.create_map(F.lit("Time Series (5min)"), series))
    return rounded(raw.explode_time_series(d.quotes.select("symbol", document.alias("raw"))))


@query(
    "src_04_fx_pair",
    """SELECT reference_date, base_currency AS from_currency, target_currency AS to_currency, round(rate, 4) AS exchange_rate,
    round(rate - 0.01, 4) AS bid_price, CAST(0 AS DOUBLE) AS ask_price FROM forex""",
)
def _(d):
    fields = F.create_map(
        F.lit("1. From_Currency Code"), F.col("base_currency"), F.lit("3. To_Currency Code"), F.col("target_currency"),
        F.lit("5. Exchange Rate"), F.col("rate").cast("string"), F.lit("8. Bid Price"), (F.col("rate") - 0.01).cast("string"),
    )
    document = F.to_json(F.create_map(F.lit("Realtime Currency Exchange Rate"), fields))
    return rounded(raw.parse_fx_pair(d.forex.select("reference_date", document.alias("raw"))))


@query("src_05_rate_history_xml", "SELECT base_currency, target_currency, rate, reference_date FROM forex WHERE target_currency <> 'CAD'")
def _(d):
    # both quote styles, and elements without a rate, which the reader must skip
    mark = F.when(F.dayofmonth("reference_date") % 2 == 0, "'").otherwise('"')
    rate = F.when(F.col("target_currency") != "CAD", F.concat(F.lit(" rate="), mark, F.col("rate").cast("string"), mark)).otherwise("")
    cube = F.concat(F.lit("<Cube currency="), mark, "target_currency", mark, rate, F.lit("/>"))
    # at most one element per currency and day
    days = d.forex.groupBy("reference_date").agg(F.concat_ws("", F.sort_array(F.collect_list(cube))).alias("cubes"))
    day = F.concat(F.lit("<Cube time="), mark, F.col("reference_date").cast("string"), mark, F.lit(">"), "cubes", F.lit("</Cube>"))
    path = scratch_path(d.spark, "rates-xml")
    days.select(day.alias("value")).write.text(path)
    return readers.read_rate_history(d.spark, path)


@query("src_06_flat_xml", "SELECT symbol, name, sector FROM listings")
def _(d):
    path = scratch_path(d.spark, "listings-xml")
    d.listings.select("symbol", "name", "sector").write.format("xml").option("rowTag", "company").option("rootTag", "companies").save(path)
    return readers.read_flat_xml(d.spark, path, "company", ["symbol", "name", "sector"])


@query(
    "src_07_multi_csv",
    """SELECT 'listings' AS _csv_source, symbol, name, sector, CAST(NULL AS STRING) AS ticker, CAST(NULL AS INTEGER) AS fiscal_year FROM listings
    UNION ALL SELECT 'filings', NULL, company_name, sector, ticker, fiscal_year FROM financials""",
)
def _(d):
    root = scratch_path(d.spark, "csv")
    writers.export_csv(d.listings.select("symbol", "name", "sector"), f"{root}/listings")
    writers.export_csv(d.financials.select(F.col("company_name").alias("name"), "sector", "ticker", "fiscal_year"), f"{root}/filings")
    files = {"listings": f"{root}/listings", "filings": f"{root}/filings", "absent": f"{root}/absent"}
    return readers.read_multi_csv(d.spark, files)


_JSON = "transaction_id string, amount double, status string, created_at timestamp_ntz"


@query("src_08_read_json", "SELECT transaction_id, round(amount, 4) AS amount, status, created_at FROM transactions")
def _(d):
    path = scratch_path(d.spark, "json")
    writers.write_jsonl(d.transactions.select("transaction_id", "amount", "status", "created_at"), path)
    return rounded(readers.read_json(d.spark, path, _JSON))


@query(
    "src_09_read_layer",
    "SELECT 'silver_forex' AS table_name, count(*) AS row_count FROM silver_forex UNION ALL SELECT 'silver_stocks', count(*) FROM silver_stocks",
)
def _(d):
    from ledgermill.operators.warehouse import layer_counts

    path = scratch_path(d.spark, "layer")
    tables = {"silver_stocks": d.silver_stocks, "silver_forex": d.silver_forex, "empty": d.silver_forex.filter("false")}
    writers.export_parquet(tables, path)
    return layer_counts(readers.read_layer(d.spark, path, list(tables)))


@query(
    "src_10_recent_rows",
    """SELECT transaction_id, sender_id, sender_name, sender_country, concat('IBAN', sender_id) AS sender_iban, sender_bank, receiver_id,
    receiver_name, receiver_country, concat('IBAN', receiver_id) AS receiver_iban, receiver_bank, round(amount, 4) AS amount, currency,
    round(amount_eur, 4) AS amount_eur, transaction_type, category AS description, concat('REF', transaction_id) AS reference, channel, status,
    is_cross_border, created_at, created_at + INTERVAL 1 DAY AS processed_at FROM transactions ORDER BY created_at DESC, transaction_id DESC LIMIT 1000""",
)
def _(d):
    # the operational store's columns that the input lacks are made up from those it has, alike in both texts
    rows = d.transactions.withColumns(
        {
            "sender_iban": F.concat(F.lit("IBAN"), "sender_id"), "receiver_iban": F.concat(F.lit("IBAN"), "receiver_id"),
            "description": F.col("category"), "reference": F.concat(F.lit("REF"), "transaction_id"),
            "processed_at": F.col("created_at") + F.expr("interval 1 day"),
        }
    )
    return rounded(readers.recent_rows(rows, readers.TRANSACTION_COLUMNS, "created_at", "transaction_id"))


@query("src_11_incremental", "SELECT event_id, user_id, ts, (SELECT max(event_id) FROM events) AS next_mark FROM events WHERE event_id > 0")
def _(d):
    batch, mark = readers.read_incremental(d.events.select("event_id", "user_id", "ts"), "event_id", 0)
    return batch.withColumn("next_mark", F.lit(mark))


@query("src_11_paged", "SELECT event_id, user_id, ts FROM events")
def _(d):
    # a key with many equal values, read in polls of a fixed size, all of them in one pass
    rows = d.events.select("event_id", "user_id", "ts")
    page, path = 2500, scratch_path(d.spark, "polls")
    batch, _ = readers.read_incremental(rows, "user_id", -1)
    polls = readers.cut_polls(batch, "user_id", page)
    polls.repartitionByRange("poll", "user_id").sortWithinPartitions("poll", "user_id").write.parquet(path)
    return d.spark.read.parquet(path).select(*rows.columns)


def _messages(d):
    text = F.to_json(F.struct("symbol", "exchange", "currency", F.col("current_price").alias("price"), "change_percent", "volume"))
    broken = F.col("event_id") % 53 == 0
    return d.quotes.select("event_id", F.when(broken, F.concat(F.lit("{broken "), text)).otherwise(text).alias("value"))


@query(
    "src_13_parse_messages",
    "SELECT event_id, symbol, exchange, currency, round(current_price, 4) AS current_price, volume FROM quotes WHERE mod(event_id, 53) <> 0",
)
def _(d):
    parsed = raw.good(raw.parse_messages(_messages(d), raw.STOCK_SCHEMA))
    return rounded(parsed.select("event_id", "symbol", "exchange", "currency", "current_price", "volume"))


@query("src_13_dead_letters", "SELECT count(*) AS dead, count(*) FILTER (WHERE mod(event_id, 53) = 0) AS marked FROM quotes WHERE mod(event_id, 53) = 0")
def _(d):
    letters = raw.dead_letters(raw.parse_messages(_messages(d), raw.STOCK_SCHEMA))
    return letters.agg(F.count(F.lit(1)).alias("dead"), F.count_if(F.col("message").startswith("{broken ")).alias("marked"))


@query(
    "src_14_stamp_metadata",
    "SELECT event_id, 'chart_api' AS _source, 'api' AS _source_type, TRUE AS _is_real_data, TRUE AS stamped FROM quotes",
)
def _(d):
    stamped = readers.stamp_metadata(d.quotes, "chart_api", "api", True)
    complete = F.col("_extracted_at").isNotNull() & F.col("_loaded_at").isNotNull()
    return stamped.select("event_id", "_source", "_source_type", "_is_real_data", complete.alias("stamped"))


@query("src_15_ntriples", "SELECT graph, s, p, o, o_kind, datatype, lang FROM quads")
def _(d):
    path = scratch_path(d.spark, "quads")
    readers.to_ntriples(graph_quads(d)).write.option("compression", "gzip").text(path)
    return readers.read_ntriples(d.spark, path, "data")


@query(
    "src_16_triplify",
    """SELECT concat('data:', symbol) AS s, 'rdf:type' AS p, 'onto:Stock' AS o, 'iri' AS o_kind, CAST(NULL AS STRING) AS datatype FROM listings WHERE symbol IS NOT NULL
    UNION ALL SELECT concat('data:', symbol), 'rdfs:label', name, 'literal', NULL FROM listings WHERE symbol IS NOT NULL
    UNION ALL SELECT concat('data:', symbol), 'onto:marketCap', CAST(CAST(market_cap AS BIGINT) AS STRING), 'literal', 'xsd:decimal' FROM listings
      WHERE symbol IS NOT NULL AND market_cap IS NOT NULL
    UNION ALL SELECT concat('data:', symbol), 'onto:belongsToSector', concat('data:', sector), 'iri', NULL FROM listings WHERE symbol IS NOT NULL""",
)
def _(d):
    rows = d.listings.filter(F.col("symbol").isNotNull())
    return readers.triplify(
        rows, F.concat(F.lit("data:"), "symbol"), "onto:Stock",
        {"rdfs:label": (F.col("name"), None), "onto:marketCap": (F.round("market_cap").cast("long"), "xsd:decimal")},
        {"onto:belongsToSector": F.concat(F.lit("data:"), "sector")},
    )


@query("snk_01_bronze", "SELECT transaction_id, currency, status, '20260110' AS run_ts FROM transactions")
def _(d):
    root = scratch_path(d.spark, "bronze")
    rows = d.transactions.select("transaction_id", "currency", "status")
    writers.write_bronze(rows, root, "sql", "transactions", "20260110")
    schema = "transaction_id string, currency string, status string, run_ts string"
    return d.spark.read.schema(schema).json(f"{root}/sql/transactions")


@query("snk_02_jsonl", "SELECT event_id, symbol, volume, ts FROM quotes")
def _(d):
    path = scratch_path(d.spark, "jsonl")
    writers.write_jsonl(d.quotes.select("event_id", "symbol", "volume", "ts"), path)
    return readers.read_json(d.spark, path, "event_id long, symbol string, volume long, ts timestamp_ntz")


@query("snk_03_replace_table", "SELECT currency_pair, reference_date FROM silver_forex")
def _(d):
    path = scratch_path(d.spark, "table")
    name = f"rates_{path.rsplit('-', 1)[1]}"
    return writers.replace_table(d.silver_forex.select("currency_pair", "reference_date"), name, path)


@query("snk_04_parquet", "SELECT transaction_id, tx_date, status FROM silver_transactions")
def _(d):
    path = scratch_path(d.spark, "export")
    writers.export_parquet({"silver": d.silver_transactions.select("transaction_id", "tx_date", "status")}, path)
    return d.spark.read.parquet(f"{path}/silver")


@query("snk_05_csv", "SELECT symbol, name, _csv_source FROM listings")
def _(d):
    path = scratch_path(d.spark, "csv")
    writers.export_csv(d.listings.select("symbol", "name", "_csv_source"), path)
    return d.spark.read.option("header", True).schema("symbol string, name string, _csv_source string").csv(path)


@query(
    "snk_06_xml",
    """SELECT target_currency AS currency, round(rate, 4) AS value, CAST(reference_date AS STRING) AS date, concat(target_currency, ' money') AS currency_name,
    'Unknown' AS region FROM forex""",
)
def _(d):
    path = scratch_path(d.spark, "rates")
    named = d.forex.withColumns({"currency_name": F.concat("target_currency", F.lit(" money")), "region": F.lit("Unknown")})
    writers.write_rates_xml(named, path)
    schema = "_currency string, _value double, _date string, currency_name string, region string"
    back = d.spark.read.format("xml").option("rowTag", "rate").schema(schema).load(path)
    return back.select(
        F.col("_currency").alias("currency"), F.round("_value", 4).alias("value"), F.col("_date").alias("date"), "currency_name", "region"
    )


@query(
    "snk_07_relational_shape",
    """SELECT event_id, symbol, CAST(market_cap AS BIGINT) AS market_cap, ts AS quote_time, current_price > 0 AS is_valid FROM quotes""",
)
def _(d):
    spaced = d.quotes.select(
        "event_id", "symbol", F.col("market_cap").alias("Market Cap"), F.col("ts").alias("Quote Time"),
        (F.col("current_price") > 0).alias("Is Valid"),
    )
    # zone-free again for the comparison; a relational sink takes the timestamp
    return writers.relational_shape(spaced).withColumn("quote_time", F.col("quote_time").cast("timestamp_ntz"))


@query(
    "snk_08_insert_if_absent",
    """SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    GROUP BY o_custkey UNION ALL SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'P'""",
)
def _(d):
    path = scratch_path(d.spark, "upsert")
    rows = d.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    rows.filter(F.col("o_orderstatus") == "P").drop("o_orderstatus").write.parquet(path)
    target = d.spark.read.parquet(path)
    writers.insert_if_absent(path, target, rows.drop("o_orderstatus"), ["o_custkey"], ["o_orderkey"])
    return d.spark.read.parquet(path)


@query(
    "jon_07_anti_insert",
    """SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def _(d):
    rows = d.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    target = rows.filter(F.col("o_orderstatus") == "P")
    return writers.absent_rows(target, rows, ["o_custkey"], ["o_orderkey"]).select("o_custkey")


@query(
    "set_03_widening_csv",
    """SELECT _csv_source, count(*) AS row_count, count(sector) AS with_sector, count(market_cap) AS with_cap FROM (
    SELECT _csv_source, CASE WHEN _csv_source = 'sp500' THEN sector END AS sector,
    CASE WHEN _csv_source = 'sp500' THEN NULL ELSE market_cap END AS market_cap FROM listings) l GROUP BY _csv_source""",
)
def _(d):
    root = scratch_path(d.spark, "csv")
    files, kinds = {}, {}
    for name in ("sp500", "gdp", "nasdaq", "nyse"):
        # each source has its own header, as the real files do
        extra, kind = ("sector", "string") if name == "sp500" else ("market_cap", "double")
        part = d.listings.filter(F.col("_csv_source") == name).select("listing_id", "symbol", "name", extra)
        files[name] = f"{root}/{name}"
        kinds[name] = f"listing_id long, symbol string, name string, {extra} {kind}"
        writers.export_csv(part, files[name])
    stacked = readers.read_multi_csv(d.spark, files, kinds)
    return stacked.groupBy("_csv_source").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("sector").alias("with_sector"), F.count("market_cap").alias("with_cap")
    )


@query(
    "snk_13_message_records",
    """SELECT transaction_id AS "key", concat('{"transaction_id":"', transaction_id, '","currency":"', currency, '","is_cross_border":', is_cross_border, '}') AS value
    FROM transactions""",
)
def _(d):
    return writers.to_message_records(d.transactions.select("transaction_id", "currency", "is_cross_border"), "transaction_id")
