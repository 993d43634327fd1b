"""Raw documents, readers and streams on literal rows."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import anomaly
from ledgermill.session import scratch_path, scratch_root
from ledgermill.sources import raw, readers, writers
from ledgermill.streaming import flows, progress, stateful

T0 = datetime(2024, 1, 1)


def chart(closes, volumes=(), **meta):
    return json.dumps({"chart": {"result": [{"meta": meta, "indicators": {"quote": [{"close": closes, "volume": list(volumes)}]}}]}})


def documents(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "symbol string, raw string")


def test_chart_documents(spark):
    docs = documents(
        spark,
        chart([10.0, None, 12.0, None], [5, None], previousClose=10.0, currency="EUR"),
        chart([10.0, 11.0, 12.0]),
        chart([12.0], previousClose=0.0),
        chart([None, None], [1]),
        "not json",
        '{"chart": {"result": []}}',
    )
    rows = {r.symbol: r for r in raw.parse_chart_quotes(docs).collect()}
    assert set(rows) == {"0", "1", "2"}
    assert (rows["0"].current_price, rows["0"].change_percent, rows["0"].volume, rows["0"].exchange) == (12.0, 20.0, 5, "Unknown")
    assert (rows["1"].previous_close, rows["1"].currency, rows["1"].volume) == (11.0, "USD", 0)
    assert (rows["2"].change, rows["2"].change_percent) == (12.0, 0.0)
    minute = {r.symbol: r for r in raw.parse_chart_quotes(docs, interval="1m").collect()}
    assert minute["1"].previous_close == 10.0
    assert (minute["2"].change, minute["2"].change_percent) == (0.0, 0.0)


def test_messages_fall_back_to_price_and_route_malformed(spark):
    frame = spark.createDataFrame([('{"symbol":"a","price":2.5}',), ('{"symbol":"b","current_price":3.5,"price":1}',), ("{oops",)], "value string")
    parsed = raw.parse_messages(frame, raw.STOCK_SCHEMA)
    assert [(r.symbol, r.current_price) for r in raw.good(parsed).collect()] == [("a", 2.5), ("b", 3.5)]
    assert [r.message for r in raw.dead_letters(parsed).collect()] == ["{oops"]


def test_rate_history_tolerates_quotes_and_gaps(spark):
    path = scratch_path(spark, "xml")
    text = """<?xml version="1.0"?><Envelope><Cube>
<Cube time="2026-01-10"><Cube currency="USD" rate="1.0825"/><Cube rate='0.86' currency='GBP'/><Cube currency="JPY"/></Cube>
<Cube time='2026-01-09'><Cube currency="USD" rate="1.08"/></Cube></Cube></Envelope>"""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    rows = sorted((str(r.reference_date), r.target_currency, r.rate) for r in readers.read_rate_history(spark, path).collect())
    assert rows == [("2026-01-09", "USD", 1.08), ("2026-01-10", "GBP", 0.86), ("2026-01-10", "USD", 1.0825)]


def test_csv_stack_needs_one_file(spark):
    with pytest.raises(FileNotFoundError):
        readers.read_multi_csv(spark, {"a": scratch_path(spark, "nothing")})


def test_triples_survive_escaping(spark):
    rows = [
        ("g", "urn:a", "urn:p", 'say "hi"\n\\n\tend\\', "literal", None, "en"), ("g", "urn:a", "urn:q", "urn:b", "iri", None, None),
        ("h", "_:b1", "urn:p", "5", "literal", "xsd:int", None), ("h", "urn:c", "urn:p", "_:b1", "iri", None, None),
    ]
    quads = spark.createDataFrame(rows, "graph string, s string, p string, o string, o_kind string, datatype string, lang string")
    path = scratch_path(spark, "nt")
    readers.to_ntriples(quads).write.text(path)
    assert sorted(map(tuple, readers.read_ntriples(spark, path).collect()), key=str) == sorted(rows, key=str)


def test_insert_if_absent_is_repeatable(spark):
    path = scratch_path(spark, "keys")
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, v string")
    batch.filter("k = 2").write.parquet(path)
    for _ in range(2):
        writers.insert_if_absent(path, spark.read.parquet(path), batch, ["k"], ["v"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "c")]


def test_relational_shape(spark):
    frame = spark.createDataFrame([(1, 1.5, True, [1])], "`Market Cap` int, Rate float, Ok boolean, xs array<int>")
    assert writers.relational_shape(frame).dtypes == [("market_cap", "bigint"), ("rate", "double"), ("ok", "boolean"), ("xs", "string")]


def test_cluster_sessions_must_name_a_shared_folder():
    class Fake:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(RuntimeError):
        scratch_root(Fake())


def test_late_rows_are_dropped_and_counted(spark):
    source, checkpoint, sink = (scratch_path(spark, n) for n in ("in", "ck", "out"))
    schema = "event_time timestamp, symbol string, exchange string, current_price double, volume long, change_percent double"

    def deliver(*minutes):
        rows = [(T0 + timedelta(minutes=m), "S", "X", float(m), 1, 0.0) for m in minutes]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = flows.windowed_quotes(spark.readStream.schema(schema).parquet(source), "event_time")
        query = flows.to_parquet(stream.select("window.start", "quote_count"), sink, checkpoint, available_now=True)
        query.awaitTermination()
        return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

    assert deliver(0, 1, 2, 10) == 0
    assert deliver(1, 3, 60) == 2
    counts = {r.start: r.quote_count for r in spark.read.parquet(sink).collect()}
    assert counts == {T0 + timedelta(minutes=m): 1 for m in (0, 1, 2, 10)}


def test_state_carries_over_batches(spark):
    source, checkpoint, root = (scratch_path(spark, n) for n in ("hits", "ck", "out"))
    alerts = stateful.CooledAlerts(root)
    schema = "rule string, point_id string, ts timestamp"
    minutes = [[0, 4, 5], [6, 9, 10, 11], [16]]
    for batch in minutes:
        rows = [("r", str(m), T0 + timedelta(minutes=m)) for m in batch]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        flows.for_each_batch(stream, alerts, checkpoint, available_now=True).awaitTermination()
    assert sorted(int(r.point_id) for r in alerts.read(spark).collect()) == [0, 5, 10, 16]
    # a replayed batch gives its rows again, in place of the old ones
    last = [("r", str(m), T0 + timedelta(minutes=m)) for m in minutes[-1]]
    alerts(spark.createDataFrame(last, schema), 2)
    assert sorted(int(r.point_id) for r in alerts.read(spark).collect()) == [0, 5, 10, 16]


def test_detector_state_equals_one_frame_over_everything(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("aaab"), rng.gauss(100, 1) + (60 if i % 37 == 0 else 0), 100, T0 + timedelta(seconds=i // 2)) for i in range(400)]
    schema = "event_id long, symbol string, current_price double, volume long, ts timestamp"
    whole = spark.createDataFrame(rows, schema)
    want = {r.event_id: r.z_score for r in anomaly.price_zscore(anomaly.quote_statistics(whole)).collect()}
    detector = stateful.price_and_volume_anomalies(scratch_path(spark, "detector"))
    for batch_id, (low, high) in enumerate([(0, 90), (90, 92), (92, 300), (300, 400)]):
        detector(whole.filter(f"event_id >= {low} and event_id < {high}"), batch_id)
    got = {r.event_id: r.z_score for r in detector.read(spark).collect()}
    assert got == want and len(want) > 5


def test_detector_makes_its_frames_once(spark):
    """Both kinds of hits, as the two detectors give them one by one, from one window over the rows."""
    rng = random.Random(5)
    rows = [(i, "a", rng.gauss(100, 1) + (60 if i % 37 == 0 else 0), 100 if i % 31 else 900, T0 + timedelta(seconds=i)) for i in range(400)]
    stats = anomaly.quote_statistics(spark.createDataFrame(rows, "event_id long, symbol string, current_price double, volume long, ts timestamp"))
    hits = stateful.price_and_volume_anomalies(scratch_path(spark, "once")).hits(stats)
    want = anomaly.price_zscore(stats).unionByName(anomaly.volume_spike(stats), allowMissingColumns=True)
    assert hits.dtypes == want.dtypes and {r.type for r in hits.collect()} == {"PRICE_SPIKE", "VOLUME_SPIKE"}
    assert sorted(map(str, hits.collect())) == sorted(map(str, want.collect()))
    windows = [df._jdf.queryExecution().sparkPlan().toString().count("Window [") for df in (hits, stats)]
    assert windows[0] == windows[1]


MESSAGES = "topic string, key string, value string"


def _deliver(spark, sinks, source, checkpoint, rows):
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(source)
    query = sinks.start(spark.readStream.schema(MESSAGES).parquet(source), checkpoint, available_now=True)
    query.awaitTermination()
    return query


def test_dispatch_replay_adds_nothing(spark):
    root, source, checkpoint = (scratch_path(spark, n) for n in ("routes", "in", "ck"))
    sinks = flows.Dispatcher(root, default=lambda rest: rest.select("topic"))
    sinks.on("stocks", flows.stock_route).on("tx", flows.transaction_route)
    rows = [
        ("stocks", "k", '{"symbol":"a","price":1}'), ("tx", "k", '{"transaction_id":"t","amount":5}'),
        ("tx", "k", '{"transaction_id":"t","amount":5}'), ("forex", "k", "{}"),
    ]
    _deliver(spark, sinks, source, checkpoint, rows)

    class Broken(Exception):
        pass

    def fail(batch, batch_id):
        sinks(batch, batch_id)
        raise Broken

    # a batch that fails after its tables are written is run again from the state before it
    new = [("tx", "k", '{"transaction_id":"u","amount":6}'), ("tx", "k", '{"transaction_id":"t","amount":7}')]
    spark.createDataFrame(new, MESSAGES).write.mode("append").parquet(source)
    stream = spark.readStream.schema(MESSAGES).parquet(source)
    with pytest.raises(Exception, match="Broken"):
        flows.for_each_batch(sinks.marked(stream), fail, checkpoint, available_now=True).awaitTermination()
    sinks.start(stream, checkpoint, available_now=True).awaitTermination()
    assert sinks.read(spark, "stocks").count() == 1
    found = sinks.read(spark, "tx").collect()
    assert sorted((r.transaction_id, r.amount) for r in found) == [("t", 5.0), ("u", 6.0)]
    assert found[0].source == "kafka" and found[0].is_real_data is False
    assert [r.topic for r in sinks.read(spark, "other").collect()] == ["forex"]


def test_dispatch_loses_nothing(spark):
    source, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "ck")
    sinks = flows.Dispatcher(scratch_path(spark, "routes"), default=lambda rest: rest.select("topic", "value"))
    sinks.on("tx", flows.transaction_route)
    first = [("tx", "k", '{"transaction_id":"a","amount":1}'), ("tx", "k", "{oops"), (None, "k", "lost"), ("tx", "k", '{"amount":7}')]
    second = [("tx", "k", '{"transaction_id":"a","amount":2}'), ("tx", "k", '{"transaction_id":"b","amount":3}'), ("tx", "k", '{"amount":8}'), ("tx", None, None)]
    for rows in (first, second):
        _deliver(spark, sinks, source, checkpoint, rows)
    got = sorted((r.transaction_id or "", r.amount or 0) for r in sinks.read(spark, "tx").collect())
    assert got == [("", 0), ("", 7.0), ("", 8.0), ("a", 1.0), ("b", 3.0)]
    assert [r.message for r in sinks.read(spark, "dead").collect()] == ["{oops"]
    assert [r.value for r in sinks.read(spark, "other").collect()] == ["lost"]
    counts = {r.topic: (r.messages, r.errors) for r in sinks.read(spark, "counts").groupBy("topic").sum().toDF("topic", "messages", "errors").collect()}
    assert counts == {"tx": (7, 1), None: (1, 0)}


def test_dispatch_work_does_not_grow_with_its_tables(spark):
    """Over 20 batches each reads its own delivery only: the tables move away half way, and no key comes twice."""
    source, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "ck")
    halves = [flows.Dispatcher(scratch_path(spark, "routes")).on("tx", flows.transaction_route) for _ in range(2)]
    logged = []
    for number in range(20):
        rows = [("tx", "k", f'{{"transaction_id":"{key}","amount":{number}}}') for key in (number, number + 1, 0)]
        query = _deliver(spark, halves[number // 10], source, checkpoint, rows)
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        assert [p["numInputRows"] for p in progress] == [6]  # every message, and once more for its key
        logged.append(progress[0]["stateOperators"][0]["customMetrics"]["rocksdbBytesCopied"])
    assert max(logged[5:]) <= 2 * max(1, max(logged[:5]))
    found = [r.transaction_id for half in halves for r in half.read(spark, "tx").collect()]
    assert sorted(found, key=int) == [str(k) for k in range(21)]


def test_batches_report_what_they_drop(spark):
    source, checkpoint, sink, reports = (scratch_path(spark, n) for n in ("in", "ck", "out", "reports"))
    schema = "at timestamp, id long"
    with progress.reported(spark, reports) as listener:
        for name, minutes in (("first", (0, 1, 2, 90)), ("second", (1, 3, 80, 200))):
            rows = [(T0 + timedelta(minutes=m), 10 * m) for m in minutes]
            spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
            stream = flows.unique_stream(spark.readStream.schema(schema).parquet(source), ["id"], "at")
            flows.drain(stream, "unique", checkpoint, sink, name)
    found = listener.table().where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r.query_name, r.input_rows, r.dropped_rows) for r in found] == [("first", 4, 0), ("second", 4, 2)]
    assert len({r.query_id for r in found}) == 1 and spark.read.parquet(sink).count() == 6


def test_memory_sink(spark):
    source = scratch_path(spark, "mem")
    spark.range(5).write.parquet(source)
    query = flows.to_memory(spark.readStream.schema("id long").parquet(source), "memory_rows")
    query.awaitTermination()
    assert spark.table("memory_rows").count() == 5


def test_incremental_mark(spark):
    rows = spark.range(10)
    batch, mark = readers.read_incremental(rows, "id", 3, 4)
    assert [r.id for r in batch.collect()] == [4, 5, 6, 7] and mark == 7
    batch, mark = readers.read_incremental(rows, "id", 9, 4)
    assert batch.count() == 0 and mark == 9
    batch, mark = readers.read_incremental(rows, "id", 3)
    assert batch.count() == 6 and mark == 9
    equal = rows.selectExpr("id div 5 as k")
    batch, mark = readers.read_incremental(equal, "k", -1, 2)
    assert batch.count() == 5 and mark == 0
    plan = readers.read_incremental(rows, "id", 3)[0]._jdf.queryExecution().toString()
    assert "Limit" not in plan and "Sort" not in plan


@pytest.mark.parametrize("values", ["id", "id % 7", "id div 9000", "cast(id * id as double)", "timestamp_seconds(id)", "cast(id % 50 as string)", "if(id < 30000, 5, id)"])
def test_key_at_a_place(spark, monkeypatch, values):
    monkeypatch.setattr(readers, "PICKED", 100)
    rows = spark.range(40_000).selectExpr(f"{values} AS k").repartition(7)
    want = sorted(r.k for r in rows.collect())
    for place in (0, 1, 12_345, 39_999, 50_000):
        assert readers.key_at(rows, "k", place) == want[min(place, 39_999)]
    assert readers.key_at(rows.limit(0), "k", 3) is None


def test_build_reports_each_table(spark):
    from ledgermill.plans.build import build_tables
    from ledgermill.plans.layers import Layers

    class Broken(Layers):
        @property
        def silver_forex(self):
            raise ValueError("feed missing")

    target = scratch_path(spark, "layers")
    report = {r.table_name: (r.status, r.record_count) for r in build_tables(Broken(spark, "/root/testdata/sf0.001"), target, ("gold",)).collect()}
    assert report["silver_forex"] == ("failed: ValueError", 0)
    assert report["gold_tx_summary"] == ("skipped", 0)
    status, rows = report["fact_transactions"]
    fact = spark.read.parquet(f"{target}/facts/fact_transactions")
    assert status == "success" and rows == fact.count() > 0
    assert fact.filter("month_key = date_sk div 100").count() == rows


def test_polls_cut_at_once_equal_polls_one_by_one(spark):
    rng = random.Random(4)
    keys = [k for k in range(300) for _ in range(rng.choice([1, 1, 2, 5, 40]))] + [400] * 90
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key long, id long")
    want, mark = [], -1
    while True:
        batch, newest = readers.read_incremental(rows, "key", mark, 300)
        if newest == mark:
            break
        want.append(sorted(r.id for r in batch.collect()))
        mark = newest
    got = {}
    for r in readers.cut_polls(rows.unionByName(spark.createDataFrame([(None, -1)], rows.schema)), "key", 300).collect():
        got.setdefault(r.poll, []).append(r.id)
    assert [sorted(got[k]) for k in sorted(got)] == want and len(want) > 5
