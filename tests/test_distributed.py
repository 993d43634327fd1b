"""Operators that split work differently from a plain window, against brute force."""

import random
import re
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgermill.operators import cooldown as cooling
from ledgermill.operators.closure import adjacency, distinct_in_order, full_lineage, rdfs_closure, reachable, transitive_closure
from ledgermill.operators.matching import name_match_pairs
from ledgermill.operators.ordered import bounded_frames, carried_frames, dense_index, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most of the rows; many equal timestamps."""
    rng = np.random.default_rng(5)
    n = 3000
    frame = pd.DataFrame(
        {
            "key": np.where(rng.random(n) < 0.7, "hot", rng.integers(0, 9, n).astype(str)),
            "ts": rng.integers(0, 200, n),
            "id": np.arange(n),
            "v": rng.random(n).round(3),
        }
    )
    return frame, spark.createDataFrame(frame).repartition(5)


def test_dense_index_is_the_global_rank(skewed):
    pdf, df = skewed
    got = dense_index(df, ["ts", "id"], "rank", start=1).toPandas().set_index("id")["rank"]
    want = pdf.sort_values(["ts", "id"]).reset_index(drop=True)
    assert [got[i] for i in want["id"]] == list(range(1, len(want) + 1))


@pytest.mark.parametrize("current, chunk", [(True, 100), (False, 100), (False, 7), (True, 100000)])
def test_frames_on_chunks_equal_frames_on_keys(skewed, current, chunk):
    pdf, df = skewed
    out = bounded_frames(
        df, ["key"], ["ts", "id"], 20, lambda w: {"n": F.count("v").over(w), "s": F.sum("v").over(w)}, current, chunk_rows=chunk
    )
    got = out.toPandas().set_index("id")
    assert len(got) == len(pdf)
    for _, group in pdf.sort_values(["ts", "id"]).groupby("key"):
        values = group["v"].tolist()
        for i, row_id in enumerate(group["id"]):
            frame = values[max(0, i - 20) : i + 1 if current else i]
            assert got.loc[row_id, "n"] == len(frame)
            if frame:
                assert got.loc[row_id, "s"] == pytest.approx(sum(frame))


def test_running_totals(skewed):
    pdf, df = skewed
    got = running_totals(df, ["ts", "id"], {"total": F.col("v"), "rows": F.lit(1)}).toPandas().set_index("id")
    want = pdf.sort_values(["ts", "id"])
    assert got.loc[want["id"], "total"].to_numpy() == pytest.approx(want["v"].cumsum().to_numpy())
    assert got.loc[want["id"], "rows"].tolist() == list(range(1, len(want) + 1))


def brute_cooldown(times, wait):
    fired, until = [], None
    for t in sorted(times):
        if until is None or t >= until:
            fired.append(t)
            until = t + wait
    return fired


@pytest.mark.parametrize("seed, gap, days", [(1, 20, 1), (2, 299, 3), (3, 5, 1), (4, 40000, 200)])
def test_cooldown_equals_the_sequential_rule(spark, seed, gap, days):
    rng = random.Random(seed)
    start, rows = datetime(2023, 12, 30, 22), []
    for rule in ("a", "b"):
        t = start
        for i in range(1500):
            t += timedelta(seconds=rng.choice([0, 1, gap, gap * rng.random() * 2]))
            rows.append((rule, t, f"{rule}{i:05d}"))
    rng.shuffle(rows)
    got = cooling.cooldown(spark.createDataFrame(rows, "rule string, ts timestamp_ntz, id string"), 5, tie=["id"]).collect()
    for rule in ("a", "b"):
        mine = [(t, i) for r, t, i in rows if r == rule]
        want = brute_cooldown([t for t, _ in mine], timedelta(minutes=5))
        assert sorted(r.ts for r in got if r.rule == rule) == want
        for row in (r for r in got if r.rule == rule):
            assert row.id == min(i for t, i in mine if t == row.ts)


def test_cooldown_state_crosses_empty_segments(spark):
    base = datetime(2024, 1, 1, 0, 59, 59)
    rows = [("r", base), ("r", base + timedelta(minutes=4)), ("r", base + timedelta(days=90)), ("r", base + timedelta(days=90, minutes=5))]
    got = cooling.cooldown(spark.createDataFrame(rows, "rule string, ts timestamp_ntz"))
    assert sorted(r.ts for r in got.collect()) == [rows[0][1], rows[2][1], rows[3][1]]


def brute_reach(edges, start):
    seen, todo = set(), [start]
    while todo:
        here = todo.pop()
        for a, b in edges:
            if a == here and b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


def test_closure_on_cycles_and_diamonds(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("e", "d"), ("x", "y")]
    df = spark.createDataFrame(edges, "src string, dst string")
    pairs = sorted((r.src, r.dst) for r in transitive_closure(df).collect())
    want = sorted((s, d) for s in "abcdexy" for d in brute_reach(edges, s))
    assert pairs == want
    start = spark.createDataFrame([("d",)], "node string")
    assert sorted(r.node for r in reachable(df, start).collect()) == ["d", "e"]
    lineage = full_lineage(df.toDF("source_asset", "target_asset"), "d").collect()
    assert sorted((r.direction, r.asset) for r in lineage) == [
        ("downstream", "d"), ("downstream", "e"), ("upstream", "a"), ("upstream", "b"), ("upstream", "c"), ("upstream", "d"), ("upstream", "e")
    ]


def test_closure_without_edges(spark):
    empty = spark.createDataFrame([], "src string, dst string")
    assert transitive_closure(empty).count() == 0
    assert reachable(empty, spark.createDataFrame([("a",)], "node string")).count() == 0


def test_inference_adds_nothing_twice(spark):
    rows = [
        ("Transfer", "rdfs:subClassOf", "Transaction", "iri"), ("Transaction", "rdfs:subClassOf", "Entity", "iri"),
        ("paidBy", "rdfs:subPropertyOf", "involves", "iri"), ("involves", "rdfs:domain", "Transfer", "iri"),
        ("involves", "rdfs:range", "Party", "iri"), ("t1", "paidBy", "p1", "iri"), ("t2", "note", "hello", "literal"),
        ("t3", "rdf:type", "Transfer", "iri"), ("t3", "rdf:type", "Entity", "iri"),
    ]
    base = spark.createDataFrame(rows, "s string, p string, o string, o_kind string")
    inferred = rdfs_closure(base)
    got = sorted((r.s, r.p, r.o) for r in inferred.collect())
    assert got == sorted(
        [
            ("Transfer", "rdfs:subClassOf", "Entity"), ("t1", "involves", "p1"), ("t1", "rdf:type", "Transfer"),
            ("t1", "rdf:type", "Transaction"), ("t1", "rdf:type", "Entity"), ("p1", "rdf:type", "Party"), ("t3", "rdf:type", "Transaction"),
        ]
    )
    again = rdfs_closure(base.unionByName(inferred.withColumn("o_kind", F.lit("iri"))))
    assert again.count() == 0


def _naive_rdfs(rows):
    """All entailed triples by applying the rules until nothing is new."""
    iris = {(s, p, o) for s, p, o, kind in rows if kind == "iri"}
    known = {(s, p, o) for s, p, o, _ in rows}
    while True:
        by = lambda q: [(s, o) for s, p, o in known if p == q]
        sub, prop = by("rdfs:subClassOf"), by("rdfs:subPropertyOf")
        new = {(a, "rdfs:subClassOf", d) for a, b in sub for c, d in sub if b == c}
        new |= {(a, "rdfs:subPropertyOf", d) for a, b in prop for c, d in prop if b == c}
        new |= {(s, q, o) for s, p, o in known for x, q in prop if x == p}
        iris |= {(s, q, o) for s, p, o in iris for x, q in prop if x == p}
        new |= {(s, "rdf:type", c) for s, p, o in known for x, c in by("rdfs:domain") if x == p}
        new |= {(o, "rdf:type", c) for s, p, o in iris for x, c in by("rdfs:range") if x == p}
        new |= {(s, "rdf:type", d) for s, c in by("rdf:type") for x, d in sub if x == c}
        if new <= known:
            return known - {(s, p, o) for s, p, o, _ in rows}
        known |= new


@pytest.mark.parametrize("seed", [1, 2])
def test_inference_equals_naive_rules(spark, seed):
    """Schemas with several parents, diamonds and cycles; asserted statements that rules would make as well."""
    rng = random.Random(seed)
    classes, props, things = [[f"{k}{i}" for i in range(n)] for k, n in (("C", 7), ("p", 5), ("x", 12))]
    rows = {(rng.choice(classes), "rdfs:subClassOf", rng.choice(classes), "iri") for _ in range(9)}
    rows |= {(rng.choice(props), "rdfs:subPropertyOf", rng.choice(props), "iri") for _ in range(5)}
    rows |= {(rng.choice(props), rng.choice(["rdfs:domain", "rdfs:range"]), rng.choice(classes), "iri") for _ in range(4)}
    rows |= {(rng.choice(things), rng.choice(props), rng.choice(things), "iri") for _ in range(15)}
    rows |= {(rng.choice(things), rng.choice(props), "text", "literal") for _ in range(4)}
    rows |= {(rng.choice(things), "rdf:type", rng.choice(classes), "iri") for _ in range(8)}
    base = spark.createDataFrame(sorted(rows), "s string, p string, o string, o_kind string")
    got = [(r.s, r.p, r.o) for r in rdfs_closure(base).collect()]
    assert len(got) == len(set(got)) and set(got) == _naive_rdfs(rows)


def test_inference_shuffles_only_what_follows_for_objects(spark):
    """Repeated statements, dealt by subject; what is made of them is not shuffled again."""
    rows = [("paidBy", "rdfs:subPropertyOf", "involves", "iri"), ("involves", "rdfs:domain", "Transfer", "iri"), ("involves", "rdfs:range", "Party", "iri")]
    rows += [(f"t{i}", "paidBy", f"p{i % 3}", "iri") for i in range(20)] + [("t1", "rdf:type", "Transfer", "iri"), ("t2", "involves", "p2", "iri")]
    base = spark.createDataFrame(rows * 2, "s string, p string, o string, o_kind string")

    def of(predicates):
        return base.filter(F.col("p").isin(predicates)) if predicates else base

    made = rdfs_closure(of, lambda predicates: of(predicates).repartition(7, "s"), 7)
    got = [(r.s, r.p, r.o) for r in made.collect()]
    assert len(got) == len(set(got)) and set(got) == _naive_rdfs({*rows})
    plan = made._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any(re.search(r"hashpartitioning\(s#\d+, p#\d+, o#", line) for line in exchanges)


def test_name_matching_equals_all_pairs(spark):
    rng = random.Random(3)
    names = ["", "a", "Ab", "abc", "abcd ltd", "xABCx", "Customer#000000012", "customer#000000012 Holding", "Customer#00000001"]
    names += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 14))) for _ in range(60)]
    rows = [(str(i), n) for i, n in enumerate(names)]
    got = sorted((r.id1, r.id2) for r in name_match_pairs(spark.createDataFrame(rows, "id string, name string")).collect())
    want = sorted(
        (i, j) for i, a in rows for j, b in rows
        if i != j and a and b and (a.lower() in b.lower() or b.lower() in a.lower())
    )
    assert got == want


def test_first_pairs_of_many_equal_names(spark):
    rows = spark.range(10_000).selectExpr("concat('a', lpad(cast(id as string), 5, '0')) as id", "'Same Name' as name")
    rows = rows.unionByName(spark.createDataFrame([("b", "same"), ("c", "other"), ("d", "")], "id string, name string"))
    got = [(r.id1, r.id2) for r in name_match_pairs(rows, first=30).collect()]
    assert got == [("a00000", f"a{i:05d}") for i in range(1, 31)]


def test_frames_with_nearly_all_rows_in_one_key(spark):
    df = spark.range(20_000).selectExpr("if(id % 100 = 0, 'rare', 'hot') as key", "id", "cast(id % 7 as double) as v")
    out = bounded_frames(df, ["key"], ["id"], 10, lambda w: {"s": F.sum("v").over(w)}, True, chunk_rows=500)
    plain = df.withColumn("t", F.sum("v").over(Window.partitionBy("key").orderBy("id").rowsBetween(-10, 0)))
    assert out.join(plain, "id").where("s <> t").isEmpty() and out.count() == 20_000


def test_hub_edges_lie_in_many_parts(spark):
    """A star: the hub's edges are not one task's, and its neighbours are found from either side."""
    star = spark.range(200_000).select(F.lit("hub").alias("source_asset"), F.concat(F.lit("leaf"), "id").alias("target_asset"))
    star = star.unionByName(spark.createDataFrame([("leaf7", "end"), ("end", "hub")], "source_asset string, target_asset string"))
    directed = star.select(F.lit("downstream").alias("direction"), F.col("source_asset").alias("src"), F.col("target_asset").alias("dst"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        parts = adjacency(directed, "direction").groupBy(F.input_file_name()).count().collect()
    finally:
        spark.conf.unset(coalesce)
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 100_000
    found = full_lineage(star, "leaf7").groupBy("direction").count().collect()
    assert {r.direction: r["count"] for r in found} == {"downstream": 200_002, "upstream": 3}


def test_ordering_runs_its_input_twice(spark, tmp_path):
    """Once for the bounds, once for the copy; rows that come from files are not counted first."""
    spark.range(5000).write.parquet(f"{tmp_path}/rows")
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = spark.read.parquet(f"{tmp_path}/rows").mapInPandas(counted, "id long")
    assert dense_index(rows, ["id"]).agg(F.sum("_idx")).first()[0] == 5000 * 4999 // 2
    assert seen.value <= 10_000


@pytest.mark.parametrize(("current", "chunk"), [(True, 30), (False, 30), (True, None)])
def test_carried_frames_equal_frames_over_everything(spark, current, chunk):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), i, rng.random()) for i in range(900)]
    schema, preceding = "key string, ts long, v double", 12
    whole = spark.createDataFrame(rows, schema)

    def columns(w):
        return {"n": F.count("v").over(w), "m": F.round(F.avg("v").over(w), 9)}

    want = sorted(bounded_frames(whole, ["key"], ["ts"], preceding, columns, current, chunk).collect(), key=str)
    before, got = spark.createDataFrame([], f"{schema}, _back long"), []
    for low, high in [(0, 5), (5, 300), (300, 301), (301, 900)]:
        batch = whole.filter(f"ts >= {low} AND ts < {high}")
        frames, tail = carried_frames(batch, before, ["key"], ["ts"], preceding, columns, current, chunk)
        got += frames.collect()
        before = spark.createDataFrame(tail.select(*before.columns).collect(), f"{schema}, _back long")
        counts = {r.key: r["count"] for r in before.groupBy("key").count().collect()}
        assert all(n <= preceding for n in counts.values())
    assert sorted(got, key=str) == want


def test_names_are_listed_under_lengths_that_occur(spark):
    """A name is looked up whole, so a hundred names that share every gram but one make no more candidates than results."""
    rows = [(str(i), f"Customer#{i:09d}") for i in range(100)] + [("x", "Big customer#000000007 Ltd"), ("y", "ö"), ("z", "Kö"), ("e", "")]
    pairs = name_match_pairs(spark.createDataFrame(rows, "id string, name string"))
    assert sorted((r.id1, r.id2) for r in pairs.collect()) == [("7", "x"), ("x", "7"), ("y", "z"), ("z", "y")]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 3 and plan.count("BroadcastHashJoin") == 0


def test_edges_are_shuffled_once_before_the_rounds(spark):
    edges = spark.range(1000).selectExpr("cast(id % 1 as string) as direction", "cast(id % 10 as string) as src", "cast(id % 20 as string) as dst")
    ranged = distinct_in_order(edges, "direction")
    assert ranged.count() == 20 and adjacency(edges, "direction").count() == 20
    assert ranged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
