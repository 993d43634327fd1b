"""Reachability over edge tables and RDFS inference built on it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import scratch_path, stored


class Rounds:
    """Rows found so far, one folder per round, read back as one table.

    The plan of a round stays the same size however many rounds came before it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self.paths: list[str] = []
        self.schema = None

    def add(self, rows: DataFrame) -> DataFrame:
        path = f"{self.root}/round-{len(self.paths)}"
        rows.write.parquet(path)
        self.paths.append(path)
        self.schema = rows.schema
        return self.spark.read.schema(rows.schema).parquet(path)

    def known(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)


def reachable(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """Nodes reachable from the ``node`` rows of ``starts`` along ``(src, dst)`` edges.

    Breadth-first: each round joins only the newest nodes, so the work per round is
    bounded by the edges leaving them, and cycles end because known nodes are removed.
    Start nodes are reported only when an edge leads back to them. Further columns that
    both frames have (such as a direction) keep separate searches apart in one pass.
    """
    group = [c for c in starts.columns if c != "node"]
    frontier = starts.distinct()
    rounds = Rounds(edges.sparkSession, "reached")
    while True:
        step = edges.join(frontier.withColumnRenamed("node", "src"), [*group, "src"])
        reached = step.select(*group, F.col("dst").alias("node")).distinct()
        if rounds.paths:
            reached = reached.join(rounds.known(), [*group, "node"], "left_anti")
        frontier = rounds.add(reached)
        if frontier.isEmpty():
            return rounds.known()


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All ``(src, dst)`` pairs joined by a path; semi-naive, exact on cycles."""
    rounds = Rounds(edges.sparkSession, "closure")
    first = delta = rounds.add(edges.select("src", "dst").distinct())
    step = first.select(F.col("src").alias("mid"), F.col("dst").alias("next"))
    while not delta.isEmpty():
        grown = (
            delta.withColumnRenamed("dst", "mid").join(step, "mid").select("src", F.col("next").alias("dst")).distinct()
        )
        delta = rounds.add(grown.join(rounds.known(), ["src", "dst"], "left_anti"))
    return rounds.known()


def direct_lineage(edges: DataFrame, asset: str, upstream: bool = True) -> DataFrame:
    here, there = ("target_asset", "source_asset") if upstream else ("source_asset", "target_asset")
    return edges.filter(F.col(here) == asset).select(F.col(there).alias("asset")).distinct()


def full_lineage(edges: DataFrame, asset: str) -> DataFrame:
    """Every upstream and downstream asset once per direction; both searches share each round."""
    ends = (("downstream", "source_asset", "target_asset"), ("upstream", "target_asset", "source_asset"))
    directed = F.array(
        *[F.struct(F.lit(d).alias("direction"), F.col(a).alias("src"), F.col(b).alias("dst")) for d, a, b in ends]
    )
    starts = edges.sparkSession.createDataFrame([(d, asset) for d, _, _ in ends], "direction string, node string")
    return reachable(adjacency(edges.select(F.inline_outer(directed)), "direction"), starts).withColumnRenamed("node", "asset")


def adjacency(edges: DataFrame, group: str) -> DataFrame:
    """Distinct ``(group, src, dst)`` stored in order, one folder per group, so that a round reads what its newest nodes need.

    Edges are cut by their whole order, hence the edges of a hub lie in as many parts as they need.
    """
    return stored(distinct_in_order(edges, group).sortWithinPartitions("src", "dst"), "adjacency", group)


def distinct_in_order(edges: DataFrame, group: str) -> DataFrame:
    """Equal edges lie in one range, so they are made distinct there; the sample of the ranges reads the edges as they are."""
    return edges.select(group, "src", "dst").repartitionByRange(group, "src", "dst").distinct()


#: So many predicates at most are listed in a filter, which then prunes the sources that are read.
_LISTED = 1000
_SCHEMA = ("rdfs:subClassOf", "rdfs:subPropertyOf", "rdfs:domain", "rdfs:range")


def _pairs(triples: DataFrame, predicate: str) -> DataFrame:
    return triples.filter(F.col("p") == predicate).select(F.col("s").alias("src"), F.col("o").alias("dst"))


def rdfs_closure(
    triples: DataFrame | Callable[[Sequence[str]], DataFrame],
    by_subject: Callable[[Sequence[str]], DataFrame] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Triples entailed by sub-class, sub-property, domain and range statements, without the asserted ones.

    ``triples`` is a table or a function that gives the triples of some predicates (all of them, if none is named); they may repeat.
    ``by_subject`` gives the same triples dealt to ``parts`` partitions by subject: what follows for the subject of a statement is then
    compared where the statement lies, and only what follows for its object is shuffled.

    The schema is closed first, on its own, and spelled out as rules: what a statement implies by its predicate, and a type by its class.
    A statement meets the rules once instead of being iterated over. What is made is held against those asserted statements only
    that can be equal to it: types by a class that something implies, and the predicates that stand above another one. The rest
    of the store is neither read nor shuffled.
    """
    def of(predicates: Sequence[str]) -> DataFrame:
        rows = triples(predicates) if callable(triples) else triples.filter(F.col("p").isin(list(predicates))) if predicates else triples
        return rows.select("s", "p", "o", "o_kind")

    schema = stored(of([*_SCHEMA]).select("s", "p", "o"), "schema")
    classes = transitive_closure(_pairs(schema, "rdfs:subClassOf"))
    properties = transitive_closure(_pairs(schema, "rdfs:subPropertyOf"))

    def names(rows: DataFrame, column: str) -> list[str] | None:
        """Names in a part of the schema, when they are few enough to list."""
        found = [r[0] for r in rows.select(column).distinct().limit(_LISTED + 1).collect()]
        return found if len(found) <= _LISTED else None

    def rules_of(predicate: str) -> DataFrame:
        """Property and class: its own statement, or that of a property above it."""
        direct = _pairs(schema, predicate)
        through = properties.withColumnRenamed("dst", "mid").join(direct.withColumnRenamed("src", "mid"), "mid")
        return stored(direct.unionByName(through.select("src", "dst")).distinct(), "rules")

    domains, ranges = rules_of("rdfs:domain"), rules_of("rdfs:range")

    def with_above(rules: DataFrame) -> DataFrame:
        return rules.unionByName(
            rules.withColumnRenamed("dst", "mid").join(classes.withColumnRenamed("src", "mid"), "mid").select("src", "dst")
        ).distinct()

    def rule(rows: DataFrame, kind: str, by_class: bool = False) -> DataFrame:
        return rows.select(F.col("src").alias("on"), F.lit(by_class).alias("by_class"), F.lit(kind).alias("kind"), F.col("dst").alias("value"))

    made = classes.select("dst").unionByName(domains.select("dst")).unionByName(ranges.select("dst")).distinct()
    closed = F.explode(F.array(F.lit("rdfs:subClassOf"), F.lit("rdfs:subPropertyOf"))).alias("dst")
    supers = properties.select("dst").unionByName(schema.sparkSession.range(1).select(closed)).distinct()
    none = F.lit(None).cast("string")
    here = [
        rule(properties, "lifted"), rule(with_above(domains), "type"), rule(classes, "type", by_class=True),
        rule(made.select(F.col("dst").alias("src"), none.alias("dst")), "known", by_class=True),
        rule(supers.select(F.col("dst").alias("src"), none.alias("dst")), "known"),
    ]
    # tables of their own, so Spark knows their size
    local = stored(reduce(DataFrame.unionByName, here).distinct(), "rules-here")
    there = stored(rule(with_above(ranges), "type"), "rules-there")

    def statements(rules: DataFrame, get: Callable[[Sequence[str]], DataFrame], *more: str) -> DataFrame:
        listed = names(rules.filter(~F.col("by_class")), "on")
        if listed is None:
            return get([])
        listed = [p for p in dict.fromkeys([*listed, *more]) if p is not None]
        return get(listed) if listed else get(["rdf:type"]).limit(0)

    facts = statements(local, by_subject or of, "rdf:type")
    is_type = F.col("p") == "rdf:type"
    asked = F.array(F.struct(F.col("p").alias("on"), F.lit(False).alias("by_class")))
    typed = F.array_append(asked, F.struct(F.col("o").alias("on"), F.lit(True).alias("by_class")))
    asks = facts.select("s", "p", "o", F.explode(F.when(is_type, typed).otherwise(asked)).alias("_a"))
    told = asks.select("s", "p", "o", "_a.on", "_a.by_class").join(local, ["on", "by_class"])
    kind, value = F.col("kind"), F.col("value")
    mine = told.select(
        "s",
        F.when(kind == "type", "rdf:type").when(kind == "lifted", value).otherwise(F.col("p")).alias("p"),
        F.when(kind == "type", value).otherwise(F.col("o")).alias("o"),
        # a statement without a subject is never known
        ((kind == "known") & F.col("s").isNotNull()).alias("known"),
    ).filter((kind != "known") | F.col("known"))

    # statements are many, ends few: reduce to one row per end and predicate first
    ends = statements(there, of).filter(F.col("o_kind") == "iri").select(F.col("o").alias("s"), "p").distinct()
    theirs = ends.join(there.withColumnRenamed("on", "p"), "p").select("s", F.lit("rdf:type").alias("p"), value.alias("o"), F.lit(False).alias("known"))

    def schema_rows(pairs: DataFrame, predicate: str) -> DataFrame:
        return pairs.select(F.col("src").alias("s"), F.lit(predicate).alias("p"), F.col("dst").alias("o"), F.lit(False).alias("known"))

    sent = theirs.unionByName(schema_rows(classes, "rdfs:subClassOf")).unionByName(schema_rows(properties, "rdfs:subPropertyOf"))
    sent = sent.repartition(parts, "s") if parts else sent
    held = mine.unionByName(sent).groupBy("s", "p", "o").agg(F.bool_or("known").alias("known"))
    return held.filter(~F.col("known")).select("s", "p", "o")


def instances_of(triples: DataFrame, cls: str) -> DataFrame:
    """Instances of ``cls`` or of any class below it, each once."""
    named = triples.sparkSession.range(1).select(F.lit(cls).alias("node"))
    up = _pairs(triples, "rdfs:subClassOf")
    below = reachable(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")), named)
    wanted = stored(below.unionByName(named).distinct().select(F.col("node").alias("o")), "classes-below")
    typed = triples.filter(F.col("p") == "rdf:type")
    return typed.join(wanted, "o", "left_semi").select(F.col("s").alias("instance")).distinct()
