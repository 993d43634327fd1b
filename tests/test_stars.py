"""The subject-bucketed triple store: stars without a shuffle, the same triples as the plain store."""

import re

import pytest

from ledgermill.catalog import load
from ledgermill.operators import patterns
from ledgermill.operators.patterns import LABEL, Graph, every, optional
from ledgermill.plans import triples
from ledgermill.plans.inputs import Inputs


@pytest.fixture(scope="module")
def graph(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    return Graph(triples.default_graph(inputs), triples.default_stars(inputs), triples.SPREAD)


def _exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Round|Single)", plan))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_stars_need_no_exchange(graph, no_broadcast):
    assert _exchanges(graph.high_value_star()) == 0
    assert _exchanges(graph.cross_border_star()) == 0
    sector = every(graph.a("onto:FinancialInstitution", "c"), graph.p(LABEL, "c", "name"))
    assert _exchanges(optional(sector, graph.p("onto:belongsToSector", "c", "sector"))) == 0


def test_two_stars_need_one_exchange(graph, no_broadcast):
    """Companies and their filings: the companies are dealt to the buckets of the filings, which stay where they are."""
    companies = every(graph.a("onto:FinancialInstitution", "company"), graph.p("onto:hasFinancialStatement", "company", "statement"))
    filings = optional(companies, graph.p("onto:fiscalYear", "statement", "year"), graph.p("onto:revenue", "statement", "revenue"))
    assert _exchanges(filings) == 1


def test_both_layouts_hold_the_same_triples(graph):
    spread = graph.triples.filter(graph.triples.p.isin(*triples.SPREAD))
    rest = graph.triples.filter(~graph.triples.p.isin(*triples.SPREAD))
    assert spread.count() > 0 and graph.stars.filter(graph.stars.p.isin(*triples.SPREAD)).count() == 0
    assert rest.exceptAll(graph.stars).isEmpty() and graph.stars.exceptAll(rest).isEmpty()


def test_answers_do_not_depend_on_the_layout(graph):
    plain = Graph(graph.triples)
    for question in ("high_value_transactions", "cross_border", "company_financials", "transactions"):
        rows = [sorted(map(str, getattr(g, question)().collect())) for g in (graph, plain)]
        assert rows[0] == rows[1] and rows[0], question


def test_a_question_stores_only_its_predicates(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    triples.forget()
    rows = triples.of_predicates(inputs, "rdf:type", "onto:amountEUR")
    assert {r.p for r in rows.select("p").distinct().collect()} == {"rdf:type", "onto:amountEUR"}
    held = next(iter(triples._tables.values()))
    assert sorted(held) == ["onto:amountEUR", "rdf:type"]
    whole = triples.default_graph(inputs).filter("p IN ('rdf:type', 'onto:amountEUR')")
    assert rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()
    triples.forget()


def test_statements_are_made_distinct_where_they_were_dealt(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    plan = triples.dealt_quads(inputs).drop("graph").distinct()._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(_deal", plan)) == 1


def test_graph_updates_shuffle_all_statements_once(spark, no_broadcast):
    plan = load().RUNNERS["grf_31_graph_updates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"Exchange hashpartitioning\((?:graph|s|p|o|o_kind)#", plan)
    assert len(re.findall(r"Exchange hashpartitioning\(_deal", plan)) == 3  # all of them, the inserted and the deleted ones


def test_updates_where_quads_were_dealt_equal_those_by_a_join(spark):
    schema = "graph string, s string, p string, o string, o_kind string, _deal long"
    rows = [("g", s, p, o, kind) for s in ("a", "b", None) for p in ("p", "q") for o in ("1", "2", None) for kind in ("iri", "literal")] * 2
    rows += [(None, "a", "p", "1", "iri"), ("h", "a", "p", "1", None)]
    gone = [("g", "a", "p", "1", None), ("g", "a", "p", "1", "iri"), ("g", None, "p", "1", "iri"), ("g", "b", "q", None, "iri"), ("h", "b", "p", "1", "iri")]
    gone += [("h", "a", "p", "1", "literal"), ("k", "z", "p", "1", "iri")]
    quads, gone = (spark.createDataFrame([(*r, sum(map(ord, r[1] or ""))) for r in some], schema).repartition(5, "_deal") for some in (rows, gone))
    got = patterns.delete_triples(quads, gone).drop("_deal")
    want = patterns.delete_triples(quads.drop("_deal"), gone.drop("_deal"))
    listed = lambda frame: sorted(map(repr, frame.select("graph", "s", "p", "o", "o_kind").collect()))
    assert listed(got) == listed(want) and 0 < got.count() < len(rows)
    assert len(re.findall("Exchange", got._jdf.queryExecution().executedPlan().toString())) == 2
