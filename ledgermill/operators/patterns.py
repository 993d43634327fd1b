"""Graph-pattern matching over a triple table with columns s, p, o, o_kind, datatype, lang.

A pattern is a filter on the predicate; patterns are combined by natural joins on
the variables they share, and an optional block is joined inside first and then
left-joined. Repeated optional values multiply rows, as bag semantics demand.

Patterns on one subject form a star. They are read from a table bucketed by subject where there is one, so a star is joined
bucket by bucket without a shuffle; queries join their stars first and follow links to other nodes afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.operators.closure import Rounds
from ledgermill.session import stored

TYPE, LABEL = "rdf:type", "rdfs:label"
BROADCAST_ROWS = 50_000  # so many nodes at most Spark may send to every task


def pattern(triples: DataFrame, predicate: str, subject: str, obj: str, keep_lang: bool = False) -> DataFrame:
    """Subjects and objects of one predicate, to be sort-merged: files of triples are far smaller than their rows in memory."""
    columns = [F.col("s").alias(subject), F.col("o").alias(obj)]
    if keep_lang:
        columns.append(F.col("lang").alias(f"{obj}_lang"))
    return triples.filter(F.col("p") == predicate).select(*columns).hint("merge")


def instances(triples: DataFrame, cls: str | list[str], subject: str) -> DataFrame:
    classes = [cls] if isinstance(cls, str) else cls
    found = triples.filter((F.col("p") == TYPE) & F.col("o").isin(*classes)).select(F.col("s").alias(subject)).hint("merge")
    return found if len(classes) == 1 else found.distinct()


def literal_is(triples: DataFrame, predicate: str, subject: str, value: str) -> DataFrame:
    return pattern(triples, predicate, subject, "_o").filter(F.col("_o") == value).select(subject)


def _shared(left: DataFrame, right: DataFrame) -> list[str]:
    names = [c for c in left.columns if c in right.columns]
    if not names:
        raise ValueError(f"patterns share no variable: {left.columns} / {right.columns}")
    return names


def every(*blocks: DataFrame) -> DataFrame:
    """Conjunction: all patterns must match."""
    return reduce(lambda a, b: a.join(b, _shared(a, b)), blocks)


def optional(base: DataFrame, *blocks: DataFrame) -> DataFrame:
    """Each block may match; variables of a block without a match stay null."""
    return reduce(lambda a, b: a.join(b, _shared(a, b), "left"), blocks, base)


def number(column: str) -> Column:
    return F.expr(f"try_cast({column} as double)")


def english(column: str) -> Column:
    """The label's language is English or not given."""
    return F.coalesce(F.col(f"{column}_lang"), F.lit("")).isin("en", "")


class Graph:
    """The reference's graph questions over one triple table.

    ``stars`` may hold the same triples bucketed by subject, all but those of the predicates ``spread``. Instead of tables
    there may be a function ``of`` that gives the triples of one predicate; ``triples`` is then needed by questions about all only.
    """

    def __init__(
        self, triples: DataFrame | None, stars: DataFrame | None = None, spread: Sequence[str] = (), of: Callable[[str], DataFrame] | None = None
    ):
        self.triples, self.stars, self.spread, self.of = triples, stars, spread, of

    def _source(self, predicate: str) -> DataFrame:
        if self.of is not None:
            return self.of(predicate)
        return self.triples if self.stars is None or predicate in self.spread else self.stars

    def p(self, predicate: str, subject: str, obj: str, keep_lang: bool = False) -> DataFrame:
        return pattern(self._source(predicate), predicate, subject, obj, keep_lang)

    def a(self, cls: str | list[str], subject: str) -> DataFrame:
        return instances(self._source(TYPE), cls, subject)

    def named(self, star: DataFrame, predicate: str, **variables: str) -> DataFrame:
        """Follow links of ``star``: for each given variable the ``predicate`` of the node it holds, under the given name.

        The nodes of all variables are looked up together, once, and joined back by Spark's choice of join.
        """
        nodes = reduce(DataFrame.unionByName, [star.select(F.col(v).alias("_node")) for v in variables.values()]).distinct()
        values = self.about(nodes, "_node", self.p(predicate, "_node", "_value"))
        for name, variable in variables.items():
            star = star.join(values.select(F.col("_node").alias(variable), F.col("_value").alias(name)), variable)
        return star.drop(*variables.values())

    def about(self, nodes: DataFrame, variable: str, *found: DataFrame) -> DataFrame:
        """``found`` (patterns on ``variable``) for the distinct nodes of that variable, stored.

        Many subjects lead to a few middle nodes (a currency, a country). Their values are looked up
        once and stored, so Spark knows how little they are before it joins them back and need not
        shuffle the subjects by a handful of keys.
        """
        wanted = nodes.select(variable).distinct()
        values = stored(every(wanted, *found), "middle")
        # the footers tell the rows; the size of the files says little about them in memory
        return values if values.count() <= BROADCAST_ROWS else values.hint("merge")

    def path(self, first: str, second: str, subject: str, obj: str) -> DataFrame:
        links = self.p(first, subject, "_mid")
        return every(links, self.about(links, "_mid", self.p(second, "_mid", obj))).select(subject, obj)

    # ---- market ----------------------------------------------------------------

    def all_stocks(self, ticker: str = "onto:hasTicker") -> DataFrame:
        found = optional(
            self.a("onto:Stock", "stock"),
            self.p(ticker, "stock", "ticker"),
            self.p(LABEL, "stock", "label"),
            self.p("onto:price", "stock", "price"),
            self.path("onto:hasCurrency", LABEL, "stock", "currency"),
        )
        return found.orderBy("ticker", "stock")

    def stock_prices(self, limit: int = 50) -> DataFrame:
        found = optional(
            every(self.a("onto:Stock", "stock"), self.p("onto:symbol", "stock", "symbol")),
            self.p(LABEL, "stock", "name"),
            self.p("onto:price", "stock", "price"),
            self.p("onto:marketCap", "stock", "marketCap"),
            self.path("onto:tradedOn", LABEL, "stock", "exchange"),
        ).drop("stock")
        return found.orderBy(number("marketCap").desc_nulls_last(), "symbol").limit(limit)

    def top_stocks(self, limit: int = 10) -> DataFrame:
        stocks = every(
            self.a("onto:Stock", "stock"), self.p("onto:symbol", "stock", "symbol"), self.p("onto:marketCap", "stock", "marketCap")
        )
        # the optional label multiplies rows only when repeated, so the cut comes after it
        named = optional(stocks, self.p(LABEL, "stock", "name")).select("symbol", "name", "marketCap")
        return named.orderBy(number("marketCap").desc(), "symbol", "name").limit(limit)

    def stock_by_symbol(self, symbol: str) -> DataFrame:
        return optional(
            every(self.a("onto:Stock", "stock"), literal_is(self._source("onto:symbol"), "onto:symbol", "stock", symbol)),
            self.p(LABEL, "stock", "name"),
            self.p("onto:price", "stock", "price"),
            self.path("onto:hasCurrency", "onto:currencyCode", "stock", "currency"),
            self.p("onto:marketCap", "stock", "marketCap"),
            self.path("onto:tradedOn", LABEL, "stock", "exchange"),
        )

    def all_currencies(self) -> DataFrame:
        return optional(
            self.a("onto:Currency", "currency"),
            self.p("onto:currencyCode", "currency", "code"),
            self.p(LABEL, "currency", "name"),
            self.p("onto:symbol", "currency", "symbol"),
        ).orderBy("code")

    def count_by_sector(self, cls: str) -> DataFrame:
        # count by the sector's node before its label is looked up
        members = every(self.a(cls, "member"), self.p("onto:belongsToSector", "member", "uri"))
        counts = every(members.groupBy("uri").agg(F.count("member").alias("_n")), self.p(LABEL, "uri", "sector"))
        return counts.groupBy("sector").agg(F.sum("_n").alias("count")).orderBy(F.col("count").desc(), "sector")

    def companies_by_sector(self, part_of_label: str) -> DataFrame:
        sectors = self.p(LABEL, "sector", "sectorLabel").filter(F.lower("sectorLabel").contains(part_of_label.lower()))
        links = self.p("onto:belongsToSector", "company", "sector")
        companies = every(self.a("onto:Company", "company"), every(links, self.about(links, "sector", sectors)))
        # two separate optionals: the second one binds on the stock found by the first
        found = optional(companies, self.p(LABEL, "company", "name"), self.p("onto:hasStock", "company", "stock"))
        caps = self.p("onto:marketCap", "stock", "marketCap")
        return (
            optional(found, caps)
            .select("company", "name", "stock", "marketCap")
            .orderBy(number("marketCap").desc_nulls_last(), "company")
        )

    # ---- exchange rates --------------------------------------------------------

    def exchange_rates(self) -> DataFrame:
        targets = self.p("onto:toCurrency", "fx", "to_uri")
        named = self.about(targets, "to_uri", self.p("skos:notation", "to_uri", "to_currency"), self.p(LABEL, "to_uri", "to_label"))
        return every(
            self.a("onto:ExchangeRate", "fx"),
            self.p("onto:rate", "fx", "rate"),
            self.path("onto:fromCurrency", "skos:notation", "fx", "from_currency"),
            every(targets, named),
        ).select("fx", "from_currency", "to_currency", "rate", "to_label").orderBy("to_currency", "fx")

    def exchange_rates_from(self, base: str, limit: int = 50) -> DataFrame:
        bases = self.path("onto:baseCurrency", "onto:currencyCode", "rate", "base").filter(F.col("base") == base)
        found = every(
            self.a("onto:ExchangeRate", "rate"),
            bases,
            self.path("onto:targetCurrency", "onto:currencyCode", "rate", "target"),
            self.p("onto:rate", "rate", "value"),
        )
        dated = optional(found, self.p("onto:date", "rate", "date")).select("rate", "target", "value", "date")
        return dated.orderBy("target", "rate").limit(limit)

    # ---- companies -------------------------------------------------------------

    def company_financials(self) -> DataFrame:
        companies = optional(
            every(self.a("onto:FinancialInstitution", "company"), self.p(LABEL, "company", "name")),
            self.p("onto:belongsToSector", "company", "sector"),
        )
        filings = optional(
            every(companies, self.p("onto:hasFinancialStatement", "company", "statement")),
            self.p("onto:fiscalYear", "statement", "year"),
            self.p("onto:fiscalQuarter", "statement", "quarter"),
            self.p("onto:revenue", "statement", "revenue"),
            self.p("onto:profitMargin", "statement", "profit_margin"),
            self.p("onto:returnOnEquity", "statement", "roe"),
        )
        return filings.orderBy("name", number("year"), F.col("quarter").desc())

    def top_roe(self, above: float = 5, limit: int = 10) -> DataFrame:
        found = every(
            self.a("onto:FinancialInstitution", "company"),
            self.p(LABEL, "company", "name"),
            self.p("onto:belongsToSector", "company", "sector"),
            self.p("onto:hasFinancialStatement", "company", "statement"),
            self.p("onto:returnOnEquity", "statement", "roe").filter(number("roe") > above),
            self.p("onto:revenue", "statement", "revenue"),
        )
        return found.orderBy(number("roe").desc(), "statement").limit(limit).select("name", "sector", "roe", "revenue")

    # ---- payments --------------------------------------------------------------

    def high_value_star(self, above: float = 10000) -> DataFrame:
        star = every(
            self.a("onto:Transaction", "tx"),
            self.p("onto:amountEUR", "tx", "amount").filter(number("amount") > above),
            self.p("onto:hasSender", "tx", "_from"),
            self.p("onto:hasReceiver", "tx", "_to"),
        )
        return optional(star, self.p("onto:status", "tx", "status"))

    def high_value_transactions(self, above: float = 10000, limit: int = 50) -> DataFrame:
        star = stored(self.high_value_star(above), "star")
        found = self.named(star, LABEL, sender_name="_from", receiver_name="_to")
        return found.orderBy(number("amount").desc(), "tx").limit(limit)

    def cross_border_star(self) -> DataFrame:
        star = every(
            self.a("onto:Transaction", "tx"),
            literal_is(self._source("onto:isCrossBorder"), "onto:isCrossBorder", "tx", "true"),
            self.p("onto:amountEUR", "tx", "amount_eur"),
            self.p("onto:hasSender", "tx", "_from"),
            self.p("onto:hasReceiver", "tx", "_to"),
        )
        return optional(star, self.p("onto:usesChannel", "tx", "channel"))

    def cross_border(self) -> DataFrame:
        star = stored(self.cross_border_star(), "star")
        found = self.named(star, "onto:country", sender_country="_from", receiver_country="_to")
        return found.orderBy(number("amount_eur").desc(), "tx")

    def transactions_with_fx(self, limit: int | None = 20) -> DataFrame:
        links = self.p("onto:hasCurrency", "tx", "curr_uri")
        base = every(
            self.a("onto:Transaction", "tx"),
            self.p("onto:amount", "tx", "original_amount"),
            self.p("onto:amountEUR", "tx", "amount_eur"),
            every(links, self.about(links, "curr_uri", self.p("skos:notation", "curr_uri", "currency"))),
        )
        if limit is not None:
            # every payment keeps at least one row, so the first rows come from the first payments
            base = base.orderBy("tx").limit(limit)
        rates = every(
            self.a("onto:ExchangeRate", "fx"), self.p("onto:toCurrency", "fx", "curr_uri"), self.p("onto:rate", "fx", "rate")
        )
        found = optional(base, rates).select("tx", "original_amount", "currency", "rate", "amount_eur")
        return found if limit is None else found.orderBy("tx", "rate").limit(limit)

    def volume_by_country(self) -> DataFrame:
        found = every(
            self.a("onto:Transaction", "tx"),
            self.p("onto:amountEUR", "tx", "amount"),
            self.path("onto:hasSender", "onto:country", "tx", "country"),
        )
        total = F.sum(F.col("amount").cast("decimal(18,2)"))
        return (
            found.groupBy("country")
            .agg(total.alias("total_volume"), F.count("tx").alias("tx_count"))
            .orderBy(F.col("total_volume").desc(), "country")
        )

    def daily_volume(self) -> DataFrame:
        found = every(
            self.a("onto:Transaction", "tx"), self.p("onto:amountEUR", "tx", "amount"), self.p("onto:timestamp", "tx", "at")
        )
        return (
            found.groupBy(F.to_date("at").alias("date"))
            .agg(F.sum(F.col("amount").cast("decimal(18,2)")).alias("daily_volume"), F.count("tx").alias("tx_count"))
            .orderBy("date")
        )

    def any_above(self, amount: float = 100000) -> DataFrame:
        """One boolean row; the scan stops at the first witness."""
        large = self.p("onto:amountEUR", "tx", "amount").filter(number("amount") > amount)
        return every(self.a("onto:Transaction", "tx"), large).limit(1).agg((F.count("tx") > 0).alias("answer"))

    def transaction_stats(self) -> DataFrame:
        amounts = every(self.a("onto:Transaction", "tx"), self.p("onto:amount", "tx", "amount"))
        amount = F.col("amount").cast("decimal(18,2)")
        return amounts.agg(
            F.count("tx").alias("total_transactions"),
            F.sum(amount).alias("total_volume"),
            F.avg(amount.cast("double")).alias("avg_amount"),
            F.max(amount).alias("max_amount"),
        )

    def count_by_status(self) -> DataFrame:
        rows = every(self.a("onto:Transaction", "tx"), self.p("onto:status", "tx", "status"))
        return rows.groupBy("status").agg(F.count("tx").alias("count")).orderBy(F.col("count").desc(), "status")

    def count_above(self, amount: float = 50000) -> DataFrame:
        rows = every(self.a("onto:Transaction", "tx"), self.p("onto:amount", "tx", "amount"))
        return rows.agg(F.count_if(number("amount") > amount).alias("high_value_count"))

    def transactions(self, status: str | None = None, min_amount: float | None = None, limit: int = 100) -> DataFrame:
        # a filter on an optional value drops the rows without it, so the pattern becomes required
        base = self.a("onto:Transaction", "tx")
        statuses, amounts = self.p("onto:status", "tx", "status"), self.p("onto:amount", "tx", "amount")
        base = every(base, statuses.filter(F.col("status") == status)) if status else optional(base, statuses)
        base = every(base, amounts.filter(number("amount") > min_amount)) if min_amount is not None else optional(base, amounts)
        star = optional(base, self.p("onto:transactionId", "tx", "txId"), self.p("onto:date", "tx", "date"))
        found = optional(star, self.path("onto:transactionCurrency", "onto:currencyCode", "tx", "currency"))
        return found.orderBy(F.col("date").desc_nulls_last(), "tx").limit(limit)

    # ---- any entity ------------------------------------------------------------

    def describe(self, iri: str) -> DataFrame:
        """Triples about ``iri``, and about the blank nodes it leads to; each round is stored."""
        rounds = Rounds(self.triples.sparkSession, "described")
        frontier = rounds.add(self.triples.filter(F.col("s") == iri).select("s", "p", "o"))
        while True:
            blanks = frontier.filter(F.col("o").startswith("_:")).select(F.col("o").alias("s")).distinct()
            blanks = blanks.join(rounds.known().select("s"), "s", "left_anti")
            if blanks.isEmpty():
                return rounds.known()
            frontier = rounds.add(self.triples.join(blanks, "s", "left_semi").select("s", "p", "o"))

    def construct_simple_stocks(self) -> DataFrame:
        found = every(
            self.a("onto:Stock", "stock"), self.p("onto:hasTicker", "stock", "ticker"), self.p("onto:priceEUR", "stock", "price")
        )
        template = [("rdf:type", F.lit("onto:SimpleStock")), ("onto:ticker", F.col("ticker")), ("onto:priceEUR", F.col("price"))]
        rows = F.array(*[F.struct(F.col("stock").alias("s"), F.lit(p).alias("p"), o.alias("o")) for p, o in template])
        return found.select(F.inline(rows)).distinct()

    def type_counts(self, prefix: str) -> DataFrame:
        typed = self._source(TYPE).filter((F.col("p") == TYPE) & F.col("o").startswith(prefix))
        return typed.groupBy(F.col("o").alias("type")).agg(F.count("s").alias("count")).orderBy(F.col("count").desc(), "type")

    def kb_stats(self, prefix: str = "onto:") -> DataFrame:
        """Seven figures about the store from one scan."""
        typed = F.col("p") == TYPE

        def of(cls):
            return F.count_if(typed & (F.col("o") == cls))

        classes = F.count_distinct(F.when(typed & (F.col("o") == "owl:Class") & F.col("s").startswith(prefix), F.col("s")))
        figures = {
            "Total Triples": F.count(F.lit(1)),
            "OWL Classes": classes,
            "Stocks": of("onto:Stock"),
            "Companies": of("onto:Company"),
            "Currencies": of("onto:Currency"),
            "Transactions": of("onto:Transaction"),
            "SKOS Concepts": of("skos:Concept"),
        }
        row = self.triples.agg(*[f.alias(f"f{i}") for i, f in enumerate(figures.values())])
        pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"f{i}").alias("value")) for i, n in enumerate(figures)])
        return row.select(F.inline(pairs))

    def data_sources(self) -> DataFrame:
        return optional(
            self.a("onto:DataSource", "source"),
            self.p(LABEL, "source", "label"),
            self.p("dcterms:format", "source", "format"),
            self.p("rdfs:comment", "source", "description"),
        )

    # ---- vocabulary ------------------------------------------------------------

    def skos_related(self) -> DataFrame:
        def named(link, variable):
            return self.path(link, "skos:prefLabel", "concept", variable)

        concepts = every(self.a("skos:Concept", "concept"), self.p("skos:prefLabel", "concept", "label", keep_lang=True))
        concepts = concepts.filter(english("label")).drop("label_lang")
        return optional(
            concepts, named("skos:broader", "broader"), named("skos:narrower", "narrower"), named("skos:related", "related")
        )

    def skos_hierarchy(self) -> DataFrame:
        concepts = every(self.a("skos:Concept", "concept"), self.p("skos:prefLabel", "concept", "prefLabel", keep_lang=True))
        broader = self.path("skos:broader", "skos:prefLabel", "concept", "broaderLabel")
        narrower = (
            self.p("skos:broader", "_child", "concept").groupBy("concept").agg(F.count("_child").alias("narrowerCount"))
        )
        found = optional(
            concepts.filter(english("prefLabel")).drop("prefLabel_lang"), broader, narrower
        )
        return found.orderBy("broaderLabel", "prefLabel")

    def concept_scheme(self) -> DataFrame:
        return optional(
            self.a("skos:ConceptScheme", "scheme"),
            self.p("dc:title", "scheme", "title"),
            self.p("dcterms:description", "scheme", "description"),
        )

    def _labelled(self, concepts: DataFrame, *more: DataFrame) -> DataFrame:
        labels = self.p("skos:prefLabel", "concept", "prefLabel", keep_lang=True).filter(english("prefLabel"))
        found = every(concepts, labels.drop("prefLabel_lang"))
        return optional(found, *more, self.p("skos:definition", "concept", "definition"))

    def top_concepts(self) -> DataFrame:
        tops = self.p("skos:hasTopConcept", "scheme", "concept").select("concept")
        return self._labelled(tops)

    def narrower_concepts(self, iri: str) -> DataFrame:
        links = self._source("skos:narrower")
        children = links.filter((F.col("p") == "skos:narrower") & (F.col("s") == iri)).select(F.col("o").alias("concept"))
        return self._labelled(children, self.p("skos:altLabel", "concept", "altLabel"))

    def search_concepts(self, keyword: str, limit: int = 50) -> DataFrame:
        """Concepts with the keyword in a label or definition.

        Each branch binds the variable it matched on; the variables it left open
        are bound afterwards, and rows equal over all branches appear once.
        """
        fields = {"prefLabel": "skos:prefLabel", "altLabel": "skos:altLabel", "definition": "skos:definition"}
        concepts = self.a("skos:Concept", "concept")
        branches = []
        for matched, predicate in fields.items():
            hits = self.p(predicate, "concept", matched).filter(F.lower(matched).contains(keyword.lower()))
            rest = [self.p(q, "concept", v) for v, q in fields.items() if v != matched]
            branches.append(optional(every(concepts, hits), *rest).select("concept", *fields))
        found = reduce(DataFrame.unionByName, branches).distinct()
        return found.orderBy("concept", *fields).limit(limit)


# ---- quads: named graphs, updates ------------------------------------------------


def ontology_classes(ontology: DataFrame, prefix: str = "onto:") -> DataFrame:
    """Classes of one named graph, given as its triples."""
    g = Graph(ontology)
    classes = g.a("owl:Class", "class").filter(F.col("class").startswith(prefix))
    return optional(
        classes, g.p(LABEL, "class", "label"), g.p("rdfs:subClassOf", "class", "superClass"), g.p("rdfs:comment", "class", "comment")
    ).orderBy("class")


def ontology_properties(triples: DataFrame | Graph, prefix: str = "onto:") -> DataFrame:
    g = triples if isinstance(triples, Graph) else Graph(triples)

    def of(kind):
        return g.a(f"owl:{kind}", "property").withColumn("type", F.lit(kind))

    properties = of("ObjectProperty").unionByName(of("DatatypeProperty")).filter(F.col("property").startswith(prefix))
    return optional(
        properties,
        g.p(LABEL, "property", "label"),
        g.p("rdfs:domain", "property", "domain"),
        g.p("rdfs:range", "property", "range"),
    ).orderBy("type", "property")


def union_default_graph(quads: DataFrame) -> DataFrame:
    return quads.drop("graph").distinct()


def graph_counts(quads: DataFrame) -> DataFrame:
    return quads.groupBy("graph").agg(F.count(F.lit(1)).alias("triple_count"))


_QUAD = ["graph", "s", "p", "o"]
_DEAL = "_deal"  # equal for equal statements: quads that are dealt by it are updated where they are, without a shuffle


def insert_triples(quads: DataFrame, new: DataFrame) -> DataFrame:
    return quads.unionByName(new).distinct()


def delete_triples(quads: DataFrame, gone: DataFrame) -> DataFrame:
    """The quads without those that have graph, subject, predicate and object of one in ``gone``; nothing is equal to null."""
    if _DEAL not in quads.columns or _DEAL not in gone.columns:
        return quads.join(gone.select(*_QUAD).distinct(), _QUAD, "left_anti")
    # a join would deal both sides anew by all of its keys
    named = gone.select(_DEAL, *_QUAD).dropna(subset=_QUAD).withColumn("_gone", F.lit(True))
    marked = quads.withColumn("_gone", F.lit(False)).unionByName(named, allowMissingColumns=True)
    found = F.max("_gone").over(Window.partitionBy(_DEAL, *_QUAD))
    return marked.withColumn("_found", found).filter(~F.col("_found")).drop("_gone", "_found")


def clear_graph(quads: DataFrame, graph: str) -> DataFrame:
    return quads.filter(F.col("graph") != graph)


def typed_bindings(bindings: DataFrame, value: str = "o", datatype: str = "datatype") -> DataFrame:
    """Typed views of a lexical value, chosen by its datatype; dates stay text."""
    kind = F.col(datatype)
    number_like = kind.contains("decimal") | kind.contains("float") | kind.contains("double")
    return bindings.withColumns(
        {
            "int_value": F.when(kind.contains("integer"), F.expr(f"try_cast({value} as bigint)")),
            "double_value": F.when(number_like, F.expr(f"try_cast({value} as double)")),
            "boolean_value": F.when(kind.contains("boolean"), F.lower(value) == "true"),
        }
    )
