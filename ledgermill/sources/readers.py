"""File, relational and message readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from ledgermill.operators.cooldown import MINUTE, cooldown
from ledgermill.operators.ordered import dense_index, running_totals
from ledgermill.session import stored


def read_rate_history(spark: SparkSession, path: str) -> DataFrame:
    """Daily reference rates from the nested XML history.

    Records are cut at each dated element by the text source, so one large file is
    still read in parallel splits; either quote style is accepted, and an element
    without a currency or a rate is skipped.
    """
    days = spark.read.option("lineSep", "<Cube time=").text(path)
    day = F.regexp_extract("value", r"""^\s*["'](\d{4}-\d{2}-\d{2})["']""", 1)
    elements = F.regexp_extract_all("value", F.lit(r"<Cube\s[^>]*>"), F.lit(0))
    cubes = days.filter(day != "").select(F.to_date(day).alias("reference_date"), F.explode_outer(elements).alias("cube"))

    def attribute(name: str) -> Column:
        return F.nullif(F.regexp_extract("cube", rf"""\s{name}\s*=\s*["']([^"']*)["']""", 1), F.lit(""))

    rates = cubes.select(
        F.lit("EUR").alias("base_currency"), attribute("currency").alias("target_currency"),
        attribute("rate").cast("double").alias("rate"), "reference_date",
    )
    return rates.filter(F.col("target_currency").isNotNull() & F.col("rate").isNotNull())


def read_flat_xml(spark: SparkSession, path: str, row_tag: str, columns: list[str]) -> DataFrame:
    """One text column per child tag; elements without any of them are skipped."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return rows.filter(F.coalesce(*[F.col(c) for c in columns]).isNotNull())


def read_multi_csv(spark: SparkSession, files: dict[str, str], schemas: dict[str, str] | None = None) -> DataFrame:
    """Stack CSV files with different headers, tagged by ``_csv_source``.

    A file that does not exist is left out; when none exists that is an error. Give
    ``schemas`` for large files: inferring types costs a second read.
    """
    schemas = schemas or {}
    parts = []
    for name, path in files.items():
        reader = spark.read.option("header", True)
        reader = reader.schema(schemas[name]) if name in schemas else reader.option("inferSchema", True)
        try:
            part = reader.csv(path)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        parts.append(part.withColumn("_csv_source", F.lit(name)))
    if not parts:
        raise FileNotFoundError(f"none of {sorted(files.values())} exists")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_json(spark: SparkSession, path: str, schema: str | None = None, array: bool = False) -> DataFrame:
    """JSON lines, or files holding one array of objects each."""
    reader = spark.read.option("multiLine", array)
    return (reader.schema(schema) if schema else reader).json(path)


def read_layer(spark: SparkSession, path: str, tables: list[str]) -> dict[str, DataFrame]:
    """Tables of a layer folder; empty ones are left out."""
    frames = {name: spark.read.parquet(f"{path}/{name}") for name in tables}
    return {name: df for name, df in frames.items() if not df.isEmpty()}


# The columns of a payment read from the operational store.
TRANSACTION_COLUMNS = (
    "transaction_id sender_id sender_name sender_country sender_iban sender_bank receiver_id receiver_name receiver_country "
    "receiver_iban receiver_bank amount currency amount_eur transaction_type description reference channel status "
    "is_cross_border created_at processed_at"
).split()


def recent_rows(df: DataFrame, columns: list[str], ts: str, tie: str, limit: int = 1000) -> DataFrame:
    """Projection and latest rows; over JDBC Spark pushes all of it into the source query."""
    return df.select(*columns).orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(limit)


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str, partition: dict | None = None, **options: str) -> DataFrame:
    """Relational table; ``partition`` (column, lower, upper, count) reads it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, driver=driver, **options)
    if partition:
        reader = reader.options(
            partitionColumn=partition["column"], lowerBound=partition["lower"],
            upperBound=partition["upper"], numPartitions=partition["count"],
        )
    return reader.load()


PICKED = 10_000  # so many keys at most are sorted on the driver


def key_at(rows: DataFrame, key: str, place: int):
    """The key of the row at ``place`` in the order of ``key`` (the greatest, if there are fewer rows); None without rows.

    A sketch of the keys names two bounds around the place, a count tells which side of them it lies on, and the search goes on
    there. Every step is one aggregation over the rows in question: nothing is sorted, and no task takes the first rows of all.
    Keys of types without such a sketch (text) are numbered over a range-partitioned order instead.
    """
    kind = rows.schema[key].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        last = rows.agg(F.max(key)).first()[0]
        found = dense_index(rows.select(key), [key], "_place").filter(F.col("_place") == place).first()
        return found[key] if found else last
    rows, value = rows.select(key).filter(F.col(key).isNotNull()), F.col(key)
    while True:
        n, low, high = rows.agg(F.count(key), F.min(key), F.max(key)).first()
        if place >= n or low == high:
            return high
        if n <= PICKED:
            return sorted(r[0] for r in rows.collect())[place]
        share = place / n
        left, right = rows.agg(F.percentile_approx(key, [max(0.0, share - 0.001), min(1.0, share + 0.001)], 10_000)).first()[0]
        if (left, right) == (low, high):
            right = left  # few different keys: the least one is judged alone
        under, inside = rows.agg(F.count_if(value < F.lit(left)), F.count_if(value.between(F.lit(left), F.lit(right)))).first()
        if place < under:
            rows = rows.filter(value < F.lit(left))
        elif place < under + inside:
            if left == right:
                return left
            rows, place = rows.filter(value.between(F.lit(left), F.lit(right))), place - under
        else:
            rows, place = rows.filter(value > F.lit(right)), place - under - inside


def read_incremental(df: DataFrame, key: str, last, limit: int | None = None) -> tuple[DataFrame, object]:
    """Rows above the high-water mark, and the new mark (the old one when nothing is new).

    Without a limit everything new is one poll, read without a sort. ``limit`` is the size of a poll: it ends with the
    key of the row at that place, and all rows of that key belong to it, so equal keys are never torn apart. The rows
    are cut at the mark, so rows that arrive between the two reads wait for the next poll.
    """
    fresh = df.filter(F.col(key) > F.lit(last))
    newest = fresh.agg(F.max(key)).first()[0] if limit is None else key_at(fresh, key, limit - 1)
    return fresh.filter(F.col(key) <= F.lit(newest)), last if newest is None else newest


def cut_polls(df: DataFrame, key: str, limit: int) -> DataFrame:
    """All polls of ``limit`` rows at once: the rows with the number of their ``poll``, cut as :func:`read_incremental` does one by one.

    A poll ends with the first key up to which ``limit`` rows have come since the last one ended. That is the rule of a
    cooldown whose moments are the counts of rows up to each key (a minute for a row), and it is solved in parallel as such.
    """
    rows = df.filter(F.col(key).isNotNull())
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    upto = stored(running_totals(counts, [key], {"_upto": F.col("_n")}).select(key, "_upto"), "rows-by-key")
    start = df.sparkSession.range(1).select(F.lit(0).cast("long").alias("_upto"))
    moment = F.timestamp_micros(F.col("_upto") * MINUTE)
    ends = cooldown(start.unionByName(upto.select("_upto")).select(F.lit("polls").alias("rule"), moment.alias("ts"), "_upto"), limit)
    ends = ends.filter(F.col("_upto") > 0).select("_upto", F.lit(1).alias("_ends"))
    marked = upto.join(ends, "_upto", "left").withColumn("_ends", F.coalesce("_ends", F.lit(0)))
    numbered = running_totals(marked, ["_upto"], {"_ended": F.col("_ends")})
    return rows.join(numbered.select(key, (F.col("_ended") - F.col("_ends")).alias("poll")), key)


def read_kafka_stream(spark: SparkSession, servers: str, topics: str, starting: str = "latest", **options: str) -> DataFrame:
    """Topic stream; needs the Kafka connector on the class path."""
    base = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting, "failOnDataLoss": "false"}
    return spark.readStream.format("kafka").options(**base, **options).load()


def stamp_metadata(df: DataFrame, source: str, source_type: str, real: bool, flag: str = "_is_real_data") -> DataFrame:
    """Extraction columns; a delivered ``_extracted_at`` is kept where present."""
    now = F.current_timestamp()
    extracted = F.coalesce(F.col("_extracted_at").cast("timestamp"), now) if "_extracted_at" in df.columns else now
    return df.withColumns(
        {"_extracted_at": extracted, "_source": F.lit(source), "_source_type": F.lit(source_type), flag: F.lit(real), "_loaded_at": now}
    )


_TERM = r"""(<[^>]*>|_:\S+)"""
_LINE = rf"""^\s*{_TERM}\s+<([^>]*)>\s+(<[^>]*>|_:\S+|"(?:[^"\\]|\\.)*"(?:@[A-Za-z0-9-]+|\^\^<[^>]*>)?)\s*(?:<([^>]*)>)?\s*\.\s*$"""


def read_ntriples(spark: SparkSession, path: str, graph: str | None = None) -> DataFrame:
    """Quads from N-Triples or N-Quads lines; a line without a graph goes to ``graph``."""
    lines = spark.read.text(path)

    def part(group: int) -> Column:
        return F.regexp_extract("value", _LINE, group)

    def bare(term: Column) -> Column:
        return F.when(term.startswith("<"), F.regexp_replace(term, "^<|>$", "")).otherwise(term)

    rows = lines.select(part(1).alias("s0"), part(2).alias("p"), part(3).alias("o0"), part(4).alias("g0")).filter(F.col("p") != "")
    literal = F.col("o0").startswith('"')
    body = F.regexp_extract("o0", r'^"((?:[^"\\]|\\.)*)"', 1)
    # undo the escapes; the double backslash is parked first so that it cannot form a new escape
    text = F.replace(body, F.lit("\\\\"), F.lit("\u0000"))
    for escaped, plain in (('\\"', '"'), ("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r"), ("\u0000", "\\")):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return rows.select(
        F.coalesce(F.nullif("g0", F.lit("")), F.lit(graph)).alias("graph"),
        bare(F.col("s0")).alias("s"),
        "p",
        F.when(literal, text).otherwise(bare(F.col("o0"))).alias("o"),
        F.when(literal, "literal").otherwise("iri").alias("o_kind"),
        F.nullif(F.regexp_extract("o0", r"\^\^<([^>]*)>$", 1), F.lit("")).alias("datatype"),
        F.nullif(F.regexp_extract("o0", r'"@([A-Za-z0-9-]+)$', 1), F.lit("")).alias("lang"),
    )


def to_ntriples(quads: DataFrame) -> DataFrame:
    """N-Quads lines of a quad table."""
    text = F.col("o")
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    suffix = F.when(F.col("lang").isNotNull(), F.concat(F.lit("@"), "lang")).when(
        F.col("datatype").isNotNull(), F.concat(F.lit("^^<"), "datatype", F.lit(">"))
    ).otherwise("")

    def node(column: str) -> Column:
        return F.when(F.col(column).startswith("_:"), F.col(column)).otherwise(F.concat(F.lit("<"), column, F.lit(">")))

    obj = F.when(F.col("o_kind") == "literal", F.concat(F.lit('"'), text, F.lit('"'), suffix)).otherwise(node("o"))
    return quads.select(
        F.concat(node("s"), F.lit(" <"), "p", F.lit("> "), obj, F.lit(" <"), "graph", F.lit("> .")).alias("value")
    )


def triplify(df: DataFrame, subject: Column, cls: str, literals: dict[str, tuple[Column, str | None]], links: dict[str, Column] | None = None) -> DataFrame:
    """Type, literal and link triples per row; a null value gives no triple."""
    null = F.lit(None).cast("string")

    def triple(p, o, kind, datatype):
        return F.struct(
            F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"),
            (F.lit(datatype) if datatype else null).alias("datatype"),
        )

    rows = [triple("rdf:type", F.lit(cls), "iri", None)]
    rows += [triple(p, value, "literal", datatype) for p, (value, datatype) in literals.items()]
    rows += [triple(p, value, "iri", None) for p, value in (links or {}).items()]
    return df.select(subject.alias("s"), F.inline_outer(F.array(*rows))).filter(F.col("o").isNotNull())
