"""Small tables for the tests of the text operators."""

from ledgermill.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Rows every operator must survive: nulls, empty and long texts, repeats, ties.
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n", "en", "a", 3),
    (4, "one", "en", "a", 3),
    (5, "one", "en", "a", 3),
    (6, "o n e", None, "a", 5),
    (7, "ÜBER die Straße\u0000 😀 ÀÉ " * 30, "de", "b", 10),
    (8, "word " * 30000, "en", "b", 10),
    (9, "x" * 120000, "en", "b", 10),
    (10, "1" * 60000 + " " + "a.b" * 20000, "en", "b", 10),
]


def folder(spark, tmp_path, rows=AWKWARD, **tables):
    """A data folder with ``documents`` (extra, clashing columns included) and other tables given as (rows, schema)."""
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.selectExpr("*", "lang AS rank", "source AS digest", "n_chars AS place", "text AS norm", "n_chars AS n").write.parquet(f"{tmp_path}/documents.parquet")
    tables.setdefault("labels", ([(r[0], r[0] % 2, 0) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int"))
    tables.setdefault("benchmark", ([(0, "a benchmark text of some words")], "item_id long, text string"))
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def run(spark, name, where):
    return queries.RUNNERS[name](spark, where)
