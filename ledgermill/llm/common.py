"""Helpers the operators of this package share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import scratch_path, stored

#: The white space of all contracts, ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
A_Z, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def slim(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier and text under fixed names; a null text is empty. Other columns, whatever their names, are left behind."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal text of the identifier, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def rows_with_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose identifier is in ``ids`` (one column ``doc_id``), columns and repeats unchanged."""
    wanted = ids.select(F.col("doc_id").alias("_wanted_id"))
    return docs.join(wanted, docs[id_col].eqNullSafe(wanted["_wanted_id"]), "left_semi")


#: Rows of a side that is broadcast; each is a file name and a number, so a side stays below some 100 MB. Beyond it Spark shuffles.
BROADCAST_ROWS = 500_000
PLACE = ["_in_file", "_at_row"]


def located(docs: DataFrame) -> DataFrame:
    """``docs`` as rows of files, so that :func:`place` tells each row from all others whatever its columns hold.

    A table read from Parquet is taken as it is, anything else is stored first.
    """
    try:
        docs.select(*place(docs)).schema
        return docs
    except AnalysisException:
        return stored(docs, "located")


def place(docs: DataFrame) -> list[Column]:
    """File and row index of each row of a table read from Parquet, as the columns ``PLACE``."""
    where = docs.metadataColumn("_metadata")
    return [where["file_path"].alias(PLACE[0]), where["row_index"].alias(PLACE[1])]


def bounded(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored side of a join, to be broadcast if it is counted to be small."""
    return F.broadcast(side) if side.count() <= rows else side


def rows_at(docs: DataFrame, places: DataFrame, *columns: Column | str) -> DataFrame:
    """The rows of ``docs`` (located) at stored ``places``, with the columns of ``places`` and some of their own."""
    rows = docs.select(*place(docs), *columns)
    return rows.join(bounded(places), PLACE)


def rows_not_at(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``docs`` (located) that are not at stored ``places``; all columns. Only a large ``places`` moves the rows."""
    kept = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("_all"), *place(docs))
    return kept.join(bounded(places.select(*PLACE)), PLACE, "left_anti").select("_all.*")


@contextmanager
def shuffles_released(spark: SparkSession):
    """Within the block, each query that ends gives its shuffle files back at once. For steps that store what they make."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


class Scratch:
    """Stored tables of one operator that are deleted as soon as all that was made from them is stored itself."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._paths: list[tuple[DataFrame, str]] = []

    def put(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self._spark, label)
        df.write.parquet(path)
        table = self._spark.read.schema(df.schema).parquet(path)
        self._paths.append((table, path))
        return table

    def tables(self) -> list[DataFrame]:
        return [t for t, _ in self._paths]

    def drop_all_but(self, *tables: DataFrame) -> None:
        self.drop(*[t for t, _ in self._paths if not any(t is x for x in tables)])

    def drop(self, *tables: DataFrame) -> None:
        context = self._spark.sparkContext
        for table, path in self._paths:
            if any(table is t for t in tables):
                folder = context._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        self._paths = [(t, p) for t, p in self._paths if not any(t is x for x in tables)]
