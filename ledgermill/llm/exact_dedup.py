"""Exact deduplication as a stateful stream.

One row per document (digest, length, identifier, content locator) runs through a streaming aggregation whose
state is kept on disk (RocksDB), keyed by digest and never expired: the state of a digest holds the best row's identifier
and locator and the number of rows seen. Map-side aggregation precedes the keyed state, so a group that holds a third of
all rows reaches its state as one row per task. The locator is file and row index; digest hits are confirmed on the full bytes
found there, least against greatest text of a digest, again combined on the map side. Texts that share a digest but
differ are split into groups of their own.

Defined results: a null text is empty, and empty texts are equal to each other. Rows are told apart by their locators alone:
one identifier may have several texts, a null identifier is one like any other and loses every tie, and of repeated rows exactly one is kept.
An empty table gives an empty result. Texts are compared whole, however long. Other columns, whatever their names, are ignored;
:func:`without_copies` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import BLANKS, PLACE, located, place, rows_at, rows_not_at
from ledgermill.session import STATE_ON_DISK, scratch_path, settings, stored

def without_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _grouped_by_stream(facts_path: str, facts: DataFrame, files_per_batch: int) -> DataFrame:
    """(digest, best, n) after the whole folder has run through the keyed state."""
    spark = facts.sparkSession
    out, state = scratch_path(spark, "dedup-updates"), scratch_path(spark, "dedup-state")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with settings(spark, STATE_ON_DISK):
        query = (
            spark.readStream.schema(facts.schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(facts_path)
            .groupBy("digest")
            .agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("n"))
            .writeStream.outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
    query.awaitTermination()
    schema = f"digest string, best {facts.schema['rank'].dataType.simpleString()}, n long, batch int"
    updates = spark.read.schema(schema).parquet(out) if _has_batches(spark, out) else spark.createDataFrame([], schema)
    last = F.max(F.struct("batch", "best", "n"))
    return updates.groupBy("digest").agg(last.alias("last")).select("digest", "last.best", "last.n")


def _has_batches(spark, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int = 64,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest and the locator (``PLACE``): one row per row of ``docs``.

    Texts are equal when they are identical after white space is deleted. Of a group the row with the most code points
    stays, then the smallest identifier. ``digest`` may be any function of the normalised text; a weak one costs time, never
    correctness.
    """
    docs = located(docs)
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    path = scratch_path(spark, "dedup-facts")
    rows = docs.select(docs[id_col].alias("doc_id"), digest(without_blanks(text)).alias("digest"), F.length(text).alias("n_chars"), *place(docs))
    rank = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", *PLACE)
    rows.select("digest", rank.alias("rank")).write.parquet(path)
    facts = spark.read.parquet(path)
    groups = stored(_grouped_by_stream(path, facts, files_per_batch), "dedup-groups")
    joined = _judged(facts.join(groups, "digest"))
    several = stored(facts.join(groups.where("n > 1"), "digest").select("digest", *_place_of("rank")), "dedup-hits")
    texts = rows_at(docs, several, without_blanks(text).alias("norm"))
    differ = texts.groupBy("digest").agg(F.min("norm").alias("least"), F.max("norm").alias("greatest")).where("least <> greatest")
    wrong = stored(differ.select("digest"), "dedup-collisions")
    if wrong.isEmpty():
        return joined
    # regroup the rows of collided digests on the text itself
    mixed = stored(facts.join(wrong, "digest").select("digest", "rank", *_place_of("rank")), "dedup-mixed")
    rows = rows_at(docs, mixed, without_blanks(text).alias("norm"))
    best = rows.groupBy("digest", "norm").agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("n"))
    return joined.join(wrong, "digest", "left_anti").unionByName(_judged(rows.drop(*PLACE).join(best, ["digest", "norm"])))


def _place_of(rank: str) -> list[Column]:
    return [F.col(f"{rank}.{c}").alias(c) for c in PLACE]


def _judged(rows: DataFrame) -> DataFrame:
    """Rows with their own ``rank``, the ``best`` one of their group and its size ``n``."""
    return rows.select(
        F.col("rank.doc_id").alias("doc_id"), F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.struct(*_place_of("rank")) == F.struct(*_place_of("best"))).alias("kept"), "digest", *_place_of("rank"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one row of each group."""
    docs = located(docs)
    gone = stored(exact_groups(docs, id_col, text_col).where("NOT kept").select(*PLACE), "dedup-gone")
    return rows_not_at(docs, gone)
