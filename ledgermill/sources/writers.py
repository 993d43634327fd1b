"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_bronze(df: DataFrame, root: str, source_type: str, name: str, run_ts: str) -> str:
    """Raw JSON of one run below its own folder; an existing run is never overwritten."""
    path = f"{root}/{source_type}/{name}/run_ts={run_ts}"
    df.write.mode("errorifexists").json(path)
    return path


def write_jsonl(df: DataFrame, path: str) -> None:
    options = {"dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    df.write.mode("overwrite").options(**options).json(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Drop and recreate a catalog table from the frame."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def export_parquet(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """One folder per table; a failing table is reported and the others still written."""
    outcome = {}
    for name, df in tables.items():
        try:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            outcome[name] = "success"
        except Exception as error:
            outcome[name] = f"failed: {type(error).__name__}"
    return outcome


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_rates_xml(df: DataFrame, path: str) -> None:
    """``<rate currency value date>`` elements with the currency's name and region inside."""
    shaped = df.select(
        F.col("target_currency").alias("_currency"), F.col("rate").alias("_value"),
        F.col("reference_date").cast("string").alias("_date"), "currency_name", "region",
    )
    shaped.write.mode("overwrite").format("xml").option("rootTag", "exchange_rates").option("rowTag", "rate").save(path)


# Export type per kind of column; anything else becomes text.
_EXPORT_TYPES = {
    "tinyint": "bigint", "smallint": "bigint", "int": "bigint", "bigint": "bigint", "float": "double", "double": "double",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp", "boolean": "boolean",
}


def relational_shape(df: DataFrame) -> DataFrame:
    """Column names and types as a relational export expects them."""
    def clean(name: str) -> str:
        return name.replace(" ", "_").lower()

    return df.select(*[F.col(f"`{n}`").cast(_EXPORT_TYPES.get(t, "string")).alias(clean(n)) for n, t in df.dtypes])


def export_jdbc(df: DataFrame, url: str, table: str, driver: str, batch_size: int = 10000, **options: str) -> bool:
    """Replace a relational table; an empty frame is skipped. True when written."""
    if df.isEmpty():
        return False
    shaped = relational_shape(df)
    (
        shaped.write.format("jdbc")
        .options(url=url, dbtable=table, driver=driver, batchsize=batch_size, truncate="false", **options)
        .mode("overwrite")
        .save()
    )
    return True


def absent_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` yet, first by ``order`` per key."""
    row = F.struct(*[F.col(c) for c in batch.columns])
    first = batch.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row")).select("_row.*")
    return first.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(path: str, target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> None:
    """Append the absent rows to the table at ``path``."""
    absent_rows(target, batch, keys, order).write.mode("append").parquet(path)


def to_message_records(df: DataFrame, key: str | Column) -> DataFrame:
    """String key and JSON value of each row, the shape a message sink takes."""
    key_column = F.col(key) if isinstance(key, str) else key
    return df.select(key_column.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
