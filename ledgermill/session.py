"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: State of streams: on disk, and a batch writes what it changed to the checkpoint instead of a whole snapshot.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_scratch: dict[str, str] = {}


def build_session(app: str = "ledgermill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` wins over them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings within a block; a stream keeps those it was started under."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of
    its own; on a cluster a machine-local folder would be lost with its node.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        _refuse_temporary(configured, context.master)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="ledgermill-")
    return _local_scratch[app]


def _refuse_temporary(folder: str, master: str) -> None:
    """A machine's own temporary folder cannot be shared; a mounted folder with a ``file:`` path can.

    Masters that run on one machine (``local``, ``local-cluster``) share even that.
    """
    path = folder.removeprefix("file:").replace("//", "/")
    if not master.startswith("local") and path.startswith(("/tmp/", "/var/tmp/", tempfile.gettempdir() + "/")):
        raise RuntimeError(f"spark.checkpoint.dir must be a folder every executor can reach, not {folder}")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/ledgermill/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage with a plain parquet table, so a lost executor costs a
    re-read instead of a recomputation and later passes see identical rows.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    schema = df.schema
    return df.sparkSession.read.schema(schema).parquet(path)
