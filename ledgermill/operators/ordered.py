"""Row-order operators that never put one group into one task.

A plain ``Window.partitionBy(key)`` sends a whole key to one task, and an
unpartitioned window sends the whole table. Here rows are range-partitioned on
the full order (key included, so a hot key spans many partitions), stored once,
and numbered from per-partition counts. Row frames are then evaluated on
fixed-size chunks that carry the few preceding rows they need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgermill.session import stored

ROWS_PER_PART = 2_000_000  # sorted by one task; more parts than the session's default follow from the input
BYTES_PER_PART = 64 << 20  # the same, of input files
ROWS_PER_CHUNK = 1_000_000  # summed in order by one task
FRAMES_PER_CHUNK = 40  # chunk length in frame lengths: 2.5 % of the rows are carried twice
_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition << 33 | position
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def _input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files behind ``df``; None where a part of it comes from elsewhere, whose size is only guessed. Runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() not in ("LogicalRelation", "LocalRelation", "OneRowRelation"):
            return None
        total += int(str(leaf.stats().sizeInBytes()))
    return total


def _ranged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Globally sorted copy of ``df`` with ``_part`` and ``_row`` (position inside it).

    ``df`` runs twice, for the sample of the bounds and for the copy.
    """
    size = _input_bytes(df)
    parts = -(-df.count() // ROWS_PER_PART) if size is None else -(-size // BYTES_PER_PART)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the usual number may be merged at run time, a larger one is meant
    ranged = df.repartitionByRange(parts, *order) if parts > usual else df.repartitionByRange(*order)
    placed = (
        ranged
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return stored(placed, "ordered").withColumns(
        {
            "_part": F.shiftright("_mid", _POSITION_BITS),
            "_row": F.col("_mid").bitwiseAND(F.lit(_POSITION_MASK)),
        }
    )


def _offsets(per_part: DataFrame, totals: Sequence[str]) -> DataFrame:
    """Exclusive prefix sums over totals: one row for each partition, or each chunk of a million rows."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in totals]
    )


def dense_index(df: DataFrame, order: Sequence[str | Column], name: str = "_idx", start: int = 0) -> DataFrame:
    """Add the global rank of every row; ``order`` must be a total order."""
    rows = _ranged(df, order)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range partition, so the broadcast is bounded by the partition count
    return (
        rows.join(F.broadcast(_offsets(counts, ["_n"])), "_part")
        .withColumn(name, F.col("_n_before") + F.col("_row") + F.lit(start))
        .drop("_mid", "_part", "_row", "_n_before")
    )


def running_totals(df: DataFrame, order: Sequence[str | Column], totals: dict[str, Column]) -> DataFrame:
    """Inclusive running sums over the global order, one output column per entry.

    Sums of chunks of fixed size are added up first, so no task sums more than a chunk in order.
    """
    names = [f"_v_{k}" for k in totals]
    rows = dense_index(df.withColumns({f"_v_{k}": v for k, v in totals.items()}), order)
    rows = rows.withColumn("_part", F.expr(f"_idx div {ROWS_PER_CHUNK}"))
    per_chunk = rows.groupBy("_part").agg(*[F.sum(n).alias(n) for n in names])
    inside = Window.partitionBy("_part").orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(_offsets(per_chunk, names), "_part")
    out = out.withColumns({k: F.col(f"_v_{k}_before") + F.sum(f"_v_{k}").over(inside) for k in totals})
    return out.drop("_idx", "_part", *names, *[f"{n}_before" for n in names])


def bounded_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    include_current: bool,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Evaluate ``columns`` over the last ``preceding`` rows of each key.

    With ``include_current`` the frame is the current row and the
    ``preceding`` rows before it, otherwise only the rows before it.
    """
    indexed = dense_index(df, [*keys, *order])
    return _frames(_chunked(indexed, preceding, chunk_rows), keys, preceding, columns, include_current)


def carried_frames(
    df: DataFrame,
    before: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    include_current: bool,
    chunk_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """:func:`bounded_frames` of rows that come after those of ``before``, and what to carry on.

    ``before`` holds the last ``preceding`` rows of each key with ``_back``, counted from 1 for the last one. Only the new rows
    are sorted; carried rows join the first chunk of their key, and the second one if the key has rows there and the first holds
    fewer than a frame of them, beyond which they cannot be in a frame. The second result has the same columns as ``before``: rows are numbered in order, so a key's last ones follow from its greatest
    number, and the rows of a key without new ones pass through.
    """
    indexed = dense_index(df, [*keys, *order])
    chunks = _chunked(indexed, preceding, chunk_rows)
    ends = indexed.groupBy(*keys).agg(F.min("_idx").alias("_lo"), F.max("_idx").alias("_hi"))
    # one row per key of the batch
    ends = stored(ends, "key-ends").withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)})

    def with_ends(rows: DataFrame, how: str) -> DataFrame:
        same = [rows[k].eqNullSafe(ends[f"_key_{i}"]) for i, k in enumerate(keys)]
        joined = rows.join(ends, reduce(lambda a, b: a & b, same), how) if same else rows.crossJoin(F.broadcast(ends))
        return joined.drop(*[f"_key_{i}" for i in range(len(keys))])

    size = _chunk_rows(preceding, chunk_rows)
    chunks_seen = F.expr(
        f"CASE WHEN _hi div {size} > _lo div {size} AND _back <= {preceding} - ({size} - _lo % {size})"
        f" THEN array(_lo div {size}, _lo div {size} + 1) ELSE array(_lo div {size}) END"
    )
    earlier = with_ends(before, "inner").withColumn("_chunk", F.explode(chunks_seen))
    earlier = earlier.withColumns({"_idx": -F.col("_back"), "_halo": F.lit(True)}).drop("_back", "_lo", "_hi")
    frames = _frames(chunks.unionByName(earlier), keys, preceding, columns, include_current)

    new = with_ends(indexed, "inner").withColumn("_back", F.col("_hi") - F.col("_idx") + 1)
    old = with_ends(before, "left").withColumn("_back", F.col("_back") + F.coalesce(F.col("_hi") - F.col("_lo") + 1, F.lit(0)))
    tail = new.select(*before.columns).unionByName(old.select(*before.columns)).filter(F.col("_back") <= preceding)
    return frames, tail


def _chunk_rows(preceding: int, chunk_rows: int | None) -> int:
    return max(chunk_rows or max(FRAMES_PER_CHUNK * preceding, 1000), preceding)


def _chunked(indexed: DataFrame, preceding: int, chunk_rows: int | None) -> DataFrame:
    """Rows with their ``_chunk``; the last ``preceding`` of a chunk once more, as ``_halo``, with the next one."""
    size = _chunk_rows(preceding, chunk_rows)
    chunk = F.expr(f"_idx div {size}")
    in_tail = F.col("_idx") % size >= size - preceding
    home = F.struct(chunk.alias("chunk"), F.lit(False).alias("halo"))
    next_chunk = F.struct((chunk + 1).alias("chunk"), F.lit(True).alias("halo"))
    return (
        indexed.withColumn("_at", F.explode(F.when(in_tail, F.array(home, next_chunk)).otherwise(F.array(home))))
        .withColumns({"_chunk": F.col("_at.chunk"), "_halo": F.col("_at.halo")})
        .drop("_at")
    )


def _frames(
    chunks: DataFrame, keys: Sequence[str], preceding: int, columns: Callable[[WindowSpec], dict[str, Column]], include_current: bool
) -> DataFrame:
    frame = (
        Window.partitionBy("_chunk", *keys).orderBy("_idx").rowsBetween(-preceding, 0 if include_current else -1)
    )
    return chunks.withColumns(columns(frame)).filter(~F.col("_halo")).drop("_chunk", "_halo", "_idx")
