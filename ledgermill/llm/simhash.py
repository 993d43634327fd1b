"""Near duplicates by SimHash: tiled exact comparison.

Each whole text becomes a fingerprint of its word shingles. Equal fingerprints are one class. The distinct fingerprints are
cut into tiles of at most about ``TILE`` by the population counts of their four 16-bit lanes, and a pair of tiles is compared
only if those counts, summed over the lanes, differ by no more than the radius: a flipped bit moves one lane's count by one, so
nothing within the radius is skipped. A comparison is an exclusive-or and a bit count in numpy. A tile pair yields not its
pairs but a spanning forest of them, at most one edge per fingerprint and partner tile, so a dense group costs
a linear number of rows and loses no link. Components come from star contractions over those edges.

The work on tile pairs grows with the square of the number of distinct fingerprints, divided by what the lanes let skip
(a factor of about 60 at radius 2).

Defined results: a null text is empty; texts without words have the fingerprint zero and are linked like any other. Repeated rows
repeat their result. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import slim
from ledgermill.llm.components import components
from ledgermill.session import stored

SEED = 42
TILE = 4096
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included; of the whole sequence if it is shorter."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - width] + 1]).tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed 64-bit number."""
    source = slim(docs, id_col, text_col)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [_signed(fingerprint(shingle_hashes(t, width))) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fp": np.array(found, dtype=np.int64)})

    return source.mapInPandas(each, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp long")


def _lanes(fp) -> list:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]


def _moves(radius: int) -> list[list[int]]:
    """Differences of lane counts within the radius, one of each opposite pair."""
    span = range(-radius, radius + 1)
    every = ([a, b, c, d] for a in span for b in span for c in span for d in span if abs(a) + abs(b) + abs(c) + abs(d) <= radius)
    return [m for m in every if m >= [0, 0, 0, 0]]


def spanning_edges(nodes: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that span every group which links within the radius form between two tiles.

    ``left`` and ``right`` hold a fingerprint in each row, as one or more 64-bit columns; ``nodes`` names the rows of
    both. A row takes one edge to each group it is near and not yet part of, so a dense group costs no more than a sparse one.
    """
    _, group = np.unique(nodes, return_inverse=True)
    split, out = len(left), []
    for i in range(split):
        far = np.bitwise_count(right ^ left[i]).sum(axis=1) if right.shape[1] > 1 else np.bitwise_count(right[:, 0] ^ left[i, 0])
        near = np.flatnonzero((far <= radius) & (group[split:] != group[i]))
        if len(near):
            near = near[np.argsort(far[near], kind="stable")]
            others, first = np.unique(group[split + near], return_index=True)
            out += [(int(nodes[i]), int(nodes[split + j])) for j in near[first]]
            group[np.isin(group, others)] = group[i]
    return out


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """u, v: edges between the fingerprints of column ``fp`` that span every group linked within ``radius`` bits."""
    lanes = F.array(*_lanes(F.col("fp")))
    cells = distinct.select("fp", lanes.alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("_size"))  # 17 to the fourth cells at most
    part = F.pmod(F.xxhash64("fp"), F.ceil(F.col("_size") / TILE)).cast("int")
    tiles = stored(
        cells.join(F.broadcast(sizes), "cell").select("cell", part.alias("part"), "fp")
        .groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")),
        "simhash-tiles",
    )
    moves = F.explode(F.array(*(F.array(*map(F.lit, m)) for m in _moves(radius))))
    left = tiles.select("cell", F.col("part").alias("left_part"), F.col("fps").alias("left"), moves.alias("move"))
    left = left.withColumn("near", F.zip_with("cell", "move", lambda c, m: c + m)).drop("cell")
    right = tiles.select(F.col("cell").alias("near"), F.col("part").alias("right_part"), F.col("fps").alias("right"))
    still = F.col("move") == F.array(*[F.lit(0)] * 4)
    pairs = left.join(right, "near").where(~still | (F.col("left_part") <= F.col("right_part"))).select("left", "right")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for a, b in zip(frame["left"], frame["right"], strict=True):
                nodes = np.concatenate([a, b]).astype(np.int64)
                prints = nodes.view(np.uint64)[:, None]
                found += spanning_edges(nodes, prints[: len(a)], prints[len(a) :], radius)
            yield pd.DataFrame(found, columns=["u", "v"], dtype=np.int64)

    return pairs.mapInPandas(compare, "u long, v long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp, component_id (the least identifier reachable through links)."""
    marked = stored(fingerprints(docs, id_col, text_col, width), "simhash-fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    hung = components(links(classes.select("fp"), radius))
    roots = classes.join(hung.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")
