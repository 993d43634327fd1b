"""Near-duplicate texts: SimHash by tiled exact comparison, confirmed on the shingles.

Texts are near duplicates when their sets of five-word shingles have a Jaccard similarity of at least 0.8. Each text has a
128-bit SimHash of that set. At similarity 0.8 two fingerprints differ in 19 bits on average with a deviation of 4, so
``RADIUS`` 30 finds a pair at the limit with a probability of 0.995, and closer pairs more surely. Tiles hold texts of one band of
set sizes and one range of population counts; sets that differ in size by more than the limit allows are never compared, nor
tiles whose population counts differ beyond the radius. A tile pair yields a spanning forest.

The forests' components are candidates: two documents within the radius are always in one. Each member is compared exactly with
the first document of its component, those that fail are compared along their own edges, and what is confirmed makes groups.
So a group of copies costs one comparison per member. A component that is not one group after that is open: its links need
not be along the forest. Blocks of its members are compared with each other, and every pair within the radius is compared on the
shingles unless both ends are already known to be in one group. No link within the radius is left out; the work on an open
component grows with the pairs of different groups in it.

Rows are told apart by file and row index and carry a number in the order of their identifiers, so one identifier may have
several texts. Texts leave their rows only for members of candidate components.

Defined results: null texts and texts without words are in no group. Of a group the row with the least identifier stays, null identifiers
after all others, then the first by its place; so of repeated rows one stays. Texts are compared whole, however long. An empty table gives
an empty result. Other columns, whatever their names, are left as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import PLACE, located, place, rows_at, rows_not_at, shuffles_released
from ledgermill.llm.components import components
from ledgermill.llm.simhash import fingerprint, shingle_hashes, spanning_edges
from ledgermill.llm.words import mix
from ledgermill.operators.ordered import dense_index
from ledgermill.session import stored

WIDTH, SIMILARITY, RADIUS = 5, 0.8, 30
TILE = 4096
BLOCK = 256  # members of an open component compared with as many others in a task
_COUNTS = 8  # population counts in one range


def _marked(texts: DataFrame, width: int) -> DataFrame:
    """Place, fingerprint and size of the shingle set of each text with words."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for file, row, text in zip(*(frame[c] for c in PLACE), frame["text"], strict=True):
                hashes = np.unique(shingle_hashes(text, width))
                both = np.array([fingerprint(hashes), fingerprint(mix(hashes))], dtype=np.uint64)
                out.append((file, row, *both.view(np.int64).tolist(), len(hashes)))
            yield pd.DataFrame(out, columns=[*PLACE, "low", "high", "size"])

    return texts.mapInPandas(each, f"{PLACE[0]} string, {PLACE[1]} long, low long, high long, size int").where("size > 0")


def _links(marked: DataFrame, similarity: float, radius: int) -> DataFrame:
    """u, v: candidate pairs that span every group linked within the radius."""
    step = -math.log(similarity)
    band = F.floor(F.log("size") / step).cast("int")  # sets of neighbouring bands at most can be similar enough
    count = F.floor((F.bit_count("low") + F.bit_count("high")) / _COUNTS).cast("int")
    cells = marked.select("doc_id", "low", "high", band.alias("band"), count.alias("count"))
    sizes = cells.groupBy("band", "count").agg(F.count(F.lit(1)).alias("_size"))  # some hundred bands times 17
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("_size") / TILE)).cast("int")
    tiles = stored(
        cells.join(F.broadcast(sizes), ["band", "count"]).groupBy("band", "count", part.alias("part"))
        .agg(F.collect_list(F.struct("doc_id", "low", "high")).alias("docs"))
        .select("band", "count", "part", *(F.col(f"docs.{c}").alias(c) for c in ("doc_id", "low", "high"))),
        "near-tiles",
    )
    left = tiles.select(*(F.col(c).alias(f"l_{c}") for c in tiles.columns), F.explode(F.array(F.lit(0), F.lit(1))).alias("_up"))
    left = left.withColumn("band", F.col("l_band") + F.col("_up"))
    reach = (radius + _COUNTS - 1) // _COUNTS
    close = F.abs(F.col("count") - F.col("l_count")) <= reach
    once = (F.col("_up") == 1) | (F.struct("l_count", "l_part") <= F.struct("count", "part"))
    pairs = left.join(tiles, "band").where(close & once)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for r in frame.itertuples(index=False):
                nodes = np.concatenate([r.l_doc_id, r.doc_id]).astype(np.int64)
                left, right = (np.column_stack(p).astype(np.int64).view(np.uint64) for p in ((r.l_low, r.l_high), (r.low, r.high)))
                found += spanning_edges(nodes, left, right, radius)
            yield pd.DataFrame(found, columns=["u", "v"], dtype=np.int64)

    columns = [c for name in ("doc_id", "low", "high") for c in (f"l_{name}", name)]
    # tile pairs differ in nothing but their size: deal them out evenly
    return pairs.select(columns).repartition(F.xxhash64(F.col("l_doc_id")[0], F.col("doc_id")[0])).mapInPandas(compare, "u long, v long")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (u, v) whose shingle sets are similar enough; ``texts`` holds all their ends."""
    left = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("left"))
    right = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("right"))
    both = stored(pairs.join(right, "v"), "near-members").join(left, "u")

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, known = None, np.zeros(0)
        for frame in frames:
            keep = []
            for u, x, y in zip(frame["u"], frame["left"], frame["right"], strict=True):
                if u != last or x is None:
                    last, known = u, np.unique(shingle_hashes(x, width))
                keep.append(_similar(known, np.unique(shingle_hashes(y, width)), similarity))
            yield frame.loc[keep, ["u", "v"]]

    return both.mapInPandas(each, "u long, v long")


def _similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= similarity * (len(x) + len(y) - shared) - 1e-9


def joined_groups(frame: pd.DataFrame, similarity: float, radius: int) -> list[tuple[int, int]]:
    """u, v: confirmed links that join the groups of the rows of side 0 with those of side 1 wherever a link does."""
    sides = [frame[frame["side"] == side] for side in (0, 1)]
    left, right = (s[["low", "high"]].to_numpy(np.int64).view(np.uint64) for s in sides)
    names, group = np.unique(frame["label"].to_numpy(), return_inverse=True)
    left_group, right_group = (group[(frame["side"] == side).to_numpy()] for side in (0, 1))
    left_id, right_id = (s["doc_id"].tolist() for s in sides)
    left_set, right_set = ([np.frombuffer(b, np.uint64) for b in s["shingles"]] for s in sides)
    root = list(range(len(names)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    far = sum(np.bitwise_count(left[:, None, k] ^ right[None, :, k]).astype(np.int16) for k in (0, 1))
    small, large = (np.array([len(x) for x in s], dtype=np.float64) for s in (left_set, right_set))
    sizes = np.minimum(small[:, None], large) >= similarity * np.maximum(small[:, None], large) - 1e-6
    at = np.argwhere((far <= radius) & sizes & (left_group[:, None] != right_group))
    out = []
    for i, j in at[np.argsort(far[at[:, 0], at[:, 1]], kind="stable")].tolist():
        p, q = find(int(left_group[i])), find(int(right_group[j]))
        if p != q and _similar(left_set[i], right_set[j], similarity):
            root[q] = p
            out.append((left_id[i], right_id[j]))
    return out


def _remaining(loose: DataFrame, firm: DataFrame, texts: DataFrame, width: int, similarity: float, radius: int) -> DataFrame:
    """Links (u, v) that the confirmed ones lack, from all pairs of different groups of a candidate component."""
    groups = components(firm).withColumnRenamed("root", "_group")
    labelled = stored(loose.join(groups, "node", "left").select("node", "root", F.coalesce("_group", "node").alias("label")), "near-labels")
    several = labelled.groupBy("root").agg(F.min("label").alias("_a"), F.max("label").alias("_z")).where("_a <> _z").select("root")
    still = labelled.join(several, "root")

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, root, label, text in zip(frame["doc_id"], frame["root"], frame["label"], frame["text"], strict=True):
                hashes = np.unique(shingle_hashes(text, width))
                both = np.array([fingerprint(hashes), fingerprint(mix(hashes))], dtype=np.uint64)
                out.append((doc_id, root, label, *both.view(np.int64).tolist(), hashes.tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "root", "label", "low", "high", "shingles"])

    named = texts.join(still.withColumnRenamed("node", "doc_id"), "doc_id").select("doc_id", "root", "label", "text")
    members = stored(named.mapInPandas(each, "doc_id long, root long, label long, low long, high long, shingles binary"), "near-open")
    # a block holds members of one large group, or whole small groups; long texts count more
    weight = F.sum(1 + F.length("shingles") / (8 * 4096)) / BLOCK
    large = members.groupBy("root", "label").agg(weight.alias("_weight")).withColumn("_large", F.col("_weight") > 1)
    rest = F.sum(F.when(~F.col("_large"), F.col("_weight")))
    rests = large.groupBy("root").agg(F.ceil(F.coalesce(rest, F.lit(0.0))).alias("_blocks"))
    shares = stored(large.join(rests, "root").withColumn("_n", F.when(F.col("_large"), F.ceil("_weight")).otherwise(F.col("_blocks"))), "near-shares")
    part = F.pmod(F.xxhash64(F.when(F.col("_large"), F.col("doc_id")).otherwise(F.col("label"))), "_n")
    block = F.struct("root", F.when(F.col("_large"), F.col("label")).alias("own"), part.alias("part"))
    blocked = stored(members.join(shares.drop("_weight", "_blocks"), ["root", "label"]).withColumn("block", block).drop("_n", "_large", "root"), "near-blocks")
    blocks = stored(blocked.select("block").distinct().select(F.col("block.root").alias("root"), "block", F.xxhash64("block").alias("_order")), "near-block-names")
    other = blocks.select("root", F.col("block").alias("other"), F.col("_order").alias("_other"))
    alike = F.coalesce(F.col("block.own") == F.col("other.own"), F.lit(False))  # both of one large group
    pairs = blocks.join(other, "root").where((F.struct("_order", "block") <= F.struct("_other", "other")) & ~alike)
    pairs = stored(pairs.select(F.struct("block", "other").alias("pair")), "near-block-pairs")
    sides = [pairs.select(F.col(f"pair.{name}").alias("block"), F.xxhash64("pair").alias("pair"), F.lit(side).alias("side")) for side, name in enumerate(("block", "other"))]
    rows = blocked.join(sides[0].unionByName(sides[1]), "block").drop("block")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(joined_groups(frame, similarity, radius), columns=["u", "v"], dtype=np.int64)

    return rows.groupBy("pair").applyInPandas(compare, "u long, v long")


def _groups(docs: DataFrame, text_col: str, id_col: str, width: int, similarity: float, radius: int) -> tuple[DataFrame, DataFrame]:
    """(node, root) in numbers of rows, and the identifier and place of each number; ``docs`` is located."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    with shuffles_released(docs.sparkSession):
        rows = docs.select(docs[id_col].alias("id"), docs[id_col].isNull().alias("unnamed"), *place(docs))
        rows = stored(dense_index(rows, ["unnamed", "id", *PLACE], "doc_id").drop("unnamed"), "near-rows")
        marked = stored(_marked(docs.select(*place(docs), text.alias("text")), width), "near-fingerprints")
        marked = stored(marked.join(rows.drop("id"), PLACE).drop(*PLACE), "near-numbered")
        edges = stored(_links(marked, similarity, radius).distinct(), "near-edges")
        loose = stored(components(edges), "near-candidates")
        members = stored(rows.join(loose.select(F.col("node").alias("doc_id")), "doc_id").select("doc_id", *PLACE), "near-places")
        texts = stored(rows_at(docs, members, text.alias("text")).drop(*PLACE), "near-texts")
        firm = stored(_confirmed(loose.where("node <> root").select(F.col("root").alias("u"), F.col("node").alias("v")), texts, width, similarity), "near-confirmed")
        rest = stored(loose.where("node <> root").join(firm.select(F.col("v").alias("node")), "node", "left_anti").select("node"), "near-rest")
        touching = edges.join(rest, edges["u"] == rest["node"], "left_semi").union(edges.join(rest, edges["v"] == rest["node"], "left_semi"))
        more = stored(_confirmed(touching.distinct(), texts, width, similarity), "near-more")
        firm = stored(firm.union(more).where("u <> v").distinct(), "near-firm")
        last = stored(_remaining(loose, firm, texts, width, similarity, radius), "near-remaining")
        return stored(components(firm.union(last)), "near-groups"), rows


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """node, root: the identifier of each row that has a near duplicate, and the least identifier of its group."""
    groups, rows = _groups(located(docs), text_col, id_col, width, similarity, radius)
    named = rows.select("doc_id", "id")
    own = groups.join(named.toDF("node", "_node"), "node").join(named.toDF("root", "_root"), "root")
    return own.select(F.col("_node").alias("node"), F.col("_root").alias("root"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but for those whose group has a row before them."""
    docs = located(docs)
    groups, rows = _groups(docs, text_col, id_col, WIDTH, SIMILARITY, RADIUS)
    gone = groups.where("node <> root").select(F.col("node").alias("doc_id"))
    return rows_not_at(docs, stored(rows.join(gone, "doc_id").select(*PLACE), "near-gone"))
