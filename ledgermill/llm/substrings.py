"""Exact repeated substrings by prefix doubling over positions.

A position's rank among all strings of one length is stood for by a 64-bit name: names are equal when the strings are (a
name of twice the length is made of the pair of names at a position and at the offset of half the length). Spark counts the
names of each round, and only positions whose name occurs again go on:

1. length ``THRESHOLD / 2``, at sampled positions only. Of each threshold-long window the least name inside it is chosen, so
   equal windows choose the same place inside them, and a window whose chosen name is unique is unique itself.
2. blocks: all windows that share a chosen place, as one string. A block that occurs again settles all its windows.
3. length ``THRESHOLD`` at every window still in doubt: those of blocks that differ although their chosen names agree, and
   those of one block out of each group of equal ones, as partners.

Ranks by a full sort of all positions would write some 16 bytes for each byte of text in each round; the first round here
writes about one byte for two of text. No rows of one name are gathered in a task: names are counted with map-side
aggregation and matched by joins that can be split.

Defined results: null texts are empty; texts below the threshold have nothing to remove; a repeated row counts as another
document. Strings are judged on the input, not on what is left. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import Scratch, shuffles_released, slim

THRESHOLD = 200
SEGMENT = 1 << 22  # windows of a text looked at together
_PLACE = np.uint64((1 << 24) - 1)
_ONE, _PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SIGN = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _doubled(names: np.ndarray, offset: int) -> np.ndarray:
    """Names of strings that are ``offset`` longer, from pairs of names that far apart."""
    return _mix(names[:-offset] * _PAIR + names[offset:] * _ONE)


def names_of(raw: np.ndarray, length: int) -> np.ndarray:
    """Name of each string of ``length`` bytes, by doubling and one last overlapping pair."""
    names, have = _SIGN[raw], 1
    while have < length:
        step = min(have, length - have)
        if len(names) <= step:
            return np.zeros(0, dtype=np.uint64)
        names = _doubled(names, step)
        have += step
    return names


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each run of ``width``."""
    have = 1
    while have < width:
        step = min(have, width - have)
        keys = np.minimum(keys[:-step], keys[step:])
        have += step
    return keys


def _segments(raw: np.ndarray, threshold: int, segment: int) -> Iterator[tuple[int, np.ndarray]]:
    for start in range(0, len(raw) - threshold + 1, segment):
        yield start, raw[start : start + segment + threshold - 1]


def _chosen(raw: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each chosen place: its name, position, and the first and last window that chose it."""
    half = threshold // 2
    names = names_of(raw, half)
    keys = (names & ~_PLACE) | np.arange(len(names), dtype=np.uint64)
    owner = (_least(keys, threshold - half + 1) & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.append(first[1:], len(owner)) - 1
    return names[owner[first]], owner[first], first, last


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _rows(columns: dict[str, list]) -> pd.DataFrame:
    joined = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in columns.items()}
    return pd.DataFrame({k: v.view(np.int64) if v.dtype == np.uint64 else v.astype(np.int64) for k, v in joined.items()})


def _places(texts: DataFrame, threshold: int, segment: int) -> DataFrame:
    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"row": [], "first": [], "last": [], "name": []}
            for row, text in zip(frame["row"], frame["text"], strict=True):
                for start, raw in _segments(_bytes(text), threshold, segment):
                    names, _, first, last = _chosen(raw, threshold)
                    out["row"].append(np.full(len(names), row, dtype=np.int64))
                    out["first"].append(first + start)
                    out["last"].append(last + start)
                    out["name"].append(names)
            yield _rows(out)

    return texts.mapInPandas(each, "row long, first int, last int, name long")


def _blocks(marked: DataFrame, threshold: int) -> DataFrame:
    """One row for each block: its row, windows, the name of the place and of the whole block."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"row": [], "first": [], "last": [], "name": [], "block": [], "copies": []}
            columns = (frame[c] for c in ("row", "text", "firsts", "lasts", "names", "copies"))
            for row, text, firsts, lasts, places, copies in zip(*columns, strict=True):
                raw = _bytes(text).tobytes()
                first, last = np.asarray(firsts, np.int64), np.asarray(lasts, np.int64)
                blocks = [hashlib.blake2b(raw[a : b + threshold], digest_size=8).digest() for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                out["row"].append(np.full(len(first), row, dtype=np.int64))
                out["first"].append(first)
                out["last"].append(last)
                out["name"].append(np.asarray(places, np.int64))
                out["block"].append(np.frombuffer(b"".join(blocks), dtype=np.int64))
                out["copies"].append(np.full(len(first), copies, dtype=np.int64))
            yield _rows(out)

    return marked.mapInPandas(each, "row long, first int, last int, name long, block long, copies long")


def _windows(doubtful: DataFrame, threshold: int) -> DataFrame:
    """One row for each window in doubt: its row, place and name at the full threshold."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"row": [], "at": [], "name": []}
            for row, text, firsts, lasts in zip(frame["row"], frame["text"], frame["firsts"], frame["lasts"], strict=True):
                raw = _bytes(text)
                for a, b in _joined(np.asarray(firsts, np.int64), np.asarray(lasts, np.int64)):
                    names = _doubled(names_of(raw[a : b + threshold], threshold // 2), threshold // 2)
                    out["row"].append(np.full(len(names), row, dtype=np.int64))
                    out["at"].append(np.arange(a, b + 1))
                    out["name"].append(names)
            yield _rows(out)

    return doubtful.mapInPandas(each, "row long, at int, name long")


def _joined(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Inclusive ranges, sorted and merged where they touch."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1] + 1]))
    return list(zip(first[new].tolist(), last[np.append(new[1:], len(first)) - 1].tolist(), strict=True))


def _again(table: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Rows whose name occurs more than once; the names are stored, so that their shuffle is over before the join's."""
    names = table.groupBy("name").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("name")
    return table.join(scratch.put(names, f"substring-{label}-names"), "name", "left_semi")


def _ranges(table: DataFrame) -> DataFrame:
    return table.groupBy("row").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))


def repeated_windows(texts: DataFrame, scratch: Scratch, threshold: int = THRESHOLD, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Texts that share a place with another (row, text), and their repeated windows as ranges (row, firsts, lasts).

    ``texts`` has a number ``row`` (equal only for equal documents) and ``text``; it is read twice.
    """
    places = scratch.put(_places(texts, threshold, segment), "substring-places")
    again = _again(places, scratch, "place").groupBy("row", "first")
    again = again.agg(F.max("last").alias("last"), F.max("name").alias("name"), F.count(F.lit(1)).alias("_times"))
    place = F.collect_list(F.struct("first", "last", "name"))
    again = again.groupBy("row").agg(place.alias("_places"), F.max("_times").alias("copies"))
    again = scratch.put(again.select("row", "copies", *(F.col(f"_places.{c}").alias(f"{c}s") for c in ("first", "last", "name"))), "substring-again")
    scratch.drop(places)
    # equal rows have one number: one of them goes on, with the number of its copies
    marked = scratch.put(texts.join(again, "row").dropDuplicates(["row"]), "substring-marked")
    scratch.drop(again)
    blocks = scratch.put(_blocks(marked, threshold), "substring-blocks")
    groups = blocks.groupBy("name", "block").agg(F.sum("copies").alias("_n"), F.min(F.struct("row", "first")).alias("_one"))
    groups = scratch.put(groups, "substring-groups")
    variants = groups.groupBy("name").agg(F.count(F.lit(1)).alias("_variants"))
    judged = blocks.join(groups.join(variants, "name"), ["name", "block"])
    partner = (F.col("row") == F.col("_one.row")) & (F.col("first") == F.col("_one.first"))
    judged = scratch.put(
        judged.select("row", "first", "last", (F.col("_n") > 1).alias("settled"), ((F.col("_variants") > 1) & ((F.col("_n") == 1) | partner)).alias("doubt")),
        "substring-judged",
    )
    scratch.drop(blocks, groups)
    doubtful = marked.select("row", "text").join(_ranges(judged.where("doubt")), "row")
    windows = scratch.put(_windows(doubtful, threshold), "substring-windows")
    found = _again(windows, scratch, "window").select("row", F.col("at").alias("first"), F.col("at").alias("last"))
    found = scratch.put(found, "substring-found")
    scratch.drop(windows)
    return marked, _ranges(judged.where("settled").select("row", "first", "last").unionByName(found))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, segment: int = SEGMENT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and ``spans`` (start, end in bytes; null if none)."""
    source = slim(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row, text, firsts, lasts in zip(frame["row"], frame["text"], frame["firsts"], frame["lasts"], strict=True):
                raw, at, kept = _bytes(text).tobytes(), 0, hashlib.sha256()
                spans = _joined(np.asarray(firsts, np.int64), np.asarray(lasts, np.int64) + threshold - 1)
                for a, b in spans:
                    kept.update(raw[at:a])
                    at = b + 1
                kept.update(raw[at:])
                out.append((row, sum(b + 1 - a for a, b in spans), [{"start": a, "end": b + 1} for a, b in spans], kept.hexdigest()))
            yield pd.DataFrame(out, columns=["row", "n_removed", "spans", "kept"])

    scratch = Scratch(docs.sparkSession)
    with shuffles_released(docs.sparkSession):
        marked, ranges = repeated_windows(source.select("row", "text"), scratch, threshold, segment)
        changed = marked.select("row", "text").join(ranges, "row")
        changed = scratch.put(changed.mapInPandas(cut, "row long, n_removed long, spans array<struct<start:int,end:int>>, kept string"), "substring-cut")
        scratch.drop_all_but(changed)
    whole = source.select("doc_id", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("_whole"))
    return whole.join(changed, "row", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept", "_whole").alias("kept_sha256"), "spans",
    )
