"""Periodic runs of words: stretches that repeat a short block at least four times over.

A run is a maximal stretch of words with smallest period ``q`` whose length is at least ``exponent * q`` and ``shortest``.
Runs are found by a dictionary of basic factors. For each power of two the factors of that many words are named by rank,
equal names for equal factors, from the names of their halves. Where a factor's next occurrence starts within twice its length
and the one after follows at the same distance, the occurrences form an arithmetic progression and its difference is
proposed as a period. The names then tell in logarithmic time how far the words agree at that distance on both sides, which
gives the maximal run; of equal stretches the smallest period stays.

Why none is lost: let ``2^k`` be the least power of two not below ``q``. Inside a run a factor of that length occurs next
exactly ``q`` words later (a smaller distance would give the run a smaller period), and with an exponent of four there is room
for a third occurrence. Names are exact: words are told apart by their bytes, not by a hash.

Each document is one row and is worked on alone, so nothing is shuffled and no key can be hot. A document of n words needs
memory for n numbers a level, up to the first level without repeats, and O(n log n) steps a level.

Defined results: null, empty and blank texts have no runs and collapse to the empty text. Repeated rows repeat their result,
whatever their identifiers. Long texts are taken whole. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.common import slim
from ledgermill.llm.words import numbered

EXPONENT, SHORTEST = 4, 6
_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


class _Factors:
    """Names of all factors of 1, 2, 4, ... words, as far as any repeats."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.names: list[np.ndarray] = []
        self.gaps: list[np.ndarray] = []  # distance to the next factor of the same name, 0 without one
        keys, size = ids.astype(np.int64), 1
        while size <= max(1, self.n // 2):
            order = np.argsort(keys, kind="stable")
            again = keys[order[1:]] == keys[order[:-1]]
            if not again.any():
                break
            name, gap = np.empty(len(keys), np.int64), np.zeros(len(keys), np.int64)
            name[order] = np.concatenate([[0], np.cumsum(~again)])
            gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
            self.names.append(name)
            self.gaps.append(gap)
            keys = name[:-size] * (len(name) + 1) + name[size:]
            size *= 2

    def periods(self, steady: bool) -> tuple[np.ndarray, np.ndarray]:
        """Start and difference of the progressions, one for each block of neighbouring starts with the same difference."""
        at, step = [], []
        for k, gap in enumerate(self.gaps):
            found = (gap > 0) & (gap <= 2 << k)
            if steady:  # a third term at the same distance
                later = np.minimum(np.arange(len(gap)) + gap, len(gap) - 1)
                found &= gap[later] == gap
            found[1:] &= ~(found[:-1] & (gap[1:] == gap[:-1]))
            at.append(np.flatnonzero(found))
            step.append(gap[found])
        return np.concatenate(at), np.concatenate(step)

    def agree(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """For how many words the stretches from ``i`` and ``j`` on (or up to them) are equal; i < j."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, size = self.names[k], 1 << k
            while True:
                a, b = (i - length - size, j - length - size) if back else (i + length, j + length)
                inside = (a >= 0) & (b + size <= self.n)
                more = np.zeros(len(i), bool)
                more[inside] = name[a[inside]] == name[b[inside]]
                if not more.any():
                    break
                length[more] += size
        return length


def runs(ids: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, length, period) of all runs in a sequence of numbers, by start, then period."""
    if exponent < 3:
        raise ValueError("an exponent below 3 leaves no room for two occurrences of a factor that is longer than the period")
    none = np.zeros((0, 3), np.int64)
    factors = _Factors(ids)
    if not factors.gaps:
        return none
    at, period = factors.periods(steady=exponent >= 4)
    start = at - factors.agree(at, at + period, back=True)
    end = at + period + factors.agree(at, at + period, back=False)
    found = np.stack([start, end - start, period], axis=1)[end - start >= np.maximum(shortest, exponent * period)]
    if not len(found):
        return none
    # the maximal stretch of a multiple of the smallest period is the same stretch
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    found = found[np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(axis=1)])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; numbers of words), collapsed (words that stay, joined by one space)."""
    source = slim(docs, id_col, text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, listed, collapsed = [], [], []
            for text in batch.column("text").to_pylist():
                words, ids = numbered(text)
                found = runs(ids, exponent, shortest)
                if len(found):
                    words = [w for w, stays in zip(words, kept_words(len(words), found), strict=True) if stays]
                n_words.append(len(ids))
                listed.append([{"start": s, "length": n, "period": p} for s, n, p in found.tolist()])
                collapsed.append(b" ".join(words).decode("utf-8", "replace"))
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(listed, _RUNS), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(each, f"doc_id {id_type}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
