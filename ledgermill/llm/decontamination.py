"""Benchmark decontamination by embedding edit distance into Hamming distance.

A random walk (Chakraborty, Goldenberg, Koucky) reads a window of words: at each step it emits the word it stands on and then
stays or moves on, as a random bit of the step and the word decides. Two windows a few edits apart emit
sequences that agree at most steps, since the walks fall into step again after an edit. So sampling ``SAMPLES`` steps gives a key
that similar windows share with fair probability, and ``REPEATS`` walks with their own samples lift it to the wanted recall.

Windows have about the size of the item, ``WINDOW`` at most: of the powers of two the largest that its words hold, laid over the item end to end. Of
the documents every window, at each word, is embedded; a walk goes on only while the steps sampled so far still lead to some
item, which gives the same keys at a fraction of the cost. Windows with a key of an item are kept if the whole embeddings
agree at ``AGREE`` of the steps. Candidates are verified exactly: the least edit distance of the whole item to any
substring around the candidate, in characters, must be at most ``max_share`` of the item's length.

Items are the stated query set: they are taken in blocks of ``BLOCK`` and each block is searched in all documents. Letters
and digits are compared, lower-cased; other signs separate words.

Defined results: null and empty texts hold nothing; items without a word cannot be found. Repeated rows repeat their
hits. Of several places of one item in a document the nearest, then the first, is reported. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import slim
from ledgermill.llm.words import NO_WORD, hashed, mix

SAMPLES = 4
REPEATS = 12
WINDOW = 32  # largest window: a longer one rarely keeps a sample of steps free of edits
AGREE = 0.3
BLOCK = 5000
_SLICE = 400_000
_GAP = 64  # empty places between documents, as many as the largest window
_MANY = re.compile(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain(text: str | None) -> str:
    """Words of a text, lower-cased, joined by single blanks."""
    return _MANY.sub(" ", (text or "").lower()).strip()


def _keys(text: str) -> np.ndarray:
    return hashed(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), NO_WORD)[0]


def _slot(key: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """Place of a key in a filter, whose size is a power of two."""
    return (key & np.uint64(len(filter_) - 1)).view(np.int64)


@cache
def _salts(seed: int) -> np.ndarray:
    return np.random.default_rng([20240305, seed]).integers(0, 1 << 63, 2 * _GAP, dtype=np.uint64) * np.uint64(2)


def _moves(words: np.ndarray, seed: int, step: int) -> np.ndarray:
    """The random bit of this step for each word."""
    return (words ^ _salts(seed)[step]) * np.uint64(0x9E3779B97F4A7C15) >= np.uint64(1 << 63)


def _emitted(words: np.ndarray, at: np.ndarray, starts: np.ndarray, window: int, step: int) -> np.ndarray:
    """The words the walks stand on; 0 once a walk has left its window."""
    if step < window:
        return words[at]
    return np.where(at - starts < window, words[np.minimum(at, len(words) - 1)], np.uint64(0))


def walk(words: np.ndarray, starts: np.ndarray, window: int, seed: int, steps: tuple[int, ...], filters: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Starts that pass the filters and the keys after each sampled step."""
    at = starts.copy()
    keys: list[np.ndarray] = []
    for step in range(steps[-1] + 1):
        word = _emitted(words, at, starts, window, step)
        if step in steps:
            key = mix((keys[-1] if keys else np.uint64(seed)) * np.uint64(0x9E3779B9) + word)
            keys.append(key)
            if filters:
                there = filters[len(keys) - 1]
                alive = there[_slot(key, there)]
                starts, at, word, key = starts[alive], at[alive], word[alive], key[alive]
                keys = [key] * len(keys)
                if not len(starts):
                    return starts, [key] * len(steps)
        at += _moves(word, seed, step)
    return starts, keys


def embedded(words: np.ndarray, starts: np.ndarray, window: int, seed: int) -> np.ndarray:
    """All ``2 * window`` emitted words of each walk, one row per start."""
    at = starts.copy()
    out = np.zeros((len(starts), 2 * window), dtype=np.uint64)
    for step in range(2 * window):
        out[:, step] = _emitted(words, at, starts, window, step)
        at += _moves(out[:, step], seed, step)
    return out


@dataclass
class _Class:
    """The items of one window size: per repeat the sampled steps, filters by depth, and the sorted keys with what they stand for."""

    window: int
    steps: list[tuple[int, ...]] = field(default_factory=list)
    filters: list[list[np.ndarray]] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    owners: list[np.ndarray] = field(default_factory=list)  # rows of (item, offset in words)
    images: list[np.ndarray] = field(default_factory=list)  # the items' embeddings, in the order of the keys


class Index:
    """Keys of the windows of a block of items."""

    def __init__(self, items: list[tuple], max_share: float, repeats: int = REPEATS, samples: int = SAMPLES):
        self.items = [(i, plain(t)) for i, t in items]
        self.max_share, self.repeats = max_share, repeats
        by: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for n, (_, text) in enumerate(self.items):
            keys = _keys(text)
            if len(keys):
                size = min(WINDOW, 1 << (len(keys).bit_length() - 1))
                for offset in sorted({*range(0, len(keys) - size + 1, size), len(keys) - size}):
                    by.setdefault(size, []).append((n, offset, keys[offset : offset + size]))
        self.classes = [self._class(size, rows, samples) for size, rows in sorted(by.items())]

    def _class(self, size: int, rows: list, samples: int) -> _Class:
        made = _Class(size)
        words = np.concatenate([r[2] for r in rows])
        starts = np.arange(len(rows), dtype=np.int32) * np.int32(size)
        rng = np.random.default_rng(size)
        for repeat in range(self.repeats):
            # a walk is in the middle of its window after as many steps as the window has words: few have left it by three halves
            early = int(rng.integers(0, min(3, size)))
            later = [s for s in range(max(2, 3 * size // 2)) if s != early]
            steps = tuple(sorted([early, *rng.choice(later, min(samples - 1, len(later)), replace=False).tolist()]))
            _, keys = walk(words, starts, size, repeat, steps)
            filters = []
            for key in keys:
                there = np.zeros(1 << (64 * len(key)).bit_length(), dtype=bool)  # about one place in a hundred is taken
                there[_slot(key, there)] = True
                filters.append(there)
            order = np.argsort(keys[-1], kind="stable")
            made.steps.append(steps)
            made.filters.append(filters)
            made.keys.append(keys[-1][order])
            made.owners.append(np.array([(rows[i][0], rows[i][1]) for i in order], dtype=np.int64))
            made.images.append(embedded(words, starts[order], size, repeat))
        return made

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Distinct rows of (item, word of the text where the item would start, word where the window starts)."""
        found = []
        every = np.flatnonzero(words).astype(np.int32)
        for kind in self.classes:
            for repeat in range(self.repeats):
                starts, keys = walk(words, every, kind.window, repeat, kind.steps[repeat], kind.filters[repeat])
                if not len(starts):
                    continue
                low, high = (np.searchsorted(kind.keys[repeat], keys[-1], side) for side in ("left", "right"))
                times = high - low
                owner = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
                window = np.repeat(starts, times)
                # Hamming distance of the embeddings: unrelated windows that share the sampled steps differ at most others
                image = embedded(words, window, kind.window, repeat)
                wanted = kind.images[repeat][owner]
                close = ((image == wanted) & (wanted > 0)).sum(axis=1) >= AGREE * (wanted > 0).sum(axis=1)
                own, window = kind.owners[repeat][owner[close]], window[close]
                found.append(np.column_stack([own[:, 0], window - own[:, 1], window]))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), dtype=np.int64)


def nearest(pattern: str, text: str, most: int) -> tuple[int, int, int] | None:
    """Least edit distance of ``pattern`` to a substring of ``text``, with its start and end; None if over ``most``.

    Bit-parallel search (Myers); the start comes from the same search backwards from the end.
    """
    place = text.find(pattern)
    if place >= 0:
        return 0, place, place + len(pattern)
    best, end = _ends(pattern, text, True)
    if best > most:
        return None
    _, back = _ends(pattern[::-1], text[:end][::-1], False, best)
    return best, end - back, end


def _ends(pattern: str, text: str, free_start: bool, want: int | None = None) -> tuple[int, int]:
    """Least distance and the (first) end where it occurs; without a free start the text counts from its beginning."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text, 1):
        eq = where.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus = (plus << 1) & full if free_start else ((plus << 1) | 1) & full
        up = ((minus << 1) & full) | (full & ~(diagonal | plus))
        down = plus & diagonal
        if score < best:
            best, end = score, i
            if score == want:
                break
    return best, end


def _hits(index: Index, ids: list, texts: list[str]) -> Iterator[tuple]:
    """doc_id, item_id, distance, matched (the place's words) of each item found in each text."""
    words = [_keys(t) for t in texts]
    begins, at = [], 0
    blank = np.zeros(_GAP, dtype=np.uint64)
    for w in words:
        begins.append(at)
        at += len(w) + _GAP
    if not at:
        return
    joined = np.concatenate([x for w in words for x in (w, blank)])
    found = index.candidates(joined)
    # by the window: the item's own start may lie before the text when only the item's end is there
    owner = np.searchsorted(np.array(begins), found[:, 2], side="right") - 1
    best: dict[tuple[int, int], tuple] = {}
    split: dict[int, list[str]] = {}
    seen: dict[tuple[int, int], int] = {}
    for (item, start, _), doc in zip(found.tolist(), owner.tolist(), strict=True):
        item_id, pattern = index.items[item]
        n = pattern.count(" ") + 1
        slack = max(2, n // 4)
        first = start - begins[doc]
        if first <= seen.get((item, doc), -1 << 60):  # inside the region that was searched last
            continue
        region = 2 * slack
        seen[item, doc] = first + slack
        if doc not in split:
            split = {doc: plain(texts[doc]).split(" ")}
        low = max(0, first - slack)
        near = " ".join(split[doc][low : max(0, first) + n + region + slack])
        hit = nearest(pattern, near, int(index.max_share * len(pattern)))
        if hit and ((item, doc) not in best or hit[0] < best[item, doc][2]):
            place = low + near[: hit[1]].count(" ")
            best[item, doc] = (ids[doc], item_id, hit[0], near[hit[1] : hit[2]], place)
    yield from best.values()


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", max_share: float = 0.2) -> DataFrame:
    """doc_id, item_id, distance, matched, first_word: each item found in each document."""
    source = slim(docs, id_col, text_col)
    wanted = items.select(items[item_col].alias("item_id"), items[item_text].cast("string").alias("text")).where("text is not null")
    id_type, item_type = source.schema["doc_id"].dataType.simpleString(), wanted.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, distance int, matched string, first_word long"
    found, block = docs.sparkSession.createDataFrame([], schema), []

    def search(block: list[tuple]) -> DataFrame:
        index = docs.sparkSession.sparkContext.broadcast(Index(block, max_share))  # BLOCK items at most

        def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows, ids, texts, held = [], [], [], 0
                for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                    ids.append(doc_id)
                    texts.append(text.lower())
                    held += len(text) // 5
                    if held > _SLICE:
                        rows += _hits(index.value, ids, texts)
                        ids, texts, held = [], [], 0
                rows += _hits(index.value, ids, texts)
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "matched", "first_word"])

        return source.mapInPandas(each, schema)

    for row in wanted.toLocalIterator():
        block.append((row.item_id, row.text))
        if len(block) == BLOCK:
            found, block = found.unionByName(search(block)), []
    return found.unionByName(search(block)) if block else found


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", max_share: float = 0.2) -> DataFrame:
    """The rows of ``docs``, unchanged, in which no item is found."""
    wanted = items.select(items[item_col].alias("item_id"), items[item_text].cast("string").alias("text")).where("text is not null")
    kept, block = docs, []

    def clean(block: list[tuple]):
        index = docs.sparkSession.sparkContext.broadcast(Index(block, max_share))

        @F.pandas_udf("boolean")
        def holds_none(texts: pd.Series) -> pd.Series:
            hit, ids, part, held = set(), [], [], 0
            for n, text in enumerate(texts):
                ids.append(n)
                part.append((text or "").lower())
                held += len(part[-1]) // 5
                if held > _SLICE:
                    hit |= {h[0] for h in _hits(index.value, ids, part)}
                    ids, part, held = [], [], 0
            hit |= {h[0] for h in _hits(index.value, ids, part)}
            return pd.Series([n not in hit for n in range(len(texts))], dtype=bool)

        return holds_none(F.col(text_col))

    for row in wanted.toLocalIterator():
        block.append((row.item_id, row.text))
        if len(block) == BLOCK:
            kept, block = kept.where(clean(block)), []
    return kept.where(clean(block)) if block else kept
