"""Interpolated modified Kneser-Ney bigram model.

Counting: tasks hash the words of their texts, sort and count them, and emit one compressed block of keys and counts for each
shard; the blocks of a shard are merged in one task. The number of shards follows from the bytes of the corpus, so a shard
has a bounded size, and because a bigram's shard depends on both of its words, a frequent word does not make a large shard.
Each shard is written as sorted key and count arrays to the shared folder; workers memory-map these files to score texts.

A word's key is a 64-bit hash. A bigram's key joins the upper halves of its words' keys, so the continuation counts can be
read from the distinct bigrams alone. With discounts D1, D2, D3+ from the counts of counts:

    p(w | u) = max(c(uw) - D, 0) / c(u) + g(u) p(w),   p(w) = max(N(.w) - D', 0) / N(..) + g' / (V + 1)

The shared folder must be a mounted file system that workers can map (``file:`` scheme, such as a network mount).

Defined results: a null or empty text is the end mark alone. Repeated rows count each time. With no training text every
token has the uniform probability 1. Other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import slim
from ledgermill.session import scratch_path, stored

SHARD_BYTES = 32 << 20
_FLUSH = 6_000_000  # tokens a task holds before it emits
_SLICE = 1_000_000  # tokens scored at once

_random = np.random.default_rng(20240229)
_SIGN = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
#: Keys of the end mark and of the place before the first word.
END, START = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0x57A2757A2757A275)
_POWERS = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        if len(_POWERS) > 3:
            _POWERS.clear()
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_keys(text: str | None) -> np.ndarray:
    """Keys of the words of a text (A-Z lower-cased, split at white space), then of the end mark."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(raw):
        return np.array([END])
    gap = _GAP[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_SIGN[_FOLD[raw]] * up[: len(raw)], dtype=np.uint64)])
    return np.append(_mix((sums[ends] - sums[starts]) * down[starts]), END)


def bigram_keys(keys: np.ndarray) -> np.ndarray:
    before = np.concatenate([[START], keys[:-1]])
    return (before >> np.uint64(32) << np.uint64(32)) | (keys >> np.uint64(32))


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (_mix(keys) % np.uint64(shards)).astype(np.int64)


def _range(keys32: np.ndarray, shards: int) -> np.ndarray:
    return ((keys32.astype(np.uint64) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _packed(array: np.ndarray) -> bytes:
    """Byte planes, compressed; sorted unsigned keys as differences."""
    if array.dtype == np.uint64:
        array = np.diff(array, prepend=np.uint64(0))
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(array.dtype.char.encode() + planes.tobytes())


def _unpacked(block: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(block)
    kind = np.dtype(raw[:1].decode())
    planes = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(kind.itemsize, -1)
    array = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
    return np.cumsum(array, dtype=np.uint64) if kind == np.uint64 else array


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.unique(keys, return_counts=True)
    return keys, counts.astype(np.uint32)


def _summed(keys: list[np.ndarray], columns: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys of several blocks and the sums of their columns."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))[: len(every)]
    return every[first], [np.add.reduceat(np.concatenate(c)[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for c in columns]


_BLOCKS = "kind string, shard long, keys binary, a binary, b binary, c binary"


def _blocks(kind: str, shard: np.ndarray, keys: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    out = []
    for s in np.unique(shard).tolist():
        own = shard == s
        packed = [_packed(c[own].astype(np.uint32)) for c in columns] + [None] * (3 - len(columns))
        out.append((kind, s, _packed(keys[own]), *packed))
    return out


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "shard", "keys", "a", "b", "c"])


def _write(path: str, **arrays: np.ndarray) -> None:
    """Arrays as files that can be mapped; a repeated task writes the same content."""
    for name, array in arrays.items():
        draft = f"{path}.{name}.{uuid.uuid4().hex}"
        with open(draft, "wb") as file:
            np.save(file, array)
        os.replace(draft, f"{path}.{name}.npy")


@dataclass
class Model:
    """Sorted arrays in ``folder`` and the corpus' totals; maps the arrays on first use."""

    folder: str
    shards: int
    tokens: int
    words: int
    bigrams: int
    discounts: tuple[float, float, float]
    low: tuple[float, float, float]
    low_rest: float

    def _map(self, name: str):
        if not hasattr(self, "_mapped"):
            self._mapped = {}
        if name not in self._mapped:
            path = f"{self.folder}/{name}.npy"
            self._mapped[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self._mapped[name]

    def _find(self, kind: str, shard: np.ndarray, keys: np.ndarray, columns: tuple[str, ...]) -> list[np.ndarray]:
        """Column values of sorted, shard-ordered keys; 0 where a key is absent."""
        out = [np.zeros(len(keys), dtype=np.int64) for _ in columns]
        cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(keys) else [0]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            name = f"{kind}-{shard[begin]}"
            table = self._map(f"{name}.keys")
            if table is None or not len(table):
                continue
            at = np.minimum(np.searchsorted(table, keys[begin:end]), len(table) - 1)
            hit = table[at] == keys[begin:end]
            for values, column in zip(out, columns, strict=True):
                values[begin:end][hit] = self._map(f"{name}.{column}")[at[hit]]
        return out

    def scores(self, keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, base log10 and model log10 of each token, given the keys of tokens and of their bigrams."""
        distinct, back = np.unique(np.concatenate([keys, [START]]), return_inverse=True)
        columns = ("count", "n1", "n2", "n3", "left")
        found = self._find("word", _range(distinct >> np.uint64(32), self.shards), distinct, columns)
        count, *_, left = (f[back[:-1]] for f in found)
        base = np.log10((count + 0.5) / (self.tokens + 0.5 * (self.words + 1)))
        d1, d2, d3 = self.low
        rest = self.low_rest / (self.words + 1)
        low = rest + np.maximum(left - np.choose(np.minimum(left, 3), [0.0, d1, d2, d3]), 0) / max(1, self.bigrams)
        # context: the token before, or the start; pairs hold its key's upper half
        before = pairs >> np.uint64(32)
        where = np.searchsorted(distinct >> np.uint64(32), before)
        total, n1, n2, n3, _ = (f[where] for f in found)
        d1, d2, d3 = self.discounts
        kinds, place = np.unique(pairs, return_inverse=True)
        shard = _shard(kinds, self.shards)
        order = np.lexsort((kinds, shard))
        seen = np.zeros(len(kinds), dtype=np.int64)
        seen[order] = self._pair_counts(shard[order], kinds[order])
        c = seen[place]
        high = np.maximum(c - np.choose(np.minimum(c, 3), [0.0, d1, d2, d3]), 0)
        p = np.where(total > 0, (high + (d1 * n1 + d2 * n2 + d3 * n3) * low) / np.maximum(total, 1), low)
        return count, base, np.log10(p)

    def _pair_counts(self, shard: np.ndarray, keys: np.ndarray) -> np.ndarray:
        (small,) = self._find("pair", shard, keys, ("count",))
        full = small == 255  # larger counts are kept aside
        if full.any():
            (small[full],) = self._find("more", shard[full], keys[full], ("count",))
        return small


def _discounts(n: np.ndarray) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams seen once to four times; 0.5, 1 and 1.5 where a number is missing."""
    if min(n[:4]) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05 * (i + 1)), i + 1 - 0.05) for i in range(3))


def _shared_folder(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"workers map the model's files, so the scratch folder must be a mounted one, not {path}")
    return parts.path


def train(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count the texts of the rows that ``learn_from`` (a condition over ``doc_id``) admits."""
    spark = docs.sparkSession
    source = slim(docs, id_col, text_col).where(learn_from).select("text")
    size = source.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    shards = max(1, -(-int(size) // SHARD_BYTES))
    folder = _shared_folder(scratch_path(spark, "ngram-model"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, pairs, held, starts = [], [], 0, 0

        def emit() -> pd.DataFrame:
            keys, counts = _counted(np.concatenate(words))
            rows = _blocks("word", _range(keys >> np.uint64(32), shards), keys, counts)
            rows += _blocks("start", np.zeros(1, np.int64), np.array([START]), np.array([starts]))
            keys, counts = _counted(np.concatenate(pairs))
            return _frame(rows + _blocks("pair", _shard(keys, shards), keys, counts))

        for frame in frames:
            for text in frame["text"]:
                keys = word_keys(text)
                words.append(keys)
                pairs.append(bigram_keys(keys))
                held += len(keys)
                starts += 1
                if held >= _FLUSH:
                    yield emit()
                    words, pairs, held, starts = [], [], 0, 0
        if held:
            yield emit()

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        kind, shard = key
        keys, (counts,) = _summed([_unpacked(b) for b in frame["keys"]], [[_unpacked(b) for b in frame["a"]]])
        if kind == "start":
            return _frame(_blocks("word", _range(keys >> np.uint64(32), shards), keys, counts))
        if kind == "word":
            return _frame(_blocks("word", np.full(len(keys), shard), keys, counts))
        os.makedirs(folder, exist_ok=True)
        large = counts >= 255
        _write(f"{folder}/pair-{shard}", keys=keys, count=np.minimum(counts, 255).astype(np.uint8))
        _write(f"{folder}/more-{shard}", keys=keys[large], count=counts[large])
        context = keys >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        times = [np.add.reduceat(c, first) for c in ((counts == 1).astype(int), (counts == 2).astype(int), (counts >= 3).astype(int))]
        rows = _blocks("context", _range(context[first], shards), context[first], *times)
        last, lefts = _counted(keys & np.uint64(0xFFFFFFFF))
        rows += _blocks("left", _range(last, shards), last, lefts)
        totals = np.array([(counts == i).sum() for i in range(1, 5)] + [len(keys)])
        return _frame(rows + [("totals", 0, totals.astype(np.int64).tobytes(), None, None, None)])

    def finish(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        part, shard = key
        if part == "totals":
            total = sum(np.frombuffer(b, dtype=np.int64) for b in frame["keys"])
            return pd.DataFrame([("pair", total.tolist(), 0)], columns=["kind", "counts", "tokens"])
        by = {k: f for k, f in frame.groupby("kind")}

        def sums(kind: str, names: str) -> tuple[np.ndarray, list[np.ndarray]]:
            if kind not in by:
                return np.zeros(1, np.uint64), [np.zeros(1, np.int64)] * len(names)
            return _summed([_unpacked(b) for b in by[kind]["keys"]], [[_unpacked(b) for b in by[kind][n]] for n in names])

        keys, (counts,) = sums("word", "a")
        upper = keys >> np.uint64(32)

        def of(table: np.ndarray, values: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(table, upper), len(table) - 1)
            return np.where(table[at] == upper, values[at], 0).astype(np.uint32)

        contexts, times = sums("context", "abc")
        lasts, (lefts,) = sums("left", "a")
        left = of(lasts, lefts)
        os.makedirs(folder, exist_ok=True)
        _write(f"{folder}/word-{shard}", keys=keys, count=counts.astype(np.uint32), n1=of(contexts, times[0]), n2=of(contexts, times[1]), n3=of(contexts, times[2]), left=left)
        real = keys != START
        totals = [int((left[real] == i).sum()) for i in range(1, 5)] + [int((left[real] >= 3).sum()), int(real.sum())]
        return pd.DataFrame([("word", totals, int(counts[real].sum()))], columns=["kind", "counts", "tokens"])

    merged = source.mapInPandas(count, _BLOCKS).groupBy("kind", "shard").applyInPandas(merge, _BLOCKS)
    parts = F.when(F.col("kind") == "totals", "totals").otherwise("word")
    ended = stored(merged.groupBy(parts.alias("part"), "shard").applyInPandas(finish, "kind string, counts array<long>, tokens long"), "ngram-totals")
    summary = {r.kind: r for r in ended.groupBy("kind").agg(
        F.array(*(F.sum(F.coalesce(F.try_element_at("counts", F.lit(i)), F.lit(0))) for i in range(1, 7))).alias("counts"), F.sum("tokens").alias("tokens")).collect()}
    if "word" not in summary:
        return Model(folder, shards, 0, 0, 0, (0.5, 1.0, 1.5), (0.5, 1.0, 1.5), 1.0)
    pair, word = summary["pair"].counts, summary["word"].counts
    low = _discounts(np.array(word))
    rest = (low[0] * word[0] + low[1] * word[1] + low[2] * word[4]) / max(1, pair[4])
    return Model(folder, shards, int(summary["word"].tokens), int(word[5]), int(pair[4]), _discounts(np.array(pair)), low, float(rest))


def perplexities(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10 probabilities of the whole text), perplexity."""
    source = slim(docs, id_col, text_col)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, texts = frame["doc_id"].tolist(), frame["text"].tolist()
            at = 0
            while at < len(texts):
                keys, begin, held = [], at, 0
                while at < len(texts) and (held < _SLICE or at == begin):
                    keys.append(word_keys(texts[at]))
                    held += len(keys[-1])
                    at += 1
                pairs = np.concatenate([bigram_keys(k) for k in keys])
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])[:-1]])
                count, base, score = model.scores(np.concatenate(keys), pairs)
                n = np.array([len(k) for k in keys])
                total = np.add.reduceat(score, ends)
                yield pd.DataFrame({
                    "doc_id": ids[begin:at], "n_tokens": n, "n_known": np.add.reduceat((count > 0).astype(np.int64), ends),
                    "base_score": np.add.reduceat(base, ends), "score": total, "perplexity": 10.0 ** np.minimum(-total / n, 300),
                })

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(each, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double, perplexity double")
