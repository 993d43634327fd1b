"""Packing of tokenised documents into sequences of a fixed length.

Each whole text is tokenised once, in the workers; its ids are cut into pieces of at most one sequence, and only the pieces'
lengths travel on. Pieces are dealt at random (by a hash) into groups of about ``GROUP`` pieces; the number of groups follows
from the number of pieces, so a group stays small at any size. Within a group, first-fit decreasing: the longest piece first,
each into the first sequence with room. A tournament tree over the sequences' room finds it in logarithmic time. A group
leaves about one sequence unfilled.

Tokenising is memoised by word, in a bounded memory that each worker keeps from task to task: the vocabulary file splits a text at white
space, letters, digits and signs, and a word's ids do not depend on its neighbours. A text with signs for which this split might differ from the tokenizer's own is given to the
tokenizer as a whole.

Defined results: a null or empty text is the end mark alone. Repeated rows are packed like other rows. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import located, place, slim
from ledgermill.session import stored

ROOM = 4096
END = 2
GROUP = 8192
#: Letters and digits among the signs up to U+024F, and the split of the vocabulary file restricted to them.
_L = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_N = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
#: Other signs (and the dotted capital I) and the special tokens' brackets.
_UNSURE = re.compile("[^\\t-\\r\\x20-\\x7e\\xa1-\\u012f\\u0131-\\u024f]|<\\|")
_WORDS_AT_ONCE = 2000
MEMORY = 150_000  # words an encoder holds ready, and as many of before; some 300 bytes each, in every worker and from task to task


class Encoder:
    """Token ids of texts, little-endian unsigned 32-bit, without special tokens."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._memory = memory
        self._known: dict[str, bytes] = {}
        self._earlier: dict[str, bytes] = {}
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self._closes[number] = token.endswith("</w>")

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        for start in range(0, len(words), _WORDS_AT_ONCE):
            some = words[start : start + _WORDS_AT_ONCE]
            ids = np.array(self._tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self._closes[ids]) + 1
            if len(ends) == len(some):
                raw, begin = ids.tobytes(), 0
                for word, end in zip(some, (4 * ends).tolist(), strict=True):
                    self._known[word] = raw[begin:end]
                    begin = end
            else:
                self._known.update((word, self._whole(word)) for word in some)

    def __call__(self, text: str) -> bytes:
        if _UNSURE.search(text):
            return self._whole(text)
        words = _SPLIT.findall(text.lower())
        try:
            return b"".join(map(self._known.__getitem__, words))
        except KeyError:
            if len(self._known) > self._memory:  # what was not used since the last time is forgotten
                self._known, self._earlier = {}, self._known
            new = []
            for word in dict.fromkeys(words):
                if word not in self._known:
                    if word in self._earlier:
                        self._known[word] = self._earlier[word]
                    else:
                        new.append(word)
            self._learn(new)
            return b"".join(map(self._known.__getitem__, words))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process; Spark's workers are used again for later tasks, which then start with what it has learnt."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: the documents' ids cut at multiples of ``room``."""
    source = slim(docs, id_col, text_col)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        end = np.array([END], dtype="<u4").tobytes()
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, room):
                    part = ids[4 * start : 4 * (start + room)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(each, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long")


def first_fit_decreasing(lengths: np.ndarray, room: int = ROOM) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [room] * (2 * leaves)  # a node holds the most room below it
    sequence, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        sequence[i], offset[i] = node - leaves, room - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return sequence, offset


def pack(cut: DataFrame, room: int = ROOM, group: int = GROUP, seed: int = 17) -> DataFrame:
    """The rows of ``cut`` (any table with ``length``) with sequence_id and offset.

    Rows are dealt by where they stand in the stored table, so equal rows go to different groups like any others.
    """
    cut = located(cut)
    names = cut.columns
    groups = max(1, -(-cut.count() // group))
    file, row = place(cut)
    dealt = cut.select(*names, F.pmod(F.xxhash64(F.lit(seed), file, row), F.lit(groups)).alias("_group"))

    def fill(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([c for c in frame.columns if c != "_group"], kind="stable")
        sequence, frame["offset"] = first_fit_decreasing(frame["length"].to_numpy(), room)
        frame["sequence_id"] = (int(key[0]) << 32) + sequence
        return frame.drop(columns="_group")

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return dealt.groupBy("_group").applyInPandas(fill, f"{fields}, sequence_id long, offset long")


def packed(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(stored(pieces(docs, vocabulary, id_col, text_col), "packing-pieces"))
