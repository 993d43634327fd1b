"""Language identification: averaged hashed subword embeddings under a linear softmax.

Every run of 2 to 4 signs of the lower-cased text (signs that are no letters become spaces) is hashed into a bucket; the mean
of the buckets' vectors goes through a linear layer and a softmax. Training is plain stochastic gradient descent in numpy on
a bounded sample: at most ``per_language`` labelled documents of each language, the smallest by a hash of the identifier
among about twice as many that a threshold on the hash admits.
A fifth of the sample is kept out of training and calibrates the temperature of the softmax and the limit below which a
document is rejected.

Prediction reads every whole text in one pass without a shuffle. What is sent to the workers is the product of the two
layers: ``BUCKETS`` times the number of languages, whatever the size of the corpus.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected. Without any labelled row every
document is ``und``. Ties go to the language that sorts first. Columns besides those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import slim

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
_LISTED = 10_000  # languages whose shares are written into the filter; more are joined
_KNOWN = np.array([c if chr(c).isalpha() else 32 for c in range(0x250)], dtype=np.uint32)
_CHUNK = 1 << 20


def subwords(text: str) -> np.ndarray:
    """Bucket of each run of signs of the orders in ``ORDERS``."""
    signs = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    signs = np.where(signs < len(_KNOWN), _KNOWN[np.minimum(signs, len(_KNOWN) - 1)], signs).astype(np.uint32)
    runs, out = signs, []
    for order in range(2, max(ORDERS) + 1):
        if len(signs) < order:
            break
        runs = runs[:-1] * np.uint32(0x01000193) + signs[order - 1 :]
        if order in ORDERS:
            mixed = runs ^ (runs >> np.uint32(15))
            out.append((mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15))
    return np.concatenate(out)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # bucket -> logits, before the mean
    bias: np.ndarray
    temperature: float
    limit: float

    def logits(self, text: str) -> np.ndarray:
        buckets = subwords(text)
        total = np.zeros(len(self.languages))
        for start in range(0, len(buckets), _CHUNK):
            total += self.table.take(buckets[start : start + _CHUNK], axis=0).sum(axis=0, dtype=np.float64)
        return total / len(buckets) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        p = _softmax(self.logits(text)[None, :] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.limit)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], dims: int = 16, epochs: int = 6, rate: float = 2.0, strictness: float = 0.001, seed: int = 7) -> Model:
    """Train on (buckets, counts, language) rows; see the module's text."""
    languages = tuple(sorted({r[2] for r in rows}))
    place = {name: i for i, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, dims)).astype(np.float32)
    layer = np.zeros((dims, len(languages)), dtype=np.float32)
    layer[:] = rng.normal(0, 0.1, layer.shape)
    bias = np.zeros(len(languages))
    held = [r for i, r in enumerate(rows) if i % 5 == 4]
    train = [r for i, r in enumerate(rows) if i % 5 != 4]
    step = 0
    for _ in range(epochs if languages else 0):
        for i in rng.permutation(len(train)):
            buckets, counts, name = train[i]
            share = (counts / counts.sum()).astype(np.float32)
            own = vectors[buckets]
            hidden = share @ own
            p = _softmax((hidden @ layer + bias)[None, :])[0]
            p[place[name]] -= 1.0
            eta = rate * (1 - step / (epochs * len(train)))
            back = layer @ p.astype(np.float32)
            layer -= eta * np.outer(hidden, p).astype(np.float32)
            bias -= 0.1 * eta * p
            vectors[buckets] = own - (eta * np.outer(share, back)).astype(np.float32)
            step += 1
    table = vectors @ layer
    temperature, limit = 1.0, 0.0
    if held:
        z = np.array([(r[1] / r[1].sum()) @ table[r[0]] + bias for r in held])
        y = np.array([place[r[2]] for r in held])
        tries = np.geomspace(0.05, 5, 60)
        losses = [-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in tries]
        temperature = float(tries[int(np.argmin(losses))])
        p = _softmax(z / temperature)
        right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y])
        # of right predictions at most the share ``strictness`` is rejected, and nothing that is more likely than not
        limit = min(0.5, float(right[int(strictness * len(right))])) if len(right) else 0.0
    return Model(languages, table.astype(np.float32), bias, temperature, limit)


def _features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        pairs = [np.unique(subwords(t), return_counts=True) for t in frame["text"]]
        yield pd.DataFrame({
            "order": frame["order"], "lang": frame["lang"],
            "buckets": [p[0].astype(np.uint16).tobytes() for p in pairs], "counts": [p[1].astype(np.uint32).tobytes() for p in pairs],
        })


def train(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 600) -> Model:
    """Fit on a bounded sample of the rows that ``learn_from`` (a condition over ``docs``) admits."""
    rows = docs.where(learn_from & docs[lang_col].isNotNull() & docs[text_col].isNotNull())
    known = rows.select(rows[id_col].alias("doc_id"), rows[lang_col].alias("lang"), F.xxhash64(rows[id_col]).alias("order"))
    # a threshold on the hash leaves about twice the sample before languages are brought together
    shares = known.groupBy("lang").agg((2.0 * per_language / F.count(F.lit(1))).alias("_share"))
    place = F.col("order") / F.lit(2.0**64) + 0.5
    # as a map in the filter, so that the rows of a language are not brought together before it
    listed = shares.limit(_LISTED + 1).collect()
    if len(listed) <= _LISTED:
        share = F.create_map(*(F.lit(x) for r in listed for x in (r["lang"], r["_share"]))) if listed else F.create_map().cast("map<string,double>")
        known = known.where(place < F.try_element_at(share, "lang"))
    else:
        known = known.join(shares, "lang").where(place < F.col("_share"))
    within = Window.partitionBy("lang").orderBy("order", "doc_id")
    chosen = known.withColumn("_at", F.row_number().over(within)).where(F.col("_at") <= per_language).select("doc_id", "lang", "order")
    texts = slim(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # per_language rows of each language at most
    texts = texts.where(F.col("text").rlike(r"\p{L}")).select("order", "lang", "text")
    found = texts.mapInPandas(_features, "order long, lang string, buckets binary, counts binary").collect()
    found.sort(key=lambda r: (r.order, r.lang))
    return fit([(np.frombuffer(r.buckets, np.uint16), np.frombuffer(r.counts, np.uint32), r.lang) for r in found])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row."""
    source = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = source.schema["doc_id"].dataType.simpleString()

    def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for frame in frames:
            found = [own.predict(t) for t in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found], "rejected": [f[2] for f in found],
            })

    return source.mapInPandas(predict, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose language the model does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series([not own.predict(t)[2] for t in texts], dtype=bool)

    return docs.where(known(docs[text_col]))
