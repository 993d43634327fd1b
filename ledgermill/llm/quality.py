"""Quality classifier: a sparse ensemble of rules.

Statistics of every whole text are counted in one pass. Small boosted trees over the statistics of labelled rows propose
rules: each path from a root is a conjunction of thresholds. A logistic model with a lasso penalty gives most rules no
weight; the rest become one Spark column expression, so scoring is code that Spark generates.

The model is fitted on a bounded sample: at most ``max_rows`` labelled rows, the smallest by a hash of the identifier among about
twice as many that a threshold on the hash admits. The statistics are taken of all documents.

Defined results: null texts are empty, and empty texts get a score like all others. Without labels of both kinds the score
is the smoothed share of label 1. Several labels of one document count as their largest. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import slim

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "longest_word", "upper", "digit", "letter", "beyond_ascii", "blank", "line_ends",
    "full_stop", "comma", "exclaim", "bar", "marks", "other_sign", "distinct_words", "top_word", "one_sign_words",
    "distinct_lines", "capital_words", "ends_in_sign",
)
_SIGNS = {"full_stop": b".", "comma": b",", "exclaim": b"!?", "bar": b"|", "marks": b"#$%&*@", "line_ends": b"\n"}
_OTHER = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,!?|#$%&*@")


def statistics(text: str) -> list[float]:
    """The values of ``STATISTICS``; shares are of all bytes, words or lines."""
    raw = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = max(1, len(raw))
    words = raw.split()
    k = max(1, len(words))
    seen = Counter(words)
    lengths = [len(w) for w in words]
    lines = [x for x in raw.split(b"\n") if x]
    share = {name: counts[list(signs)].sum() / n for name, signs in _SIGNS.items()}
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    values = {
        "log_bytes": np.log1p(len(raw)), "log_words": np.log1p(len(words)), "mean_word": sum(lengths) / k,
        "longest_word": np.log1p(max(lengths, default=0)), "upper": upper / n, "digit": digit / n,
        "letter": (upper + lower) / n, "beyond_ascii": counts[128:].sum() / n, "blank": counts[32] / n,
        "other_sign": counts[list(_OTHER)].sum() / n, "distinct_words": len(seen) / k,
        "top_word": max(seen.values(), default=0) / k, "one_sign_words": lengths.count(1) / k,
        "distinct_lines": len(set(lines)) / max(1, len(lines)), "capital_words": sum(w[:1].isupper() for w in words) / k,
        "ends_in_sign": sum(w[-1] in b"#$%&*@!?|" for w in words) / k, **share,
    }
    return [float(values[name]) for name in STATISTICS]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one column for each of ``STATISTICS``."""
    source = slim(docs, id_col, text_col)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = np.array([statistics(t) for t in frame["text"]]).reshape(len(frame), len(STATISTICS))
            out = pd.DataFrame(values, columns=list(STATISTICS))
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(each, f"doc_id {id_type}, " + ", ".join(f"{name} double" for name in STATISTICS))


Condition = tuple[int, bool, float]  # statistic, whether above, threshold


@dataclass(frozen=True)
class Rules:
    bias: float
    weighted: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self) -> Column:
        """The probability of label 1 as an expression over the columns of :func:`measure`."""
        terms = [F.when(_holds(rule), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.weighted]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.bias))))


def _holds(rule: tuple[Condition, ...]) -> Column:
    tests = (F.col(STATISTICS[i]) > t if above else F.col(STATISTICS[i]) <= t for i, above, t in rule)
    return reduce(lambda a, b: a & b, tests)


def _paths(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, least: int, rule: tuple[Condition, ...] = ()) -> tuple[list, np.ndarray]:
    """Rules of a regression tree for one boosting step, and its fitted values."""
    value = np.full(len(x), -grad.sum() / (hess.sum() + 1.0))
    found = [rule] if rule else []
    if depth == 0 or len(x) < 2 * least:
        return found, value
    best, where = 1e-9, None
    base = grad.sum() ** 2 / (hess.sum() + 1.0)
    for i in range(x.shape[1]):
        order = np.argsort(x[:, i], kind="stable")
        sorted_x, g, h = x[order, i], grad[order].cumsum(), hess[order].cumsum()
        cuts = np.flatnonzero(sorted_x[1:] > sorted_x[:-1])
        cuts = cuts[(cuts + 1 >= least) & (len(x) - cuts - 1 >= least)]
        if len(cuts):
            gain = g[cuts] ** 2 / (h[cuts] + 1.0) + (g[-1] - g[cuts]) ** 2 / (h[-1] - h[cuts] + 1.0) - base
            k = int(gain.argmax())
            if gain[k] > best:
                best, where = gain[k], (i, float((sorted_x[cuts[k]] + sorted_x[cuts[k] + 1]) / 2))
    if where is None:
        return found, value
    i, threshold = where
    above = x[:, i] > threshold
    for side in (False, True):
        rows = above == side
        more, value[rows] = _paths(x[rows], grad[rows], hess[rows], depth - 1, least, (*rule, (i, side, threshold)))
        found += more
    return found, value


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 0.001, rounds: int = 400) -> Rules:
    """Trees propose rules, an accelerated proximal gradient fits their lasso weights."""
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if len(np.unique(y)) < 2:
        return Rules(prior, ())
    margin, rules = np.full(len(y), prior), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        found, value = _paths(x, p - y, p * (1 - p), depth, max(5, len(y) // 500))
        rules += found
        margin += 0.3 * value
    rules = list(dict.fromkeys(rules))
    if not rules:
        return Rules(prior, ())
    z = np.ones((len(x), len(rules)), dtype=bool)
    for j, rule in enumerate(rules):
        for i, above, t in rule:
            z[:, j] &= (x[:, i] > t) == above
    share = z.mean(axis=0)
    scale = np.sqrt(np.maximum(share * (1 - share), 1e-4))
    a = (z - share) / scale
    bound = 0.25 * np.linalg.norm(a, 2) ** 2 / len(y)
    w = ahead = np.zeros(len(rules))
    b, t = prior, 1.0
    for _ in range(rounds):
        gap = 1 / (1 + np.exp(-(a @ ahead + b))) - y
        moved = ahead - a.T @ gap / len(y) / bound
        new = np.sign(moved) * np.maximum(np.abs(moved) - penalty / bound, 0)
        b -= 4 * gap.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_next * (new - w)
        w, t = new, t_next
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    weights = w[kept] / scale[kept]
    return Rules(float(b - share[kept] @ weights), tuple((rules[j], float(v)) for j, v in zip(kept, weights, strict=True)))


def train(measured: DataFrame, labels: DataFrame, learn_from: Column, label_col: str = "quality", id_col: str = "doc_id", max_rows: int = 12000) -> Rules:
    """Fit on at most ``max_rows`` labelled rows of :func:`measure`; ``learn_from`` is a condition over ``doc_id``."""
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("double").alias("label"))
    known = known.where(learn_from & F.col("label").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    # a threshold on the hash leaves about twice the sample before it is sorted and cut
    place = F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5
    known = known.where(place < 2.0 * max_rows / max(1, known.count()))
    rows = measured.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).toPandas()
    return fit(rows[list(STATISTICS)].to_numpy(dtype=float), rows["label"].to_numpy(dtype=float))
