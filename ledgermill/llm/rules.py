"""Quality rules: clean a document line by line, then reject it if too much of it was lost.

Each line is judged by three rules, in this order, and removed with the first it fails:

* punctuation: signs that are not prose make up a twentieth of its characters, or more than a quarter as many doubled marks
  (``!!``, ``??``) as words stand in it, or it has ``long_line`` words or more and none of them ends in a sign that ends a
  sentence or a clause;
* navigation: two or more separators (bar, bullet, arrow), one for each four words at least;
* boilerplate: a notice of licence, copyright, cookies, terms, or a button.

A document is rejected if it fails the base rules (too few words, too many repeated three-word windows) or if more than
``max_lost`` percent of the characters of its lines are removed. Comparisons are between whole numbers.

Rows are judged alone in one pass over the texts; nothing is shuffled. Defined results: null and empty texts have no words and fail
the base rules; a line without a word fails no rule, has no characters and stays. Repeated rows repeat their result, whatever their
identifiers. Long texts are taken whole. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.common import BLANKS, slim
from ledgermill.llm.words import numbered

#: Signs counted in a text, signs counted in a line, doubled marks, words at an end, separators and notices.
SYMBOLS = "#*$%&|<>"
NOT_PROSE = "#*$%&<>"
DOUBLED = r"[!?][!?]+"
ENDED = r"[.!?:;,…\"'”’»)\]](?:[\x20\x09-\x0D]|$)"
SEPARATORS = r"[|»›•→]"
NOTICE = (
    r"(?i)licen[sc]ed under|all rights reserved|copyright|\(c\) [0-9]{4}|©|cookie|privacy policy|terms of (?:use|service)"
    r"|javascript|click here|subscribe|sign (?:up|in)\b|log ?in\b|read more|lorem ipsum"
)
RULES = ("punctuation", "navigation", "boilerplate")
_DOUBLED, _ENDED, _SEPARATORS, _NOTICE = (re.compile(p, re.ASCII) for p in (DOUBLED, ENDED, SEPARATORS, NOTICE))
#: Without one of these, in lower case, a text holds no notice; the expression is then not tried on its lines.
_IN_NOTICES = (
    "licen", "rights reserved", "copyright", "(c) ", "©", "cookie", "privacy policy", "terms of ", "javascript", "click here", "subscribe",
    "sign up", "sign in", "login", "log in", "read more", "lorem ipsum",
)


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeated: int = 50  # percent of words in repeated windows
    long_line: int = 8  # words a line may have without an ending
    max_lost: int = 40  # percent of characters


def _count(text: str, signs: str) -> int:
    return sum(text.count(sign) for sign in signs)


def failed_rule(line: str, limits: Limits = Limits(), notices: bool = True) -> str | None:
    """The first of ``RULES`` that a line without surrounding blanks fails; without ``notices`` it is known to hold none."""
    doubled = len(_DOUBLED.findall(line)) if "!" in line or "?" in line else 0
    if 20 * _count(line, NOT_PROSE) >= len(line) or doubled and 4 * doubled > _words(line):
        return "punctuation"
    if not _ENDED.search(line) and _words(line) >= limits.long_line:
        return "punctuation"
    separators = len(_SEPARATORS.findall(line)) if "|" in line or not line.isascii() else 0
    if separators >= 2 and 4 * separators >= _words(line):
        return "navigation"
    return "boilerplate" if notices and _NOTICE.search(line) else None


def _words(line: str) -> int:
    return len(line.encode("utf-8", "surrogatepass").split())


def repeated_words(ids: np.ndarray) -> int:
    """How many words lie in windows of three words that are found twice or more."""
    if len(ids) < 4:
        return 0
    pairs = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)[1]
    _, window, found = np.unique(pairs[:-1] * (ids.max() + 1) + ids[2:], return_inverse=True, return_counts=True)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : len(ids) - 2 + k] |= found[window] > 1
    return int(covered.sum())


def judge(text: str, limits: Limits = Limits()) -> dict[str, object]:
    """All columns of :func:`clean` but the identifier."""
    _, ids = numbered(text)
    seen: set[str] = set()
    removed, left = dict.fromkeys(RULES, 0), []
    n_dup_lines = line_chars = lost_chars = 0
    lower = text.lower()
    notices = any(part in lower for part in _IN_NOTICES)
    for line in text.split("\n"):
        bare = line.strip(BLANKS)
        if not bare:
            left.append(line)
            continue
        n_dup_lines += line in seen
        seen.add(line)
        line_chars += len(bare)
        rule = failed_rule(bare, limits, notices)
        if rule:
            removed[rule] += 1
            lost_chars += len(bare)
        else:
            left.append(line)
    n_words, n_repeat_words = len(ids), repeated_words(ids)
    base_failed = n_words < limits.min_words or 100 * n_repeat_words > limits.max_repeated * n_words
    return {
        "n_words": n_words, "word_chars": len(text) - _count(text, BLANKS), "n_symbols": _count(text, SYMBOLS),
        "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words, **{f"n_{rule}": n for rule, n in removed.items()},
        "line_chars": line_chars, "lost_chars": lost_chars, "cleaned": "\n".join(left), "base_failed": base_failed,
        "kept": not base_failed and 100 * lost_chars <= limits.max_lost * line_chars,
    }


_COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    + ", ".join(f"n_{rule} long" for rule in RULES)
    + ", line_chars long, lost_chars long, cleaned string, base_failed boolean, kept boolean"
)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """doc_id, counts of the whole text, removed lines by rule, characters of lines and those lost, cleaned, base_failed, kept."""
    source = slim(docs, id_col, text_col)
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = {name: kinds[kind] for name, kind in (c.split() for c in _COLUMNS.split(", "))}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [judge(text, limits) for text in batch.column("text").to_pylist()]
            columns = [pa.array([row[name] for row in judged], kind) for name, kind in fields.items()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *fields])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(each, f"doc_id {id_type}, {_COLUMNS}")
