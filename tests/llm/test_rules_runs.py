import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgermill.llm import periodic, rules
from tests.llm.helpers import AWKWARD, SCHEMA, folder, run

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def given(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


def plain_runs(words):
    """All maximal runs by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(6, 4 * q):
                found.setdefault((start, length), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_periodic(rows):
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        n = len(words)
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        milli = best[1] and 1000 * best[1] // best[2]
        out.append((doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_periodic_runs_equal_plain_search(spark, tmp_path):
    # texts of a few words take every period in reasonable time; repeated and null identifiers with different texts
    short = [(r[0], (r[1] or "")[:900], *r[2:]) for r in given(spark)]
    awkward = [r if len(r[1] or "") < 100_000 else (r[0], r[1][:2000], *r[2:]) for r in AWKWARD]
    more = [(None, "a b " * 9, "", "", 0), (None, None, "", "", 0), (5, "x y z\t" * 7 + "x y", "", "", 0), (5, "x", "", "", 0)]
    rows = short + awkward + more + more
    found = run(spark, "op13_periodic_runs", folder(spark, tmp_path, rows)).collect()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r[c] for c in names) for r in found), key=repr) == plain_periodic([r[:2] for r in rows])


def test_long_texts_and_empty_table(spark, tmp_path):
    where = folder(spark, tmp_path, AWKWARD)
    found = {r.doc_id: r for r in run(spark, "op13_periodic_runs", where).collect()}
    assert (found[8].n_runs, found[8].start, found[8].length, found[8].period) == (1, 0, 30000, 1)
    assert len(found) == len(AWKWARD)
    (tmp_path / "empty").mkdir()
    empty = folder(spark, tmp_path / "empty", [])
    assert run(spark, "op13_periodic_runs", empty).count() == run(spark, "op12_quality_rules", empty).count() == 0


@pytest.mark.parametrize("exponent", [3, 4, 5])
def test_runs_of_small_alphabets(exponent):
    rng = np.random.default_rng(exponent)
    for _ in range(800):
        n, letters = int(rng.integers(0, 60)), int(rng.integers(1, 4))
        ids = rng.integers(0, letters, n)
        if n > 10 and rng.random() < 0.5:
            p, a = int(rng.integers(1, 9)), int(rng.integers(0, n))
            ids = np.array([ids[i if i < a else min(n - 1, a + (i - a) % p)] for i in range(n)])
        found, w = {}, ids.tolist()
        for q in range(1, n // exponent + 1):
            i = 0
            while i + q < n:
                start = i
                while i + q < n and w[i] == w[i + q]:
                    i += 1
                if i > start and i - start + q >= max(6, exponent * q):
                    found.setdefault((start, i - start + q), q)
                i += 1
        want = sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))
        assert [tuple(r) for r in periodic.runs(ids, exponent).tolist()] == want


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), again, len(inside), failed


def test_quality_rules_counts(spark, tmp_path):
    more = [(None, "a b c " * 40, "", "", 0), (None, None, "", "", 0), (5, "l\nl\n l\nl\n\n\n", "", "", 0), (5, "x\r\nx\r\n", "", "", 0)]
    rows = given(spark) + AWKWARD + more + more
    found = run(spark, "op12_quality_rules", folder(spark, tmp_path, rows)).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((tuple(r[c] for c in names) for r in found), key=repr) == sorted(((r[0], *plain_counts(r[1])) for r in rows), key=repr)
    assert not any(r.kept and r.base_failed for r in found)


def test_lines_are_judged_by_rule():
    prose = "These are eight or more words, as one writes them."
    assert rules.failed_rule(prose) is None
    assert rules.failed_rule("Those are eight or more words without an end") == "punctuation"
    assert rules.failed_rule("Short heading") is None
    assert rules.failed_rule("BUY!! NOW!! AND!! SAVE!!") == "punctuation"
    assert rules.failed_rule("this*** has$$$ signs%%%.") == "punctuation"
    assert rules.failed_rule("Home | News | Sport | About us.") == "navigation"
    assert rules.failed_rule("Licensed under the Apache License, Version 2.0.") == "boilerplate"


def test_documents_that_lose_too_much_go(spark):
    prose = "\n".join(" ".join(f"word{i}of{k}" for k in range(9)) + "." for i in range(9))
    menus = "\n".join(" | ".join(f"item{i}of{k}" for k in range(9)) for i in range(9))
    rows = [(1, prose, "", "", 0), (2, f"{prose}\n{menus[:60]}.\nAll rights reserved.", "", "", 0), (3, f"{prose}\n{menus}", "", "", 0)]
    found = {r.doc_id: r for r in rules.clean(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1].kept and found[1].cleaned == prose
    assert found[2].kept and found[2].cleaned == prose and (found[2].n_navigation, found[2].n_boilerplate) == (1, 1)
    assert not found[3].kept


def test_labels_agree_with_the_rules(spark):
    """Documents labelled clean stay; most of the others go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = rules.clean(docs).join(labels, "doc_id").where("n_words >= 50").groupBy("quality").agg({"kept": "count", "*": "count"})
    kept = {r.quality: r.n for r in rules.clean(docs).join(labels, "doc_id").where("n_words >= 50 AND kept").groupBy("quality").count().withColumnRenamed("count", "n").collect()}
    total = {r["quality"]: r["count(kept)"] for r in judged.collect()}
    assert kept[1] >= 0.99 * total[1] and kept.get(0, 0) <= 0.1 * total[0]
