import re

import pytest

import corpus_pipeline
from ledgermill.llm import near_duplicates
from tests.llm.helpers import AWKWARD, SCHEMA, folder

GIVEN = "/root/testdata/sf0.01"


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    """Least identifier of the group of each document, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and not x.isdisjoint(y):
                shared = len(x & y)
                if shared >= 0.8 * (len(x) + len(y) - shared):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {i: find(i) for i in sets}


def test_near_groups_equal_brute_force(spark):
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_groups(rows)
    hung = {r.node: r.root for r in near_duplicates.near_groups(docs).collect()}
    got = {i: hung.get(i, i) for i in want}
    wrong = [i for i in want if got[i] != want[i]]
    assert len(set(want.values())) < len(want) - 20
    assert len(wrong) <= 2, wrong  # pairs at the very limit may be missed
    kept = {r.doc_id for r in near_duplicates.without_near_duplicates(docs).collect()}
    assert kept == {i for i in want if got[i] == i}


def test_a_dense_group_in_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "TILE", 16)
    base = [f"word{i}" for i in range(100)]
    rows = [(i, " ".join(base[: i % 90] + [f"other{i}"] + base[i % 90 + 1 :]), "en", "s", 0) for i in range(150)]
    rows += [(1000 + i, " ".join(f"z{i}x{k}" for k in range(60)), "en", "s", 0) for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.doc_id for r in near_duplicates.without_near_duplicates(docs).collect()}
    assert kept == {0, *range(1000, 1050)}


def _jaccard(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def _changed(words, places, mark):
    """One word of every five-word shingle run replaced at each of the places."""
    out = list(words)
    for k in places:
        out[k] = f"{mark}{k}"
    return " ".join(out)


@pytest.mark.parametrize("block", [256, 3])
def test_links_beside_the_forest(spark, monkeypatch, block):
    """Edit chains, copies around a hub at 0.7 and many of both: as brute force has them."""
    monkeypatch.setattr(near_duplicates, "BLOCK", block, raising=False)
    rows, at = [], 0
    for n in range(12):
        base = [f"w{n}x{i}" for i in range(400)]
        first, second = range(5, 300, 40), range(20, 400, 48)
        chain = [" ".join(base), _changed(base, first, "a"), _changed(_changed(base, first, "a").split(), second, "b")]
        assert _jaccard(chain[0], chain[1]) >= 0.8 <= _jaccard(chain[1], chain[2]) and 0.6 < _jaccard(chain[0], chain[2]) < 0.8
        hub = [f"h{n}x{i}" for i in range(400)]
        copy = _changed(hub, range(3, 400, 26), "c")
        copies = [" ".join(hub), *(_changed(copy.split(), [k], "d") for k in range(10, 70, 10))]
        assert all(_jaccard(copies[0], c) < 0.8 for c in copies[1:]) and _jaccard(copies[1], copies[2]) > 0.9
        for text in [chain[0], chain[2], chain[1]] if n % 2 else [chain[0], chain[1], chain[2]]:
            rows.append((at, text, "en", "s", 0))
            at += 1
        for text in copies:
            rows.append((at, text, "en", "s", 0))
            at += 1
    want = brute_groups([r[:2] for r in rows])
    hung = {r.node: r.root for r in near_duplicates.near_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: hung.get(i, i) for i in want} == want


def test_one_identifier_with_two_texts_and_null_identifiers(spark):
    """Rows are told apart by where they stand; a text is lost only where a near copy of it stays."""
    t, u = (" ".join(f"{mark}{k}" for k in range(60)) for mark in "tu")
    rows = [(1, t), (2, t + " x"), (3, u), (3, t), (4, u + " y"), (None, u), (None, "alone " * 3), (None, None), (None, None)]
    kept = near_duplicates.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, t), (3, u), (None, "alone " * 3), (None, None), (None, None)], key=str)


def test_clashing_names_pass_through(spark):
    rows = spark.range(40).selectExpr("id AS doc_id", "concat('a b c d e f g ', id % 20) AS text", "id AS node", "id AS root", "id AS _at_row", "'f' AS _in_file", "id AS _row", "id AS size", "id AS _gone_id")
    for stage in (near_duplicates.without_near_duplicates,):
        out = stage(rows)
        assert out.columns == rows.columns and 1 <= out.count() <= 20


def test_stages_keep_the_columns(spark, tmp_path):
    where = folder(spark, tmp_path)
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, where)
        assert out.columns == docs.columns and out.count() <= len(AWKWARD)
        assert stage(spark, docs.limit(0), where).count() == 0


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_run_on_awkward_tables(spark, tmp_path, rows):
    corpus_pipeline.run(spark, folder(spark, tmp_path, rows)).collect()


def test_run_on_the_given_documents(spark):
    truth = {r.doc_id: r.text for r in spark.read.parquet(f"{GIVEN}/documents.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.run(spark, GIVEN).collect()}
    items = [r.text for r in spark.read.parquet(f"{GIVEN}/benchmark.parquet").collect()]
    bare = {}
    for i, t in truth.items():
        bare.setdefault(re.sub(r"\s", "", t), []).append(i)
    assert all(len(kept & set(group)) <= 1 for group in bare.values())
    assert not any(item in truth[i] for i in kept for item in items)
    clean = {i for i, root in brute_groups(truth.items()).items() if root == i and not any(item in truth[i] for item in items)}
    assert len(kept & clean) > 0.98 * len(clean)
