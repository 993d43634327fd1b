import re

import numpy as np
import pytest
import xxhash

from ledgermill.llm import simhash
from ledgermill.llm.components import components
from tests.llm.helpers import AWKWARD, folder, run


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_groups_equal_brute_force(spark, tmp_path):
    given = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = given + [(1000 + r[0], *r[1:]) for r in AWKWARD] + [(5000, given[3][1], "", "", 0)]
    prints = {r[0]: brute_fingerprint(r[1]) for r in rows}
    want = brute_components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = run(spark, "op1_simhash", folder(spark, tmp_path, rows)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{prints[d]:016x}", want[d]) for d in prints}


def test_empty_table(spark, tmp_path):
    assert run(spark, "op1_simhash", folder(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("tile", [4096, 8])
def test_no_link_is_lost_in_dense_groups(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(1)
    seeds = [0, (1 << 64) - 1, 1 << 63, *(int(x) for x in rng.integers(0, 1 << 63, 10))]
    prints = {s ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for s in seeds for a, b, c in rng.integers(0, 64, (25, 3))}
    signed = {p - (1 << 64) if p >= 1 << 63 else p: p for p in prints}
    hung = components(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), 2)).collect()
    got = {s: s for s in signed} | {r.node: r.root for r in hung}
    assert got == brute_components(list(signed), lambda a, b: (signed[a] ^ signed[b]).bit_count() <= 2)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 299, 299: 299}
