import hashlib
from collections import Counter

import numpy as np
import pytest

from ledgermill.llm import substrings
from tests.llm.helpers import AWKWARD, SCHEMA, folder, run


def brute(rows, threshold=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + threshold] for _, b in raw for k in range(len(b) - threshold + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - threshold + 1):
            if seen[b[k : k + threshold]] > 1:
                gone[k : k + threshold] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_given_and_awkward_documents(spark, tmp_path):
    given = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    awkward = [(1000 + r[0], r[1] and r[1][:3000], *r[2:]) for r in AWKWARD]
    rows = given + awkward + [given[5], given[5], (7000, given[9][1][100:900] + "!" + given[9][1][900:], "", "", 0)]
    where = folder(spark, tmp_path, rows)
    assert got(run(spark, "op3_substrings", where)) == brute([r[:2] for r in rows])


def test_empty_table(spark, tmp_path):
    assert run(spark, "op3_substrings", folder(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("segment", [1 << 22, 50])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_small_alphabets(spark, seed, segment):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abé"), n)) for n in (150, 80, 60)]
    rows = []
    for i in range(60):
        text = "".join(base[k][int(a) : int(a) + 60] for k, a in zip(rng.integers(0, 3, 4), rng.integers(0, 60, 4)))
        rows.append((i, "x" * int(rng.integers(0, 40)) + text, "", "", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(substrings.remove_repeats(docs, threshold=20, segment=segment)) == brute([r[:2] for r in rows], 20)
