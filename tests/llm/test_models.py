import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import ngram_lm, packing, queries
from tests.llm.helpers import AWKWARD, SCHEMA, folder, run

GIVEN = "/root/testdata/sf0.01"


def crc(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


@pytest.mark.parametrize("name", ["op2_language", "op5_packing", "op9_ngram_lm", "op10_quality"])
def test_awkward_and_empty_tables(spark, tmp_path, name):
    got = run(spark, name, folder(spark, tmp_path / "a")).collect()
    assert {r.doc_id for r in got} == {r[0] for r in AWKWARD}
    assert run(spark, name, folder(spark, tmp_path / "b", [])).count() == 0
    twice = run(spark, name, folder(spark, tmp_path / "c", [r for r in AWKWARD[:6] for _ in range(2)])).collect()
    assert len(twice) == 12


def test_language_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{GIVEN}/documents.parquet").collect()}
    got = run(spark, "op2_language", GIVEN).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and {r.doc_id for r in held} == {d for d in truth if crc(d, 4) == 2}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and np.mean([r.rejected for r in got]) < 0.01


def test_no_letters_is_und(spark, tmp_path):
    got = {r.doc_id: r for r in run(spark, "op2_language", folder(spark, tmp_path, AWKWARD + [(50, "12 34 !", "en", "", 0)])).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 50)] == ["und"] * 4 and got[1].score == 0
    assert {got[i].lang_pred for i in (4, 5, 7, 8)} <= {"en", "de"}


def test_quality_on_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{GIVEN}/labels.parquet").collect()}
    got = [r for r in run(spark, "op10_quality", GIVEN).collect() if r.held_out and r.doc_id in truth]
    good = sorted(r.score for r in got if truth[r.doc_id] == 1)
    bad = [r.score for r in got if truth[r.doc_id] == 0]
    auc = np.mean([np.searchsorted(good, b, "right") / len(good) for b in bad])
    assert 1 - auc > 0.95
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.93


def test_ids_equal_the_tokenizers(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    odd = ["don't WE'LL ''s $'re x²³¼½ 12.5", "İstanbul ΣΑΣ", "a\x1cb\x85c　d \xa0e", "<|endoftext|> x", "é ﬁ", "ªº µ ǅ ƻ ǀ", "😀😀 a", "!!'s", "\xad a\xadb"]
    texts = odd + [r[1] or "" for r in AWKWARD] + [r.text for r in spark.read.parquet(f"{GIVEN}/documents.parquet").limit(300).collect()]
    encode = packing.Encoder(queries.vocabulary(), memory=500)
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == want, text[:100]


def test_packing_is_a_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{GIVEN}/documents.parquet").collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in run(spark, "op5_packing", GIVEN).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for doc_id, text in docs.items():
        ids, at = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], dtype="<u4"), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.ROOM
        used += at
    assert used / (len(sequences) * packing.ROOM) > 0.99


def test_first_fit_decreasing_equals_a_plain_scan():
    lengths = np.random.default_rng(3).integers(1, 100, 300)
    sequence, offset = packing.first_fit_decreasing(lengths, 100)
    room, want = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        k = next((k for k, r in enumerate(room) if r >= lengths[i]), None)
        if k is None:
            room.append(100)
            k = len(room) - 1
        want[i] = (k, 100 - room[k])
        room[k] -= lengths[i]
    assert {i: (s, o) for i, (s, o) in enumerate(zip(sequence, offset, strict=True))} == want


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w] + ["</s>"]


def brute(rows):
    """Base scores, and the same bigram model, with dictionaries of words."""
    train = [words(t) for i, t in rows if crc(i, 5) != 1]
    unigrams = Counter(w for ws in train for w in ws)
    pairs = Counter(p for ws in train for p in zip(["<s>"] + ws, ws))
    n, v = sum(unigrams.values()), len(unigrams)
    left, context = Counter(w for _, w in pairs), Counter()
    times = defaultdict(lambda: [0, 0, 0])
    for (u, _), c in pairs.items():
        context[u] += c
        times[u][min(c, 3) - 1] += 1

    def discounts(counts):
        k = [sum(c == i for c in counts) for i in range(1, 5)]
        if min(k) <= 0:
            return [0.5, 1.0, 1.5]
        y = k[0] / (k[0] + 2 * k[1])
        return [min(max(i + 1 - (i + 2) * y * k[i + 1] / k[i], 0.05 * (i + 1)), i + 1 - 0.05) for i in range(3)]

    d, low = discounts(pairs.values()), discounts(left.values())
    rest = sum(low[min(c, 3) - 1] for c in left.values()) / max(1, len(pairs)) / (v + 1) if pairs else 1 / (v + 1)

    def p(u, w):
        p1 = rest + (max(left[w] - low[min(left[w], 3) - 1], 0) / len(pairs) if left[w] else 0)
        if not context[u]:
            return p1
        c = pairs[u, w]
        return ((max(c - d[min(c, 3) - 1], 0) if c else 0) + sum(a * b for a, b in zip(d, times[u])) * p1) / context[u]

    out = {}
    for i, t in rows:
        ws = words(t)
        base = sum(math.log10((unigrams[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out[i] = (len(ws), sum(unigrams[w] > 0 for w in ws), n, base, sum(math.log10(p(u, w)) for u, w in zip(["<s>"] + ws, ws)))
    return out


@pytest.mark.parametrize("shard_bytes", [None, 100_000])
def test_language_model_equals_plain_dictionaries(spark, tmp_path, monkeypatch, shard_bytes):
    if shard_bytes:
        monkeypatch.setattr(ngram_lm, "SHARD_BYTES", shard_bytes)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(1000 + r[0], r[1]) for r in AWKWARD]
    where = folder(spark, tmp_path, [(i, t, "en", "s", 0) for i, t in rows])
    want = brute(rows)
    got = run(spark, "op9_ngram_lm", where).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3]
        assert r.base_score == pytest.approx(w[3], rel=1e-9) and r.score == pytest.approx(w[4], rel=1e-6)
        assert r.held_out == (crc(r.doc_id, 5) == 1)


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "a b a c a b", "", "", 0), (2, "b a d", "", "", 0)], SCHEMA)
    model = ngram_lm.train(docs, docs.doc_id > 0)
    keys = np.concatenate([ngram_lm.word_keys("a b c d unknown")])
    for before in ngram_lm.word_keys("a b")[:2]:
        pairs = (before >> np.uint64(32) << np.uint64(32)) | (keys >> np.uint64(32))
        total = 0
        for key, pair in zip(keys, pairs):
            ordered = np.array([before, key])
            total += 10 ** model.scores(ordered, np.array([pair, pair]))[2][1]
        assert total == pytest.approx(1.0)


def test_equal_rows_are_dealt_to_all_groups(spark):
    """40,000 equal rows: as many groups as of any other rows, none above its usual size."""
    cut = spark.range(40_000).selectExpr("1L AS doc_id", "0L AS start", "10L AS length", "7L AS ids_crc32", "10L AS doc_tokens")
    out = packing.pack(cut, group=2000)
    sizes = [r["count"] for r in out.groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()]
    assert sum(sizes) == 40_000 and len(sizes) == 20 and max(sizes) < 2 * 2000
    assert out.selectExpr("count(DISTINCT sequence_id, offset)").first()[0] == 40_000


def test_a_small_word_memory_changes_nothing():
    texts = [" ".join(f"word{i % k}s{i}" for i in range(60)) for k in (3, 7, 11)] * 3
    plain, small = packing.Encoder(queries.vocabulary()), packing.Encoder(queries.vocabulary(), memory=20)
    assert [plain(t) for t in texts] == [small(t) for t in texts] == [plain._whole(t) for t in texts]


def test_numerals_are_no_letters(spark, tmp_path):
    rows = [(1, "½ ² Ⅷ 123 __", "en", "", 0), (2, "plain words here", "en", "", 0), (3, "andere Wörter dort", "de", "", 0), (4, "ªº", "de", "", 0)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in run(spark, "op2_language", folder(spark, tmp_path, rows)).collect()}
    assert got[1][0] == "und" and all(got[i][0] != "und" for i in (2, 3, 4))
