import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import exact_dedup, pii
from tests.llm.helpers import AWKWARD, SCHEMA, folder, run

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        if kind == "email" and "@" not in (text or ""):
            continue  # the plain pattern takes quadratic time on a long word
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


TRICKY = [
    "a@b.c_d@e.f x@y", "mail me at joe.doe+1@site-a.co.uk.", "1.2.3.4.5 256.1.1.1 000255.1.1.1 1.2.3", "😀 9.9.9.9 é a@b.cc",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "79927398713 4" + "0" * 30, "+49 (30) 1234567 +1.2.3 +123456789012345678",
    "a@b a@@b.c @b.c.d a@b..c a@b.c..d e@f.g", "+1 234 567 8901+1 234 567 8901", "1.1.1.1a1.1.1.1.1.1.1.1", "- - 12 34-5678 9012 3456 78",
    "IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432", "DE89370400440532013001",
]


def test_base_spans_equal_a_plain_search(spark, tmp_path):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TRICKY)] + [(100 + r[0], *r[1:]) for r in AWKWARD]
    got = {r.doc_id: r for r in run(spark, "op4_pii", folder(spark, tmp_path, rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        want = brute(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (text[:80], got[doc_id].spans, want)
        assert [got[doc_id][f"n_{k}"] for k in BASE] == [sum(k == w[0] for w in want) for k in BASE]
        assert got[doc_id].spans.startswith(joined)
    assert got[11].spans.count("iban") == 2 and "iban" not in got[12].spans


def test_base_spans_of_the_given_documents(spark):
    where = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{where}/documents.parquet").collect()}
    for r in run(spark, "op4_pii", where).collect():
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in brute(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_context_words_raise_the_score(spark):
    docs = spark.createDataFrame([(1, "visa card 4111 1111 1111 1111"), (2, "zzz 4111 1111 1111 1111")], "doc_id long, text string")
    got = {r.doc_id: r.card[0].score for r in pii.find(docs).collect()}
    assert got[1] == pytest.approx(0.8) and got[2] == pytest.approx(0.7)


def groups_of(rows):
    by = {}
    for r in rows:
        by.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append(r)
    out = {}
    for norm, members in by.items():
        keep = max(members, key=lambda r: (len(r[1] or ""), -r[0]))[0]
        for r in members:
            out[r[0]] = (keep, len(members), r[0] == keep, hashlib.sha256(norm.encode()).hexdigest())
    return out


@pytest.mark.parametrize("digest", [None, lambda c: F.length(c).cast("string")])
def test_exact_groups_even_with_a_weak_digest(spark, digest):
    docs = spark.createDataFrame(AWKWARD + [(20, "abc", "", "", 0), (21, "a bd", "", "", 0), (22, "ab d", "", "", 0)], SCHEMA)
    got = exact_dedup.exact_groups(docs, **({"digest": digest} if digest else {})).collect()
    want = groups_of(docs.collect())
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got} == {k: v[:3] for k, v in want.items()}
    assert len(got) == len(want)


def test_state_lasts_over_micro_batches(spark, tmp_path):
    rows = [(i, f"text {i % 7}" + " " * (i % 3), "en", "s", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(12)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.digest) for r in exact_dedup.exact_groups(docs, files_per_batch=1).collect()}
    assert got == groups_of(rows)


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (2, "a ", "en", "s", 2), (3, "b", "en", "s", 1), (3, "b", "en", "s", 1)], SCHEMA)
    assert sorted(r.doc_id for r in exact_dedup.without_copies(docs).collect()) == [2, 3]
    assert sorted(r.kept for r in exact_dedup.exact_groups(docs).collect()) == [False, False, False, True, True]


@pytest.mark.parametrize("name", ["op4_pii", "op8_exact_dedup"])
def test_empty_table(spark, tmp_path, name):
    assert run(spark, name, folder(spark, tmp_path, [])).count() == 0


def test_awkward_rows(spark, tmp_path):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in run(spark, "op8_exact_dedup", folder(spark, tmp_path)).collect()}
    assert got == groups_of(AWKWARD)


def test_one_identifier_with_two_texts_and_null_identifiers(spark):
    """Rows are told apart by where they stand, not by their identifiers."""
    rows = [(3, "b"), (5, "a"), (5, "b"), (6, "a"), (7, "c"), (7, "d"), (8, "c"), (9, "d"), (None, "y"), (2, "y"), (None, "z"), (None, "z ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect() if r.doc_id is not None)
    want = [(2, 2, 2, True), (3, 3, 2, True), (5, 3, 2, False), (5, 5, 2, True), (6, 5, 2, False), (7, 7, 2, True), (7, 7, 2, True), (8, 7, 2, False), (9, 7, 2, False)]
    assert got == want
    kept = sorted(((r.doc_id, r.text) for r in exact_dedup.without_copies(docs).collect()), key=str)
    assert kept == sorted([(3, "b"), (5, "a"), (7, "c"), (7, "d"), (2, "y"), (None, "z ")], key=str)


def test_many_equal_rows_and_clashing_names(spark):
    docs = spark.range(20_000).selectExpr("id % 3 AS doc_id", "'same' AS text", "id AS _at_row", "'x' AS _in_file", "id AS _row", "id AS _metadata", "id AS `a.b`", "id AS rank", "1 AS n")
    groups = exact_dedup.exact_groups(docs)
    assert groups.where("kept").select("doc_id", "keep_id", "group_size").collect() == [(0, 0, 20_000)]
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns and kept.count() == 1


def test_a_megabyte_of_short_numbers(spark):
    """Very many matches in one text: in seconds, and each at its place."""
    text = "12a" * 350_000 + " mail x@y.de"
    started = time.monotonic()
    found = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert time.monotonic() - started < 60
    assert [(s.start, s.end) for s in found.email] == [(len(text) - 6, len(text))] and not found.card
    cards = " 4111111111111111," * 3000
    found = pii.find(spark.createDataFrame([(1, cards)], "doc_id long, text string")).first()
    assert [(s.start, s.end) for s in found.card] == [(18 * k + 1, 18 * k + 17) for k in range(3000)]
