import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import decontamination, passages
from tests.llm.helpers import AWKWARD, SCHEMA, folder, run


def distance(a, b):
    """Least edit distance of a to any substring of b."""
    row = list(range(len(a) + 1))
    best = row[-1]
    for c in b:
        old, row[0] = row[0], 0
        for i, d in enumerate(a, 1):
            old, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, old + (c != d))
        best = min(best, row[-1])
    return best


def test_nearest_equals_the_full_table():
    rng = np.random.default_rng(5)
    for _ in range(300):
        text = "".join(rng.choice(list("abc "), int(rng.integers(0, 40))))
        pattern = "".join(rng.choice(list("abc "), int(rng.integers(1, 12))))
        found = decontamination.nearest(pattern, text, 100)
        assert found[0] == distance(pattern, text)
        piece = text[found[1] : found[2]]
        assert distance(pattern, piece) == found[0]


def made_words(rng, n):
    return ["".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 8)))) for _ in range(n)]


def edited(rng, words, share):
    out = []
    for w in words:
        r = rng.random()
        if r < share / 3:
            continue
        out.append("zz" + w[2:] if r < 2 * share / 3 else w)
        if r > 1 - share / 3:
            out.append("new")
    return out


def test_recall_of_edited_items(spark, tmp_path):
    rng = np.random.default_rng(11)
    items = [(i, " ".join(made_words(rng, int(rng.integers(12, 60))))) for i in range(60)]
    rows, planted = [], set()
    for i in range(400):
        words = made_words(rng, 150)
        if i % 2:
            item, text = items[i % 60]
            words[70:70] = edited(rng, text.split(" "), 0.1 if i % 4 == 1 else 0)
            planted.add((i, item))
        rows.append((i, " ".join(words).upper() if i % 3 == 0 else ", ".join(words), "en", "s", 0))
    where = folder(spark, tmp_path, rows + [(9000 + r[0], *r[1:]) for r in AWKWARD], benchmark=(items + [(99, None), (98, "")], "item_id long, text string"))
    got = run(spark, "op6_decontamination", where).collect()
    texts, wanted = {r[0]: decontamination.plain(r[1]) for r in rows}, dict(items)
    for r in got:
        pattern = decontamination.plain(wanted[r.item_id])
        assert r.distance == distance(pattern, texts[r.doc_id]) <= 0.2 * len(pattern)
    close = {(d, i) for d, i in planted if distance(decontamination.plain(wanted[i]), texts[d]) <= 0.2 * len(wanted[i])}
    found = {(r.doc_id, r.item_id) for r in got}
    assert found <= planted and len(found & close) / len(close) >= 0.98
    docs, bench = spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/benchmark.parquet")
    kept = {r.doc_id for r in decontamination.without_contaminated(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in found}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    once = sorted(map(tuple, decontamination.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK", 15)
    assert sorted(map(tuple, decontamination.contaminated(docs, items).collect())) == once
    exact = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if decontamination.plain(i.text) in decontamination.plain(d.text)}
    assert exact <= {r[:2] for r in once} and exact


def test_empty_tables(spark, tmp_path):
    empty = ([], "item_id long, text string")
    assert run(spark, "op6_decontamination", folder(spark, tmp_path / "a", [])).count() == 0
    assert run(spark, "op6_decontamination", folder(spark, tmp_path / "b", benchmark=empty)).count() == 0
    assert run(spark, "op7_passages", folder(spark, tmp_path / "c", [])).count() == 0


def brute_chain(rows):
    """Best chain score by comparing all pairs of segments."""
    score = []
    for i, (a, b, size) in enumerate(rows):
        best = 0.0
        for j, (x, y, s) in enumerate(rows):
            if x + s <= a and y + s <= b:
                best = max(best, score[j] - passages.GAP * (a - x - s + b - y - s))
        score.append(size + best)
    return max(score)


def chain_score(rows, chain):
    total = 0.0
    for k, i in enumerate(chain):
        a, b, size = rows[i]
        total += size
        if k:
            x, y, s = rows[chain[k - 1]]
            assert x + s <= a and y + s <= b
            total -= passages.GAP * (a - x - s + b - y - s)
    return total


@pytest.mark.parametrize("seed", range(5))
def test_best_chain_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    rows = np.column_stack([rng.integers(0, 200, 80), rng.integers(0, 200, 80), rng.integers(5, 20, 80)])
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    found = passages.chains(rows, 0)
    assert chain_score(rows, found[0]) == pytest.approx(brute_chain(rows.tolist()))
    assert sorted(i for c in found for i in c) == sorted({i for c in found for i in c})


def test_two_seeds_apart_make_no_chain():
    rng = np.random.default_rng(3)
    told = set()
    for _ in range(3000):
        a, b = rng.integers(0, 60, 2), rng.integers(0, 60, 2)
        if rng.random() < 0.3:
            b = a + int(rng.integers(0, 9))
        if (a[0], b[0]) == (a[1], b[1]):
            continue
        apart = passages.apart(b, a)
        assert apart == (not passages.chains(passages.segments(a, b), passages.SEED + 1))
        told.add(apart)
    assert told == {True, False}


def test_names_of_stretches_are_equal_where_the_words_are():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, 400).astype(np.uint32)
    names = passages.stretch_names(words, np.arange(400), 6)
    kept = {}
    for i in range(395):
        assert kept.setdefault(names[i], words[i : i + 6].tolist()) == words[i : i + 6].tolist()
    assert len(kept) == len({tuple(words[i : i + 6]) for i in range(395)}) and not names[395:].any()


def test_words_of_many_texts_equal_those_of_each():
    texts = ["", "One two,  THREE", "ΟΔΟΣ", "\n", "ÀÉ x\n\ny İ", "last word", ""]
    words, begins = passages.words_of(pa.array(texts))
    assert [words[a:b].tolist() for a, b in zip(begins, begins[1:])] == [passages.word_numbers(t).tolist() for t in texts]
    assert passages.words_of(pa.array([], pa.string()))[1].tolist() == [0]


def full_table(x, y):
    row = [0] * (len(y) + 1)
    for word in x:
        old = row
        row = [0]
        for j, other in enumerate(y):
            row.append(max(row[-1], old[j + 1], old[j] + (word == other)))
    return row[-1]


def test_common_words_equal_the_full_table():
    rng = np.random.default_rng(6)
    for _ in range(300):
        x, y = (rng.integers(0, 6, rng.integers(0, 90)).tolist() for _ in range(2))
        assert passages.common(x, y) == full_table(x, y)


def agreement(pairs):
    """Length and equal words of the best prefix; the first of those with most gain."""
    gains = [(sum(1 if equal else -2 for equal in pairs[:n]), -n) for n in range(1, len(pairs) + 1)]
    gain, n = max(gains, default=(0, 0))
    return (-n, sum(pairs[:-n])) if gain > 0 else (0, 0)


def test_alignment_of_many_chains_equals_one_at_a_time():
    rng = np.random.default_rng(8)
    x, y, bounds, rows, counts, wanted = [], [], [], [], [], []
    for _ in range(200):
        one = rng.integers(0, 3, rng.integers(4, 60)).tolist()
        two = [w if rng.random() < 0.8 else 9 for w in one][rng.integers(0, 3) :] + rng.integers(0, 3, 5).tolist()
        chain, a, b = [], int(rng.integers(0, 4)), int(rng.integers(0, 4))
        while a + 4 <= len(one) and b + 4 <= len(two) and len(chain) < 4:
            size = int(rng.integers(1, 5))
            chain.append((a, b, size))
            a, b = a + size + int(rng.integers(0, 6)), b + size + int(rng.integers(0, 6))
        if not chain:
            continue
        same = sum(one[p + k] == two[q + k] for p, q, size in chain for k in range(size))
        same += sum(full_table(one[p + s : v], two[q + s : w]) for (p, q, s), (v, w, _) in zip(chain, chain[1:]))
        (p, q, _), (v, w, size) = chain[0], chain[-1]
        back, more = agreement([one[p - k] == two[q - k] for k in range(1, min(p, q) + 1)])
        ahead, equal = agreement([c == d for c, d in zip(one[v + size :], two[w + size :])])
        place = [p - back, v + size + ahead, q - back, w + size + ahead]
        wanted.append((*place, (same + more + equal) / max(place[1] - place[0], place[3] - place[2])))
        bounds.append((len(x), len(x) + len(one), len(y), len(y) + len(two)))
        x, y, rows, counts = x + one, y + two, rows + chain, [*counts, len(chain)]
    found, alike = passages.align(*map(np.array, (x, y, bounds, rows, counts)))
    assert [(*f, s) for f, s in zip(found.tolist(), alike.tolist())] == wanted and len(wanted) > 100


@pytest.mark.parametrize(("id_type", "chunk"), [("bigint", 50), ("string", 200_000)])
def test_chains_of_packed_links_equal_those_of_each_pair(spark, monkeypatch, id_type, chunk):
    monkeypatch.setattr(passages, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    phrases = [made_words(rng, 12) for _ in range(12)]
    rows = []
    for i in range(60):
        words = sum((phrases[k] + made_words(rng, int(rng.integers(0, 20))) for k in rng.integers(0, 12, 5)), [])
        rows.append((None if i == 7 else str(i) if id_type == "string" else i, " ".join(words)))
    docs = spark.createDataFrame(rows + rows[:3], f"doc_id {id_type}, text string").repartition(3)
    held = passages._linked(passages._seed_rows(docs, id_type, 40), id_type).collect()
    packed = passages._links_and_seeds(passages._seed_rows(docs, id_type, 40), id_type).localCheckpoint()
    seen = packed.where("often IS NOT NULL").select("doc_id", "at", "name", "extra", "often").collect()
    assert sorted(map(repr, map(tuple, seen))) == sorted(repr((r.doc_id, r.at, r.name, r.extra, r.often)) for r in held if r.number == 0)
    links = {}
    for r in held:
        if (r.doc_id, r.at) != (r.partner_id, r.partner_at):
            links.setdefault((r.partner_id, r.doc_id), set()).add((r.partner_at, r.at))
    wanted = []
    for (one, two), places in links.items():
        if len(places) > 1:
            found = passages.segments(*np.array(sorted(places)).T)
            for chain in passages.chains(found, 10 if one == two else 5):
                wanted.append((one, two, [tuple(found[i].tolist()) for i in chain]))
    got = passages._chain_rows(packed.where("often IS NULL").select("links.*"), id_type, 5).collect()
    got = [(r.partner_id, r.doc_id, [tuple(s) for s in r.chain]) for r in got]
    # the chains left out are alone in their cell with another short one
    short = lambda c: max(c[-1][0] - c[0][0], c[-1][1] - c[0][1]) + c[-1][2] < 10
    assert sorted(repr(g) for g in got if not short(g[2])) == sorted(repr(w) for w in wanted if not short(w[2]))
    cells = lambda all_: {(p, d, c[0][0] // passages.CELL, c[0][1] // passages.CELL) for p, d, c in all_ if short(c)}
    assert cells(got) == cells(wanted) and len(cells(got)) == sum(short(c) for *_, c in got) and any(len(c) > 1 for *_, c in got)


def test_planted_fuzzy_passages(spark, tmp_path):
    rng = np.random.default_rng(2)
    passage = made_words(rng, 80)
    rows, planted = [], set()
    for i in range(200):
        words = made_words(rng, 120)
        if i % 5 == 0:
            words[60:60] = edited(rng, passage, 0.06 if i % 2 else 0)
            planted.add(i)
        rows.append((i, " ".join(words), "en", "s", 0))
    inner = made_words(rng, 70)
    rows.append((500, " ".join(inner + made_words(rng, 30) + inner), "en", "s", 0))
    rows += [(9000 + r[0], *r[1:]) for r in AWKWARD[:7]] + [rows[1]] * 2
    got = run(spark, "op7_passages", folder(spark, tmp_path, rows)).collect()
    found = {r.doc_id for r in got} | {r.partner_id for r in got}
    assert found & set(range(200)) <= planted and len(found & planted) >= 0.95 * len(planted)
    same = [r for r in got if r.doc_id == 500]
    assert [(r.partner_first, r.partner_end, r.first_word, r.end_word) for r in same] == [(0, 70, 100, 170)]
    for r in got:
        if r.doc_id < 200:
            assert 55 <= r.first_word and r.end_word <= 150 and 50 <= r.end_word - r.first_word and 0.8 <= r.alike <= 1


def test_very_long_documents(spark, tmp_path):
    got = run(spark, "op7_passages", folder(spark, tmp_path, AWKWARD)).collect()
    assert all(r.alike >= 0.8 for r in got)


@pytest.mark.parametrize("cuts", [[(0, 35), (35, 70)], [(0, 35), (18, 52), (36, 70)], [(i, i + 20) for i in range(0, 60, 10)]])
def test_passages_spread_over_earlier_documents(spark, tmp_path, cuts):
    rng = np.random.default_rng(7)
    rows, wanted = [], set()
    for n in range(10):
        passage = made_words(rng, 70)
        for cut in [*(passage[a:b] for a, b in cuts), passage, passage, passage]:
            rows.append((len(rows), " ".join(made_words(rng, 40) + cut + made_words(rng, 40)), "en", "s", 0))
        wanted |= {len(rows) - 1, len(rows) - 2}
    got = run(spark, "op7_passages", folder(spark, tmp_path, rows)).collect()
    whole = {r.doc_id for r in got if r.end_word - r.first_word >= 66}
    assert wanted <= whole
    assert all(r.alike >= 0.8 and r.first_word >= 38 and r.end_word <= 112 for r in got)


@pytest.mark.parametrize(("every", "size"), [(5, 50), (6, 50), (7, 50), (8, 50), (10, 50), (6, 60)])
def test_recall_of_edited_passages(spark, tmp_path, every, size):
    rng = np.random.default_rng(every)
    rows = []
    for n in range(200):
        passage = made_words(rng, size)
        changed = [f"q{n}x{i}" if i % every == every - 1 else w for i, w in enumerate(passage)]
        for words in (passage, changed):
            rows.append((len(rows), " ".join(made_words(rng, 40) + words + made_words(rng, 40)), "en", "s", 0))
    got = run(spark, "op7_passages", folder(spark, tmp_path, rows)).collect()
    found = {(r.partner_id, r.doc_id) for r in got}
    assert found <= {(2 * n, 2 * n + 1) for n in range(200)}
    assert len(found) >= (0.9 if every == 5 else 0.97) * 200


@pytest.mark.parametrize("holders", [1, 12])
def test_edited_passages_whose_parts_all_occur_first_elsewhere(spark, tmp_path, holders):
    """Every seed of the passage is held by ``holders`` earlier documents or more, none of which has the passage."""
    rng = np.random.default_rng(holders)
    rows, pairs = [], set()
    for n in range(20):
        passage = made_words(rng, 64)
        changed = [f"q{n}x{i}" if i % 8 == 7 else w for i, w in enumerate(passage)]
        parts = [passage[i : i + 20] for i in range(0, 64, 10)] * holders
        for words in (*parts, passage, changed):
            rows.append((len(rows), " ".join(made_words(rng, 40) + words + made_words(rng, 40)), "en", "s", 0))
        pairs.add((len(rows) - 2, len(rows) - 1))
    got = run(spark, "op7_passages", folder(spark, tmp_path, rows)).collect()
    found = {(r.partner_id, r.doc_id) for r in got}
    assert found <= pairs and len(found) >= 19


@pytest.mark.parametrize(("group", "links"), [(16 << 20, 2_000_000), (2000, 300)])
def test_passages_whose_seeds_all_stand_together_elsewhere(spark, tmp_path, monkeypatch, group, links):
    """Any two seeds of the passage that are near each other are held by 12 earlier documents, none of which has the passage."""
    monkeypatch.setattr(passages, "GROUP", group)
    monkeypatch.setattr(passages, "TILE_LINKS", links)
    rng = np.random.default_rng(5)
    rows, pairs = [], set()
    for n in range(4):
        passage = made_words(rng, 64)
        changed = [f"q{n}x{i}" if i % 8 == 7 else w for i, w in enumerate(passage)]
        parts = [passage[i : i + 36] for i in range(0, 32, 4)] * 12
        for words in (*parts, passage, changed):
            rows.append((len(rows), " ".join(made_words(rng, 40) + words + made_words(rng, 40)), "en", "s", 0))
        pairs.add((len(rows) - 2, len(rows) - 1))
    got = run(spark, "op7_passages", folder(spark, tmp_path, rows)).collect()
    found = {(r.partner_id, r.doc_id) for r in got if r.end_word - r.first_word >= 56}
    assert found == pairs and all(r.alike >= 0.8 for r in got)


@pytest.mark.parametrize("two", [False, True])
def test_long_documents_of_a_tile_are_compared_in_parts(two):
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 32, (2, 3000), dtype=np.uint64).astype(np.uint32)
    words[1, 500:900] = words[0, 1000:1400]
    at = [passages.seeds(w)[0].astype(np.int32) for w in words]
    columns = [pa.array([1, 2]), [w.tobytes() for w in words], [a.tobytes() for a in at], [np.full(len(a), 2, np.int8).tobytes() for a in at]]
    columns = [*(pa.array(c) for c in columns), pa.array([two, two]), pa.array([0, 1 if two else 0])]
    batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "words", "at", "mark", "two", "side"])
    whole, parts = ([(p, o, *f) for ps, os, fs, _ in passages._tile_passages(batch, most, 40, 0.8) for p, o, f in zip(ps.tolist(), os.tolist(), fs.tolist(), strict=True)] for most in (10**6, 10))
    assert whole == [(0, 1, 1000, 1400, 500, 900)] and len(parts) > 1
    assert all(p[:2] == (0, 1) and p[2] - p[4] == p[3] - p[5] == 500 for p in parts)
    assert set().union(*(range(p[2], p[3]) for p in parts)) == set(range(1000, 1400))


def test_rows_of_a_line_meet_place_by_place():
    at = np.array([3, 8, 13, 18, 23, 70, 0, 1, 2, 3, 9, 5, 9, 30, 31, 32])
    doc = np.array([0] * 6 + [1] * 5 + [2] * 5)
    name = np.array([7] * 10 + [8, 7, 7, 7, 7, 7], dtype=np.uint64)
    order = np.random.default_rng(1).permutation(len(at))
    rank = np.empty(len(at), int)
    rank[order] = passages.in_rows(doc[order], name[order], at[order], 40)
    assert rank.tolist() == [0, 1, 2, 3, 4, -1, 0, 1, 2, 3, -1, -1, -1, -1, -1, -1]
    assert passages.in_rows(doc[:0], name[:0], at[:0], 40).tolist() == []


@pytest.mark.parametrize(("near", "held"), [(8, 4_000_000), (8, 40), (2, 10)])
def test_links_equal_those_of_all_holders(spark, monkeypatch, near, held):
    rng = np.random.default_rng(near + held)
    texts = [(None if i == 7 else i, " ".join(rng.choice(list("abcd"), int(rng.integers(0, 30))))) for i in range(120)]
    monkeypatch.setattr(passages, "HELD", held)
    monkeypatch.setattr(passages, "NEAR", near)
    monkeypatch.setattr(passages, "CHUNK", 50)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = passages._linked(passages._seed_rows(docs, "bigint", 40), "bigint").collect()
    holders = {}
    for doc_id, text in texts:
        for at, name in zip(*passages.seeds(passages.word_numbers(text)), strict=True):
            holders.setdefault(int(name.view(np.int64)), []).append((-1 if doc_id is None else doc_id, int(at)))
    place = lambda doc_id, at: (-1 if doc_id is None else doc_id, at)
    links = {}
    for r in got:
        links.setdefault(r.name, []).append((place(r.doc_id, r.at), place(r.partner_id, r.partner_at), r.number, r.often))
    repeated = {name: sorted(h) for name, h in holders.items() if len(h) > 1}
    assert links.keys() == repeated.keys() and any(len(h) <= near for h in repeated.values()) and any(len(h) > near for h in repeated.values())
    for name, held_by in repeated.items():
        assert sorted(own for own, _, number, _ in links[name] if not number) == held_by
        pairs = {(other, own) for own, other, _, _ in links[name] if own != other}
        assert all(a < b for a, b in pairs) and {often for *_, often in links[name]} == {len(held_by) > near}
        if len(held_by) <= near:
            assert pairs == {(a, b) for i, a in enumerate(held_by) for b in held_by[i + 1 :]}
        else:
            centre = set.intersection(*map(set, pairs))
            assert len(pairs) == len(held_by) - 1 and centre and (held < 100 or centre == {held_by[0]})


@pytest.mark.parametrize("size", [8, 20, 50, 64, 100])
@pytest.mark.parametrize("every", [5, 7, 10])
def test_recall_by_distance_between_typos(size, every):
    rng = np.random.default_rng(100 * size + every)
    items = [(i, " ".join(made_words(rng, size))) for i in range(40)]
    texts = []
    for _, text in items:
        words = [("q" + w[1:]) if i % every == every - 1 else w for i, w in enumerate(text.split())]
        texts.append(" ".join(made_words(rng, 40) + words + made_words(rng, 40)))
    hits = decontamination._hits(decontamination.Index(items, 0.2), list(range(40)), texts)
    assert len({h[:2] for h in hits} & {(i, i) for i in range(40)}) >= 36
