import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from ledgermill.llm import conversations
from tests.llm.helpers import run

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\x0c\r"


def plain_best(items):
    """(role, text, fault) in order: cost, audit and turns of the best way, every way kept by its exact roles."""
    ways = {"": (0, "", ())}  # by what has been read, as a short text that may go on alike
    for role, text, fault in [*items, (None, None, "end")]:
        opened = dict(ways)
        for _ in range(2):
            for read, (cost, audit, turns) in list(opened.items()):
                for new in ("user", "assistant"):
                    offer(opened, read + new[0], (cost + 5, audit + "I", (*turns, f"{new}:")))
        if fault == "end":
            return min(w for read, w in opened.items() if LEGAL.match(read))
        ways = {}
        for read, (cost, audit, turns) in opened.items():
            offer(ways, read, (cost + 2, audit + "D", turns))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                offer(ways, read + (role[:1] or "?"), (cost + more, audit + "K", (*turns, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    offer(ways, read + new[0], (cost + more + 1, audit + "R", (*turns, f"{new}:{text}")))


def offer(ways, read, way):
    if any(LEGAL.match(read + more) for more in ("", "a", "ua")):
        short = read if read in ("", "s") else "ua" if read[-1] == "a" else "u"
        if short not in ways or way < ways[short]:
            ways[short] = way


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(place.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, turns in convs.items():
        out.append((conv, *repaired(turns)))
    return sorted(out, key=repr)


def repaired(turns):
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
    seen, items = set(), []
    for _, role, text in turns:
        bare = text.strip(BLANK)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        items.append((role, text, fault))
    known = {t[0] for t in turns if t[0] is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    pairs = zip(items, items[1:], strict=False)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
    cost, audit, left = plain_best(items)
    faults = [sum(i[2] == f for i in items) for f in ("blank", "duplicate", "truncated")]
    return gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()


def folder(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.selectExpr("*", "conv_id AS conv", "turn AS place", "role AS digest", "text AS last", "turn AS part").write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    return sorted(((r.conv_id, *(r[c] for c in COLUMNS)) for r in df.collect()), key=repr)


def test_awkward_and_random_conversations(spark, tmp_path):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "User", "", "robot", None]
    texts = ["Yes.", "No!", "maybe", "", " \n\t", None, "ß 😀?", "a.\nb", "x" * 100_000 + "."]
    rows = [(conv, None if rng.random() < 0.1 else rng.randint(0, 9), rng.choice(roles), rng.choice(texts)) for conv in [None, *range(150)] for _ in range(rng.randint(1, 9))]
    rows += rows[:5] + [(7000, None, None, None), (7001, 5, "user", "Hi."), (7002, -3, "user", "Hi."), (7002, 4, "assistant", "Yo.")]
    assert got(run(spark, "op11_conversation_repair", folder(spark, tmp_path, rows))) == brute(rows)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(run(spark, "op11_conversation_repair", "/root/testdata/sf0.001")) == brute(rows)


def test_conversation_over_many_stretches(spark):
    rng = random.Random(5)
    turns = [(i // 2, rng.choice(["user", "assistant", "system"]), f"{rng.randint(0, 300)}{rng.choice(['.', '', '?'])}") for i in range(1500)]
    rows = [(1, *t) for t in turns] + [(2, *t) for t in turns[:70]] + [(None, *t) for t in turns[:40]]
    found = conversations.repair(spark.createDataFrame(rows, SCHEMA), segment=16)
    hashes = {r.conv_id: r.sha256 for r in conversations.digests(found.turns).collect()}
    for r in found.summary.collect():
        want = repaired([t[1:] for t in rows if t[0] == r.conv_id])
        assert (*(r[c] for c in COLUMNS[:-1]), hashes[r.conv_id]) == want


def test_empty_table(spark, tmp_path):
    assert run(spark, "op11_conversation_repair", folder(spark, tmp_path, [])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_plain_search(seed):
    rng = random.Random(seed)
    role = {"s": "system", "u": "user", "a": "assistant", "o": "robot"}
    for _ in range(300):
        codes = "".join(rng.choice("suaoSUAOxuaua") for _ in range(rng.randint(0, 14)))
        items = [(role.get(c.lower(), "user"), "t", "blank" if c == "x" else "truncated" if c.isupper() else "") for c in codes]
        assert conversations.solve(codes) == plain_best(items)[:2]
