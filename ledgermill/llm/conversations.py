"""Conversation structure repair: the cheapest edits that make the turns of a conversation alternate.

Each row of a conversation, in the order of its turns, is kept (cost 0), given another role (1) or deleted (2); turns without text
may be put in anywhere (5 each). Blank rows and repeats of an earlier role and text have to go; a truncated row that stays costs 5
more. The first letters of the roles that result must read ``(s?(ua)+)?``. Of equally cheap ways the one whose letters of edits
(K, R, D, I) come first in ASCII order is taken.

A conversation is solved by depth-first branch-and-bound. An explicit stack holds nodes (rows done, state of the pattern, cost,
edits so far). A node is given up when its cost and a lower bound for the rows that are left do not beat the best whole way found, when
the table of its rows and state has a way that is as good, or when another state of the same rows is so much cheaper that it could catch up
by putting turns in. When the stack is empty the cost is proved the least; a second run in the order of the edits' letters then finds the
first way of that cost. Each node is entered with a few costs at most, so the work is linear in the rows. The bound adds up, per row, the
least that its fault or role costs, or, per pair of neighbours that cannot both stay as they are, one.

How it scales: rows are numbered over a global order by conversation and turn, so a long conversation spans many tasks. Stretches of
``SEGMENT`` numbers are solved apart, for every state they may begin and end with where a conversation goes on beyond them, and
the stretches of one conversation are then joined in order; that pass reads one row for each stretch and keeps the edits of at most four ways.
Repeats are found by a grouped minimum. Texts are read for faults and at the end, never gathered; only :func:`digests` streams the turns of
one conversation through one task, since a hash over a whole conversation has to.

Defined results: a null role or text is one space; a null identifier is a conversation of its own. Null turns come first; rows of one
turn are ordered by role, then by the SHA-256 of the text, and equal rows are interchangeable. A role counts by its first letter as it
stands, so a kept ``User`` or an empty role fits nowhere and needs another role. An empty table gives empty results. Long texts are
read whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import BLANKS
from ledgermill.operators.ordered import dense_index
from ledgermill.session import stored

SEGMENT = 64
#: Costs of the edits, and of a truncated row that stays.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5

_BEGIN, _SYSTEM, _USER, _ANSWER = range(4)  # what the pattern has read last
_ENDS = (_BEGIN, _ANSWER)
#: State after a kept row, by state and first letter; the role that may come next, and the state after it.
_KEEP = {(_BEGIN, "s"): _SYSTEM, (_BEGIN, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ANSWER, (_ANSWER, "u"): _USER}
_NEXT = {_BEGIN: ("user", _USER), _SYSTEM: ("user", _USER), _USER: ("assistant", _ANSWER), _ANSWER: ("user", _USER)}
#: From which states a state can be reached. Once something is read, any way can be caught up with for two turns put in.
_REACH = {_BEGIN: (_BEGIN,), _SYSTEM: (_BEGIN, _SYSTEM), _USER: (0, 1, 2, 3), _ANSWER: (0, 1, 2, 3)}
_CATCH_UP = 2 * COST["I"]
#: A row as one letter: its role's first letter (``o``: any other), as a capital if it is truncated, ``x`` if it has to go.
MUST_GO = "x"


def _least(letter: str) -> int:
    """What a row costs at least wherever it stands; a system row may be free once, see :func:`_bounds`."""
    if letter == MUST_GO or letter.isupper():
        return COST["D"]
    return COST["R"] if letter in "os" else 0


def _bounds(codes: str) -> tuple[list[int], list[int]]:
    """Lower bounds for the rows from each on: once something was read, and before (one system row may then stay)."""
    n = len(codes)
    after = [0] * (n + 2)
    system = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        after[i] = _least(codes[i]) + after[i + 1]
        if i + 1 < n and codes[i] == codes[i + 1] and codes[i] in "ua":
            after[i] = max(after[i], 1 + after[i + 2])
        system[i] = int(codes[i] == "s") or system[i + 1]
    return after, [after[i] - system[i] for i in range(n + 1)]


def _search(codes: str, entry: int, exits: tuple[int, ...], proved: int | None) -> tuple[int, str] | None:
    """One run of the search. Without ``proved`` the most promising node goes first and the cost of the result is the least there is.

    With ``proved``, that least cost, nodes go in ASCII order of their edits, so the first whole way of that cost is the result.
    """
    n = len(codes)
    after, before = _bounds(codes)
    reach = _REACH[max(exits)]
    best: tuple[int, str] | None = None
    limit = proved
    seen: dict[tuple[int, int], int] = {}
    floor = [1 << 60] * (n + 1)
    stack = [(0, entry, 0, "")]
    while stack:
        at, state, cost, edits = stack.pop()
        if seen.get((at, state), 1 << 60) <= cost or cost > floor[at] + _CATCH_UP:
            continue
        if limit is not None and cost + (before if state == _BEGIN else after)[at] > limit:
            continue
        seen[at, state] = cost
        if len(reach) == 4:
            floor[at] = min(floor[at], cost)
        if at == n and state in exits:
            best = (cost, edits)
            if proved is not None:
                break
            limit = cost - 1
        nodes = [(at, _NEXT[state][1], cost + COST["I"], edits + "I")]
        if at < n:
            letter = codes[at]
            nodes.append((at + 1, state, cost + COST["D"], edits + "D"))
            if letter != MUST_GO:
                stays = cost + (TRUNCATED if letter.isupper() else 0)
                nodes.append((at + 1, _NEXT[state][1], stays + COST["R"], edits + "R"))
                kept = _KEEP.get((state, letter.lower()))
                if kept is not None:
                    nodes.append((at + 1, kept, stays + COST["K"], edits + "K"))
        nodes = [x for x in nodes if x[1] in reach]
        # what goes first is put on the stack last
        if proved is None:
            nodes.sort(key=lambda x: x[2] + (before if x[1] == _BEGIN else after)[x[0]], reverse=True)
        else:
            nodes.sort(key=lambda x: x[3], reverse=True)
        stack += nodes
    return best


def solve(codes: str, entry: int = _BEGIN, exits: tuple[int, ...] = _ENDS) -> tuple[int, str] | None:
    """Cost and edits of the best way from ``entry`` through all rows to one of ``exits``; None if there is none."""
    if entry not in _REACH[max(exits)]:
        return None
    proved = _search(codes, entry, exits, None)
    return proved and _search(codes, entry, exits, proved[0])


def replay(codes: str, entry: int, edits: str) -> list[tuple[int, str | None]]:
    """The turns that edits leave: number of the row they stand at, and a new role or None; a negative number marks a turn put in."""
    out: list[tuple[int, str | None]] = []
    at, state = 0, entry
    for edit in edits:
        if edit == "K":
            out.append((at, None))
            state = _KEEP[state, codes[at].lower()]
        elif edit in "RI":
            role, state = _NEXT[state]
            out.append((at if edit == "R" else -1 - min(at, len(codes) - 1), role))
        at += edit != "I"
    return out


def illegal_pairs(codes: str) -> int:
    return sum(pair not in ("su", "ua", "au") for pair in zip(codes, codes[1:], strict=False) for pair in ["".join(pair)])


@dataclass(frozen=True)
class Repair:
    """``summary``: one row per conversation; ``turns``: what is left of each, in the order of ``place`` and ``part``."""

    summary: DataFrame
    turns: DataFrame


_SOLVED = "conv string, segment long, lo long, codes string, whole boolean, ways array<struct<entry:int,exit:int,cost:bigint,edits:string>>"
_PIECES = "conv string, segment long, lo long, codes string, entry int, edits string, cost long"


def _solve_segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        ways = []
        for row in frame.itertuples():
            entries = [_BEGIN] if row.first else range(4)
            exits = [_ENDS] if row.whole else [(s,) for s in range(4)]
            found = [(e, x[-1], solve(row.codes, e, x)) for e in entries for x in exits]
            ways.append([{"entry": e, "exit": x, "cost": w[0], "edits": w[1]} for e, x, w in found if w])
        yield frame[["conv", "segment", "lo", "codes", "whole"]].assign(ways=ways)


class _Chain:
    """The stretches of one conversation so far: for each state the best way to it, and how each stretch was entered.

    Ways that another one can catch up with are dropped; what all ways share at their beginning is not compared again.
    """

    def __init__(self) -> None:
        self.ways: dict[int, tuple[int, str]] = {_BEGIN: (0, "")}
        self.steps: list[tuple[tuple, dict[int, tuple[int, str, int]]]] = []

    def add(self, head: tuple, ways: list) -> None:
        now: dict[int, tuple[int, str]] = {}
        step: dict[int, tuple[int, str, int]] = {}
        for way in ways:
            if way["entry"] not in self.ways:
                continue
            cost, edits = self.ways[way["entry"]]
            both = (cost + way["cost"], edits + way["edits"])
            if way["exit"] not in now or both < now[way["exit"]]:
                now[way["exit"]], step[way["exit"]] = both, (way["entry"], way["edits"], way["cost"])
        least = min(cost for cost, _ in now.values())
        now = {state: way for state, way in now.items() if way[0] <= least + _CATCH_UP}
        shared = len(os.path.commonprefix([edits for _, edits in now.values()]))
        self.ways = {state: (cost - least, edits[shared:]) for state, (cost, edits) in now.items()}
        self.steps.append((head, step))

    def pieces(self) -> list[tuple]:
        state = min((self.ways[s], s) for s in _ENDS if s in self.ways)[1]
        out = []
        for head, step in reversed(self.steps):
            state, edits, cost = step[state]
            out.append((*head, state, edits, cost))
        return out


def _join_segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by conversation and stretch; a conversation is passed on when the next one begins."""
    names = [c.split()[0] for c in _PIECES.split(", ")]
    conv, chain = None, _Chain()
    for frame in frames:
        done = []
        for row in frame.itertuples():
            if row.conv != conv:
                done += chain.pieces() if chain.steps else []
                conv, chain = row.conv, _Chain()
            chain.add((row.conv, row.segment, row.lo, row.codes), row.ways)
        yield pd.DataFrame(done, columns=names)
    yield pd.DataFrame(chain.pieces() if chain.steps else [], columns=names)


def _replay_segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [
            (p.conv, p.lo + (at if at >= 0 else -1 - at), part, role, at >= 0)
            for p in frame.itertuples()
            for part, (at, role) in enumerate(replay(p.codes, p.entry, p.edits))
        ]
        yield pd.DataFrame(rows, columns=["conv", "place", "part", "new_role", "own"])


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", segment: int = SEGMENT
) -> Repair:
    """Summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. Turns: conv_id, place, part, role, text."""
    space = F.lit(" ")
    slim = rows.select(
        rows[conv_col].alias("conv_id"), rows[turn_col].cast("long").alias("turn"), F.coalesce(rows[role_col].cast("string"), space).alias("role"),
        F.coalesce(rows[text_col].cast("string"), space).alias("text"),
    )
    slim = slim.withColumns(
        {
            "conv": F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")),
            "digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256)),
            "last": F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1)),
            "tie": F.monotonically_increasing_id(),
        }
    )
    placed = dense_index(slim, ["conv_id", "turn", "role", "digest", "tie"], "place").drop("digest", "tie").withColumn(
        "digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    )
    placed = stored(placed, "conversation-rows")

    names = placed.select("conv", "role", "digest", "place")
    repeats = names.groupBy("conv", "role", "digest").agg(F.min("place").alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    judged = placed.drop("text").join(repeats, ["conv", "role", "digest"], "left")
    blank = F.col("last") == ""
    duplicate = ~blank & F.coalesce(F.col("place") > F.col("earliest"), F.lit(False))
    truncated = ~blank & ~duplicate & ~F.col("last").isin(".", "!", "?")
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    judged = judged.select(
        "conv", "conv_id", "turn", "place", blank.cast("long").alias("blank"), duplicate.cast("long").alias("duplicate"),
        truncated.cast("long").alias("truncated"), initial.alias("initial"),
        F.when(blank | duplicate, F.lit(MUST_GO)).when(truncated, F.upper(initial)).otherwise(initial).alias("code"),
        F.expr(f"place div {segment}").alias("segment"),
    )
    judged = stored(judged, "conversation-faults")

    faults = ["blank", "duplicate", "truncated"]
    per_turn = judged.groupBy("conv", "turn").agg(
        F.min("conv_id").alias("conv_id"), F.min("place").alias("lo"), F.max("place").alias("hi"), *[F.sum(f).alias(f) for f in faults]
    )
    stats = per_turn.groupBy("conv").agg(
        F.min("conv_id").alias("conv_id"), F.min("lo").alias("conv_lo"), F.max("hi").alias("conv_hi"), *[F.sum(f).alias(f) for f in faults],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
    )
    stats = stored(stats, "conversation-statistics")

    joined = lambda column: F.array_join(F.transform("rows", lambda r: r[column]), "")
    stretches = judged.groupBy("conv", "segment").agg(F.array_sort(F.collect_list(F.struct("place", "code", "initial"))).alias("rows"))
    stretches = stretches.select("conv", "segment", F.col("rows")[0]["place"].alias("lo"), joined("code").alias("codes"), joined("initial").alias("initials"))
    bounds = stats.select("conv", "conv_lo", "conv_hi")
    first = F.col("lo") == F.col("conv_lo")
    stretches = stretches.join(bounds, "conv").select(
        "conv", "segment", "lo", "codes", "initials", first.alias("first"), (first & (F.col("lo") + F.length("codes") > F.col("conv_hi"))).alias("whole")
    )
    stretches = stored(stretches, "conversation-stretches")

    solved = stored(stretches.drop("initials").mapInPandas(_solve_segments, _SOLVED), "conversation-ways")
    way = F.col("ways")[0]
    alone = solved.where("whole").select("conv", "segment", "lo", "codes", way["entry"].alias("entry"), way["edits"].alias("edits"), way["cost"].alias("cost"))
    parts = solved.where("NOT whole").repartition("conv").sortWithinPartitions("conv", "segment")
    pieces = stored(alone.unionByName(parts.mapInPandas(_join_segments, _PIECES)), "conversation-pieces")

    ordered = F.array_sort(F.collect_list(F.struct("segment", "edits")))
    audits = pieces.groupBy("conv").agg(F.sum("cost").alias("cost"), ordered.alias("parts"))
    audits = audits.select("conv", "cost", F.array_join(F.transform("parts", lambda p: p["edits"]), "").alias("audit"))
    illegal = _illegal(stretches)
    summary = stats.join(audits, "conv").join(illegal, "conv")
    summary = summary.select("conv_id", "gaps", *faults, "illegal", "cost", "audit")

    kept = pieces.mapInPandas(_replay_segments, "conv string, place long, part int, new_role string, own boolean")
    # dealt by conversation on both sides, so that the turns need no further shuffle to be read in order
    kept, texts = kept.repartition("conv"), placed.select("conv", "conv_id", "place", "role", "text").repartition("conv")
    turns = kept.join(texts, ["conv", "place"]).select(
        "conv_id", "conv", "place", "part", F.coalesce("new_role", "role").alias("role"), F.when(F.col("own"), F.col("text")).otherwise("").alias("text")
    )
    return Repair(summary, turns)


def _illegal(stretches: DataFrame) -> DataFrame:
    """conv, illegal: neighbours whose first letters do not follow one another, inside stretches and where two meet."""
    pairs = F.filter(
        F.transform(F.sequence(F.lit(1), F.length("initials")), lambda i: F.substring(F.col("initials"), i, F.lit(2))),
        lambda pair: (F.length(pair) == 2) & ~pair.isin("su", "ua", "au"),
    )
    inside = stretches.select("conv", F.size(pairs).cast("long").alias("n"))
    meets = stretches.where("NOT whole").select(
        "conv", F.explode(F.array(F.struct(F.col("segment").alias("at"), F.left("initials", F.lit(1)).alias("letter"), F.lit(1).alias("side")),
                                  F.struct((F.col("segment") + 1).alias("at"), F.right("initials", F.lit(1)).alias("letter"), F.lit(0).alias("side")))).alias("x")
    )
    meets = meets.groupBy("conv", "x.at").agg(
        F.max(F.when(F.col("x.side") == 0, F.col("x.letter"))).alias("left"), F.max(F.when(F.col("x.side") == 1, F.col("x.letter"))).alias("right")
    )
    meets = meets.where("left IS NOT NULL AND right IS NOT NULL").select(
        "conv", (~F.concat("left", "right").isin("su", "ua", "au")).cast("long").alias("n")
    )
    return inside.unionByName(meets).groupBy("conv").agg(F.sum("n").alias("illegal"))


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, sha256 of the ``role:text`` of its turns joined by newlines; rows are read one by one in order."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state = None, hashlib.sha256()
        for frame in frames:
            done = []
            for next_conv, line in zip(frame["conv"], frame["line"], strict=True):
                if next_conv != conv:
                    done += [(conv, state.hexdigest())] if conv is not None else []
                    conv, state = next_conv, hashlib.sha256()
                    line = line[1:]
                state.update(line.encode("utf-8", "surrogatepass"))
            yield pd.DataFrame(done, columns=["conv", "sha256"])
        yield pd.DataFrame([(conv, state.hexdigest())] if conv is not None else [], columns=["conv", "sha256"])

    ordered = turns.repartition("conv").sortWithinPartitions("conv", "place", "part")
    hashed = ordered.select("conv", F.concat(F.lit("\n"), "role", F.lit(":"), "text").alias("line")).mapInPandas(each, "conv string, sha256 string")
    named = F.when(F.col("conv") != "null", F.substring("conv", 2, 1 << 30)).cast(turns.schema["conv_id"].dataType)
    return hashed.select(named.alias("conv_id"), "sha256")
