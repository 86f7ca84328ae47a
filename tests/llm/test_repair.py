"""Conversation repair against a plain table of all cheapest edits."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tillroll.llm import repair
from tillroll.llm.queries import damaged, op11_repair
from tests.conftest import SMALL_SF

LEGAL = {"su", "ua", "au"}
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def brute_edits(turns, state=0, goal=None):
    """Least (cost, edits) by relaxing all paths: turns as (initial, fault)."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserted(best):
        for _ in range(4):
            for g in list(best):
                for new in {k for r, k in step[g].items() if r in "ua"}:
                    now = (best[g][0] + 3, best[g][1] + "I")
                    best[new] = min(best.get(new, now), now)
        return best
    best = {state: (0, "")}
    for initial, fault in turns:
        fresh = {}
        for g, (cost, edits) in inserted(best).items():
            tries = [(g, cost + 4, "D")]
            if fault not in "bd":
                extra = 3 if fault == "t" else 0
                tries += [(to, cost + extra, "K") for r, to in step[g].items() if r == initial]
                tries += [(to, cost + 3 + extra, "R") for r, to in step[g].items() if r in "ua"]
            for to, c, e in tries:
                fresh[to] = min(fresh.get(to, (c, edits + e)), (c, edits + e))
        best = fresh
    if goal is not None:
        return best.get(goal)
    best = inserted(best)
    return min(best[g] for g in (0, 3) if g in best)


TURNS = st.lists(st.tuples(st.sampled_from("uuaasx"), st.sampled_from("----tbd")), max_size=14)


@settings(max_examples=400, deadline=None)
@given(TURNS)
def test_search_finds_the_ascii_least_of_the_cheapest(turns):
    assert repair.Search(turns).cheapest() == brute_edits(turns)


@settings(max_examples=150, deadline=None)
@given(TURNS.filter(bool))
def test_parts_between_all_states(turns):
    for goal in range(4):
        search = repair.Search(turns, goal)
        for state in (3, 1, 0, 2):
            assert search.cheapest(state) == brute_edits(turns, state, goal)


@settings(max_examples=150, deadline=None)
@given(st.lists(TURNS.filter(bool), min_size=1, max_size=5))
def test_segments_join_to_the_whole(parts):
    cells = [repair._cells(p, False) for p in reversed(parts)]
    assert repair.joined_segments(cells) == brute_edits([t for p in parts for t in p])


def test_long_searches_stay_small():
    rng = random.Random(4)
    turns = [("ua"[k % 2] if rng.random() < 0.8 else rng.choice("uas"), rng.choice("bdtt" + "-" * 16)) for k in range(256)]
    search = repair.Search(turns)
    assert search.cheapest() == brute_edits(turns) and search.entered < 40_000


def fault_of(turn, seen):
    role, text = turn
    solid = text.strip(" \t\n\x0b\x0c\r")
    return "b" if not solid else "d" if turn in seen else "-" if solid[-1] in ".!?" else "t"


def brute(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)."""
    by_conv, out = {}, {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, faults = set(), []
        for _, *turn in turns:
            faults.append(fault_of(tuple(turn), seen))
            seen.add(tuple(turn))
        initials = [t[1][:1] for t in turns]
        numbers = {t[0] for t in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = brute_edits(list(zip(initials, faults)))
        texts, state, k = [], "", 0
        for e in audit:
            role = "user" if not state or state[-1] != "u" else "assistant"
            if e == "I":
                texts.append(f"{role}:")
            else:
                k += 1
                if e == "D":
                    continue
                role = turns[k - 1][1] if e == "K" else role
                texts.append(f"{role}:{turns[k - 1][2]}")
            state += role[0]
        assert GRAMMAR.match(state)
        out[conv] = (gaps, *(faults.count(f) for f in "bdt"), sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest() if texts else None)
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def check(spark, rows, extra=()):
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in extra])
    frame = spark.createDataFrame([tuple(r) + ("x",) * len(extra) for r in rows], schema).repartition(3)
    repairs = repair.plan_repairs(frame).cache()
    turns = repair.repaired_turns(frame, repairs)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.digest_repaired(turns).collect()}
    got = {r["conv_id"]: (*tuple(r)[1:], digests.get(r["conv_id"])) for r in repairs.collect()}
    assert got == brute(rows)
    return turns


def talk(n, seed, conv):
    rng = random.Random(seed)
    roles = lambda k: rng.choice(["user", "assistant", "system", "tool"]) if rng.random() < 0.15 else ["user", "assistant"][k % 2]
    texts = lambda k: rng.choice(["", " \n\t", "cut off", "Same.", f"A full sentence {k}."]) if rng.random() < 0.3 else f"Turn {k}!"
    return [(conv, k + (k > n // 2), roles(k), texts(k)) for k in range(n)]


@pytest.mark.parametrize("segment", [3, 256])
def test_equals_brute_force(spark, make, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = [r for conv in range(25) for r in talk(random.Random(conv).randint(1, 9), conv, conv)] + talk(300, 99, 77)
    check(spark, rows)


def test_nulls_ties_repeats_and_long_texts(spark, make, clashes):
    long = "word " * 100_000 + "end."
    rows = [(None, 1, "user", "Hi."), (None, None, "assistant", "First."), (1, None, None, None), (2, 1, "user", None), (2, 1, "user", "a."),
            (2, 1, "user", "b."), (2, 1, "user", "b."), (2, 1, "user", "b."), (3, 5, "user", long), (3, 6, "assistant", long), (3, 7, "assistant", long),
            (4, 0, "", "no role."), (5, 3, "user", "漢字。"), (5, 9, "assistant", "é! "), (6, 2, "system", "only system."), (7, 1, "user", "  ")]
    turns = check(spark, rows, clashes + ["first", "segment", "kind", "place", "edit"])
    kept = sorted((r["place"], r["edit"], r["turn"], r["role"], len(r["text"])) for r in turns.collect() if r["conv_id"] == 3)
    assert kept == [(0, "K", 5, "user", len(long)), (1, "K", 6, "assistant", len(long))]


def test_one_conversation_holds_most_turns(spark, make, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 32)
    check(spark, talk(900, 5, 1) + [(1, 2000, "user", "Same again.")] * 200 + talk(6, 6, 2))


def test_empty_table(spark, make):
    frame = spark.createDataFrame([], SCHEMA)
    repairs = repair.plan_repairs(frame)
    assert repairs.collect() == [] and repair.digest_repaired(repair.repaired_turns(frame, repairs)).collect() == []


def test_query_against_brute_force(spark, make, tmp_dir):
    import zlib
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL_SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(1000, None, None, "Null turn."), (1001, 4, "user", None), (None, None, "user", "x.")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_dir}/conversations.parquet")
    left = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            left += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert sorted(map(repr, map(tuple, damaged(spark.createDataFrame(rows, SCHEMA)).collect()))) == sorted(map(repr, left))
    nothing, empty = (0, 0, 0, 0, 0, 0, "", None), hashlib.sha256(b"").hexdigest()
    expected = {c: (*brute(left).get(c, nothing)[:-1], brute(left).get(c, nothing)[-1] or empty) for c in {r[0] for r in rows}}
    assert {r["conv_id"]: tuple(r)[1:] for r in op11_repair(spark, tmp_dir).collect()} == expected
