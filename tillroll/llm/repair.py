"""Conversation structure repair: the cheapest edits that make the turns alternate.

The repaired roles' initials spell ``(s?(ua)+)?``: nothing, or user and assistant in turns after at
most one system turn. Edits of a conversation, in the order of its turns: Keep costs 0, Rerole (to
user or assistant) 3, Delete 4, Insert (an empty user or assistant turn, anywhere) 3; blank and
duplicate turns must be deleted, and a truncated turn that stays costs 3 more. Of the cheapest
edits those whose initials are ASCII-least are taken.

They are found by iterative-deepening A*: depth-first search tries the edits in ASCII order under a
cost bound that grows to the least cost that went beyond it. Failed states (turns passed, state of
the grammar) keep what they are known to cost at least, over all bounds, so a state is entered again
only with more left to spend. The first path that is accepted is the answer.

On Spark, turns are numbered in order by one range sort of short rows (no texts); a long
conversation falls into segments of at most ``SEGMENT`` turns that are searched apart, from every
state of the grammar to every other one, and joined from the last to the first.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import written

#: Costs of the edits, what a truncated turn costs when it stays, white space, ends of sentences.
DELETE, INSERT, REROLE, STAYS_CUT = 4, 3, 3, 3
SPACE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
#: Turns of a conversation that are searched at once.
SEGMENT = 256
#: Characters of a text that order turns of equal number and role, before its digest does.
HEAD = 64

# States of the grammar: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
_ACCEPTED = (0, 3)
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEXT, _NEXT_ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
_LEGAL = {"su", "ua", "au"}
#: Cheapest inserts that end a conversation in each state.
_TAIL = ("", "II", "I", "")
_NEVER = 1 << 60


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


def _least_costs(turns: list[tuple[str, str]]) -> list[int]:
    """What the turns from each place on cost at least, whatever the state.

    Deletions that must be, 3 for every truncated turn (kept or deleted, it costs as much), and
    for disjoint pairs of neighbours that can't both stay 3 more, or 1 where one is truncated (its
    deletion costs 4 in all)."""
    out = [0] * (len(turns) + 1)
    forced, pairs_from, after = 0, [0, 0], None  # pair costs from the next staying turn, from the one after it
    for k in range(len(turns) - 1, -1, -1):
        initial, fault = turns[k]
        if fault in "bd":
            forced += DELETE
        else:
            pairs = pairs_from[0]
            if after is not None and initial + after[0] not in _LEGAL:
                pairs = max(pairs, pairs_from[1] + (1 if "t" in (fault, after[1]) else 3))
            pairs_from, after = [pairs, pairs_from[0]], (initial, fault)
            forced += STAYS_CUT if fault == "t" else 0
        out[k] = forced + pairs_from[0]
    return out


class Search:
    """Cheapest edits of some turns, each (initial of the role, fault): ``b`` blank, ``d`` duplicate,
    ``t`` truncated or another letter. With ``goal`` None the turns are a whole conversation; else they
    are a part of one that ends in the state ``goal`` with its last turn's edit."""

    def __init__(self, turns: list[tuple[str, str]], goal: int | None = None):
        self.turns, self.goal = turns, goal
        least = _least_costs(turns)
        self.known = [[least[k]] * 4 for k in range(len(turns) + 1)]
        self.known[-1] = [INSERT * len(t) for t in _TAIL] if goal is None else [0 if g == goal else _NEVER for g in range(4)]
        if goal in (0, 1):  # inserts lead away from these states and never back
            system = False
            for known, (initial, fault) in zip(self.known[-2::-1], reversed(turns)):
                system = system or (initial == "s" and fault not in "bd")
                for state in range(4):
                    if state != goal and not (goal == 1 and state == 0 and system):
                        known[state] = _NEVER
        self.entered = 0

    def _moves(self, at: int, state: int) -> list[tuple[str, int, int, int]]:
        """(edit, cost, turns passed, state after it), in ASCII order."""
        insert = ("I", INSERT, at, _NEXT[state])
        if at == len(self.turns):
            return [insert] if self.goal is None else []
        initial, fault = self.turns[at]
        moves = [("D", DELETE, at + 1, state), insert]
        if fault not in "bd":
            extra = STAYS_CUT if fault == "t" else 0
            if initial in _KEEP[state]:
                moves.append(("K", extra, at + 1, _KEEP[state][initial]))
            moves.append(("R", REROLE + extra, at + 1, _NEXT[state]))
        return moves

    def _accepts(self, at: int, state: int) -> bool:
        return at == len(self.turns) and (state in _ACCEPTED if self.goal is None else state == self.goal)

    def _within(self, state: int, bound: int) -> str | None:
        """The first path of at most ``bound`` in ASCII order; states that fail learn their cost."""
        known = self.known
        if self._accepts(0, state):
            return ""
        # Frames: place, state, left to spend, moves, which is next, least cost that any move needs.
        frames = [[0, state, bound, self._moves(0, state), 0, _NEVER]]
        path: list[str] = []
        while frames:
            frame = frames[-1]
            at, now, left, moves, k, _ = frame
            if k == len(moves):
                known[at][now] = max(known[at][now], frame[5])
                frames.pop()
                if path:
                    path.pop()
                if frames:  # what the move to this state needs is known better now
                    above = frames[-1]
                    above[5] = min(above[5], above[3][above[4] - 1][1] + known[at][now])
                continue
            frame[4] += 1
            edit, cost, to, then = moves[k]
            needs = cost + known[to][then]
            if needs > left:
                frame[5] = min(frame[5], needs)
                continue
            path.append(edit)
            if self._accepts(to, then):
                return "".join(path)
            self.entered += 1
            frames.append([to, then, left - cost, self._moves(to, then), 0, _NEVER])
        return None

    def cheapest(self, state: int = 0) -> tuple[int, str] | None:
        """(cost, edits) from a state of the grammar, or None where the goal is out of reach."""
        while (bound := self.known[0][state]) < _NEVER:
            path = self._within(state, bound)
            if path is not None:
                return bound, path
        return None


def _cells(turns: list[tuple[str, str]], whole: bool) -> list[dict]:
    """Costs and edits from each state to each (a whole conversation: from the start, to the end)."""
    if whole:
        cost, audit = Search(turns).cheapest()
        return [{"start": 0, "end": -1, "cost": cost, "audit": audit}]
    out = []
    for goal in range(4):
        search = Search(turns, goal)
        for state in range(4):
            found = search.cheapest(state)
            if found:
                out.append({"start": state, "end": goal, "cost": found[0], "audit": found[1]})
    return out


def joined_segments(segments) -> tuple[int, str]:
    """(cost, edits) of a conversation from its segments' cells, the last segment first.

    Edits of one segment with one cost differ before either ends, so comparing them segment by
    segment compares the whole strings. A state's edits are a chain of the segments' strings."""
    best: list[tuple | None] = [(INSERT * len(t), t, None) for t in _TAIL]
    for cells in segments:
        if cells and cells[0]["end"] < 0:
            return cells[0]["cost"], cells[0]["audit"]
        fresh: list[tuple | None] = [None] * 4
        for c in cells:
            rest = best[c["end"]]
            if rest is None:
                continue
            now = (c["cost"] + rest[0], c["audit"], rest)
            held = fresh[c["start"]]
            if held is None or now[:2] < held[:2]:
                fresh[c["start"]] = now
        best = fresh
    parts, chain = [], best[0]
    cost = chain[0]
    while chain is not None:
        parts.append(chain[1])
        chain = chain[2]
    return cost, "".join(parts)


ORDER = ["conv_id", "turn", "role", "head", "digest"]


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The named columns with what orders them: the text's head and the digest of conversation, role
    and text, which equal turns of a conversation share."""
    named = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                 F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                                 F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))
    whole = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.octet_length("role").cast("string"), F.lit(":"),
                     F.col("role"), F.col("text"))
    return named.withColumns({"head": F.substring("text", 1, HEAD), "digest": F.unhex(F.sha2(whole, 256))})


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["conv_id"].eqNullSafe(right["conv_id"])


def plan_repairs(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): one row a conversation.

    Turns are ordered by turn (nulls first); of one number by role, the text's first ``HEAD``
    characters and a digest. Null roles and texts count as one blank; rows without conv_id are one
    conversation. A turn's first fault counts: blank (white space alone), duplicate (an earlier one
    has its role and text) or truncated (the last character that is no white space is not
    ``[.!?]``). ``gaps``: turn numbers missing between the least and the largest; ``illegal``:
    neighbours whose roles' initials are not su, ua or au; ``audit``: initials of the cheapest edits.
    An empty table gives no rows. Only the four named columns are read.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    own = (F.when(trimmed == "", "b").when(F.right(trimmed, F.lit(1)).isin(*SENTENCE_ENDS), "-").otherwise("t"))
    short = _turns(conversations, conv_col, turn_col, role_col, text_col).select(
        *ORDER, F.left(F.col("role"), F.lit(1)).alias("initial"), own.alias("fault"))
    numbered = (short.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("pos", F.monotonically_increasing_id())
                .select("conv_id", "turn", "digest", "initial", "fault", "pos", F.expr(f"pos div {SEGMENT}").alias("segment")))
    turns = written(numbered, "turns")
    spans = written(turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        (F.min("segment") < F.max("segment")).alias("long")), "spans")
    firsts = turns.groupBy("digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    fault = F.when(F.col("fault") == "b", "b").when(F.col("first") < F.col("pos"), "d").otherwise(F.col("fault"))
    segments = (turns.join(firsts, "digest", "left").select("conv_id", "segment", "pos", "initial", fault.alias("fault"))
                .groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("pos", "initial", "fault"))).alias("turns")))
    long = spans.filter("long").select("conv_id", "long")
    apart = segments.join(long, _same(segments, long), "left").select(
        segments["conv_id"], "segment", "turns", F.col("long").isNull().alias("whole"))
    cell = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    names = ["conv_id", "segment", "blank", "duplicate", "truncated", "illegal", "first", "last", "cells"]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [cell]

    def searched(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for conv_id, number, own, whole in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    pairs = [(t["initial"], t["fault"]) for t in own]
                    faults = [f for _, f in pairs]
                    out.append((conv_id, number, *(faults.count(f) for f in "bdt"), illegal_pairs([i for i, _ in pairs]),
                                pairs[0][0], pairs[-1][0], _cells(pairs, whole)))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    cells = apart.mapInArrow(searched, "conv_id long, segment long, blank long, duplicate long, truncated long, illegal long, "
                                       "first string, last string, cells array<struct<start:int,end:int,cost:long,audit:string>>")
    backwards = cells.repartition("conv_id").sortWithinPartitions("conv_id", F.col("segment").desc())

    def whole_conversations(batches):
        """Runs of rows of one conversation, across batches."""
        held, of = [], None
        for batch in batches:
            for row in zip(*(batch.column(n) for n in names)):
                conv_id = row[0].as_py()
                if held and conv_id != of:
                    yield of, held
                    held = []
                of = conv_id
                held.append(tuple(c.as_py() for c in row[2:]))
        if held:
            yield of, held

    def combined(batches):
        out = []
        for conv_id, rows in whole_conversations(batches):
            cost, audit = joined_segments(r[6] for r in rows)
            across = sum(earlier[5] + later[4] not in _LEGAL for later, earlier in zip(rows, rows[1:]))
            out.append((conv_id, *(sum(r[k] for r in rows) for k in range(3)), sum(r[3] for r in rows) + across, cost, audit))
            if len(out) >= 512 or len(audit) > 1 << 20:
                yield _repairs(out)
                out = []
        if out:
            yield _repairs(out)

    repairs = backwards.mapInArrow(combined, "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    return spans.join(repairs, _same(spans, repairs)).select(
        spans["conv_id"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _repairs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 6 + [pa.string()])],
                           ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def repaired_turns(conversations: DataFrame, repairs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the turns that stay or are inserted, in the order
    of :func:`plan_repairs` and by its ``repairs`` (conv_id, audit). Inserted turns have no number.

    Texts are shuffled once, by conversation, and streamed past the edits; a task holds one batch.
    Rows of a conversation stand together and in order in their partition.
    """
    texts = _turns(conversations, conv_col, turn_col, role_col, text_col)
    edits = repairs.select("conv_id", *[F.lit(None).cast(k).alias(n) for n, k in (("turn", "long"), ("role", "string"))],
                           F.col("audit").alias("text"), F.lit("").alias("head"), F.lit(None).cast("binary").alias("digest"),
                           F.lit(0).alias("kind"))
    rows = (texts.withColumn("kind", F.lit(1)).unionByName(edits).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", *ORDER[1:]).select("conv_id", "kind", "turn", "role", "text"))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = ["conv_id", "place", "edit", "turn", "role", "text"]

    def run(batches):
        audit, at, state, place, of = "", 0, 0, 0, None
        out, size = [], 0

        def inserts():
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                out.append((of, place, "I", None, _NEXT_ROLE[state], ""))
                at, state, place = at + 1, _NEXT[state], place + 1

        for batch in batches:
            for conv_id, kind, turn, role, text in zip(*batch.columns):
                if kind.as_py() == 0:
                    inserts()  # those that end the conversation before
                    audit, at, state, place, of = text.as_py(), 0, 0, 0, conv_id.as_py()
                    continue
                inserts()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                kept = role.as_py()
                if edit == "R":
                    kept, state = _NEXT_ROLE[state], _NEXT[state]
                else:
                    state = _KEEP[state][kept[0]]
                out.append((of, place, edit, turn.as_py(), kept, text.as_py()))
                place, size = place + 1, size + len(out[-1][5])
                if len(out) >= 1000 or size >= 4 << 20:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out, size = [], 0
        inserts()
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return rows.mapInArrow(run, "conv_id long, place long, edit string, turn long, role string, text string")


def digest_repaired(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of :func:`repaired_turns` as it comes (conversations together, in
    order): the digest of ``role:text`` of all turns, joined by line feeds. A digest is sequential,
    so one task streams a conversation. Conversations without a turn left are not among the rows."""
    def run(batches):
        digest, of, out = None, None, []
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(n) for n in ("conv_id", "role", "text"))):
                conv_id = conv_id.as_py()
                if digest is None or conv_id != of:
                    if digest is not None:
                        out.append((of, digest.hexdigest()))
                    digest, of = hashlib.sha256(), conv_id
                else:
                    digest.update(b"\n")
                digest.update(f"{role.as_py()}:{text.as_py()}".encode("utf-8", "surrogatepass"))
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64(), pa.string()])], ["conv_id", "repaired_sha256"])
                out = []
        if digest is not None:
            yield pa.record_batch([pa.array([of], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(run, "conv_id long, repaired_sha256 string")
