"""Chat formatting by columnar byte assembly.

Template: each turn is ``<turn ROLE>TEXT</turn>`` and a line feed. Inside texts and roles a
backslash stands before every backslash, before ``<turn`` and before ``</turn`` (in roles before
``>`` too), so a text can hold any control string and is read back unchanged.

A batch of turns is one block of bytes: the escapes' places, the lengths of header, content and
footer and their cumulative sums give every source byte its index in one preallocated buffer, which
becomes the Arrow column without a Python string per turn.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import bytesets as bs

FOOTER = b"</turn>\n"
_CONTROL = (b"<turn", b"</turn")
_TURN = re.compile(rb"<turn ((?:[^\\>]++|\\.)*+)>((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)


def header(role: bytes) -> bytes:
    return b"<turn " + re.sub(rb"[\\>]|<(?=/?turn)", rb"\\\g<0>", role) + b">"


def unescape(content: bytes) -> bytes:
    return re.sub(rb"\\(.)", rb"\1", content, flags=re.S)


def _escapes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True at each byte before which a backslash must go; control strings stand within one row."""
    mark = data == 0x5C
    for control in _CONTROL:
        at = np.flatnonzero(data[:max(0, len(data) - len(control) + 1)] == control[0])
        for k, c in enumerate(control[1:], 1):
            at = at[data[at + k] == c]
        mark[at[at + len(control) <= offsets[np.searchsorted(offsets, at, "right")]]] = True
    return mark


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all formatted turns; where each turn starts (one more: the end), and where
    its content starts and ends in it."""
    offsets, data = bs.string_buffers(texts)
    n = len(offsets) - 1
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    mark = _escapes(data, offsets)
    first = np.zeros(len(data) + 1, np.int64)  # escapes before each byte
    np.cumsum(mark, out=first[1:])
    lengths = np.diff(offsets) + first[offsets[1:]] - first[offsets[:-1]]
    names = [r or "" for r in roles.to_pylist()]
    heads = {r: np.frombuffer(header(r.encode("utf-8", "surrogatepass")), np.uint8) for r in set(names)}
    foot = np.frombuffer(FOOTER, np.uint8)
    head_lengths = np.array([len(heads[r]) for r in names], np.int64)
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(head_lengths + lengths + len(foot), out=starts[1:])
    out = np.empty(int(starts[-1]), np.uint8)
    content = starts[:-1] + head_lengths
    # Scatter index of each source byte: its row's content start, its place in the row, escapes so far.
    shift = np.repeat(content - offsets[:-1] - first[offsets[:-1]], np.diff(offsets))
    index = np.arange(len(data)) + shift + first[1:]
    out[index] = data
    out[index[mark] - 1] = 0x5C
    for role, bytes_ in heads.items():
        rows = np.array([r == role for r in names])
        out[(starts[:-1][rows][:, None] + np.arange(len(bytes_))).ravel()] = np.tile(bytes_, int(rows.sum()))
    if n:
        out[((starts[1:] - len(foot))[:, None] + np.arange(len(foot))).ravel()] = np.tile(foot, n)
    return out, starts, content, content + lengths


def format_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """(conv_id, part, formatted, loss): each conversation's formatted text, in one or more parts.

    Parts, numbered in order, are consecutive runs of turns that stand in one range partition and Arrow batch; a
    conversation's text is its parts in order, so a very long one is never gathered in a task.
    ``loss`` holds the spans (start, end; bytes of ``formatted``) of the trained role's contents.

    Turns are ordered by turn, then role, then text (null turns first); rows that repeat a turn
    all stay. Null text and null role count as empty; rows with a null conv_id are a conversation
    of their own. Only the four named columns are read.
    """
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = ["conv_id", "turn", "role", "text"]
    dealt = turns.repartitionByRange(*ordered[:3]).sortWithinPartitions(*ordered)

    def run(batches):
        part = TaskContext.get().partitionId() << 40  # range partitions are numbered in order
        for batch in batches:
            offsets, _ = bs.string_buffers(batch.column(3))
            for i, j in bs.row_slices(offsets):
                turn = batch.slice(i, j - i)
                out, starts, begin, end = assemble(turn.column(2), turn.column(3))
                ids = turn.column(0).fill_null(0).to_numpy() * 2 + turn.column(0).is_null().to_numpy(zero_copy_only=False)
                limits = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [j - i]])
                n = len(limits) - 1
                formatted = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(starts[limits]), pa.py_buffer(out)])
                learned = pc.equal(turn.column(2), trained_role).to_numpy(zero_copy_only=False)
                base = np.repeat(starts[limits[:-1]], np.diff(limits))
                loss = pa.StructArray.from_arrays([pa.array((begin - base)[learned]), pa.array((end - base)[learned])], ["start", "end"])
                counts = np.add.reduceat(learned.astype(np.int64), limits[:-1])
                yield pa.record_batch([turn.column(0).take(pa.array(limits[:-1])), pa.array(np.arange(part, part + n)),
                                       formatted.cast(pa.string()), bs.list_column(loss, counts)],
                                      ["conv_id", "part", "formatted", "loss"])
                part += n

    return dealt.mapInArrow(run, "conv_id long, part long, formatted string, loss array<struct<start:long,end:long>>")


def read_turns(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of each turn of a formatted text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its parts: n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars. Parts stream through one digest in order; a task holds one part at a time."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        now, turns, loss, counts, out = object(), None, None, [0, 0, 0], []
        nothing = now

        def closed():
            return (now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2])

        for batch in batches:
            for conv_id, text, spans in zip(*(batch.column(c) for c in ("conv_id", "formatted", "loss"))):
                conv_id, raw = conv_id.as_py(), text.as_py().encode("utf-8", "surrogatepass")
                if now is nothing or conv_id != now:
                    if now is not nothing:
                        out.append(closed())
                    now, turns, loss, counts = conv_id, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for role, content in read_turns(raw):
                    turns.update(role + b"\n" + content + b"\n")
                    counts[0] += 1
                for span in spans.as_py():
                    learned = unescape(raw[span["start"]:span["end"]])
                    loss.update(learned)
                    counts[1] += len(learned.decode("utf-8", "surrogatepass"))
                counts[2] += len(text.as_py())
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if now is not nothing:
            yield pa.record_batch([pa.array([c], k) for c, k in zip(closed(), kinds)], names)

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")
