"""Document fingerprints: a Merkle tree over sections and paragraphs.

Paragraphs (lines) are the tree's leaves. Sections end at blank lines and, so that a text without
any still has several, after paragraphs whose hash ends in three zero bits: the cuts depend on the
content near them, so an edit moves no later boundary. Each inner hash covers its children in
order: equal roots mean equal texts, and two trees can be compared from the root down, opening
only branches that differ.

Likeness goes by smaller units, as a text may be one paragraph: pieces of up to three words that
don't cross the end of a sentence, each with a short hash, weighed by their bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tillroll.llm import bytesets as bs
from tillroll.llm.scratch import shuffle_width

_PIECE = re.compile(rb"[^\s.!?;|]+[.!?;|]+\s*|(?:[^\s.!?;|]+\s+){1,2}[^\s.!?;|]+[.!?;|]*\s*|\S+\s*|\s+")
_DIGEST = 16


@dataclass(frozen=True)
class Tree:
    """``paragraphs``: (section number, start byte, end byte, hash); ``pieces``: short hash and
    length of each piece."""

    root: bytes
    sections: list[bytes]
    paragraphs: list[tuple[int, int, int, bytes]]
    pieces: list[tuple[int, int]]


def _hash(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=_DIGEST).digest()


def build_tree(text: bytes) -> Tree:
    """The tree of a UTF-8 text; an empty text has a root and nothing below."""
    sections, paragraphs, branch, at = [], [], [], 0
    lines = text.split(b"\n") if text else []
    for line in lines:
        digest = _hash(b"\x01", line)
        paragraphs.append((len(sections), at, at + len(line), digest))
        branch.append(digest)
        at += len(line) + 1
        if not line or digest[-1] & 7 == 0:
            sections.append(_hash(b"\x02", *branch))
            branch = []
    if branch:
        sections.append(_hash(b"\x02", *branch))
    return Tree(_hash(b"\x03", *sections), sections, paragraphs, [(xxh3_64_intdigest(p), len(p)) for p in _PIECE.findall(text)])


def likeness(a: Tree, b: Tree) -> float:
    """Share of the two texts' bytes that stand in common pieces (0 to 1); 1 for equal roots."""
    if a.root == b.root:
        return 1.0
    x, y, size = Counter(h for h, _ in a.pieces), Counter(h for h, _ in b.pieces), dict(a.pieces)
    total = sum(n for _, n in a.pieces) + sum(n for _, n in b.pieces)
    both = sum(min(x[h], y[h]) * size[h] for h in x.keys() & y.keys())
    return min(1.0, 2 * both / total) if total else 0.0


def edited_paragraphs(a: Tree, b: Tree) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Byte spans of the paragraphs of each text that the other lacks, found from the root down:
    sections that both trees hold are not opened."""
    if a.root == b.root:
        return [], []

    def own(x: Tree, y: Tree) -> list[tuple[int, int]]:
        same, known = set(x.sections) & set(y.sections), {p[3] for p in y.paragraphs}
        return [(s, e) for k, s, e, h in x.paragraphs if x.sections[k] not in same and h not in known]
    return own(a, b), own(b, a)


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, sections, paragraphs): root, section and paragraph hashes with byte spans.

    One row per input row, no shuffle. Null counts as empty text; repeated rows get equal trees.
    """
    paragraph = pa.struct([("section", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary())])

    def run(batches):
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(1))
            for i, j in bs.row_slices(offsets):
                trees = [build_tree(data[offsets[k]:offsets[k + 1]].tobytes()) for k in range(i, j)]
                yield pa.record_batch([
                    batch.column(0).slice(i, j - i), pa.array([t.root.hex() for t in trees], pa.string()),
                    pa.array([t.sections for t in trees], pa.list_(pa.binary())),
                    pa.array([[dict(zip(("section", "start", "end", "hash"), p)) for p in t.paragraphs] for t in trees], pa.list_(paragraph)),
                ], ["doc_id", "fingerprint", "sections", "paragraphs"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string, sections array<binary>, "
             "paragraphs array<struct<section:int,start:long,end:long,hash:binary>>")


def _dealt_by_range(docs: DataFrame, ranges: int) -> DataFrame:
    """The rows with their id range, each range with one more row: the one that follows its last.

    Ids descend, nulls come last, and the last row of all is followed by the first of all. Range
    limits and first ids come from a scan of the id column alone and are as many as the ranges;
    the texts are shuffled once. Columns: doc_id, text, deal (range), extra (the added row).
    """
    ids = docs.select("doc_id")
    shares = [k / ranges for k in range(1, ranges)]
    limits = ids.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    cuts = np.unique(np.array(limits or [], np.int64))

    def deal(column: pa.Array) -> np.ndarray:
        number = np.searchsorted(cuts, column.fill_null(0).to_numpy(), "left").astype(np.int32)
        number[column.is_null().to_numpy(zero_copy_only=False)] = -1
        return number

    def largest(batches):
        for batch in batches:
            number = deal(batch.column(0))
            yield pa.record_batch([pa.array(number), batch.column(0)], ["deal", "doc_id"])

    firsts = sorted((r["deal"], r["first"]) for r in ids.mapInArrow(largest, "deal int, doc_id long")
                    .groupBy("deal").agg(F.max("doc_id").alias("first")).collect())
    # Who follows the last row of range k: the largest id of the next lower range.
    follows = {firsts[k - 1][1]: firsts[k][0] for k in range(len(firsts))}

    def copied(batches):
        for batch in batches:
            number, row_ids = deal(batch.column(0)), batch.column(0).to_pylist()
            also = [k for k, d in enumerate(row_ids) if d in follows]
            take = pa.array([*range(batch.num_rows), *also], pa.int64())
            to = np.concatenate([number, np.array([follows[row_ids[k]] for k in also], np.int32)])
            extra = np.arange(len(take)) >= batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.take(take).columns, pa.array(to), pa.array(extra)],
                                             names=["doc_id", "text", "deal", "extra"])

    return docs.mapInArrow(copied, "doc_id long, text string, deal int, extra boolean")


def edit_and_compare(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     ranges: int | None = None) -> DataFrame:
    """Each text against an edit of it and against its neighbour's text, by their trees.

    The next document is that of the next smaller id (after the smallest: the largest; nulls come
    last). The edited text replaces the last half of the code points by as many of the next text's
    first ones. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, edited_at (byte spans of the paragraphs that the edit changed).

    Null counts as empty. Rows that repeat an id stand in the order of their texts, each followed
    by the next one. A single row is its own neighbour. ``ranges``: id ranges that the texts are
    dealt into, two per shuffle partition if not given.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = (_dealt_by_range(docs, ranges or 2 * shuffle_width(docs.sparkSession)).repartition("deal")
            .sortWithinPartitions("deal", "extra", F.col("doc_id").desc_nulls_last(), "text"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_at"]
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def compare(now, following):
        text, following_text = now["text"], following["text"]
        half = len(text) // 2
        edited = (text[:len(text) - half] + following_text[:half]).encode("utf-8", "surrogatepass")
        tree, changed = now["tree"], build_tree(edited)
        return (now["doc_id"], len(text), hashlib.sha256(edited).hexdigest(), tree.root.hex(), changed.root.hex(),
                likeness(tree, changed), likeness(tree, following["tree"]),
                [{"start": a, "end": b} for a, b in edited_paragraphs(tree, changed)[0]])

    def run(batches):
        held, of, seen_extra, out = None, None, False, []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("doc_id", "text", "deal", "extra"))):
                doc_id, text, deal, extra = (x.as_py() for x in row)
                if deal != of:
                    held, of, seen_extra = None, deal, False
                if extra and seen_extra:
                    continue  # another row with the id of the following range's first
                now = {"doc_id": doc_id, "text": text, "tree": build_tree(text.encode("utf-8", "surrogatepass"))}
                if held is not None:
                    out.append(compare(held, now))
                held, seen_extra = now, extra
                if len(out) >= 256:
                    yield _batch(out, names, spans)
                    out = []
        if out:
            yield _batch(out, names, spans)

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double, edited_at array<struct<start:long,end:long>>")


def _batch(rows: list[tuple], names: list[str], spans: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), spans]
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)
