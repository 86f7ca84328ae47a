"""Benchmark decontamination by winnowing.

Every window of ``span`` words holds ``span - k + 1`` k-grams; the smallest of their hashes is its
fingerprint. Equal windows have equal fingerprints wherever they stand, so joining documents and
items on fingerprints meets every shared run of ``span`` words or more. Items shorter than a span
are one window of their own length; their fingerprint is the smallest hash of all their k-grams
with k reduced to fit, which keeps the same guarantee for them.

Documents are read once. A fixed-size bitmap of the items' fingerprints leaves only windows that
can match; these are extended to their words, and the words themselves are the join key, so a hash
collision can't add a hit and no pair of a common k-gram is formed that isn't a match.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import bytesets as bs
from tillroll.llm.scratch import row_key, written

#: Bytes outside words: all of ASCII but digits and letters (upper case is lowered first).
WORD = bs.byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


@dataclass(frozen=True)
class WinnowParams:
    """``span``: words of a window; ``k``: words of a k-gram; ``filter_bits``: size of the bitmap
    that every task holds (2 MB), whatever the number of items."""

    span: int = 10
    k: int = 5
    filter_bits: int = 1 << 24


def _gram_size(length: int, params: WinnowParams) -> int:
    return min(params.k, max(1, length // 2))


def fingerprints(words: np.ndarray, length: int, params: WinnowParams) -> np.ndarray:
    """The winnowed fingerprint of each window of ``length`` words, by its first word."""
    k = _gram_size(length, params)
    grams = bs.gram_hashes(words, k)
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    least = grams[:n].copy()
    for step in range(1, length - k + 1):
        np.minimum(least, grams[step:step + n], out=least)
    return bs.mix64(least + np.uint64(length))


def _words(offsets, data, i, j):
    text, starts = bs.joined(offsets, data, i, j)
    text = bs.LOWER[text]
    begin, end = bs.word_spans(text, WORD)
    return text, begin, end, bs.word_hashes(text, begin, end), np.searchsorted(begin, starts)


def _window_texts(text: bytes, begin, end, at: np.ndarray, length: int) -> list[bytes]:
    return [b" ".join(text[begin[w]:end[w]] for w in range(s, s + length)) for s in at.tolist()]


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, params: WinnowParams) -> DataFrame:
    """(item_id, size, fingerprint, window) of every window of every item."""
    def run(batches):
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(1))
            for i, j in bs.row_slices(offsets, 1 << 18):
                text, begin, end, hashes, first = _words(offsets, data, i, j)
                raw = text.tobytes()
                ids, sizes, prints, windows = [], [], [], []
                for k in range(j - i):
                    a, n = int(first[k]), int(first[k + 1] - first[k])
                    if not n:
                        continue
                    size = min(n, params.span)
                    own = fingerprints(hashes[a:a + n], size, params)
                    ids += [batch.column(0)[i + k].as_py()] * len(own)
                    sizes += [size] * len(own)
                    prints.append(own)
                    windows += _window_texts(raw, begin, end, np.arange(a, a + len(own)), size)
                yield pa.record_batch([
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()),
                    pa.array(np.concatenate(prints).view(np.int64) if prints else [], pa.int64()),
                    pa.array(windows, pa.binary())], ["item_id", "size", "fingerprint", "window"])

    return (benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "item_id long, size int, fingerprint long, window binary"))


def _bitmap(prints: DataFrame, bits: int) -> dict[int, bytes]:
    """The fingerprints' bitmap, by window size: at most ``span`` x ``bits / 8`` bytes reach the driver."""
    slot = F.pmod("fingerprint", F.lit(bits)) + 1
    rows = (prints.select("size", slot.alias("slot"))
            .groupBy("size", F.bitmap_bucket_number("slot").alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")).collect())
    out: dict[int, bytearray] = {}
    for r in rows:
        whole = out.setdefault(r["size"], bytearray(bits // 8))
        whole[(r["part"] - 1) * 4096:(r["part"] - 1) * 4096 + len(r["bitmap"])] = r["bitmap"]
    return {k: bytes(v) for k, v in out.items()}


def _scan(docs: DataFrame, bitmaps, params: WinnowParams) -> DataFrame:
    """(doc_id, row_key, n_words, hits) per document row; hits: windows whose fingerprint may match."""
    window = pa.struct([("start", pa.int32()), ("size", pa.int32()), ("window", pa.binary())])

    def run(batches):
        filters = {size: np.frombuffer(b, np.uint8) for size, b in bitmaps.value.items()}
        mask = np.uint64(params.filter_bits - 1)
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(1))
            for i, j in bs.row_slices(offsets):
                text, begin, end, hashes, first = _words(offsets, data, i, j)
                raw, ids = text.tobytes(), batch.column(0).slice(i, j - i).to_pylist()
                of = np.repeat(np.arange(j - i), np.diff(first))
                found: list[list] = [[] for _ in range(j - i)]
                for size, bits in filters.items():
                    prints = fingerprints(hashes, size, params)
                    if not len(prints):
                        continue
                    inside = of[:len(prints)] == of[size - 1:size - 1 + len(prints)]
                    slot = prints & mask
                    maybe = np.flatnonzero(inside & (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool))
                    for at, words in zip(maybe.tolist(), _window_texts(raw, begin, end, maybe, size)):
                        k = int(of[at])
                        found[k].append({"start": at - int(first[k]), "size": size, "window": words})
                yield pa.record_batch([
                    pa.array(ids, pa.int64()), batch.column(2).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)),
                    pa.array(found, pa.list_(window))], ["doc_id", "row_key", "n_words", "hits"])

    return docs.mapInArrow(run, "doc_id long, row_key binary, n_words long, hits array<struct<start:int,size:int,window:binary>>")


def decontaminate(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  params: WinnowParams = WinnowParams()) -> DataFrame:
    """(doc_id, row_key, n_words, n_hit, item_ids, spans), one row per document row.

    ``spans`` are the merged runs of hit words (start, end; end exclusive), ``item_ids`` the
    distinct items with a window in the document, sorted as strings. Null and wordless texts have
    no words and no hits; null or wordless items have no window; items repeated under one id count
    once; an item with a null id hits words but is not listed. Documents that repeat a doc_id each
    keep their row. Only the named columns are read.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("row_key"))
    items = written(item_windows(benchmark, item_col, item_text_col, params).distinct(), "items")
    bitmaps = docs.sparkSession.sparkContext.broadcast(_bitmap(items, params.filter_bits))
    scanned = written(_scan(docs, bitmaps, params), "scan")
    maybe = (scanned.filter(F.size("hits") > 0).select("row_key", F.explode("hits").alias("h"))
             .select("row_key", "h.start", "h.size", "h.window").distinct())
    matched = maybe.join(items.select("item_id", "size", "window"), ["size", "window"])
    listed = (matched.filter("item_id is not null").select("row_key", F.col("item_id").cast("string").alias("item")).distinct()
              .groupBy("row_key").agg(F.array_sort(F.collect_list("item")).alias("item_ids")))
    merged = F.expr("""aggregate(array_sort(collect_set(struct(start, start + size as end))),
        cast(array() as array<struct<start:int,end:int>>),
        (acc, w) -> if(size(acc) > 0 and w.start <= element_at(acc, -1).end,
            concat(slice(acc, 1, size(acc) - 1), array(struct(element_at(acc, -1).start as start, greatest(element_at(acc, -1).end, w.end) as end))),
            concat(acc, array(struct(w.start as start, w.end as end)))))""")
    covered = matched.select("row_key", "start", "size").distinct().groupBy("row_key").agg(merged.alias("spans"))
    result = covered.join(listed, "row_key", "left")
    return (scanned.select("doc_id", "row_key", "n_words").join(result, "row_key", "left").select(
        "doc_id", "row_key", "n_words",
        F.coalesce(F.expr("aggregate(spans, 0L, (s, w) -> s + w.end - w.start)"), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans")))
