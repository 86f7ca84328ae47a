"""MinHash near-duplicate detection with b-bit signatures.

Plan, all tables distributed:

1. one pass over the texts gives each document its set size, a digest of its shingle set, band
   keys and the packed low bits of its minima; documents with equal sets become one class;
2. classes that share a band key are candidates. First only each band group's smallest member is
   compared with the others (as many pairs as members); candidates whose collision-corrected
   b-bit estimate is near the threshold or above, and whose parity sketches don't rule a link out,
   are confirmed on full sets;
3. components of the confirmed links leave few groups with members of different components. In
   those, all pairs across components are estimated inside the tasks (groups over a block size
   are dealt out as pairs of blocks), and only pairs that pass the estimate and the sketch are
   emitted and confirmed. So no candidate pair is lost and no group is expanded into all its pairs.

The parity sketch has a bit per slot: whether an odd number of the set's shingles falls there. Two
sketches differ in no more bits than the sets in elements, so a pair over the allowed difference is
surely no link. It keeps groups of near copies just below the threshold from being confirmed pair
by pair.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import bytesets as bs
from tillroll.llm.components import connected_components
from tillroll.llm.scratch import probably_in, row_key, written

WORD = bs.byte_table("\x20\x09\x0a\x0b\x0c\x0d")


@dataclass(frozen=True)
class NearDedupParams:
    """``percent``: link at 100 * intersection >= percent * union. ``bands`` x ``rows`` minima; at
    similarity s a pair shares no band with probability (1 - s**rows)**bands, 2.6e-7 at 0.85.
    ``margin``: how far below the threshold an estimate may fall and still be confirmed (over
    five standard errors). ``block``: members of a band group that one task compares."""

    shingle: int = 5
    percent: int = 85
    bands: int = 32
    rows: int = 6
    bits: int = 4
    margin: float = 0.15
    block: int = 4096
    parity_bits: int = 2048
    seed: int = 77

    @property
    def minima(self) -> int:
        return self.bands * self.rows


def shingle_sets(offsets: np.ndarray, data: np.ndarray, i: int, j: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of rows i..j, sorted within each row, and their count per row."""
    text, starts = bs.joined(offsets, data, i, j)
    text = bs.LOWER[text]
    begin, end = bs.word_spans(text, WORD)
    words = bs.word_hashes(text, begin, end)
    first = np.searchsorted(begin, starts)  # the first word of each row
    n_words = np.diff(first)
    grams = bs.gram_hashes(words, size)
    out, counts = [], np.zeros(j - i, np.int64)
    for k in range(j - i):
        a, n = first[k], n_words[k]
        if n >= size:
            own = np.unique(grams[a:a + n - size + 1])
        elif n:
            own = bs.mix64(bs.gram_hashes(words[a:a + n], int(n)) + np.uint64(n))
        else:
            continue
        counts[k] = len(own)
        out.append(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def minima(sets: np.ndarray, starts: np.ndarray, params: NearDedupParams) -> np.ndarray:
    """One 32-bit minimum per permutation (column) of each set (row)."""
    values = (sets >> np.uint64(32)).astype(np.uint32)
    factors = bs.seeded(params.minima, params.seed)
    out = np.empty((len(starts), params.minima), np.uint32)
    for k, f in enumerate(factors):
        permuted = (values ^ np.uint32(f >> np.uint64(32))) * np.uint32(f & np.uint64(0xFFFFFFFF))
        out[:, k] = np.minimum.reduceat(permuted, starts)
    return out


def band_keys(low: np.ndarray, params: NearDedupParams) -> np.ndarray:
    """A 64-bit key per band (column); the band's number is part of it."""
    grouped = low.reshape(len(low), params.bands, params.rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(params.bands, dtype=np.uint64), (len(low), params.bands)).copy()
    for k in range(params.rows):
        keys = bs.mix64(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return keys


def pack_low_bits(low: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of each minimum, packed into 64-bit words."""
    lanes = 64 // bits
    padded = np.zeros((len(low), -(-low.shape[1] // lanes) * lanes), np.uint64)
    padded[:, :low.shape[1]] = low & np.uint32((1 << bits) - 1)
    shifts = (np.arange(lanes, dtype=np.uint64) * np.uint64(bits))
    return np.bitwise_or.reduce(padded.reshape(len(low), -1, lanes) << shifts, axis=2)


def estimate(a: np.ndarray, b: np.ndarray, n_minima: int, bits: int) -> np.ndarray:
    """Collision-corrected similarity of packed signatures, row by row, by bit counts."""
    differ = a ^ b
    fold, step = differ.copy(), 1
    while step < bits:
        fold |= differ >> np.uint64(step)
        step += 1
    one = np.uint64(sum(1 << k for k in range(0, 64, bits)))
    unequal = np.bitwise_count(fold & one).sum(axis=1)
    chance = 2.0 ** -bits
    return ((1 - unequal / n_minima) - chance) / (1 - chance)


def parity_sketch(own: np.ndarray, bits: int) -> np.ndarray:
    """Which slots hold an odd number of the set's elements, packed."""
    slots = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((slots & 1).astype(np.uint8)).view(np.uint64)


def may_link(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """False where set sizes or parity sketches rule a link out; never for a link."""
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    differ = np.bitwise_count(a ^ b).sum(axis=1).astype(np.int64)
    return fits & (differ * (100 + percent) <= (n + m) * (100 - percent))


def sign(docs: DataFrame, params: NearDedupParams) -> DataFrame:
    """(doc_id, key, n_shingles, node, bands, sig, parity) of each (doc_id, text, key) row; node is null for an empty set."""
    n_bytes = params.minima * params.bits // 8

    def run(batches):
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(1))
            for i, j in bs.row_slices(offsets):
                sets, counts = shingle_sets(offsets, data, i, j, params.shingle)
                full = np.flatnonzero(counts)
                edges = np.zeros(len(full) + 1, np.int64)
                np.cumsum(counts[full], out=edges[1:])
                node: list = [None] * (j - i)
                parity = np.zeros((j - i, params.parity_bits // 64), np.uint64)
                for k, a, b in zip(full.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
                    node[k] = hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest()
                    parity[k] = parity_sketch(sets[a:b], params.parity_bits)
                keys = np.zeros((j - i, params.bands), np.uint64)
                packed = np.zeros((j - i, -(-n_bytes // 8)), np.uint64)
                if len(full):
                    low = minima(sets, edges[:-1], params)
                    keys[full], packed[full] = band_keys(low, params), pack_low_bits(low, params.bits)
                yield pa.record_batch([
                    batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(counts), pa.array(node, pa.binary()),
                    bs.list_column(pa.array(keys.view(np.int64).ravel()), np.full(j - i, params.bands)),
                    bs.binary_column(packed), bs.binary_column(parity)], ["doc_id", "key", "n_shingles", "node", "bands", "sig", "parity"])

    return docs.mapInArrow(run, "doc_id long, key binary, n_shingles long, node binary, bands array<long>, sig binary, parity binary")


def _matrix(column) -> np.ndarray:
    """A column of equally long binary values as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _estimated(pairs: DataFrame, classes: DataFrame, params: NearDedupParams) -> DataFrame:
    """Of the pairs (u, v) those whose estimate, set sizes and sketches allow the threshold."""
    side = lambda name: classes.select(F.col("node").alias(name), F.col("sig").alias(f"{name}_sig"),
                                       F.col("parity").alias(f"{name}_parity"), F.col("n_shingles").alias(f"{name}_n"))
    least, n_minima, bits, percent = params.percent / 100 - params.margin, params.minima, params.bits, params.percent

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            of = lambda c: _matrix(batch.column(c))
            good = estimate(of("u_sig"), of("v_sig"), n_minima, bits) >= least
            good &= may_link(batch.column("u_n").to_numpy(), batch.column("v_n").to_numpy(), of("u_parity"), of("v_parity"), percent)
            yield batch.select(["u", "v"]).filter(pa.array(good))

    return (pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "u_sig", "v_sig", "u_parity", "v_parity", "u_n", "v_n")
            .mapInArrow(run, "u binary, v binary"))


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, params: NearDedupParams) -> DataFrame:
    """Of the pairs (u, v) those whose full shingle sets reach the threshold.

    Only texts of classes that occur in a pair are read again and shuffled, one text a class: a
    fixed-size bitmap of their row keys filters the scan.
    """
    nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    wanted = written(classes.select("node", "key").join(nodes, "node"), "wanted")
    texts = probably_in(docs.select("key", "text"), "key", wanted, "key").join(wanted, "key").select("node", "text")
    size, percent = params.shingle, params.percent

    def collect_sets(batches):
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(1))
            nodes_in = batch.column(0).to_pylist()
            for i, j in bs.row_slices(offsets):
                sets, counts = shingle_sets(offsets, data, i, j, size)
                edges = np.concatenate([[0], np.cumsum(counts)])
                own = [sets[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                same = [hashlib.blake2b(s, digest_size=16).digest() == n for s, n in zip(own, nodes_in[i:j])]
                yield pa.record_batch([pa.array(nodes_in[i:j], pa.binary()), pa.array(own, pa.large_binary()).cast(pa.binary())],
                                      ["node", "shingles"]).filter(pa.array(same))

    sets = written(texts.mapInArrow(collect_sets, "node binary, shingles binary").dropDuplicates(["node"]), "sets")

    def compare(batches):
        for batch in batches:
            good = []
            for a, b in zip(batch.column("u_set"), batch.column("v_set")):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    side = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_set"))
    return (pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "u_set", "v_set")
            .mapInArrow(compare, "u binary, v binary"))


def _groups(batches, keys: list[str]):
    """Record batches cut so that no run of equal keys (the rows come sorted) spans two of them."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        last = np.ones(table.num_rows, bool)
        for k in keys:
            column = table.column(k).to_numpy()
            last &= column == column[-1]
        cut = table.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
        held = table.slice(cut)
        if cut:
            yield table.slice(0, cut)
    if held is not None and held.num_rows:
        yield held


def _across(members: DataFrame, params: NearDedupParams) -> DataFrame:
    """Estimated pairs (u, v) across components within the band groups of ``members``
    (band, node, root, sig, parity, n_shingles): every such pair is looked at, those that pass are emitted."""
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / params.block).cast("int").alias("blocks"))
    dealt = (members.join(sizes, "band")
             .withColumn("own", F.pmod(F.hash("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
             .select("band", "lo", "hi", "own", "node", "root", "sig", "parity", "n_shingles")
             .repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi"))
    least, n_minima, bits, percent = params.percent / 100 - params.margin, params.minima, params.bits, params.percent

    def run(batches):
        for table in _groups(batches, ["band", "lo", "hi"]):
            n = table.num_rows
            key = np.stack([table.column(k).to_numpy().astype(np.int64) for k in ("band", "lo", "hi")])
            starts = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
            end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
            node = table.column("node").to_pylist()
            number: dict[bytes, int] = {}
            root = np.array([number.setdefault(r, len(number)) for r in table.column("root").to_pylist()])
            sig, parity = _matrix(table.column("sig")), _matrix(table.column("parity"))
            size, own = table.column("n_shingles").to_numpy(), table.column("own").to_numpy()
            cross_only = key[1] != key[2]
            rows = np.arange(n)
            for step in range(1, n):
                rows = rows[rows + step < end[rows]]
                if not len(rows):
                    break
                there = rows + step
                use = root[rows] != root[there]
                use &= ~cross_only[rows] | (own[rows] != own[there])
                a, b = rows[use], there[use]
                if len(a):
                    good = estimate(sig[a], sig[b], n_minima, bits) >= least
                    good[good] = may_link(size[a[good]], size[b[good]], parity[a[good]], parity[b[good]], percent)
                    found = [tuple(sorted((node[x], node[y]))) for x, y in zip(a[good], b[good])]
                    if found:
                        yield pa.record_batch([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], ["u", "v"])

    return dealt.mapInArrow(run, "u binary, v binary").distinct()


def linked_rows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                params: NearDedupParams = NearDedupParams()) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, kept, first), one row per input row.

    ``key`` is the row's :func:`~tillroll.llm.scratch.row_key`. ``kept``: the row has its component's
    smallest doc_id; in a component without any doc_id one row is kept. ``first`` is true for one
    row of each component (that with the smallest doc_id, then key) and for all rows with an empty
    set. Other edge cases as in :func:`near_duplicates`.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    signed = written(sign(docs, params).withColumn("row", F.monotonically_increasing_id()), "signed")
    found = signed.filter("node is not null")
    # One row stands for each class of equal sets.
    firsts = found.groupBy("node").agg(F.min("key").alias("first_key"))
    classes = written(
        found.join(firsts, "node").filter("key = first_key")
        .select("node", "key", "n_shingles", "bands", "sig", "parity").dropDuplicates(["node"]), "classes")
    members = classes.select("node", F.explode("bands").alias("band"))
    hubs = members.groupBy("band").agg(F.min("node").alias("u"), F.count("*").alias("n")).filter("n > 1")
    shared = written(members.join(hubs, "band").select("band", "node", "u"), "bands")
    stars = shared.filter("node <> u").select("u", F.col("node").alias("v")).distinct()
    first_pairs = written(_estimated(stars, classes, params), "pairs")
    links = written(_confirmed(first_pairs, docs, classes, params), "links")
    roots = connected_components(links)

    labelled = shared.join(roots, "node", "left").select(
        "band", "node", F.coalesce("root", "node").alias("root"))
    mixed = (labelled.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b"))
             .filter("a <> b").select("band"))
    crossing = labelled.join(mixed, "band").join(classes.select("node", "sig", "parity", "n_shingles"), "node")
    more_pairs = written(_across(crossing, params).join(first_pairs, ["u", "v"], "left_anti"), "pairs")
    if more_pairs.limit(1).count():
        more = _confirmed(more_pairs, docs, classes, params)
        roots = connected_components(links.unionByName(written(more, "links")))

    placed = written(signed.select("doc_id", "key", "row", "n_shingles", "node").join(
        roots.withColumnRenamed("root", "linked"), signed.node == roots.node, "left").select(
        "doc_id", "key", "row", "n_shingles", F.coalesce("linked", signed.node).alias("root")), "placed")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key", "row")
    smallest = placed.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least_id"), F.min_by("row", order).alias("first_row"))
    first = F.coalesce(F.col("row") == F.col("first_row"), F.lit(True))
    return placed.join(smallest, "root", "left").select(
        "doc_id", "key", "n_shingles", F.coalesce("least_id", "doc_id").alias("component_id"),
        F.when(F.coalesce("least_id", "doc_id").isNull(), first).otherwise(
            F.coalesce("least_id", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"), first.alias("first"))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    params: NearDedupParams = NearDedupParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Null or wordless texts have an empty set, are linked with nothing and kept; fewer words than
    a shingle count as one shingle. Rows that repeat a doc_id each keep their row; ties (equal
    texts) go to the smallest doc_id. Rows without a doc_id are linked as others are; a component
    of such rows alone has a null component_id, and one of its rows is kept. Only the two named
    columns are read, so other columns and their names don't matter. An empty table gives an empty
    result.
    """
    return linked_rows(documents, id_col, text_col, params).select("doc_id", "n_shingles", "component_id", "kept")
