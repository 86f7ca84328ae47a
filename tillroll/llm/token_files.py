"""Token ids of documents in binary files: one id array a file, document boundaries in Elias-Fano code.

A file holds the ids of a run of documents in ascending doc_id order, one after the other, as
little-endian numbers of 2 or 4 bytes; then the documents' ends and their doc_ids, both as
Elias-Fano sequences; then a footer of fixed size. Ids are written as they come, so a task holds
only the boundaries of its open file. The files that count are those named by the manifest that
Spark commits, so a retried or speculative task leaves at most an unlisted file.
"""

from __future__ import annotations

import math
import os
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.elias_fano import EliasFano
from tillroll.llm.scratch import shuffle_width, written
from tillroll.session import scratch_path

#: Fixed values of the format.
MAGIC = b"TOKIDS01"
_FOOTER = struct.Struct("<QQQQQB7x8s")  # ids, documents, of them without doc_id, bytes of ends, of doc_ids, bytes an id
#: Long texts are encoded in pieces, cut at the first blank or line feed after so many characters; short ones together.
_CUT_FROM = 1 << 22


@dataclass(frozen=True)
class TokenFileParams:
    """``end_id`` follows each document (None: nothing does). ``width``: bytes of an id. A new file
    begins after ``file_ids`` ids or ``file_docs`` documents. ``cache``: words whose ids a worker
    remembers (twice as many at most). ``piece``: bytes of ids that a reader holds, beyond one
    document's where it returns ids. ``task_ids``: ids that a reading task reads, or one file's."""

    end_id: int | None = 2
    width: int = 2
    file_ids: int = 64 << 20
    file_docs: int = 4 << 20
    cache: int = 500_000
    piece: int = 4 << 20
    task_ids: int = 4 << 20


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:/") else f"file://{path}")


class WordEncoder:
    """Ids by the tokenizers library, of whole texts, remembered by blank-separated word.

    That takes a tokenizer that drops white space and merges only inside a word, as a probe tells;
    with any other one whole texts go to the library. Blanks and line feeds separate words here; all
    other characters are left to the library. Two generations of words are remembered, so memory
    is bounded whatever the number of different words.
    """

    LONGEST, TOGETHER = 64, 200

    def __init__(self, path: str, width: int, cache: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one thread a task; Spark runs the tasks
        from tokenizers import Tokenizer
        self.tokenizer, self.kind, self.limit = Tokenizer.from_file(path), f"<u{width}", cache
        self.by_word = self._drops_white_space()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _drops_white_space(self) -> bool:
        probe = "ab cd\nef  gh"
        parts = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in probe.split()]
        return sum(parts, []) == self.tokenizer.encode(probe, add_special_tokens=False).ids

    def _encode(self, words: list[str]) -> list[bytes]:
        """Each word's ids. Some hundred words go to the library as one text; the ids' places tell the words."""
        out = []
        for at in range(0, len(words), self.TOGETHER):
            some = words[at:at + self.TOGETHER]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, starts = np.array(found.ids, self.kind), np.array([a for a, _ in found.offsets], np.int64)
            ends = np.cumsum([len(w) + 1 for w in some])
            raw, cuts = ids.tobytes(), (np.searchsorted(starts, ends) * ids.itemsize).tolist()
            out += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        """Different words' ids, remembered or from the library; at most ``limit`` new ones are remembered."""
        found = list(map(self.young.get, words))
        missing = [w for w, ids in zip(words, found) if ids is None]
        if not missing:
            return found
        short = [w for w in missing if len(w) <= self.LONGEST][:self.limit]
        if len(self.young) + len(short) > self.limit:
            self.young, self.old = {}, self.young
        new = dict(zip(missing, map(self.old.get, missing)))
        fresh = [w for w, ids in new.items() if ids is None]
        new.update(zip(fresh, self._encode(fresh)))
        self.young.update(zip(short, map(new.__getitem__, short)))
        return [new[w] if ids is None else ids for w, ids in zip(words, found)]

    def encode(self, text: str) -> bytes:
        """The text's ids, little-endian."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        out: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0
        for k, text in enumerate(texts):
            at = 0
            while at < len(text):
                end = self._cut(text, at + _CUT_FROM)
                held.append((k, text[at:end]))
                size += end - at
                if size >= _CUT_FROM:
                    self._pieces(held, out)
                    held, size = [], 0
                at = end
        self._pieces(held, out)
        return [b"".join(parts) for parts in out]

    @staticmethod
    def _cut(text: str, at: int) -> int:
        """The next blank or line feed from there, or the end."""
        found = [k for k in (text.find(" ", at), text.find("\n", at)) if k >= 0]
        return min(found, default=len(text))

    def _pieces(self, held: list[tuple[int, str]], out: list[list[bytes]]) -> None:
        """The ids of some texts' pieces, to the texts' parts. Arrow splits the pieces and puts their ids
        together, so that Python handles each different word once."""
        words = pc.split_pattern(pc.replace_substring(pa.array([piece for _, piece in held], pa.string()), "\n", " "), " ")
        every = words.flatten().dictionary_encode()
        # By way of NumPy: several times as fast as to_pylist.
        ids = self._ids(every.dictionary.to_numpy(zero_copy_only=False).tolist())
        _, ends, raw = pa.array(ids, pa.large_binary()).take(every.indices).buffers()
        if raw is None:  # no ids at all
            return
        raw, cuts = memoryview(raw), np.frombuffer(ends, np.int64)[words.offsets.to_numpy()].tolist()
        for (k, _), start, end in zip(held, cuts, cuts[1:]):
            out[k].append(raw[start:end])


_encoders: dict[tuple, WordEncoder] = {}


def _encoder(*key) -> WordEncoder:
    """One encoder a Python worker, whose memory its later tasks find filled."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(*key)
    return _encoders[key]


def encode_documents(documents: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     params: TokenFileParams = TokenFileParams()) -> DataFrame:
    """(doc_id, ids): each text's ids with the end id, as little-endian bytes; null counts as empty.
    ``tokenizer`` is the path of a file of the tokenizers library; no special tokens are added."""
    width, cache = params.width, params.cache
    end = b"" if params.end_id is None else int(params.end_id).to_bytes(width, "little")

    def run(batches):
        encoder = _encoder(tokenizer, width, cache)
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for i, j in _runs(lengths, _CUT_FROM if encoder.by_word else 1 << 20):
                texts = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                ids = [b + end for b in encoder.encode_many(texts)]
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, ids binary")


def _runs(lengths: np.ndarray, size: int):
    """(start, end) of consecutive rows of about ``size`` bytes, at least one."""
    total, at = np.cumsum(lengths), 0
    while at < len(lengths):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + size, "right")))
        yield at, end
        at = end


class TokenFileWriter:
    """One file; documents come in ascending doc_id order, those without one first."""

    def __init__(self, path: str, width: int):
        system, place = _place(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.path, self.width, self.out = path, width, system.open_output_stream(place)
        self.ends: list[int] = []
        self.doc_ids: list[int] = []
        self.nameless = self.ids = 0

    def write(self, doc_id: int | None, ids: memoryview) -> None:
        self.out.write(ids)
        self.ids += len(ids) // self.width
        self.ends.append(self.ids)
        if doc_id is None:
            self.nameless += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> tuple[str, int, int]:
        ends = EliasFano.of(np.array(self.ends, np.int64)).to_bytes()
        names = EliasFano.of(np.array(self.doc_ids, np.int64)).to_bytes()
        self.out.write(ends + names + _FOOTER.pack(self.ids, len(self.ends), self.nameless, len(ends), len(names), self.width, MAGIC))
        self.out.close()
        return self.path, len(self.ends), self.ids


class TokenFile:
    """A file opened for reading by document number; only the two sequences are held."""

    def __init__(self, path: str):
        system, place = _place(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        foot = self.file.read_at(_FOOTER.size, size - _FOOTER.size) if size >= _FOOTER.size else b""
        if foot[-8:] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        self.ids, self.documents, self.nameless, n_ends, n_names, self.width, _ = _FOOTER.unpack(foot)
        at = self.ids * self.width
        self.ends = EliasFano.from_bytes(self.file.read_at(n_ends, at))
        self.names = EliasFano.from_bytes(self.file.read_at(n_names, at + n_ends))

    def bounds(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the documents' ids start and end."""
        k = np.asarray(k, np.int64)
        starts = np.zeros(len(k), np.int64)
        starts[k > 0] = self.ends[k[k > 0] - 1]
        return starts, self.ends[k]

    def doc_ids(self, k: np.ndarray) -> list[int | None]:
        k = np.asarray(k, np.int64)
        out: list[int | None] = [None] * len(k)
        named = np.flatnonzero(k >= self.nameless)
        for i, v in zip(named.tolist(), self.names[k[named] - self.nameless].tolist()):
            out[i] = v
        return out

    def read(self, start: int, end: int) -> np.ndarray:
        """The ids from place ``start`` up to ``end``."""
        return np.frombuffer(self.file.read_at((end - start) * self.width, start * self.width), f"<u{self.width}")

    def document(self, k: int) -> np.ndarray:
        (start,), (end,) = self.bounds([k])
        return self.read(int(start), int(end))

    def close(self) -> None:
        self.file.close()


def _number_below(cuts: list[int], value: Column) -> Column:
    """How many of the ascending ``cuts`` are less than the value (null: none): first by blocks of cuts, then
    in one block, so that a row is compared with few of them."""
    if not cuts:
        return F.lit(0)
    block = math.isqrt(len(cuts))
    listed = lambda some: F.split(F.lit(",".join(map(str, some))), ",").cast("array<long>")
    below = lambda some: F.size(F.filter(some, lambda cut: cut < value))
    passed = block * below(listed(cuts[block - 1::block]))
    return passed + below(F.slice(listed(cuts), passed + 1, block))


def write_token_files(encoded: DataFrame, folder: str, params: TokenFileParams = TokenFileParams(),
                      ranges: int | None = None, doc_ids: DataFrame | None = None) -> DataFrame:
    """Writes (doc_id, ids) to files in ``folder`` (shared by all executors) and returns the
    committed manifest (path, documents, ids, first_document, first_id): how many documents and ids
    the files before it hold.

    Documents stand in ascending doc_id order, those without one first; rows that repeat a doc_id
    all stay, in the order of their ids' bytes. Range limits come from ``doc_ids`` (a frame with the
    same doc_id column, best the table that ``encoded`` was made of, as a scan of that column alone
    then does; ``encoded`` itself if not given). Only ids are shuffled, once. ``ranges``: two per
    shuffle partition if not given.
    """
    spark = encoded.sparkSession
    width, file_ids, file_docs = params.width, params.file_ids, params.file_docs
    n = max(1, ranges or 2 * shuffle_width(spark))
    shares = [k / n for k in range(1, n)]
    limits = (encoded if doc_ids is None else doc_ids).select(F.col("doc_id").cast("long").alias("doc_id")).agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else None
    cuts = sorted(set(limits or []))
    # By Spark's own functions: a second Python step would take a second worker a task, and the words that
    # ``encode_documents`` remembers would be spread over both.
    dealt = (encoded.select("doc_id", "ids", _number_below(cuts, F.col("doc_id")).alias("deal"))
             .repartitionById(len(cuts) + 1, F.col("deal"))
             .sortWithinPartitions("deal", F.col("doc_id").asc_nulls_first(), "ids"))

    def run(batches):
        writer, number, now = None, 0, None
        names, kinds = ["deal", "number", "path", "documents", "ids"], [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]

        def closed():
            return pa.record_batch([pa.array([v], k) for v, k in zip((now, number, *writer.close()), kinds)], names)

        for batch in batches:
            for doc_id, ids, of in zip(*(batch.column(c) for c in ("doc_id", "ids", "deal"))):
                if writer is not None and (of.as_py() != now or writer.ids >= file_ids or len(writer.ends) >= file_docs):
                    yield closed()
                    writer, number = None, number + 1
                if writer is None:
                    now = of.as_py()
                    writer = TokenFileWriter(f"{folder.rstrip('/')}/{uuid.uuid4().hex}.tokens", width)
                writer.write(doc_id.as_py(), memoryview(ids.as_buffer()))
        if writer is not None:
            yield closed()

    # One task writes the manifest's few short rows. A Parquet file a writing task would be hundreds of files of one
    # row, for each of which Hadoop's local file system starts processes (``chmod``) beside a full executor.
    files = written(dealt.mapInArrow(run, "deal int, number int, path string, documents long, ids long").repartition(1), "token-files")
    # One short row a file, so the running sums are one task's work whatever the size of the files.
    before = Window.orderBy("deal", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", "documents", "ids",
                        F.coalesce(F.sum("documents").over(before), F.lit(0)).cast("long").alias("first_document"),
                        F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long").alias("first_id"))


def read_token_files(manifest: DataFrame, params: TokenFileParams = TokenFileParams(), with_ids: bool = True) -> DataFrame:
    """(doc_id, document, start, n_tokens, ids_crc32, ids): one row a document of the manifest's
    files. ``document`` and ``start`` count the documents and ids before it in all files;
    ``ids_crc32`` is the checksum of the ids as unsigned 32-bit little-endian numbers; ``ids``
    (left out unless ``with_ids``) are the file's bytes. An empty manifest gives no rows."""
    piece = params.piece
    names = ["doc_id", "document", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids

    def checked(source: TokenFile, start: int, end: int) -> tuple[int, bytes]:
        crc, kept = 0, []
        for at in range(start, end, max(1, piece // source.width)):
            ids = source.read(at, min(end, at + piece // source.width))
            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
            if with_ids:
                kept.append(ids.tobytes())
        return crc, b"".join(kept)

    def rows_of(source: TokenFile, first_document: int, first_id: int):
        """Documents in runs of about a piece, each run read at once."""
        at = 0
        while at < source.documents:
            some = np.arange(at, min(at + 4096, source.documents))
            starts, ends = source.bounds(some)
            some = some[:max(1, int(np.searchsorted(ends, starts[0] + piece // source.width, "right")))]
            starts, ends = starts[:len(some)], ends[:len(some)]
            out, held = [], None
            if (ends[-1] - starts[0]) * source.width <= piece:
                held = source.read(int(starts[0]), int(ends[-1]))
            for k, doc_id, start, end in zip(some.tolist(), source.doc_ids(some), starts.tolist(), ends.tolist()):
                if held is None:
                    crc, ids = checked(source, start, end)
                else:
                    own = held[start - int(starts[0]):end - int(starts[0])]
                    crc, ids = zlib.crc32(own.astype("<u4").tobytes()), own.tobytes() if with_ids else b""
                out.append((doc_id, first_document + k, first_id + start, end - start, crc) + ((ids,) if with_ids else ()))
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)
            at += len(some)

    def run(batches):
        for batch in batches:
            for path, first_document, first_id in zip(*(batch.column(c).to_pylist() for c in ("path", "first_document", "first_id"))):
                source = TokenFile(path)
                yield from rows_of(source, first_document, first_id)
                source.close()

    # A number of its own, so that adaptive execution doesn't merge these few short rows into one task: two tasks a
    # core, or more where they would read more than ``task_ids`` each, but none without a file.
    files, ids = manifest.agg(F.count("*"), F.coalesce(F.sum("ids"), F.lit(0))).first()
    tasks = max(2 * manifest.sparkSession.sparkContext.defaultParallelism, math.ceil(ids / params.task_ids))
    return manifest.select("path", "first_document", "first_id").repartition(max(1, min(files, tasks, 50_000))).mapInArrow(
        run, "doc_id long, document long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def token_folder(spark) -> str:
    """A fresh folder for token files under the cluster's shared folder."""
    return scratch_path(spark, "llm-tokens")
