"""Secret scan: three fixed patterns, and dictionary-primed compression novelty.

Novelty: a candidate is a run of key-like characters after a sensitive word; at "=" a run is split
into name and value, so that the name is part of the value's context. A zstandard compressor primed
with the text around it, less copies of the candidate, and with common code identifiers compresses
the candidate alone; the bytes it needs beyond an empty frame, per character, are its novelty. A
name or a value that the surroundings or the identifiers explain costs little; a random key costs
almost a byte per character and is reported. A compressor primed with so little text can't tell a
rare word from random letters, so a candidate without digits must also be unlike words: fewer of its
letter pairs are common ones than in words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import bytesets as bs

#: Kinds in report order.
KINDS = ("assign", "access", "hex", "novel")
#: The patterns and least lengths of the three plain kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: Stems without which ASSIGN can't match.
STEMS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
#: Words that make a context sensitive.
SENSITIVE = re.compile(r"secret|token|passw|pwd|api[_-]?key|auth|bearer|credential|private|access|session|signature|(?<![a-z])key(?![a-z])", re.I | re.A)
#: Letter pairs that make up most of the words of English, German, French, Spanish and source code.
PAIRS = frozenset((
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch "
    "ll be ma si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so rs un lo wa ge ie wh ee wi em ad ol rt po "
    "we na ul ni ts mo ow pa im mi ai sh ir su id os iv ia am fi ci vi pl ig tu ev ld ry mp fe bl ab gh ty op wo sa ay ex ke fr oo av ag "
    "if ap gr od bo sp rd do uc bu ei ov by rm ep tt oc fa ef cu rn sc gi da yo cr cl du ga qu ue ff ba ey ls va um pp ua up lu go ht ru "
    "ug ds lt pi rc rr eg au ck ew mu br bi pt ak pu ui rg ib tl ny ki rk ys ob mm fu ph og ms ye ud mb ip ub oi rl gu dr hr cc tw ft wn "
    "nu af hu nn eo vo rv nf xp gn sm fl iz ok nl my gl aw ju oa eq sy sl ps jo lf nv je nk kn gs dy hy ze ks xt bs ik dd pf sk tz zu "
    "hl ka rz eu ko ku kt lb lk rb zt zi hn ah oh uf eh ih ux ez ja cq").split())
#: Common identifiers of source code, the fixed part of the dictionary.
IDENTIFIERS = (
    "import from return function class public private static const let var def self this null None true false "
    "string number integer boolean object array list dict config settings environment production development "
    "example placeholder changeme your_api_key_here access_token refresh_token client_id client_secret "
    "Authorization Bearer Basic username password secret key value default host port localhost database "
    "connection session cookie header request response content application json https http www com org version "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ").encode()
#: Fixed values of zstandard: a block's header; literals of a block up to this size are stored raw.
BLOCK_HEADER, BLOCK = 3, 60

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True
_KEY_BYTE = np.zeros(256, bool)
_KEY_BYTE[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-")] = True
_VALUE = re.compile(rb"[^=]+(?:=+\Z)?")
_LETTERS = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class SecretParams:
    """``least``: characters of a novelty candidate; ``before``: characters in which a sensitive
    word must stand; ``around``: characters on each side that prime the dictionary; ``novelty``:
    marginal bytes per character from which a candidate is reported; ``common``: share of word-like
    letter pairs from which a candidate without digits counts as words."""

    least: int = 16
    before: int = 48
    around: int = 512
    novelty: float = 0.8
    common: float = 0.75


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three fixed patterns, failing matches dropped."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return out


def marginal_bytes(candidate: bytes, surroundings: bytes) -> int:
    """Bytes that the candidate adds to a frame whose dictionary holds its surroundings.

    Long candidates go in as blocks too short for entropy coding, which would pack random characters
    to their alphabet's entropy; each block still finds matches in all that stands before it.
    """
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + b"\n" + surroundings, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compressor = zstandard.ZstdCompressor(level=3, dict_data=primed, write_checksum=False, write_content_size=False)
    empty = len(compressor.compress(b""))
    if len(candidate) <= BLOCK:
        return len(compressor.compress(candidate)) - empty
    stream, size = compressor.compressobj(size=len(candidate)), 0
    for k in range(0, len(candidate), BLOCK):
        size += len(stream.compress(candidate[k:k + BLOCK])) + len(stream.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)) - BLOCK_HEADER
    return size + len(stream.flush()) - empty


def like_words(candidate: str, common: float) -> bool:
    """Whether a candidate has no digit and as many common letter pairs as words have."""
    if any(c.isdigit() for c in candidate):
        return False
    pairs = [run[k:k + 2] for run in _LETTERS.findall(candidate.lower()) for k in range(len(run) - 1)]
    return sum(p in PAIRS for p in pairs) >= common * len(pairs)


def _surroundings(text: str, a: int, b: int, around: int) -> str:
    """The text on both sides of a candidate, blank where the candidate (less padding) stands again."""
    same = text[a:b].rstrip("=")
    blank, n = " " * len(same), b - a
    before = text[max(0, a - around - n):a].replace(same, blank)
    return before[max(0, len(before) - around):] + " " + text[b:b + around + n].replace(same, blank)[:around]


def novel_spans(text: str, candidates: list[tuple[int, int]], params: SecretParams) -> list[tuple[str, int, int]]:
    """Candidates (code points) in a sensitive context that their surroundings don't explain."""
    out = []
    for a, b in candidates:
        context = text[max(0, a - params.before):a]
        if not SENSITIVE.search(context):
            continue
        if like_words(text[a:b], params.common):
            continue
        candidate = text[a:b].encode()
        around = _surroundings(text, a, b, params.around).encode("utf-8", "surrogatepass")
        if marginal_bytes(candidate, around) >= params.novelty * len(candidate):
            out.append(("novel", a, b))
    return out


def _suspects(raw: np.ndarray, starts: np.ndarray, least: int) -> tuple[set[int], dict[int, list[tuple[int, int]]]]:
    """Rows that a plain pattern may match; key-like runs, split at "=", by row (bytes)."""
    rows: set[int] = set()
    row_of = lambda at: np.searchsorted(starts, at, "right") - 1
    begin, end = bs.word_spans(raw, _HEX_BYTE)
    rows.update(row_of(begin[end - begin >= LEAST["hex"]]).tolist())
    lowered = bs.LOWER[raw].tobytes()
    text = raw.tobytes()
    for where, stems in ((lowered, STEMS), (text, (b"AKIA",))):
        for stem in stems:
            at = where.find(stem)
            while at >= 0:
                row = int(row_of(at))
                rows.add(row)
                at = where.find(stem, int(starts[row + 1]))
    begin, end = bs.word_spans(raw, _KEY_BYTE)
    long = end - begin >= least
    begin, end = begin[long], end[long]
    runs: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(begin.tolist(), end.tolist()):
        for m in _VALUE.finditer(text, a, b):
            if m.end() - m.start() >= least:
                runs.setdefault(int(row_of(a)), []).append(m.span())
    return rows, runs


def _uncovered(points: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Of the sorted points (start, end) those that the spans together don't cover."""
    merged: list[list[int]] = []
    for x, y in sorted(s[1:] for s in spans):
        if merged and x <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], y)
        else:
            merged.append([x, y])
    out, at = [], 0
    for a, b in points:
        while at < len(merged) and merged[at][1] <= a:
            at += 1
        if at == len(merged) or not merged[at][0] <= a < b <= merged[at][1]:
            out.append((a, b))
    return out


def scan_rows(offsets: np.ndarray, data: np.ndarray, i: int, j: int, params: SecretParams) -> list[list[tuple[str, int, int]]]:
    """All spans (code points) of rows i..j, by start and then kind."""
    raw, starts = bs.joined(offsets, data, i, j, gap=0x0A)
    rows, runs = _suspects(raw, starts, params.least)
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(j - i)]
    for k in rows | runs.keys():
        own = raw[starts[k]:starts[k + 1] - 1].tobytes()
        text = own.decode("utf-8", "replace")
        spans = plain_spans(text) if k in rows else []
        if k in runs:
            points, chars, done = [], 0, 0
            for a, b in runs[k]:
                a, b = a - int(starts[k]), b - int(starts[k])
                chars += len(own[done:a].decode("utf-8", "replace"))
                points.append((chars, chars + b - a))
                chars, done = chars + b - a, b
            free = _uncovered(points, spans)
            spans += novel_spans(text, free, params)
        out[k] = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 params: SecretParams = SecretParams()) -> DataFrame:
    """(doc_id, spans): per document row its spans (kind, start, end) in code points, end exclusive.

    Kinds ``assign``, ``access`` and ``hex`` are all matches of the fixed patterns; ``novel`` spans
    are added where those don't cover them. Null and empty texts have no spans; repeated rows each
    keep their row. No shuffle; memory is bounded by a slice of rows or the longest text.
    """
    def run(batches):
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(1))
            for i, j in bs.row_slices(offsets):
                found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in scan_rows(offsets, data, i, j, params)]
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(found, _SPANS)], ["doc_id", "spans"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact_secrets(documents: DataFrame, text_col: str = "text", mask: str = "[SECRET]",
                   params: SecretParams = SecretParams()) -> DataFrame:
    """The documents with every span (overlaps merged) replaced by ``mask``; all columns stay.

    A null text stays null; a text without spans stays as it is, byte for byte.
    """
    at = documents.columns.index(text_col)

    def run(batches):
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(at))
            for i, j in bs.row_slices(offsets):
                part, spans = batch.slice(i, j - i), scan_rows(offsets, data, i, j, params)
                if any(spans):
                    texts = part.column(at).to_pylist()
                    for k, own in enumerate(spans):
                        if own:
                            texts[k] = _masked(texts[k], own, mask)
                    part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
                yield part

    return documents.mapInArrow(run, documents.schema)


def _masked(text: str, spans: list[tuple[str, int, int]], mask: str) -> str:
    out, done = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= done:
            out += [text[done:a], mask]
        done = max(done, b)
    return "".join(out) + text[done:]
