"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages (runs of whole words). Each passage is encoded by its character
make-up and its words' repetition; a hidden layer turns the code into h. Gated attention gives
each passage the weight softmax(w . (tanh(V h) * sigmoid(U h))), and the score is a logistic
function of the weighted sum of the h. Only documents have labels: encoder, attention and output
are trained together on them by full gradients.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import bytesets as bs

#: Byte kinds: letters of either case, digits, white space, sentence marks, other ASCII, UTF-8 leads and trails.
_KINDS = 9
_KIND = np.full(256, 6, np.uint8)
_KIND[ord("a"):ord("z") + 1] = 0
_KIND[ord("A"):ord("Z") + 1] = 1
_KIND[ord("0"):ord("9") + 1] = 2
_KIND[[0x20, 9, 10, 11, 12, 13]] = 3
_KIND[list(b".,;:'\"?-()")] = 4
_KIND[list(b"|<>{}[]=/\\")] = 5
_KIND[0x80:0xC0] = 8
_KIND[0xC0:] = 7
_SPACE = bs.byte_table("\x20\x09\x0a\x0b\x0c\x0d")
N_FEATURES = 16


@dataclass(frozen=True)
class QualityParams:
    """``words``: words of a passage; ``sample``: most labelled documents to learn from (the first
    by a hash of the id) and ``sample_passages``: larger documents aren't learnt from. The network
    has ``hidden`` units and ``gates`` attention units. Scoring has no bounds."""

    words: int = 64
    sample: int = 4000
    sample_passages: int = 512
    hidden: int = 16
    gates: int = 8
    steps: int = 400
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 3


def encode_passages(offsets: np.ndarray, data: np.ndarray, i: int, j: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Passage codes of rows i..j and the number of passages per row (one, all zero but the last
    feature, for a text without words)."""
    text, starts = bs.joined(offsets, data, i, j)
    begin, end = bs.word_spans(text, _SPACE)
    hashes = bs.word_hashes(bs.LOWER[text], begin, end)
    first = np.searchsorted(begin, starts)
    n_words = np.diff(first)
    counts = np.maximum(1, -(-n_words // words))
    out = np.zeros((int(counts.sum()), N_FEATURES))
    place = np.concatenate([[0], np.cumsum(counts)])
    of_word = place[np.repeat(np.arange(j - i), n_words)] + (np.arange(len(begin)) - np.repeat(first[:-1], n_words)) // words
    if len(begin):
        limits = np.flatnonzero(np.concatenate([[True], of_word[1:] != of_word[:-1]]))
        used = of_word[limits]  # passages with words
        size = np.diff(np.append(limits, len(begin))).astype(float)
        kind = _KIND[text]
        lo, hi = begin[limits], end[np.append(limits[1:], len(begin)) - 1]
        width = (hi - lo).astype(float)
        sums = np.zeros(len(text) + 1, np.int32)
        for k in range(_KINDS):
            np.cumsum(kind == k, out=sums[1:])
            out[used, k] = (sums[hi] - sums[lo]) / width
        length = (end - begin).astype(float)
        mean = np.add.reduceat(length, limits) / size
        out[used, 9] = np.log1p(mean)
        out[used, 10] = np.log1p(np.sqrt(np.maximum(0, np.add.reduceat(length ** 2, limits) / size - mean ** 2)))
        order = np.lexsort((hashes, of_word))
        fresh = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])])
        out[used, 11] = np.add.reduceat(fresh.astype(float), limits) / size  # distinct words
        again = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])])
        out[used, 12] = np.add.reduceat(again.astype(float), limits) / size  # the same word twice running
        last = _KIND[text[end - 1]]
        out[used, 13] = np.add.reduceat((last >= 5).astype(float) * (last <= 6), limits) / size  # words that end in a symbol
        out[used, 14] = np.log1p(size) / np.log1p(words)
    out[:, 15] = 1.0
    return out, counts


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    value: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    output: np.ndarray
    bias: float

    def attention(self, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight of each passage, score of each document)."""
        h = np.tanh(((codes - self.mean) / self.scale) @ self.encode)
        logit = (np.tanh(h @ self.value) / (1 + np.exp(-(h @ self.gate)))) @ self.attend
        edges = np.concatenate([[0], np.cumsum(counts)])[:-1]
        weight = np.exp(logit - np.repeat(np.maximum.reduceat(logit, edges), counts))
        weight /= np.repeat(np.add.reduceat(weight, edges), counts)
        pooled = np.add.reduceat(weight[:, None] * h, edges)
        return weight, 1 / (1 + np.exp(-np.clip(pooled @ self.output + self.bias, -40, 40)))


def fit(bags: list[np.ndarray], labels: np.ndarray, params: QualityParams = QualityParams()) -> QualityModel:
    """The model from encoded bags and 0/1 labels; without labels of both kinds it scores their share."""
    random = np.random.default_rng(params.seed)
    codes = np.concatenate(bags) if bags else np.zeros((1, N_FEATURES))
    counts = np.array([len(b) for b in bags] or [1])
    labels = np.asarray(labels, float)
    mean, scale = codes.mean(axis=0), codes.std(axis=0)
    scale[scale < 1e-6] = 1.0
    x = (codes - mean) / scale
    p = {"E": random.normal(0, 0.3, (N_FEATURES, params.hidden)), "V": random.normal(0, 0.3, (params.hidden, params.gates)),
         "U": random.normal(0, 0.3, (params.hidden, params.gates)), "a": random.normal(0, 0.3, params.gates),
         "o": random.normal(0, 0.3, params.hidden), "b": np.zeros(1)}
    share = float(labels.mean()) if len(labels) else 0.5
    p["b"][0] = np.log((share + 1e-3) / (1 - share + 1e-3))
    if not len(labels) or share in (0.0, 1.0):
        return QualityModel(mean, scale, p["E"], p["V"], p["U"], p["a"], p["o"] * 0, float(p["b"][0]))
    edges = np.concatenate([[0], np.cumsum(counts)])[:-1]
    moment, square = {k: v * 0 for k, v in p.items()}, {k: v * 0 for k, v in p.items()}
    for step in range(1, params.steps + 1):
        h = np.tanh(x @ p["E"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        logit = (t * g) @ p["a"]
        w = np.exp(logit - np.repeat(np.maximum.reduceat(logit, edges), counts))
        w /= np.repeat(np.add.reduceat(w, edges), counts)
        z = np.add.reduceat(w[:, None] * h, edges)
        score = 1 / (1 + np.exp(-(z @ p["o"] + p["b"])))
        d = (score - labels) / len(labels)
        dz = np.repeat(d[:, None] * p["o"], counts, axis=0)
        dw = (dz * h).sum(axis=1)
        dl = w * (dw - np.repeat(np.add.reduceat(w * dw, edges), counts))
        dt, dg = dl[:, None] * p["a"] * g * (1 - t ** 2), dl[:, None] * p["a"] * t * g * (1 - g)
        dh = (w[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h ** 2)
        grads = {"E": x.T @ dh, "V": h.T @ dt, "U": h.T @ dg, "a": ((t * g) * dl[:, None]).sum(axis=0), "o": z.T @ d, "b": d.sum(keepdims=True)}
        for k, grad in grads.items():
            grad = grad + params.decay * p[k] * (k != "b")
            moment[k] = 0.9 * moment[k] + 0.1 * grad
            square[k] = 0.999 * square[k] + 0.001 * grad ** 2
            p[k] = p[k] - params.rate * (moment[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
    return QualityModel(mean, scale, p["E"], p["V"], p["U"], p["a"], p["o"], float(p["b"][0]))


def _training_bags(documents: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str,
                   label_col: str, params: QualityParams) -> list[tuple[np.ndarray, int]]:
    """Encoded passages and label of the bounded sample; only codes reach the driver."""
    order = F.xxhash64(id_col, F.lit(params.seed))
    marked = (labels.filter(usable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(id_col).agg(F.max(label_col).cast("int").alias("label")))
    last = marked.select(order.alias("order")).orderBy("order").limit(params.sample).agg(F.max("order")).first()[0]
    if last is None:
        return []
    chosen = (documents.select(F.col(id_col), F.col(text_col).alias("text")).filter(order <= last)
              .join(marked.filter(order <= last), id_col).select(F.col(id_col).cast("long").alias("doc_id"), "text", "label"))
    words, most = params.words, params.sample_passages

    def run(batches):
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(1))
            for i, j in bs.row_slices(offsets):
                codes, counts = encode_passages(offsets, data, i, j, words)
                parts = np.split(codes.astype(np.float32), np.cumsum(counts)[:-1])
                yield pa.record_batch([
                    batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                    pa.array([p.tobytes() if len(p) <= most else None for p in parts], pa.binary())], ["doc_id", "label", "codes"])

    rows = chosen.mapInArrow(run, "doc_id long, label int, codes binary").filter("codes is not null").collect()
    return [(np.frombuffer(r["codes"], np.float32).reshape(-1, N_FEATURES).astype(float), r["label"])
            for r in sorted(rows, key=lambda r: (r["doc_id"], bytes(r["codes"])))]


def score_quality(documents: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality", params: QualityParams = QualityParams()) -> DataFrame:
    """(doc_id, score, passages, top_passage): per document row the probability of label 1, its
    number of passages and the one with the largest attention weight (from 0).

    ``labels`` (id, label) marks some documents; ``usable`` says which of its rows may be learnt
    from. Labels repeated for an id count once (the largest); null labels are left out. Null and
    wordless texts are scored as one empty passage. Without labels of both kinds every text gets
    their share, 0.5 if there are none. Scoring is one pass without a shuffle.
    """
    sample = _training_bags(documents, labels, F.lit(True) if usable is None else usable, id_col, text_col, label_col, params)
    model = documents.sparkSession.sparkContext.broadcast(fit([b for b, _ in sample], np.array([y for _, y in sample]), params))
    words = params.words

    def run(batches):
        for batch in batches:
            offsets, data = bs.string_buffers(batch.column(1))
            for i, j in bs.row_slices(offsets):
                codes, counts = encode_passages(offsets, data, i, j, words)
                weight, score = model.value.attention(codes, counts)
                edges = np.concatenate([[0], np.cumsum(counts)])
                top = [int(weight[a:b].argmax()) for a, b in zip(edges[:-1], edges[1:])]
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(score), pa.array(counts.astype(np.int64)),
                                       pa.array(top, pa.int64())], ["doc_id", "score", "passages", "top_passage"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, score double, passages long, top_passage long")
