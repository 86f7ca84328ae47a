"""Language identification by a string kernel.

Kernel: blended-spectrum presence kernel, the number of distinct character n-grams (1 to 3) that
two texts share, normalised by the geometric mean of their own counts. An n-gram is a run of
lower-cased letters and marks of any script, or of these and a gap between words; it is counted by
the slot (of 2**18) that its code points hash to. Nystroem: texts are described by their kernel
values to a few landmark texts, whitened by the landmarks' own kernel matrix. On these features one
ridge regression per language (one versus rest) is fitted; its weights are folded back onto the
landmarks, so scoring a batch is two matrix products.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tillroll.llm import bytesets as bs

_SLOT_BITS = 18
N_GRAMS = 1 << _SLOT_BITS
_ROWS = 64
_PIECE = 1 << 20  # code points that one step over a text covers
_SPARSE = N_GRAMS // 32  # fewer slots than these are sent as numbers, others as a bit set
_SEEDS = bs.seeded(3, 29)
_ANY = (1 << 63) - 1


@dataclass(frozen=True)
class LangParams:
    """Bounds of what is fitted on the driver: ``per_language`` labelled texts of each language, and
    ``max_texts`` in all, shared evenly (one at least for each language), a text being 33 KB at most;
    of these the first ``landmarks`` of each language are landmarks, ``max_landmarks`` in all, dealt
    to the languages in turns. Every language with a labelled text is learnt (from its likeness to
    other languages' landmarks if there are more languages than landmarks), and prediction has no
    bounds."""

    per_language: int = 300
    max_texts: int = 12_000
    landmarks: int = 24
    max_landmarks: int = 480
    ridge: float = 1e-2
    seed: int = 5


@dataclass(frozen=True)
class LangModel:
    languages: list[str]
    vocabulary: np.ndarray  # n-gram codes that occur in a landmark
    landmarks: np.ndarray  # presence of each of them (row) in each landmark (column)
    norms: np.ndarray  # square root of each landmark's number of n-grams
    weights: np.ndarray  # landmark kernel values to language scores
    bias: np.ndarray


_letters: tuple[np.ndarray, np.ndarray] | None = None


def letter_table() -> tuple[np.ndarray, np.ndarray]:
    """Per code point its lower-case form, 0 if it is neither a letter nor a mark, and whether it is a letter."""
    global _letters
    if _letters is None:
        folded, letter = np.zeros(0x110000, np.uint64), np.zeros(0x110000, bool)
        for c in range(0x110000):
            s = chr(c)
            letter[c] = s.isalpha()
            if letter[c] or unicodedata.category(s)[0] == "M":
                folded[c] = ord(s.lower()[0])
        _letters = folded, letter
    return _letters


def gram_slots(text: str) -> Iterator[np.ndarray]:
    """Slots of the text's character n-grams (with repeats), piece by piece; none if it has no letter."""
    folded, letter = letter_table()
    gap = np.zeros(1, np.uint64)
    before, seen, held = gap, False, []
    for at in range(0, len(text), _PIECE):
        points = np.frombuffer(text[at:at + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        seen = seen or bool(letter[points].any())
        c = np.concatenate([before, folded[points], gap if at + _PIECE >= len(text) else gap[:0]])
        c = c[np.concatenate([[True], (c[1:] > 0) | (c[:-1] > 0)])]  # one gap between words, whatever stands there
        if not len(c) > len(before):
            continue
        two = (c[:-1] << np.uint64(21)) | c[1:]
        three = (two[:-1] << np.uint64(21)) | c[2:]
        old = len(before)
        slots = [bs.mix64(g ^ seed) >> np.uint64(64 - _SLOT_BITS)
                 for g, seed in zip((c[old:], two[old - 1:], three[max(old - 2, 0):]), _SEEDS)]
        # Marks before the first letter count only if a letter follows.
        held.append(np.unique(np.concatenate(slots)).astype(np.int64))
        if seen:
            yield from held
            held = []
        before = c[-2:]


def _presence(texts: pa.Array):
    """Per text its n-gram flags (one shared buffer) or None if it has no letter."""
    flags = np.zeros(N_GRAMS, bool)
    for value in texts:
        known = False
        for slots in gram_slots(value.as_py() or ""):
            flags[slots] = known = True
        yield flags if known else None
        flags[:] = False


def pack(flags: np.ndarray) -> bytes:
    """The flags as the numbers of the few that are set, or as a bit set."""
    at = np.flatnonzero(flags)
    return at.astype("<u4").tobytes() if len(at) < _SPARSE else np.packbits(flags).tobytes()


def unpack(grams: bytes) -> np.ndarray:
    if len(grams) == N_GRAMS // 8:
        return np.unpackbits(np.frombuffer(grams, np.uint8)).astype(bool)
    flags = np.zeros(N_GRAMS, bool)
    flags[np.frombuffer(grams, "<u4")] = True
    return flags


def _by_language(limits: dict[str, int], lang: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[lang] if limits else F.lit(None).cast("long")


def training_rows(documents: DataFrame, text_col: str, lang_col: str, usable: Column, id_col: str,
                  params: LangParams) -> DataFrame:
    """(lang, order, grams) of the bounded training sample; grams as :func:`pack` gives them.

    Which texts: the first of each language by a hash of id and text, equal rows counting once. The
    numbers of different rows by language (approximate, which only has to leave enough) give a
    limit that few rows of each language pass, and only these are ranked; so no task gets more
    than some thousand short rows of a language, however many there are. Texts are hashed and
    filtered where they are read and never shuffled.
    """
    lang, order = F.col(lang_col), F.xxhash64(id_col, text_col, F.lit(params.seed))
    labelled = documents.filter(usable & lang.isNotNull() & F.col(text_col).isNotNull())
    rows = labelled.select(lang.alias("lang"), order.alias("order"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("order").alias("n")).collect()}
    share = max(1, min(params.per_language, params.max_texts // max(1, len(sizes))))
    enough = 3 * share + 30
    passing = {k: _ANY if n <= enough else int((enough / n - 0.5) * 2.0 ** 64) for k, n in sizes.items()}
    ranked = (rows.filter(F.col("order") <= _by_language(passing, F.col("lang"))).distinct()
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order"))))
    last = {r["lang"]: r["last"] for r in ranked.filter(F.col("rank") <= share).groupBy("lang").agg(F.max("order").alias("last")).collect()}
    chosen = labelled.filter(order <= _by_language(last, lang)).select(lang.alias("lang"), order.alias("order"), F.col(text_col).alias("text"))

    def run(batches):
        done = set()
        for batch in batches:
            new = []
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key not in done:
                    done.add(key)
                    new.append(i)
            batch = batch.take(pa.array(new, pa.int64()))
            grams = [None if f is None else pack(f) for f in _presence(batch.column(2))]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(grams, pa.binary())], ["lang", "order", "grams"])

    sample = chosen.mapInArrow(run, "lang string, order long, grams binary").filter("grams is not null")
    return sample.groupBy("lang", "order").agg(F.first("grams").alias("grams"))


def fit(rows: list[tuple[str, int, bytes]], params: LangParams = LangParams()) -> LangModel:
    """The model from the collected sample (lang, order, grams); no rows give a model without languages."""
    by_lang: dict[str, list[bytes]] = {}
    for lang, _, grams in sorted(rows, key=lambda r: (r[0], r[1])):
        by_lang.setdefault(lang, []).append(bytes(grams))
    languages = sorted(by_lang)
    chosen = [(k, g) for k, lang in enumerate(languages) for g in by_lang[lang][:params.per_language]]
    turns = [by_lang[lang][i] for i in range(params.landmarks) for lang in languages if i < len(by_lang[lang])]
    marks = [unpack(g) for g in turns[:params.max_landmarks]]
    if not marks:
        return LangModel([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    vocabulary = np.flatnonzero(np.logical_or.reduce(marks))
    landmarks = np.stack([m[vocabulary] for m in marks], axis=1).astype(np.float32)
    norms = np.sqrt([m.sum() for m in marks])
    among = landmarks.T @ landmarks / np.outer(norms, norms)
    values, vectors = np.linalg.eigh(among.astype(np.float64))
    kept = values > 1e-8 * values.max()
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    kernel = np.empty((len(chosen), len(marks)))
    for i, (_, grams) in enumerate(chosen):
        flags = unpack(grams)
        kernel[i] = flags[vocabulary].astype(np.float32) @ landmarks / (np.sqrt(flags.sum()) * norms)
    features = kernel @ whiten
    centre = features.mean(axis=0)
    target = np.where(np.array([k for k, _ in chosen])[:, None] == np.arange(len(languages)), 1.0, -1.0)
    middle = target.mean(axis=0)
    shifted = features - centre
    solved = np.linalg.solve(shifted.T @ shifted + params.ridge * len(chosen) / len(marks) * np.eye(shifted.shape[1]),
                             shifted.T @ (target - middle))
    return LangModel(languages, vocabulary, landmarks, norms, whiten @ solved, middle - centre @ solved)


def score_texts(texts: pa.Array, model: LangModel) -> tuple[list[str], np.ndarray]:
    """Predicted language and score (0 to 1) of each text."""
    rows, own = np.zeros((len(texts), len(model.vocabulary)), np.float32), np.zeros(len(texts))
    for i, flags in enumerate(_presence(texts)):
        if flags is not None:
            rows[i] = flags[model.vocabulary]
            own[i] = np.count_nonzero(flags)
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    kernel = rows @ model.landmarks / (np.sqrt(np.maximum(own, 1))[:, None] * model.norms)
    margin = np.clip((kernel @ model.weights + model.bias + 1) / 2, 1e-9, 1)
    best = margin.argmax(axis=1)
    share = margin[np.arange(len(best)), best] / margin.sum(axis=1)
    known = own > 0
    return [model.languages[b] if k else "und" for b, k in zip(best, known)], np.where(known, share, 0.0)


def identify_languages(documents: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
                       text_col: str = "text", lang_col: str = "lang", params: LangParams = LangParams()) -> DataFrame:
    """The documents with ``lang_pred`` and ``lang_score`` added (replaced, if they exist).

    ``usable`` says which rows with a language the model may learn from (all, if not given). Text
    alone is the input of a prediction. Null texts and texts without a letter are ``und`` with
    score 0; without a single labelled text every row is. All columns and all rows stay; repeated
    rows get equal predictions. Prediction is one pass without a shuffle; the broadcast model is
    bounded by the parameters.
    """
    sample = training_rows(documents, text_col, lang_col, F.lit(True) if usable is None else usable, id_col, params)
    model = documents.sparkSession.sparkContext.broadcast(fit([tuple(r) for r in sample.collect()], params))
    base = documents.drop("lang_pred", "lang_score")
    at = base.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                part = batch.slice(i, _ROWS)
                langs, scores = score_texts(part.column(at), model.value)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores)],
                                                 names=[*part.schema.names, "lang_pred", "lang_score"])

    out = StructType([*base.schema.fields]).add("lang_pred", StringType()).add("lang_score", DoubleType())
    return base.mapInArrow(run, out)
