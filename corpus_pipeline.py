"""A corpus pipeline of five stages over ``documents``; each works on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to
the shared folder and reads it back as the next stage's input. All stages but the last return the
columns of documents. Empty inputs give empty outputs; null texts are rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, decontaminate, langid, near_dedup, secrets
from tillroll.llm.queries import tokenizer
from tillroll.llm.scratch import parted, prepare, row_key, without, written

#: Near copies are linked from a similarity of 0.8 (85 % belongs to the op9 query): 50 bands of 6
#: minima share none at 0.8 with probability 2.5e-7.
NEAR = near_dedup.NearDedupParams(percent=80, bands=50)


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents whose language can't be told (``und``: no letter at all) go; the
    others take the predicted language as theirs."""
    prepare(spark)
    found = langid.identify_languages(docs)
    return found.filter("lang_pred <> 'und'").select(
        *[F.col("lang_pred").alias("lang") if c == "lang" else c for c in docs.columns])


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9 at a similarity of 0.8: of each group of linked rows only that with the smallest
    doc_id stays (rows without one come last; of equal ids and of none that with the smallest key).

    Decisions go by row (id and text): different texts under one id are documents of their own, and
    of rows with equal id and text one stays. Only rows that go or repeat, which are found on keys
    alone, are shuffled.
    """
    prepare(spark)
    rows = docs.withColumn("__row_key", row_key("doc_id", "text"))
    found = near_dedup.linked_rows(docs, params=NEAR).groupBy(F.col("key").alias("__key")).agg(
        F.count("*").alias("__rows"), F.max("first").alias("__first"))
    special = written(found.filter("not __first or __rows > 1"), "special")
    plain, rest = parted(rows, "__row_key", special, "__key")
    looked_up = rest.join(special, rest["__row_key"] == special["__key"], "left")
    stays = looked_up.filter("__rows is null").select(*_columns(docs))
    one = F.min(F.struct(*_columns(docs))).alias("__one")
    repeated = looked_up.filter("__first and __rows > 1").groupBy("__key").agg(one).select(*[F.col(f"__one.`{c}`") for c in docs.columns])
    return plain.select(*_columns(docs)).unionByName(stays).unionByName(repeated)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a window of a benchmark item go, row by row (id and text)."""
    prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontaminate.decontaminate(docs, benchmark).filter("n_hit > 0").select(F.col("row_key").alias("__hit")).distinct()
    rows = docs.withColumn("__row_key", row_key("doc_id", "text"))
    return without(rows, "__row_key", written(hit, "hit"), "__hit").select(*_columns(docs))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: secrets in the texts are masked; every document stays, n_chars follows."""
    prepare(spark)
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids of each text, with the digests of ids and of the decoded bytes."""
    prepare(spark)
    return bpe.encode_documents(docs, *tokenizer())


STAGES = [("language ID", identify), ("MinHash near-dedup", deduplicate), ("benchmark decontamination", clean_of_benchmark),
          ("secret scans", redact), ("byte-level BPE", tokenize)]

#: The first stage is a learned model and the last one a tokenizer: SQL has no words for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
