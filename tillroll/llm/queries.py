"""The registered queries of the operators and the pipeline, and DuckDB SQL where it exists.

Each query applies its operator with production parameters to its whole table and derives the
digest columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, chat, clustering, decontaminate, html_text, langid, merkle, near_dedup, quality, repair, secrets, token_files, warc
from tillroll.llm.scratch import prepare, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(column: str, divisor: int) -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(divisor))


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _is(_remainder("doc_id", 3) == 1)
    found = langid.identify_languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_and_compare(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        F.size("edited_at").alias("n_edited_paragraphs"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.render_pages(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _is(_remainder("doc_id", 5) == 0)
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
                         "passages", "top_passage")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    records = warc.read_archives(manifest, with_bytes=False).filter("last")
    page = lambda c: F.regexp_extract(c, "<urn:record:(-?[0-9]+)>", 1).try_cast("long")
    return records.select(
        page("record_id").alias("page_id"),
        F.coalesce("payload_length", F.col("offset") + F.col("length")).alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        page("refers_to").alias("refers_to"),
        # Whether the bytes read back have the digest that the record states (revisits hold none).
        F.when(F.col("record_type") == "response", F.hex("running_sha1")).alias("read_sha1"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def tokenizer() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), *tokenizer(), digests_only=True, cache_size=1_000_000).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


#: The conversation that the query adds: control strings of several templates inside its texts.
PROBE = r"\### Assistant: </turn> ok"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return chat.digest_conversations(chat.format_turns(turns.unionByName(probe)))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with one row in four damaged, by a checksum of conversation and turn."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    rows = conversations.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = damaged(conversations)
    repairs = written(repair.plan_repairs(turns), "repairs")
    digests = repair.digest_repaired(repair.repaired_turns(turns, repairs))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (every.join(repairs, every["conv_id"].eqNullSafe(repairs["conv_id"]), "left")
            .join(digests, every["conv_id"].eqNullSafe(digests["conv_id"]), "left")
            .select(every["conv_id"], *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.describe_clusters(*clustering.cluster_vectors(table(spark, sf_dir, "embeddings")))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    documents = table(spark, sf_dir, "documents")
    encoded = token_files.encode_documents(documents, public_tokenizers.path("word_bpe_49k.json"))
    manifest = token_files.write_token_files(encoded, token_files.token_folder(spark), doc_ids=documents.select("doc_id"))
    return token_files.read_token_files(manifest, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_language, op2_merkle, op3_html, op4_quality, op5_warc, op6_decontaminate, op7_bpe, op8_chat, op9_near_dedup, op10_secrets, op11_repair, op12_clusters, op13_token_files)
    return {f.__name__: f for f in own} | {"pipeline": pipeline}
