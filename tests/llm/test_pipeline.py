"""The pipeline against a plain Python version of its decisions."""

import corpus_pipeline
from tests.llm.test_near_dedup import brute, corpus
from tests.llm.test_text_operators import brute_hits

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0 if t is None else len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_keep_and_drop_the_right_rows(spark, tmp_dir):
    rows = corpus(3, n_base=10) + [(5000, None), (5001, "123 456 !!"), (5002, "one two three four five six seven eight nine ten eleven"),
                                   (5003, "token = \"abcdef0123456789abcd\" and some other plain words of a text")]
    item = [(1, "Two three four five six seven eight nine ten eleven")]
    spark.createDataFrame(item, "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    _documents(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, tmp_dir).collect()}
    lettered = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    kept = {i for i, (_, _, k) in brute(lettered, 80).items() if k}
    assert set(out) == {i for i, t in lettered if i in kept and not brute_hits(t, item)[1]}
    assert {5000, 5001, 5002}.isdisjoint(out) and 5003 in out and corpus_pipeline.ORACLE_SQL is None


def test_stages_return_the_columns_of_documents(spark, tmp_dir):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = _documents(spark, [(1, "a b c token = abcdef0123456789"), (1, "a b d e f g"), (2, None), (None, "x y z"), (None, "x y z")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmp_dir)
        assert docs.columns == COLUMNS
    rows = sorted(map(tuple, docs.collect()), key=repr)
    assert rows == sorted([(1, "a b c [SECRET]", "en", "s", 14), (1, "a b d e f g", "en", "s", 11), (None, "x y z", "en", "s", 5)], key=repr)


def test_empty_documents(spark, tmp_dir):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    _documents(spark, []).write.parquet(f"{tmp_dir}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []


def test_near_copies_are_linked_from_a_similarity_of_80_percent(spark, tmp_dir):
    words = [f"v{k}" for k in range(100)]
    copy = lambda changed: " ".join("other" if k in changed else w for k, w in enumerate(words))
    # Of 96 shingles each inner change takes 5: the first two share 86 of 106 (0.81).
    rows = corpus(3, n_base=10) + [(5000, copy([])), (5001, copy([30, 70])), (5002, copy([10, 40, 60, 90]))]
    at_80, at_85 = ({i for i, (_, _, k) in brute(rows, percent).items() if k} for percent in (80, 85))
    got = {r["doc_id"] for r in corpus_pipeline.deduplicate(spark, _documents(spark, rows), tmp_dir).collect()}
    assert got == at_80 != at_85


def test_rows_without_an_id_are_deduplicated_and_cleaned(spark, tmp_dir):
    words = [f"v{k}" for k in range(100)]
    copy = lambda at: " ".join("other" if k == at else w for k, w in enumerate(words))
    alone = " ".join(f"u{k}" for k in range(100))
    docs = _documents(spark, [(7, copy(-1)), (None, copy(-1)), (None, copy(50)), (None, alone), (None, alone + " end"), (None, "a few other words")])
    out = [(r["doc_id"], r["text"]) for r in corpus_pipeline.deduplicate(spark, docs, tmp_dir).collect()]
    assert (7, copy(-1)) in out and (None, "a few other words") in out and len(out) == 3
    assert len({(None, alone), (None, alone + " end")} & set(out)) == 1
    spark.createDataFrame([(1, "some benchmark passage")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs = _documents(spark, [(None, "has some benchmark passage inside"), (None, "clean"), (3, "clean too"), (4, "some benchmark passage")])
    assert {r["text"] for r in corpus_pipeline.clean_of_benchmark(spark, docs, tmp_dir).collect()} == {"clean", "clean too"}


def test_a_unique_text_under_a_repeated_id_stays(spark, tmp_dir):
    a, b = (" ".join(f"{w}{k}" for k in range(40)) for w in "ab")
    docs = _documents(spark, [(1, a), (7, a), (7, b), (8, b + " end"), (9, b), (9, b), (None, a), (None, "c d e f g h"), (None, "c d e f g h")])
    out = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.deduplicate(spark, docs, tmp_dir).collect()), key=repr)
    assert out == sorted([(1, a), (7, b), (None, "c d e f g h")], key=repr)
    spark.createDataFrame([(1, a)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    out = {(r["doc_id"], r["text"]) for r in corpus_pipeline.clean_of_benchmark(spark, docs, tmp_dir).collect()}
    assert out == {(7, b), (8, b + " end"), (9, b), (None, "c d e f g h")}


def test_extra_columns_with_names_of_the_stages(spark, tmp_dir):
    from pyspark.sql import functions as F
    spark.createDataFrame([(1, "some benchmark passage")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    text = "a longer text of more than five words stands here"
    docs = _documents(spark, [(1, text), (2, text), (3, "has some benchmark passage inside it"), (4, "token = abcdef0123456789"), (4, "token = abcdef0123456789"), (5, None)])
    names = ["kept", "rows", "special_id", "__id", "key", "row", "first", "node", "row_key", "hit_id", "spans", "lang_pred"]
    for name in names:
        docs = docs.withColumn(name, F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmp_dir)
        assert docs.columns == COLUMNS + names
    assert sorted((r["doc_id"], r["text"], r["kept"]) for r in docs.collect()) == [(1, text, "x"), (4, "[SECRET]", "x")]
    assert corpus_pipeline.tokenize(spark, docs, tmp_dir).count() == 2


def test_every_stage_takes_long_texts(spark, tmp_dir):
    spark.createDataFrame([(1, "some benchmark passage")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    long = " ".join(f"word{k}" for k in range(60_000))
    docs = _documents(spark, [(1, long), (2, long + " end"), (3, "some benchmark passage " + long[:100_000]), (4, "y" * 300_000)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tmp_dir)
    assert sorted((r["doc_id"], r["n_chars"]) for r in docs.collect()) == [(1, len(long)), (4, 300_000)]
