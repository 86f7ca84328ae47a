"""Every operator on nulls, empty and very long texts, repeated rows, empty tables, clashing names."""

import hashlib

import pytest

from tillroll.llm import bpe, decontaminate, html_text, langid, merkle, near_dedup, quality, secrets

LONG = "alpha beta gamma delta epsilon zeta " * 30_000
ROWS = [(1, "the cat sat on the mat and the dog ran to the hill again"), (2, None), (3, ""), (4, "   \n\t "),
        (None, "a text without an id that has words"), (5, LONG), (6, "x" * 200_000), (7, "!!! 123 ???"),
        (1, "the cat sat on the mat and the dog ran to the hill again"), (8, "漢字かな交じり文 é🙂 ß")]


def _tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _operators(spark, make):
    bench = make([(1, "cat sat on the mat and the dog ran to the"), (2, None), (3, ""), (None, "alpha beta")], "item_id")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, 0, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return {
        "lang": lambda d: langid.identify_languages(d.withColumn("lang", d.text.substr(1, 0))),
        "merkle": merkle.edit_and_compare,
        "tree": merkle.fingerprints,
        "html": lambda d: html_text.render_pages(d, "doc_id", "text").withColumnRenamed("page_id", "doc_id"),
        "quality": lambda d: quality.score_quality(d, labels),
        "decontaminate": lambda d: decontaminate.decontaminate(d, bench),
        "bpe": lambda d: bpe.encode_documents(d, *_tokenizer()),
        "dedup": near_dedup.near_duplicates,
        "secrets": secrets.scan_secrets,
        "redact": secrets.redact_secrets,
    }


NAMES = ["lang", "merkle", "tree", "html", "quality", "decontaminate", "bpe", "dedup", "secrets", "redact"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_each_row(spark, make, clashes, name):
    out = _operators(spark, make)[name](make(ROWS, extra=clashes)).collect()
    assert len(out) == len(ROWS)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out) == sorted((i is None, i or 0) for i, _ in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, make, name):
    assert _operators(spark, make)[name](make([])).collect() == []


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("merkle", "dedup")])
def test_repeated_rows_are_equal(spark, make, name):
    out = [r for r in _operators(spark, make)[name](make(ROWS)).collect() if r["doc_id"] == 1]
    assert len(out) == 2 and out[0] == out[1]


def test_defined_results(spark, make):
    ops = _operators(spark, make)
    docs = make(ROWS)
    dedup = {r["doc_id"]: r for r in ops["dedup"](docs).collect()}
    assert [dedup[i]["n_shingles"] for i in (2, 3, 4)] == [0, 0, 0] and dedup[6]["n_shingles"] == 1
    assert dedup[3]["component_id"] == 3 and dedup[3]["kept"] and dedup[None]["kept"]
    assert dedup[5]["n_shingles"] == 6
    lang = {r["doc_id"]: r for r in ops["lang"](docs).collect()}
    assert all(lang[i]["lang_pred"] == "und" and lang[i]["lang_score"] == 0 for i in (2, 3, 4, 7))
    hit = {r["doc_id"]: r for r in ops["decontaminate"](docs).collect()}
    assert hit[1]["n_hit"] == 11 and list(hit[1]["item_ids"]) == ["1"]
    assert hit[5]["n_hit"] == 60_000 and list(hit[5]["item_ids"]) == []  # an item without an id
    assert hit[2]["n_words"] == 0 and list(hit[2]["spans"]) == []
    ids = {r["doc_id"]: r for r in ops["bpe"](docs).collect()}
    assert list(ids[2]["ids"]) == [] and ids[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert ids[5]["decoded_sha256"] == hashlib.sha256(LONG.encode()).hexdigest()
    assert {r["text"] for r in ops["redact"](docs).collect() if r["doc_id"] == 2} == {None}
