"""Elias-Fano sequences and token files against plain arrays and the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import token_files
from tillroll.llm.elias_fano import EliasFano
from tillroll.llm.queries import op13_token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(-2 ** 62, 2 ** 62)), max_size=300))
def test_sequences_come_back(values):
    values = sorted(values)
    if values and values[-1] - values[0] >= 2 ** 63:
        values = [v for v in values if v >= 0]
    seq = EliasFano.from_bytes(EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert len(seq) == len(values) and seq[np.arange(len(values))].tolist() == values
    assert [seq[k] for k in range(0, len(values), 7)] == values[::7]


def test_sparse_and_dense_sequences_and_their_space():
    rng = np.random.default_rng(1)
    for top in (10, 10_000, 10 ** 9, 10 ** 15):
        values = np.sort(rng.integers(0, top, 20_000))
        seq = EliasFano.of(values)
        assert (seq[np.arange(20_000)] == values).all()
        low = max(0, int(np.log2(max(1, top / 20_000))))
        assert len(seq.to_bytes()) * 8 <= 20_000 * (low + 3.6) + 1024
    far = np.array([0] * 5000 + [1 << 40] * 5000)
    assert (EliasFano.of(far)[np.arange(10_000)] == far).all()
    with pytest.raises(ValueError):
        EliasFano.of([2, 1])
    with pytest.raises(IndexError):
        EliasFano.of([1, 2])[2]


def _library(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


WORDY = "It's  the\tsame text\n\nas they'll see: 3.14, «ÉCOLE» naïve é İstanbul ΟΔΟΣ 漢字 🙂🙂<|endoftext|>x <|startoftext|> \x00 a b"


@pytest.mark.parametrize("cache", [3, 1000])
def test_words_are_encoded_as_whole_texts_are(cache, monkeypatch):
    monkeypatch.setattr(token_files, "_CUT_FROM", 50)
    encoder = token_files.WordEncoder(PATH, 2, cache)
    assert encoder.by_word
    for text in (WORDY, "", " ", "\n \n", "a" * 500, WORDY * 5, " x ", "word " * 40, "́ ́a ̸b", "ﬁ ſ ǅ \r\n\r x"):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == _library(text)
        assert len(encoder.young) <= max(cache, 64)


class _Counting(dict):
    """A memory that counts how often it is asked."""

    asked = 0

    def __getitem__(self, word):
        self.asked += 1
        return super().__getitem__(word)

    def get(self, word, default=None):
        self.asked += 1
        return super().get(word, default)


def test_python_handles_each_different_word_of_some_texts_once():
    encoder = token_files.WordEncoder(PATH, 2, 1000)
    encoder.young = _Counting()
    texts = ["the same words\n" * 500, "", "Words, words  the" * 500, "漢字 é"]
    for _ in range(2):
        assert [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode_many(texts)] == [_library(t) for t in texts]
    assert encoder.young.asked < 50


def test_memory_keeps_its_limit_when_one_text_has_more_words():
    encoder, text = token_files.WordEncoder(PATH, 2, 10), " ".join(f"word{k}" for k in range(300))
    for _ in range(3):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == _library(text)
        assert len(encoder.young) <= 10 and len(encoder.old) <= 10


def test_other_tokenizers_get_whole_texts():
    other = token_files.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), 2, 10)
    assert not other.by_word and len(other.encode("two words")) > 0


ROWS = [(5, WORDY), (None, "no id"), (3, None), (-2, "minus two"), (5, "again five"), (9, ""), (5, WORDY), (None, "a second"), (70, "long words " * 9000)]


@pytest.mark.parametrize("params", [{}, {"file_ids": 8, "piece": 16}, {"file_docs": 2}, {"width": 4}])
def test_files_hold_the_documents_in_order(make, tmp_dir, params):
    params = token_files.TokenFileParams(**params)
    encoded = token_files.encode_documents(make(ROWS, extra=["deal", "ids", "path"]), PATH, params=params)
    manifest = token_files.write_token_files(encoded, tmp_dir, params, ranges=3)
    got = sorted(token_files.read_token_files(manifest, params).collect(), key=lambda r: r["document"])
    kind = f"<u{params.width}"
    expected = sorted(((i is not None, i or 0, np.array(_library(t) + [2], kind).tobytes()) for i, t in ROWS))
    start = 0
    assert [r["document"] for r in got] == list(range(len(ROWS)))
    for row, (named, doc_id, ids) in zip(got, expected):
        own = np.frombuffer(ids, kind)
        assert (row["doc_id"], bytes(row["ids"])) == (doc_id if named else None, ids)
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(own), zlib.crc32(own.astype("<u4").tobytes()))
        start += len(own)
    files = manifest.collect()
    assert sum(r["documents"] for r in files) == len(ROWS) and sum(r["ids"] for r in files) == start
    opened = token_files.TokenFile(files[0]["path"])
    assert opened.document(0).tolist() == np.frombuffer(bytes(got[0]["ids"]), kind).tolist()


@pytest.mark.parametrize("cuts", [[], [4], [-5, 0, 1], list(range(-20, 60, 7)), [-2 ** 63, 3, 2 ** 63 - 1]])
def test_rows_are_dealt_by_the_cuts_below_their_id(spark, cuts):
    values = [None, -2 ** 63, 2 ** 63 - 1, *range(-25, 65)]
    rows = spark.createDataFrame([(v,) for v in values], "doc_id long")
    got = {r[0]: r[1] for r in rows.select("doc_id", token_files._number_below(cuts, rows["doc_id"])).collect()}
    assert got == {v: 0 if v is None else int(np.searchsorted(cuts, v, "left")) for v in values}


def test_texts_pass_through_python_once_before_the_shuffle(make, tmp_dir, monkeypatch):
    plans, kept = [], token_files.written
    monkeypatch.setattr(token_files, "written", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or kept(df, name))
    token_files.write_token_files(token_files.encode_documents(make(ROWS), PATH), tmp_dir, ranges=3).collect()
    (plan,) = plans
    physical = plan[plan.index("== Physical Plan"):]
    assert physical.count("MapInArrow") == 2  # encoding, and writing after the shuffle


def _many_files(make, folder, params):
    encoded = token_files.encode_documents(make([(k, f"text {k}") for k in range(90)]), PATH, params=params)
    return token_files.write_token_files(encoded, folder, params, ranges=30)


def test_the_manifest_of_many_files_is_written_by_one_task(make, tmp_dir, monkeypatch):
    tables, kept = [], token_files.written
    monkeypatch.setattr(token_files, "written", lambda df, name: tables.append(kept(df, name)) or tables[-1])
    manifest = _many_files(make, tmp_dir, token_files.TokenFileParams())
    assert manifest.count() == 30 and len(tables[0].inputFiles()) == 1


@pytest.mark.parametrize("task_ids", [4 << 20, 10, 1])
def test_reading_tasks_follow_cores_and_ids(make, tmp_dir, spark, task_ids):
    params = token_files.TokenFileParams(file_docs=1, task_ids=task_ids)
    manifest = _many_files(make, tmp_dir, params)
    read = token_files.read_token_files(manifest, params)
    got = sorted(read.select("doc_id", "document", "start", "n_tokens").collect())
    ids = sum(r["n_tokens"] for r in got)
    assert read.rdd.getNumPartitions() == min(90, max(2 * spark.sparkContext.defaultParallelism, -(-ids // task_ids)))
    assert [r["doc_id"] for r in got] == [r["document"] for r in got] == list(range(90))
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:k]) for k in range(90)]


def test_empty_table_and_foreign_files(make, tmp_dir):
    manifest = token_files.write_token_files(token_files.encode_documents(make([]), PATH), tmp_dir)
    assert manifest.collect() == [] and token_files.read_token_files(manifest).collect() == []
    with open(f"{tmp_dir}/x.tokens", "wb") as out:
        out.write(b"short")
    with pytest.raises(ValueError):
        token_files.TokenFile(f"{tmp_dir}/x.tokens")


def test_query_against_the_library(spark):
    import pyarrow.parquet as pq
    from tests.conftest import SMALL_SF
    from tokenizers import Tokenizer
    docs = pq.read_table(f"{SMALL_SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    docs.sort(key=lambda d: d["doc_id"])
    library, start, expected = Tokenizer.from_file(PATH), 0, []
    for d in docs:
        ids = np.array(library.encode(d["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op13_token_files(spark, SMALL_SF).collect())) == expected
