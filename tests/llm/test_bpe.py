import hashlib
from functools import cache

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martloom.llm import bpe
from martloom.llm.queries import TOKENIZER, op1_bpe

PATH = public_tokenizers.path(TOKENIZER)


@cache
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture
def theirs():
    return library()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 1\n\t'sé’ü中🙂\x1c\x85.!%<|>"), max_size=60))
def test_encode_like_the_library(text):
    ids = bpe.codec(PATH).encode(text).tolist()
    assert ids == library().encode(text, add_special_tokens=False).ids
    assert bpe.codec(PATH).decode(ids) == text


@pytest.mark.parametrize(
    "text",
    ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "x" * 5000, "thth " * 3000, "\n" * 999 + "a"],
)
def test_special_and_long(theirs, text):
    assert bpe.codec(PATH).encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_slabs_do_not_change_the_result(monkeypatch):
    text = "Und der the that's  12 34 é\n\n x " * 50
    whole = bpe.codec(PATH).encode(text).tolist()
    monkeypatch.setattr(bpe, "SLAB_CHARS", 10)
    monkeypatch.setattr(bpe, "SLAB_PIECES", 7)
    assert bpe.codec(PATH).encode(text).tolist() == whole


def test_cache_generations(monkeypatch, theirs):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    c = bpe.Codec(PATH)
    for text in ("one two three four five six one two", "one nine ten two"):
        assert c.encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_frame_edges(spark):
    rows = [(1, None, 7), (2, "", 7), (2, "", 7), (None, "ab ab", 8), (3, "no\x00o", None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, token_ids INT")
    out = bpe.decode(bpe.encode(df, PATH), PATH)
    assert out.columns == ["doc_id", "text", "token_ids", "decoded"]
    got = [tuple(r) for r in out.select("doc_id", "text", "decoded").collect()]
    assert got == [(a, b, b or "") for a, b, _ in rows]
    assert bpe.encode(df.limit(0), PATH).collect() == []
    lists = spark.createDataFrame([(None,), ([],)], "token_ids ARRAY<INT>")
    assert [r.decoded for r in bpe.decode(lists, PATH).collect()] == [None, ""]


def test_query_against_the_library(spark, theirs):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op1_bpe(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = theirs.encode(texts[r.doc_id], add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(theirs.decode(ids, skip_special_tokens=False))


def test_both_ways_in_one_pass(spark):
    rows = [(1, None, 7), (2, "ab ab <|endoftext|>", 7), (3, "no\x00o 🙂", None)]
    df = spark.createDataFrame(rows, "id INT, text STRING, decoded INT")
    apart = bpe.decode(bpe.encode(df, PATH), PATH)
    for remember in (True, False):
        once = bpe.encode(df, PATH, decoded="decoded", remember=remember)
        assert once.dtypes == apart.dtypes and sorted(once.collect()) == sorted(apart.collect())
