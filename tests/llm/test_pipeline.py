import pytest

import corpus_pipeline
from martloom.llm import bpe
from martloom.llm.queries import TOKENIZER
from tests.llm.test_jaccard import brute as brute_groups
from tests.llm.test_line_dedup import brute_of_every_length as brute_lines

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage got and gave, written and read again as the check does."""
    top = tmp_path_factory.mktemp("stages")
    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{top}/{name}")
        out = spark.read.parquet(f"{top}/{name}")
        seen[name] = (docs, out)
        docs = out
    return seen


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "languages", "lines", "near_copies", "mixture", "tokens",
    ]
    for before, after in list(stages.values())[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after.dtypes == before.dtypes


def test_languages_keep_clean_documents(stages):
    before, after = (df.collect() for df in stages["languages"])
    kept = {r.doc_id: r for r in after}
    assert len(kept) >= 0.97 * len(before)
    assert all(kept[r.doc_id].text == r.text for r in before if r.doc_id in kept)


def test_lines_like_brute_force(stages):
    before, after = (df.collect() for df in stages["lines"])
    gone = brute_lines([(r.doc_id, r.text) for r in before])
    expected = {}
    for r in before:
        lines = [x for k, x in enumerate(r.text.split("\n")) if (r.doc_id, k) not in gone]
        text = "\n".join(lines)
        if text.strip():
            expected[r.doc_id] = (text, len(text))
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == expected


def test_one_of_each_group_stays(stages):
    before, after = (df.collect() for df in stages["near_copies"])
    groups = brute_groups([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {least for _, least in groups.values()}


def test_mixture_and_tokens(stages):
    before, after = (df.collect() for df in stages["mixture"])
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in after)
    assert {r.doc_id for r in after} <= set(texts)
    encoded = stages["tokens"][1].collect()
    assert len(encoded) == len(after)
    codec = bpe.codec(bpe_path())
    by_text = sorted(r.text for r in after)
    assert sorted(codec.decode(r.token_ids) for r in encoded) == by_text
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in encoded)


def bpe_path():
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


ROWS = [
    (1, None, None, None, None, "k"),
    (2, "", "en", "src1", 0, "k"),
    (3, "the of and that erin, one line of it here", "en", None, 1, "k"),
    (3, "the of and that erin, one line of it here", "en", None, 1, "k"),
    (None, "the thing of that inter and there", "xx", "src1", 1, None),
    (4, "12345 ... !!", "de", "src1", 1, "k"),
    (5, "the of and that erin, one line of it here", None, "src2", 1, "k"),
]
DDL = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, key STRING"


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_edges(spark, name):
    docs = spark.createDataFrame(ROWS, DDL)
    out = STAGES[name](spark, docs, FOLDER)
    rows = out.collect()
    if name != "tokens":
        assert out.columns == docs.columns
    if name == "lines":
        assert sorted((r.doc_id or 0) for r in rows) == [0, 3, 3, 4]
    if name == "near_copies":
        assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 2, 3, 4]
    if name == "tokens":
        assert all(r.round_trip for r in rows) and len(rows) == len(ROWS)
    assert STAGES[name](spark, docs.limit(0), FOLDER).collect() == []


def test_an_exact_copy_leaves_no_lines(spark):
    text = "Les.\n\nthe first of these lines is a long one\n  \t\nHaanth.\n\u00a0\nx"
    rows = [(k, text, "en", "src1", len(text), "k") for k in (1, 2)]
    rows += [(3, "\n\t\n", "en", "src1", 3, "k"), (4, "y\nLes.\n", "en", "src1", 7, "k")]
    out = STAGES["lines"](spark, spark.createDataFrame(rows, DDL), FOLDER).collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in out} == {1: (text, len(text)), 4: ("y\n", 2)}


def test_no_other_text_of_a_repeated_id_is_lost(spark):
    words = lambda seed: " ".join(f"w{seed}x{k}" for k in range(40))
    rows = [(1, words(1)), (1, words(2)), (1, words(1)), (2, words(3)), (3, words(3)), (None, words(4))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars INT")
    out = STAGES["near_copies"](spark, docs, FOLDER)
    expected = [(1, words(1)), (1, words(2)), (2, words(3)), (None, words(4))]
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(
        map(str, spark.createDataFrame(expected, "doc_id BIGINT, text STRING").collect())
    )
