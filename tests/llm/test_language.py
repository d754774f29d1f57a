import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import language
from martloom.llm.queries import op3_language, page_language

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs.select("doc_id", "text", "lang"))


def test_trigrams():
    assert len(language.trigrams(b"")) == 0
    assert (language.trigrams(b"Ab  cd") == language.trigrams(b" aB\n\t-1cd ")).all()
    assert len(language.trigrams("aé".encode())) == 3


def posterior(logs):
    w = np.exp(np.array(logs) - max(logs))
    return w / w.sum()


def brute(rows, model):
    """key -> (lang, posterior) of rows (key, text, declared, host)."""
    n = len(model.languages)
    base = [math.log((1 - language.UNKNOWN) / n)] * n + [math.log(language.UNKNOWN)]
    logs, alone = [], []
    for _, text, declared, _ in rows:
        _, x = model.of((text or "").encode())
        tag = (declared or "").strip().lower().split("-")[0]
        if tag in model.languages:
            hit = [1 - language.DECLARED_ERRS if tag == l else language.DECLARED_ERRS / n for l in model.languages]  # noqa: E741
            x = x + np.log([*hit, 1 / n])
        logs.append(x)
        alone.append(posterior(x + np.array(base)))
    alone = np.array(alone)

    def smooth(own, parent):
        return (own + language.SMOOTHING * parent) / (own.sum() + language.SMOOTHING)

    corpus = smooth(alone.sum(axis=0), np.exp(base))
    out = {}
    name = lambda h: (h or "").strip().lower() or None
    domain = lambda h: ".".join(h.split(".")[-2:])
    for (key, *_, host), x in zip(rows, logs):
        prior = corpus
        if h := name(host):
            of = lambda f: alone[[name(r[3]) is not None and f(name(r[3])) for r in rows]].sum(axis=0)
            prior = smooth(of(lambda o: domain(o) == domain(h)), corpus)
            prior = smooth(of(lambda o: o == h), prior)
        p = posterior(x + np.log(np.maximum(prior, 1e-12)))
        out[key] = ([*model.languages, None][int(p.argmax())], p.max())
    return out


def test_like_brute_force(spark, docs, model):
    some = docs.select("doc_id", "text", "lang", "source").limit(120).collect()
    rows = [(r.doc_id, r.text[: 5 + k % 40], (r.lang, None, "xx", "DE-at")[k % 4], f"h{k % 5}.{r.source}.com") for k, r in enumerate(some)]
    rows += [(-1, None, "de", None), (-2, "123", None, " "), (-3, "Щука жрёт", None, "h1.src1.com")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "k BIGINT, text STRING, declared STRING, host STRING, key STRING")
    out = language.identify(df, model, F.col("k"), F.col("text"), F.col("declared"), F.col("host")).collect()
    expected = brute(rows, model)
    assert {r.key: r.lang for r in out} == {k: v[0] for k, v in expected.items()}
    for r in out:
        assert r.posterior == pytest.approx(expected[r.key][1], rel=1e-6)
    got = {r.key: r for r in out}
    assert got[-1].lang == "de" and not got[-1].accepted
    assert not got[-2].accepted and got[-2].text_lang is None
    assert got[-3].lang is None and not got[-3].accepted


def test_held_out_accuracy(spark, docs):
    train = docs.filter("doc_id % 2 = 0").select("doc_id", "text", "lang")
    test = docs.filter("doc_id % 2 = 1")
    found = language.identify(test, language.fit(train), F.struct("doc_id", "lang"), F.col("text")).collect()
    good = [r.lang == r.key.lang for r in found]
    assert sum(good) / len(good) > 0.97
    assert sum(r.accepted for r in found) / len(found) > 0.99


def test_edges(spark, docs, model):
    ddl = "page_id BIGINT, url STRING, html STRING, lang STRING"
    rows = [(1, None, None, "x"), (2, "no url", "<html>", "x"), (2, "no url", "<html>", "x"), (None, "", "", None)]
    df = spark.createDataFrame(rows, ddl)
    assert [r.accepted for r in page_language(df, model).collect()] == [False] * 4
    assert page_language(df.limit(0), model).collect() == []
    empty = language.fit(docs.limit(0))
    assert len(page_language(df, empty).collect()) == 4


def test_pages(spark):
    out = {r.page_id: r for r in op3_language(spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    said = {p.page_id: p.html.split('lang="')[1][:2] for p in pages}
    assert sorted(out) == sorted(said)
    assert sum(out[k].lang == v for k, v in said.items()) / len(said) > 0.98
