import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martloom.llm import fingerprint
from martloom.llm.queries import op12_fingerprints

DDL = "doc_id BIGINT, text STRING, lanes STRING, h INT, key STRING"
MOD = 1 << 32


def chained(*parts):
    """The hash of several values, each the seed of the next."""
    seed = 42
    for part in parts:
        if isinstance(part, str):
            seed = xxhash.xxh64_intdigest(part.encode(), seed)
        elif part is not None:
            seed = xxhash.xxh64_intdigest(part.to_bytes(8, "little"), seed) if part >= 256 else _int(part, seed)
    return seed


def _int(value, seed):
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), seed)


def brute(text):
    """Lanes of a text, paragraph by paragraph."""
    total = np.zeros(fingerprint.WIDTH, dtype=object)
    for paragraph in (text or "").split("\n"):
        lanes = []
        for k in range(4):
            h = chained(k, paragraph)
            lanes += [h % MOD, h >> 32]
        pieces = re.findall(f"(?s).{{1,{fingerprint.PIECE}}}", paragraph)
        features = []
        for piece in pieces:
            words = re.findall(r"[^ \t\n\x0b\f\r]+", piece)
            for a, b in zip(words, [*words[1:], None]):
                x = chained(a, b)
                features.append((x, xxhash.xxh64_intdigest(x.to_bytes(8, "little"), 42)))
        lanes.append(len(features))
        for side in (0, 1):
            for k in range(32):
                lanes += [sum(f[side] >> (k + up) & 1 for f in features) for up in (0, 32)]
        total = (total + np.array(lanes, dtype=object)) % MOD
    return [int(x) for x in total]


def cosine(a, b):
    if a == b:
        return 1.0
    x, y = (np.array(v[9:], dtype=float) * 2 - v[8] for v in (a, b))
    norm = np.sqrt(x @ x) * np.sqrt(y @ y)
    return float(np.clip(x @ y / norm, 0, 1)) if norm else 0.0


def expected(rows):
    """By row: what the query gives, the next document being the next larger doc_id."""
    texts = {d: t or "" for d, t in rows if d is not None}
    order = sorted(texts)
    after = dict(zip(order, [*order[1:], *order[:1]]))
    out = []
    for d, t in rows:
        t = t or ""
        cut = len(t) // 4
        other = texts[after[d]] if d is not None else ""
        edited = t[: len(t) - cut] + other[:cut]
        own, new = brute(t), brute(edited)
        near_next = cosine(own, brute(other)) if d is not None else 0.0
        out.append(
            (d, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, new, cosine(own, new), near_next)
        )
    return out


def words(rnd, n):
    return "".join(rnd.choice(["the ", "Erin ", "thón\t", "a\n", "b b ", "\n\n", "🙂 ", "x y "]) for _ in range(n))


def rows_of(df):
    return [tuple(r) for r in fingerprint.near_edits(df).collect()]


def close(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=1e-9)


def test_like_brute_force(spark):
    rnd = random.Random(3)
    rows = [(d * 7 - 20, words(rnd, rnd.randrange(40))) for d in range(60)]
    rows += [(1000, "w " * 9000 + "tail"), (1001, None), (1002, ""), (1003, "one"), (1004, "x" * 300_000)]
    rows += [(None, "no id, but some words"), (None, None)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL).repartition(5)
    close(rows_of(df), expected(rows))


def test_repeated_rows_and_tables_of_one_or_none(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "e f g h i"), (2, "e f g h i"), (2, "e f g h i")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL)
    close(rows_of(df), expected(rows))
    one = df.limit(1)
    close(rows_of(one), expected(rows[:1]))
    assert rows_of(df.limit(0)) == []
    several = spark.createDataFrame([(1, "a b c d e f g h", "", 1, ""), (2, "x", "", 1, ""), (2, "y", "", 1, "")], DDL)
    got = rows_of(several)
    assert len(got) == 3 and {r[0] for r in got} == {1, 2}


def test_order_of_paragraphs_and_incremental_change(spark):
    parts = ["first one", "second one", "", "second one", "third"]
    texts = [(1, "\n".join(parts)), (2, "\n".join(parts[::-1])), (3, "\n".join(parts[:-1])), (4, "third"), (5, "fourth")]
    lanes = {
        r.k: r.lanes
        for r in fingerprint.paragraph_sums(spark.createDataFrame(texts, "k INT, text STRING"), ["k"]).collect()
    }
    assert lanes[1] == lanes[2] != lanes[3]
    one = spark.createDataFrame([(lanes[1], lanes[3], lanes[4], lanes[5])], "a ARRAY<BIGINT>, b ARRAY<BIGINT>, c ARRAY<BIGINT>, d ARRAY<BIGINT>")
    a, b, c, d = map(F.col, "abcd")
    row = one.select(
        (fingerprint.plus(b, c) == a).alias("inserted"),
        (fingerprint.minus(a, c) == b).alias("deleted"),
        (fingerprint.plus(fingerprint.minus(a, c), d) == a).alias("changed"),
        fingerprint.likeness(a, a).alias("same"),
        fingerprint.likeness(a, b).alias("part"),
        fingerprint.likeness(c, fingerprint.nothing()).alias("none"),
    ).first()
    assert row.inserted and row.deleted and not row.changed
    assert row.same == 1.0 and 0.5 < row.part < 1.0 and row.none == 0.0


def test_query_over_its_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = op12_fingerprints(spark, folder)
    assert out.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    got = {r.doc_id: r for r in out.collect()}
    hexed = lambda lanes: "".join(f"{x:08x}" for x in lanes)
    for d, n, sha, own, new, near_edited, near_next in expected(docs):
        r = got[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, sha, hexed(own), hexed(new))
        assert (r.near_edited, r.near_next) == pytest.approx((near_edited, near_next), abs=1e-9)
    longer = [r for r in got.values() if r.n_chars >= 200]
    assert np.mean([r.near_edited > r.near_next for r in longer]) > 0.95
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_shuffles_of_finished_steps_are_given_back(spark, monkeypatch):
    """Each written step is followed by a collection of the driver, which frees the files of its shuffles."""
    steps = []
    kept = fingerprint._step
    monkeypatch.setattr(fingerprint, "_step", lambda df, name: steps.append(name) or kept(df, name))
    df = spark.createDataFrame([(i, f"text {i}\nof {i % 3}") for i in range(9)], "doc_id BIGINT, text STRING")
    assert fingerprint.near_edits(df).count() == 9
    assert steps == ["units", "ranges", "edges", "fingerprints"]


def test_texts_are_exchanged_once(spark, monkeypatch):
    """Whatever the ranges: ids beyond the doubles, ids with several texts, rows without id."""
    plans = {}
    kept = fingerprint._step
    planned = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(fingerprint, "_step", lambda df, name: plans.update({name: planned(df)}) or kept(df, name))
    rnd = random.Random(5)
    rows = [(d, words(rnd, 12)) for d in [*range(9), *(2**60 + k for k in range(5))]]
    rows.append((None, "no id"))
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL)
    repeated = [(*r, "x", 1, "y") for r in [(3, "a b c\nd e"), (3, "a b c\nd e"), (2**60, "other words here"), (None, "no id")]]
    more = df.unionByName(spark.createDataFrame(repeated, DDL))
    got = []
    for ranges in (1, 32):
        monkeypatch.setattr(fingerprint, "RANGES", ranges)
        close(rows_of(df), expected(rows))
        assert plans["fingerprints"].count("Exchange hashpartitioning") <= 2  # of the texts, and of a row a range
        got.append(sorted(map(str, rows_of(more))))
    assert got[0] == got[1] and len(got[0]) == len(rows) + len(repeated)
