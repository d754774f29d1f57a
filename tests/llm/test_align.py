import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from martloom.llm import align
from martloom.llm.queries import op13_alignment

FIRST, SECOND = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DDL = "doc_id BIGINT, text STRING, row STRING, a INT, n_pairs STRING"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(FIRST)
    a.encode_special_tokens = True
    a.no_padding()
    a.no_truncation()
    return a, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def tokens(text, libraries):
    """(id, start, end) of both tokenizers, by the libraries themselves."""
    a, b = libraries
    codec = align.codec(FIRST)
    found = []
    for ids, of in (
        (a.encode(" " + text, add_special_tokens=False).ids, lambda i: codec.strings[i]),
        (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i)
         else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        spans, at = [], 0
        for i in ids:
            spans.append((i, at, at + len(of(i))))
            at = spans[-1][2]
        if b"".join(map(of, ids)) != (" " + text).encode():
            return None
        found.append(spans)
    return found


def brute(rows, libraries):
    groups = []
    for _, text in rows:
        found = tokens(text, libraries) if text else None
        if not found:
            groups.append(None)
            continue
        a, b = found
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        starts = [0, *ends[:-1]]
        inside = lambda spans, s, e: [i for i, x, y in spans if s <= x and y <= e]
        groups.append([(inside(a, s, e), inside(b, s, e)) for s, e in zip(starts, ends)])
    linked = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in groups]
    count = Counter(p for links in linked for p in links)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (d, _), g, links in zip(rows, groups, linked):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or [])
        out.append((
            d, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), sum(links.values()),
            sum(w for p, w in links.items() if count[p] == most[p[0]]),
            sum(w * count[p] for p, w in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=repr)


def got(df):
    rows = align.align(df, FIRST, SECOND).select(*COLUMNS).collect()
    return sorted((tuple(r) for r in rows), key=repr)


ODD = [
    (1, None), (2, ""), (3, "<|endoftext|> and <s> </s> <unk> <0x41>"), (4, " two  spaces   here "), (5, "a▁b"),
    (6, "日本語のテキスト、そして emoji 🙂🙂👩‍👩‍👧 ok"), (7, "\x00\x01 control"), (8, "x" * 5000), (9, "tab\tand\r\nline\n\n\nend\n"),
    (10, "ﬁ ligature ＦＵＬＬ"), (None, "no id"), (None, None), (11, "repeated row"), (11, "repeated row"), (12, " nbsp 　x"),
    (13, "é combining"), (14, " "), (15, "\n"),
]


@pytest.mark.parametrize("small", [False, True])
def test_like_brute_force(spark, libraries, monkeypatch, small):
    if small:
        sizes = {"BLOCK_CHARS": 60, "FLOPS": 7, "SLAB_CHARS": 5, "COUNTED": 50, "PAIRS": 40, "ENTRIES": 30, "SLICE": 20}
        for name, value in sizes.items():
            monkeypatch.setattr(align, name, value)
    rnd = random.Random(1)
    words = ["the", "Reoush", "ontiontion", "über", "naïve", "42,", "don't", "\n", "  ", "🙂", "hahehe", "I"]
    rows = ODD + [(k, " ".join(rnd.choice(words) for _ in range(rnd.randrange(30)))) for k in range(20, 60)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL).repartition(3)
    assert got(df) == brute(rows, libraries)


def test_whole_table_and_query(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = op13_alignment(spark, folder)
    assert out.columns == [*COLUMNS, "n_overlaps"]
    assert sorted((tuple(r)[:8] for r in out.collect()), key=repr) == brute(rows, libraries)


def test_empty_table(spark):
    df = spark.createDataFrame([], DDL)
    assert got(df) == [] and align.overlap_links(df, FIRST, SECOND).collect() == []


def test_overlap_links(spark, libraries):
    rows = [(k, t) for k, t in ODD if k is not None and k != 11] + [(30, "Reoush ontiontion naïve")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL)
    expected = set()
    for d, text in rows:
        a, b = (tokens(text, libraries) if text else None) or ([], [])
        for i, (x, s, e) in enumerate(a):
            for j, (y, u, v) in enumerate(b):
                if (n := min(e, v) - max(s, u)) > 0:
                    expected.add((d, i, j, x, y, n))
    links = {tuple(r) for r in align.overlap_links(df, FIRST, SECOND).collect()}
    assert links == expected
    counts = {r.doc_id: r.n_overlaps for r in align.align(df, FIRST, SECOND).collect()}
    assert counts == {d: sum(x[0] == d for x in links) for d, _ in rows}


def test_long_texts_are_encoded_as_a_whole(libraries):
    rnd = random.Random(4)
    text = "".join(rnd.choice(["word ", "x", "  ", "\n", "é ", "it's ", "a1 ", "."]) for _ in range(90_000))
    a, b = align.tokenizers(FIRST, SECOND).encode(text)
    assert a.tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
    assert b.tolist() == libraries[1].encode(text)


def test_products():
    rng = np.random.default_rng(2)
    for shape, other in (((7, 5), (5, 9)), ((1, 3), (3, 1)), ((0, 4), (4, 2))):
        x, y = (rng.integers(0, 3, s) * (rng.random(s) < 0.5) for s in (shape, other))
        made = [align.Csr.of(*np.nonzero(m), m.shape, m[np.nonzero(m)]) for m in (x, y)]
        dense = lambda c, s: np.array([[*np.bincount(c.indices[p:q], c.data[p:q], s[1])] for p, q in zip(c.indptr, c.indptr[1:])]).reshape(s)  # noqa: E731, E501
        out = made[0].product(made[1])
        assert (dense(out, (shape[0], other[1])) == x @ y).all()
        assert (dense(made[0].transposed(), shape[::-1]) == x.T).all()
