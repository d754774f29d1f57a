import random

import pytest

from martloom.llm import line_dedup
from martloom.llm.queries import op9_line_dedup

DDL = "doc_id BIGINT, text STRING, line INT, h STRING"


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute(rows):
    """(doc_id, line) of repeated lines."""
    lines = sorted(
        (d, k, " ".join(x.split()))
        for d, t in {(d, t) for d, t in rows if d is not None and t is not None}
        for k, x in enumerate(t.split("\n"))
    )
    lines = [x for x in lines if len(x[2]) >= line_dedup.MIN_CHARS]
    return {
        (d, k) for n, (d, k, x) in enumerate(lines) if any(within_one(y, x) for *_, y in lines[:n])
    }


def edited(rnd, line):
    k = rnd.randrange(len(line))
    way = rnd.randrange(4)
    mid = {0: "", 1: rnd.choice("aé🙂b") + line[k], 2: rnd.choice("abc"), 3: line[k]}[way]
    return line[:k] + mid + line[k + 1 :]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("aab cé") for _ in range(rnd.randrange(15, 40))) for _ in range(30)]
    base += ["aaaaaaaaaaaaaaaaaaaaaaaaaaab", "aaaaaaaaaaaaaaaaaaaaaaaaaacb", "same start but the end is other"]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rnd.randrange(6)):
            line = rnd.choice(base)
            for _ in range(rnd.choice([0, 1, 1, 2])):
                line = edited(rnd, line) if line else line
            lines.append(line)
        rows.append((d, "\n".join(lines)))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DDL)
    assert {tuple(r) for r in line_dedup.repeated_lines(df).collect()} == brute(rows)


def test_edges(spark):
    line = "a line that is long enough to count"
    rows = [
        (5, None), (None, line), (6, ""), (7, f"{line}\n\nshort\n  {line} \nshort"), (8, f"short\n{line}"),
        (9, line), (9, line), (10, "x" * 300_000 + "\n" + line.upper()), (11, "x" * 299_999),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DDL)
    assert {tuple(r) for r in line_dedup.repeated_lines(df).collect()} == brute(rows)
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns
    texts = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    expected = [
        (5, None), (None, line), (6, ""), (7, f"{line}\n\nshort\nshort"), (8, "short"), (9, ""), (9, ""),
        (10, "x" * 300_000 + "\n" + line.upper()), (11, ""),
    ]
    assert texts == sorted(expected, key=repr)
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []


def test_halves_are_exact():
    rnd = random.Random(4)
    for _ in range(3000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randrange(20, 30)))
        b = edited(rnd, a)
        if len(b) >= 20:
            assert set(line_dedup.halves(a)) & set(line_dedup.halves(b))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {tuple(r) for r in line_dedup.repeated_lines(docs).collect()}
    assert got == brute(rows)


def brute_of_every_length(rows):
    """(doc_id, line) of lines that equal an earlier one, or are one edit from it at 20 characters."""
    lines = sorted(
        (d, k, " ".join(x.split())) for d, t in set(rows) for k, x in enumerate(t.split("\n")) if x.strip()
    )
    near = lambda a, b: min(len(a), len(b)) >= 20 and within_one(a, b)
    return {
        (d, k) for n, (d, k, x) in enumerate(lines) if any(y == x or near(y, x) for *_, y in lines[:n])
    }


def test_query_takes_lines_of_every_length(spark, tmp_path):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("ab c") for _ in range(rnd.randrange(30))) for _ in range(40)]
    rows = [(d, "\n".join(rnd.choice(base) for _ in range(rnd.randrange(1, 7)))) for d in range(80)]
    rows += [(80, "Les.\n}\n \u00a0"), (81, "}\n{\n Les. \n\nLes"), (82, "Les."), (83, "")]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/documents.parquet")
    gone = brute_of_every_length(rows)
    expected = {
        d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows
    }
    out = op9_line_dedup(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in out} == expected
    assert expected[81] == "{\n\nLes" and expected[82] == ""
