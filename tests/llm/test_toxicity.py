import random

import numpy as np
import pytest

from martloom.llm import toxicity
from martloom.llm.queries import op8_toxicity

DDL = "doc_id BIGINT, text STRING, lang STRING, score INT, toxic INT"


def test_fold():
    assert toxicity.fold("Іd1оt") == toxicity.fold("idiot") == "idiot"
    assert toxicity.fold("L0s3r") == toxicity.fold("loser") == "ioser"
    assert toxicity.fold("$tup1d") == toxicity.fold("ｓｔｕｐｉｄ") == "stupid"
    assert toxicity.fold("mo​ron") == "moron"
    assert toxicity.fold("Ｃlówn!") == "ciown!"
    assert toxicity.fold("in 2024, 100 %") == "in 2024, 100 %"


def matcher(exceptions=("trash can",)):
    f = toxicity.fold
    return toxicity.Matcher(
        toxicity.Lexicon({f("lowei"): 3.0}, {f("trash"): 2.0, f("clown"): 4.0}, exceptions)
    )


def brute_hits(m, folded):
    """Terms at each word start, tried one by one."""
    out, spared = [], []
    starts = [k for k in range(len(folded)) if folded[k].isalpha() and (not k or not folded[k - 1].isalpha())]
    ends = lambda k: k == len(folded) or not folded[k].isalpha()
    for k in starts:
        for phrase in map(toxicity.fold, m.lexicon.exceptions):
            if folded.startswith(phrase, k) and ends(k + len(phrase)):
                spared.append((k, k + len(phrase) - 1))
    for k in starts:
        best = None
        for terms, whole in ((m.lexicon.starts, False), (m.lexicon.words, True)):
            for t, w in terms.items():
                if folded.startswith(t, k) and (not whole or ends(k + len(t))) and w > (best or (0, 0, 0))[2]:
                    best = (k, k + len(t) - 1, w)
        if best and not any(a <= best[0] and best[1] <= b for a, b in spared):
            out.append(best)
    return out


def test_hits():
    m = matcher()
    hits = lambda t: [w for *_, w in m.hits(toxicity.fold(t))]
    assert hits("a trash, a TR4SH; trashy atrash") == [2.0, 2.0]
    assert hits("Loweischaft und lowei aloweia") == [3.0, 3.0]
    assert hits("the trash can and the trash") == [2.0]
    assert hits("the trash cannot") == [2.0]
    assert hits("") == []
    rnd = random.Random(1)
    words = ["trash", "can", "clown", "lowei", "loweia", "x", "tr@sh", "cl0wn", ",", "cans", "\n"]
    for _ in range(300):
        folded = toxicity.fold(rnd.choice(["", " "]).join(rnd.choice(words) for _ in range(rnd.randrange(9))))
        assert sorted(m.hits(folded)) == sorted(brute_hits(m, folded))


def test_copies_do_not_make_a_word_toxic(spark):
    rnd = random.Random(2)
    word = lambda: "w" + "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows = []
    for k in range(400):
        words = [word() for _ in range(60)]
        if toxic := k % 2:
            for _ in range(4):
                words.insert(rnd.randrange(60), rnd.choice(["zgromp", "Zgr0mp"]))
        rows.append((k, " ".join(words), "en", 1, toxic))
    rows += [(1000 + k, rows[1][1] + " quixotic", "en", 1, 1) for k in range(60)]
    df = spark.createDataFrame(rows, DDL)
    lexicon = toxicity.learn(df, df.select("doc_id", "toxic", "lang"))
    assert "quixotic" not in lexicon.words
    assert any(t.startswith("zgr") for t in [*lexicon.starts, *lexicon.words])
    out = {r.doc_id: r for r in toxicity.score(df, lexicon).collect()}
    assert all(out[r[0]].predicted == r[4] for r in rows)


def test_edges(spark):
    rows = [(1, None, "x", 1, 0), (2, "", "x", 1, 0), (2, "", "x", 1, 0), (None, "trash " * 100_000, "x", 1, 0)]
    df = spark.createDataFrame(rows, DDL)
    out = toxicity.score(df, matcher().lexicon).collect()
    assert out[0].score == out[1].score == out[2].score < 0.5 < out[3].score
    assert out[3].predicted == 1
    assert toxicity.score(df.limit(0), matcher().lexicon).collect() == []
    empty = toxicity.learn(df.limit(0), df.limit(0).select("doc_id", "toxic"))
    assert not empty.starts and not empty.words
    assert {r.predicted for r in toxicity.score(df, empty).collect()} == {0}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_held_out(spark, folder):
    out = op8_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    y, p = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    order = p.argsort()
    rank = np.empty(len(p))
    rank[order] = np.arange(len(p))
    auc = (rank[y == 1].mean() - (y == 1).sum() / 2 + 0.5) / (y == 0).sum()
    predicted = np.array([r.predicted for r in rows])
    assert auc > 0.97
    assert (predicted[y == 1] == 1).mean() > 0.9 and (predicted[y == 0] == 1).mean() < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_intercept_follows_the_odds_of_all_labels(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "fit_logit", lambda x, y: (-1.0, 2.0, 0.5, 0.1))
    rows = [(k, f"some words {k}", "en", 1, int(k % 10 == 0)) for k in range(200)]
    df = spark.createDataFrame(rows, DDL)
    learn = lambda limit: toxicity.learn(df, df.select("doc_id", "toxic"), limit=limit).logit
    assert learn(200) == (-1.0, 2.0, 0.5, 0.1)
    assert learn(20) == learn(5) == pytest.approx((-1.0 + np.log(20 / 180), 2.0, 0.5, 0.1))
    assert learn(90) == pytest.approx((-1.0 + np.log(20 / 180) - np.log(20 / 90), 2.0, 0.5, 0.1))


def test_rare_terms_are_weighed_whatever_is_more_frequent(spark, monkeypatch):
    # A cap on the terms by their frequency, should there be one, is reached by everyday words.
    monkeypatch.setattr(toxicity, "MAX_TERMS", 20, raising=False)
    monkeypatch.setattr(toxicity, "HELD_COUNTS", 50, raising=False)
    rnd = random.Random(5)
    everyday = ["common" + chr(97 + k) for k in range(20)]
    rows = []
    for k in range(200):
        words = [rnd.choice(everyday) for _ in range(40)]
        rows.append((k, " ".join(words[:20] + (["zgromp"] if k % 10 == 1 else []) + words[20:]), "en", 1, k % 2))
    df = spark.createDataFrame(rows, DDL)
    lexicon = toxicity.learn(df, df.select("doc_id", "toxic"))
    assert [t for t in [*lexicon.starts, *lexicon.words] if t.startswith("zgr")]
    assert not [t for t in [*lexicon.starts, *lexicon.words] if t.startswith("com")]
