from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from martloom.llm import mixing

DDL = "doc_id BIGINT, text STRING, lang STRING, source STRING, epoch STRING, tokens INT"


def test_shortage_goes_to_siblings_first():
    supplies = {("web", "en"): 10, ("web", "de"): 1000, ("books", "en"): 1000}
    tree = mixing.build_tree(supplies, {("web",): 1.0, ("books",): 1.0})
    plan = mixing.allocate(tree, 1000, 1)
    assert plan == {("web", "en"): 10, ("web", "de"): 490, ("books", "en"): 500}
    # Only when the family is empty does the rest go up.
    tree = mixing.build_tree({**supplies, ("web", "de"): 100}, {})
    assert mixing.allocate(tree, 1000, 1) == {("web", "en"): 10, ("web", "de"): 100, ("books", "en"): 890}
    assert sum(mixing.allocate(tree, 10**6, 3).values()) == 3 * 1110
    assert mixing.allocate(mixing.build_tree({("a",): 5, ("b",): 5}, {("b",): 0.0}), 8, 1) == {("a",): 5, ("b",): 0}


def test_nothing_is_lost_below_a_weight_of_zero():
    tree = mixing.build_tree({("a", "x"): 100, ("a", "y"): 10, ("b", "z"): 100}, {("a", "x"): 0.0})
    assert mixing.allocate(tree, 100, 1) == {("a", "x"): 0, ("a", "y"): 10, ("b", "z"): 90}
    tree = mixing.build_tree({("a", "x"): 100, ("b", "z"): 100}, {("a", "x"): 0.0})
    assert mixing.allocate(tree, 80, 1) == {("a", "x"): 0, ("b", "z"): 80}


@pytest.mark.parametrize("budget", [0, 1, 7, 99, 100, 1000])
def test_shares_add_up(budget):
    for weights in ([1, 1, 1], [0.1, 0.7, 0.2], [5, 0, 1e-9]):
        rooms = [30, 40, 50]
        given = mixing.share(budget, weights, rooms)
        assert sum(given) == min(budget, sum(r for r, w in zip(rooms, weights) if w))
        assert all(0 <= g <= r for g, r in zip(given, rooms))


def corpus():
    rows = []
    for k in range(400):
        source = "s0" if k % 3 == 0 else f"s{k % 7}"
        text = "\n".join(" ".join(f"w{k}_{i}" for i in range(j, j + 5)) for j in range(0, k % 23, 5))
        rows.append((k, text, ("en", "de", None)[k % 5 % 3], source, "old", 1))
    return rows


def domain():
    return F.concat(F.lit("d"), (F.substring("source", 2, 1).cast("int") % 2).cast("string"))


@pytest.mark.parametrize("budget,epochs", [(0.4, 1), (1.0, 2), (3.0, 2)])
def test_budgets_are_met(spark, budget, epochs):
    rows = corpus()
    df = spark.createDataFrame(rows, DDL)
    weights = {("d0",): 3.0, ("d1",): 1.0, ("d0", "de"): 0.5}
    out = mixing.mix(df, budget, weights, domain(), epochs, seed=3)
    assert sorted(out.columns) == sorted(["doc_id", "text", "lang", "source", "tokens", "epoch", "n_tokens"])
    out = out.collect()
    leaf = lambda r: (f"d{int(r[3][1]) % 2}", r[2], r[3])
    supplies = Counter()
    for r in rows:
        supplies[leaf(r)] += len(r[1].split())
    tree = mixing.build_tree(supplies, weights)
    plan = mixing.allocate(tree, int(budget * sum(supplies.values())), epochs)
    taken = Counter()
    whole = {r[0]: r for r in rows}
    epochs_of = defaultdict(set)
    for r in out:
        assert r.n_tokens == len(r.text.split())
        assert whole[r.doc_id][1].startswith(r.text)
        taken[leaf(whole[r.doc_id])] += r.n_tokens
        assert r.epoch not in epochs_of[r.doc_id]
        epochs_of[r.doc_id].add(r.epoch)
    assert taken == Counter({k: v for k, v in plan.items() if v})
    # At most one document of a leaf is cut, and only in its last epoch.
    cut = Counter(leaf(whole[r.doc_id]) for r in out if 0 < r.n_tokens < len(whole[r.doc_id][1].split()))
    assert all(n == 1 for n in cut.values())


def test_seeds_shuffle(spark):
    df = spark.createDataFrame(corpus(), DDL)
    picks = [
        sorted(r.doc_id for r in mixing.mix(df, 0.3, {}, domain(), 1, seed).select("doc_id").collect())
        for seed in (1, 1, 2)
    ]
    assert picks[0] == picks[1] != picks[2]


def test_edges(spark):
    rows = [(1, None, None, None, "o", 1), (2, "", "en", "s1", "o", 1), (3, "a b", "en", "s1", "o", 1)]
    rows += [(3, "a b", "en", "s1", "o", 1), (None, " c\td ", "en", "s1", "o", 1)]
    rows += [(5, "x " * 200_000, "de", "s2", "o", 1)]
    df = spark.createDataFrame(rows, DDL)
    out = mixing.mix(df, 1.0, {}, F.lit(None).cast("string"), 1).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in out) == Counter({(1, 0): 1, (2, 0): 1, (3, 2): 2, (None, 2): 1, (5, 200_000): 1})
    half = mixing.mix(df, 0.5, {}, F.lit("all"), 1).collect()
    assert sum(r.n_tokens for r in half) == 100_003
    assert mixing.mix(df.limit(0), 1.0, {}, F.lit("all")).collect() == []
    assert mixing.mix(df, 0.0, {}, F.lit("all")).filter("n_tokens > 0").collect() == []
