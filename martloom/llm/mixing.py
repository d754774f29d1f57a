"""Mixing sources to target weights, down a tree of domains, languages and sources.

A budget of tokens flows from the root to the leaves by the weights. A leaf can give its own tokens once
an epoch, ``max_epochs`` times at most. What a node cannot take up goes to its siblings by their
weights, and only what the whole family cannot take up to the level above. Each leaf then gives whole
epochs and a prefix of one more, in an order that the seed and the epoch shuffle; the last document
of the prefix is cut, so that a leaf meets its budget to the token.

The driver sees one sum a leaf. The prefix is found from the token sums of hash ranges of a leaf: only
the range that holds the cut is ordered, however large the leaf is.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.session import written

LEVELS = ("domain", "lang", "source")
# Ranges of a leaf's shuffled order; a leaf orders about one part in so many of its rows.
RANGES = 4096
# More leaves than this are a mistake in the tree, and an error.
MAX_LEAVES = 100_000


@dataclass
class Tree:
    """A node of the mix: its weight among its siblings, and what its leaves can give."""

    weight: float = 1.0
    supply: int = 0
    children: dict[str | None, Tree] = field(default_factory=dict)

    def room(self, epochs: int) -> int:
        """Tokens that ``share`` can place below; it serves nothing of weight 0."""
        served = [c for c in self.children.values() if c.weight > 0]
        return sum(c.room(epochs) for c in served) if self.children else self.supply * epochs


def share(budget: int, weights: list[float], rooms: list[int]) -> list[int]:
    """``budget`` by ``weights``, where a child's shortage goes to its siblings by theirs.

    Whole numbers by largest remainder, the first child first among equals. Gives out all of the
    budget that the children with a positive weight have room for.
    """
    given = [0] * len(weights)
    open_ = [k for k, w in enumerate(weights) if w > 0 and rooms[k] > 0]
    left = min(budget, sum(rooms[k] for k in open_))
    while left > 0:
        total = sum(weights[k] for k in open_)
        exact = {k: left * weights[k] / total for k in open_}
        full = [k for k in open_ if exact[k] >= rooms[k]]
        if full:
            for k in full:
                given[k] = rooms[k]
                left -= rooms[k]
            open_ = [k for k in open_ if k not in full]
            if left <= 0 or not open_:
                break
            continue
        for k in open_:
            given[k] = int(exact[k])
        rest = left - sum(given[k] for k in open_)
        for k in sorted(open_, key=lambda k: (given[k] - exact[k], k)):
            extra = min(rest, 1, rooms[k] - given[k])
            given[k] += extra
            rest -= extra
        for k in open_:  # only where rounding in double precision has left some
            extra = min(rest, rooms[k] - given[k])
            given[k] += extra
            rest -= extra
        break
    return given


def allocate(tree: Tree, budget: int, epochs: int) -> dict[tuple, int]:
    """Tokens of each leaf, by its path."""
    out: dict[tuple, int] = {}

    def down(node: Tree, amount: int, path: tuple) -> None:
        if not node.children:
            out[path] = amount
            return
        names = sorted(node.children, key=lambda x: (x is None, x or ""))
        parts = [node.children[x] for x in names]
        given = share(amount, [p.weight for p in parts], [p.room(epochs) for p in parts])
        for name, part, tokens in zip(names, parts, given):
            down(part, tokens, (*path, name))

    down(tree, budget, ())
    return out


def build_tree(supplies: Mapping[tuple, int], weights: Mapping[tuple, float]) -> Tree:
    """``weights`` by path, of any length: ("web",), ("web", "en"); a path not named weighs 1."""
    root = Tree()
    for path, supply in supplies.items():
        node = root
        for k in range(len(path)):
            prefix = path[: k + 1]
            node = node.children.setdefault(path[k], Tree(float(weights.get(prefix, 1.0))))
        node.supply += supply
    return root


def _tokens(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")).cast("bigint")


def _prefix(text: Column, n: Column) -> Column:
    """The text up to its n-th word, with the white space inside as it was."""
    parts = F.split(F.translate(text, "\t\n\u000b\f\r", "     "), " ")
    # The pieces are the input of the lambda: named inside, they would be split anew for each.
    places = F.filter(F.transform(parts, lambda w, k: F.when(w != "", k + 1)), lambda k: k.isNotNull())
    last = F.element_at(places, n.cast("int"))
    taken = F.slice(parts, 1, last)
    return F.substring(text, F.lit(1), F.length(F.array_join(taken, " ")))


def mix(
    docs: DataFrame,
    budget: float,
    weights: Mapping[tuple, float],
    domain: Column,
    max_epochs: int = 4,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """The mix: rows of ``docs`` with ``epoch``, ``n_tokens`` taken and the ``text`` they are taken
    from, once for each epoch that takes the row; then all its columns of other names.

    Tokens are words between white space. ``budget`` is a fraction of all tokens. Without room for the
    budget in the tree, the mix is all that there is.

    Edge cases: null domains, languages and sources are names of their own. Texts that are null or
    without words have no tokens: they come once, in epoch 0 with the text as it is, where their
    leaf gives any token or has none, and never if its weight is 0. Repeated rows count each; ties of
    the shuffled order, which only equal doc_ids can have, go by text, and equal rows may stand for
    one another. An empty table gives no rows. Columns of ``docs`` named epoch or n_tokens are replaced.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("epoch", "n_tokens")]
    rows = docs.select(
        F.struct(*[docs[c] for c in own]).alias("row"),
        F.struct(domain.alias("domain"), docs[lang].alias("lang"), docs[source].alias("source")).alias("leaf"),
        docs[doc_id].alias("id"),
        _tokens(docs[text]).alias("tokens"),
    )
    sums = rows.groupBy("leaf").agg(F.sum("tokens").alias("tokens")).limit(MAX_LEAVES + 1).collect()
    if len(sums) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} leaves: group the sources first")
    supplies = {tuple(r.leaf): r.tokens for r in sums}
    tree = build_tree(supplies, weights)
    plan = allocate(tree, int(budget * sum(supplies.values())), max_epochs)

    def weighted(path: tuple) -> bool:
        return all(weights.get(path[: k + 1], 1.0) > 0 for k in range(len(path)))

    leaves = [
        (path, plan[path] // s if s else 0, plan[path] % s if s else 0, weighted(path) and (plan[path] > 0 or not s))
        for path, s in supplies.items()
    ]
    leaf_type = rows.schema["leaf"].dataType.simpleString()
    given = spark.createDataFrame(leaves, f"leaf {leaf_type}, whole BIGINT, rest BIGINT, blank BOOLEAN")
    # Shuffled anew for the epoch that is taken in part.
    shuffled = F.xxhash64(F.lit(seed), "whole", "id")
    bits = RANGES.bit_length() - 1
    dealt = rows.join(F.broadcast(given), "leaf").select(
        "*", shuffled.alias("rank"), F.shiftrightunsigned(shuffled, 64 - bits).alias("range")
    )
    before = Window.partitionBy("leaf").orderBy("range")
    ranges = (
        dealt.filter("rest > 0")
        .groupBy("leaf", "range")
        .agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
        .withColumn("first", F.sum("t").over(before) - F.col("t"))
        .select("leaf", "range", "first", (F.col("first") + F.col("t")).alias("last"), "rest")
    )
    # One range a leaf holds the cut.
    cuts = written(ranges.filter("first < rest and rest <= last").select("leaf", F.col("range").alias("cut"), "first"), "cuts")
    placed = dealt.join(F.broadcast(cuts), "leaf", "left")
    order = Window.partitionBy("leaf").orderBy(F.shiftrightunsigned("rank", 1), "rank", "id", F.col("row")[text])
    in_cut = placed.filter("range = cut").withColumn("sofar", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    left = F.col("rest") - F.col("first") - F.coalesce("sofar", F.lit(0))
    partial = F.greatest(F.lit(0), F.least("tokens", left))
    outside = placed.filter("cut is null or range <> cut").withColumn(
        "part", F.when(F.col("range") < F.col("cut"), F.col("tokens")).otherwise(0)
    )
    columns = ["row", "tokens", "whole", "part", "blank"]
    both = outside.select(*columns).unionByName(in_cut.withColumn("part", partial).select(*columns))
    epochs = F.when(F.col("tokens") == 0, F.col("blank").cast("bigint")).otherwise(
        F.col("whole") + (F.col("part") > 0).cast("bigint")
    )
    taken = both.filter(epochs > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), epochs - 1)))
    n = F.when(F.col("epoch") < F.col("whole"), F.col("tokens")).otherwise(F.col("part"))
    value = F.col("row")[text]
    cut_text = F.when(n < F.col("tokens"), _prefix(value, n)).otherwise(value)
    return taken.select(
        *[cut_text.alias(c) if c == text else F.col("row")[c].alias(c) for c in own],
        F.col("epoch").cast("int").alias("epoch"),
        F.when(F.col("tokens") == 0, F.lit(0)).otherwise(n).cast("bigint").alias("n_tokens"),
    )
