"""Text predicates, tokens and score bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Right-closed score bins, lowest first. A score at or below the first edge has no bin.
BIN_EDGES = (-1.0, -0.5, -0.1, 0.1, 0.5, 1.0)
BIN_LABELS = ("Very Negative", "Negative", "Neutral", "Positive", "Very Positive")

# Fixed value: the normalisation constant of the published valence-sum formula.
SCORE_ALPHA = 15.0

# Tokens are runs of letters, marks, digits and apostrophes of any script.
TOKEN_BREAK = r"[^\p{L}\p{M}\p{N}']+"
WORD = r"[\p{L}\p{M}\p{N}']+"


def contains_ignoring_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def mentions_list(text: Column, names: list[str]) -> Column:
    """The given names that occur in ``text``, which is lower case already, in the order given."""
    found = [F.when(F.contains(text, F.lower(F.lit(n))), F.lit(n)) for n in names]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def tokens(text: Column, token_break: str = TOKEN_BREAK) -> Column:
    return F.split(F.lower(text), token_break)


def normalised_score(valence_sum: Column) -> Column:
    """Map an unbounded valence sum into (-1, 1)."""
    return valence_sum / F.sqrt(valence_sum * valence_sum + F.lit(SCORE_ALPHA))


def score_bin(score: Column) -> Column:
    """Ordered label of a score; NULL outside ``(-1, 1]`` and for NULL."""
    label = None
    for low, high, name in zip(BIN_EDGES, BIN_EDGES[1:], BIN_LABELS):
        inside = (score > low) & (score <= high)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label


def bin_rank(label: Column) -> Column:
    """1-based position of a label in the bin order, for sorting."""
    return F.nullif(F.array_position(F.array(*[F.lit(b) for b in BIN_LABELS]), label), F.lit(0))
