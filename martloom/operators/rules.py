"""Rule-based sentiment: valences of words, changed by the words around them.

Everything is an expression over the tokens of a row, so texts are neither exploded nor exchanged.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import WORD, normalised_score
from martloom.operators.lexicon import Lookup, inline_lookup

SCORE_PLACES = 6
MILLION = 1_000_000

# The published weights of the rules.
DEGREE = 0.293
CAPITALS = 0.733
NEGATION = -0.74
FADING = (1.0, 0.95, 0.9)
CONTRAST_BEFORE, CONTRAST_AFTER = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MOST_QUESTIONS, QUESTIONS = 0.18, 3, 0.96

# English words that the rules go by.
NEGATIONS = ("not", "no", "never", "none", "nothing", "neither", "nor", "without", "cannot", "can't", "don't", "isn't")
DEGREES = {
    **dict.fromkeys(("very", "really", "so", "extremely", "totally", "absolutely", "most", "incredibly"), DEGREE),
    **dict.fromkeys(("slightly", "barely", "hardly", "somewhat", "partly", "little"), -DEGREE),
}
CONTRASTS = ("but",)


@dataclass(frozen=True)
class Words:
    """The words that the rules go by, in lower case."""

    negations: tuple[str, ...] = NEGATIONS
    degrees: Mapping[str, float] = field(default_factory=lambda: dict(DEGREES))
    contrasts: tuple[str, ...] = CONTRASTS


def _degree(word: Column, degrees: Mapping[str, float]) -> Column:
    by_weight: dict[float, list[str]] = {}
    for w, weight in degrees.items():
        by_weight.setdefault(weight, []).append(w)
    found = F.lit(0.0)
    for weight, words in by_weight.items():
        found = F.when(word.isin(words), F.lit(weight)).otherwise(found)
    return found


def _changed(info: Column, x: Column, i: Column, mixed: Column) -> Column:
    """The valence of the token at ``i`` under the three tokens before it."""
    up = lambda c: F.when(c, F.lit(CAPITALS)).otherwise(F.lit(0.0))
    sign = F.when(x["v"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    value = x["v"] / MILLION + sign * up(x["caps"] & mixed)
    for k, fading in enumerate(FADING):
        before = F.get(info, i - (k + 1))
        degree = F.when(before["v"].isNull(), F.coalesce(before["degree"], F.lit(0.0))).otherwise(F.lit(0.0))
        louder = up((degree != 0) & before["caps"] & mixed)
        value = value + sign * (degree + louder) * F.lit(fading)
    for k in range(len(FADING)):
        negated = F.coalesce(F.get(info, i - (k + 1))["negates"], F.lit(False))
        value = value * F.when(negated, F.lit(NEGATION)).otherwise(F.lit(1.0))
    return value


def _read(token: Column, lookup: Lookup, words: Words) -> Column:
    """What the rules ask of a token."""
    word = F.lower(token)
    return F.struct(
        lookup(word).alias("v"),
        _degree(word, words.degrees).alias("degree"),
        word.isin(list(words.negations)).alias("negates"),
        ((token == F.upper(token)) & (token != word)).alias("caps"),
        word.isin(list(words.contrasts)).alias("contrasts"),
    )


def _weighed(x: Column, i: Column) -> Column:
    """The token at ``i`` with its place before or after the contrast, in whole millionths."""
    part = F.when(F.col("_turn") < 0, F.lit(1.0)).when(i < F.col("_turn"), F.lit(CONTRAST_BEFORE))
    part = part.when(i > F.col("_turn"), F.lit(CONTRAST_AFTER)).otherwise(F.lit(1.0))
    value = _changed(F.col("_info"), x, i, F.col("_mixed")) * part
    return F.when(x["v"].isNull(), F.lit(0).cast("bigint")).otherwise(F.floor(value * MILLION + F.lit(0.5)))


def _marks(text: Column, mark: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(mark), F.lit("")))


def rule_scores(
    texts: DataFrame,
    lexicon: DataFrame,
    words: Words | None = None,
    keep: tuple[str, ...] = ("id",),
    text_column: str = "content",
) -> DataFrame:
    """One row per row of ``texts``: its ``keep`` columns and its score in (-1, 1).

    Words are runs of letters, marks, digits and apostrophes. A word of ``lexicon`` (token, valence)
    counts its valence, and

    * degree words among the three before it, unless they are in the lexicon themselves, raise or lower
      its strength, less with each step away;
    * capitals raise it, its own and a degree word's, in texts that are not all in capitals;
    * each negation among the three before it turns its sign and weakens it;
    * what stands before the first contrast word counts half, what follows it half as much again.

    Exclamation and question marks then strengthen the sum, which is normalised. A text that is NULL or
    holds no word of the lexicon scores 0. The lexicon has to fit into a row's expression; a larger one
    raises.
    """
    words = words or Words()
    lookup = inline_lookup(lexicon)
    if lookup is None:
        raise ValueError("the lexicon of the rules is looked up in the row and must be smaller")
    text = F.coalesce(F.col(text_column), F.lit(""))
    tokens = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    noise = F.least(_marks(text, "!"), F.lit(MOST_EXCLAMATIONS)) * F.lit(EXCLAMATION)
    asked = _marks(text, "?")
    doubt = F.when(asked <= 1, F.lit(0.0)).when(asked <= MOST_QUESTIONS, asked * F.lit(QUESTION)).otherwise(F.lit(QUESTIONS))
    # Each step reads the one before, named so that it is computed once a row.
    steps = texts.select(*keep, F.transform(tokens, lambda t: _read(t, lookup, words)).alias("_info"), (noise + doubt).alias("_marks"))
    loud = F.size(F.filter("_info", lambda x: x["caps"]))
    turn = F.array_position(F.transform("_info", lambda x: x["contrasts"]), F.lit(True)) - 1
    steps = steps.withColumn("_mixed", (loud > 0) & (loud < F.size("_info"))).withColumn("_turn", turn)
    summed = F.aggregate(F.transform("_info", _weighed), F.lit(0).cast("bigint"), lambda a, x: a + x)
    scored = steps.select(*keep, "_marks", summed.alias("_sum"))
    total = F.col("_sum") / F.lit(float(MILLION)) + F.signum(F.col("_sum").cast("double")) * F.col("_marks")
    return scored.select(*keep, F.round(normalised_score(total), SCORE_PLACES).alias("sentiment_score"))
