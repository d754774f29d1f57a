"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, accents and look-alike letters of other scripts to their Latin
skeleton, digits and signs that stand for letters to these letters, invisible characters away. One
automaton finds all lexicon terms, at word starts or as whole words, and all exception phrases; a term
inside an exception phrase does not count. The score is a logistic function of the matched weight, by
itself and relative to the text's length.

The lexicon is learned: a term's weight is its log odds between toxic and clean documents, counted
over distinct contexts, so that copies of one document do not make its words look toxic.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.lookup import bounded
from martloom.session import written

# Labelled documents of each class that a lexicon is fitted on at most.
SAMPLE = 6_000
PREFIXES = (4, 5, 6)
MIN_CONTEXTS = 4
MIN_WEIGHT = 3.0
# Counts of clean documents that a task holds at a time.
HELD_COUNTS = 100_000
# Phrases with a lexicon word in a harmless sense (fixed values).
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pathetic fallacy", "pond scum")

# Letters of other scripts that look like Latin ones (fixed values).
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t",
    "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "σ": "s", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "γ": "y", "ı": "i",
    "ø": "o", "ł": "l", "đ": "d", "ħ": "h", "æ": "ae", "œ": "oe", "ß": "ss", "þ": "p",
}
# Digits and signs that stand for letters inside a word (fixed values).
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}
INVISIBLE = "­​‌‍⁠﻿"

_WORD = re.compile(r"[^\W\d_]+")
# A word with a sign or digit before one of its letters.
_MIXED = re.compile(r"[^\W_]*[0-9@$!|]+[^\W\d_]+(?:[0-9@$!|]+[^\W\d_]+)*")


_SIGNS = re.compile(r"[0-9@$!|]")


@lru_cache(maxsize=1)
def _table() -> dict[int, str]:
    """One translation for accents, look-alikes, width forms and invisible characters."""
    table = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code).lower()) if c.isascii())
        if plain:
            table[code] = plain.lower()
    table |= {code: None for code in range(0x300, 0x370)}  # combining accents
    table |= {ord(c): s for c, s in LOOK_ALIKES.items()} | {ord(c): None for c in INVISIBLE}
    # The letters that one digit may stand for fold to one of them.
    return table | {ord("l"): "i"}


def _letters(match: re.Match) -> str:
    return "".join(SUBSTITUTES.get(c, c) for c in match.group())


def fold(text: str) -> str:
    """The skeleton of a text."""
    text = text.lower()
    if _SIGNS.search(text):
        text = _MIXED.sub(_letters, text)
    return text.translate(_table())


@dataclass
class Lexicon:
    """Folded terms and weights; ``starts`` match at word starts, ``words`` whole words only."""

    starts: dict[str, float] = field(default_factory=dict)
    words: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    # Logistic on (1, log weight, log weight per 1,000 words, log words).
    logit: tuple[float, float, float, float] = (-2.0, 2.0, 0.5, 0.0)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list] = defaultdict(list)
        for kind, terms in (("start", lexicon.starts), ("word", lexicon.words)):
            for term, weight in terms.items():
                entries[term].append((kind, weight))
        for phrase in lexicon.exceptions:
            entries[fold(phrase)].append(("except", 0.0))
        for term, what in entries.items():
            self.automaton.add_word(term, (len(term), what))
        if entries:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Spans and weights of the terms that count: of terms at one word the heaviest."""
        if not len(self.automaton):
            return []
        found, spared, n = {}, [], len(folded)
        for last, (length, what) in self.automaton.iter(folded):
            first = last - length + 1
            if first and folded[first - 1].isalpha():
                continue
            ends = last + 1 == n or not folded[last + 1].isalpha()
            for kind, weight in what:
                if kind == "except":
                    if ends:
                        spared.append((first, last))
                elif (kind == "start" or ends) and weight > found.get(first, (0, 0.0))[1]:
                    found[first] = (last, weight)
        return [
            (a, b, w) for a, (b, w) in found.items() if not any(x <= a and b <= y for x, y in spared)
        ]

    def features(self, text: str) -> tuple[float, float, float, float]:
        """Constant, matched weight, weight by length, and length, as logarithms."""
        weight = sum(w for *_, w in self.hits(fold(text)))
        words = text.count(" ") + text.count("\n") + 1
        return 1.0, math.log1p(weight), math.log1p(1000 * weight / words), math.log(words)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton steps."""
    if not len(y) or y.min() == y.max():
        return Lexicon().logit
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = _sigmoid(x @ beta)
        gradient = x.T @ (p - y) + ridge * beta
        hessian = (x.T * np.maximum(p * (1 - p), 1e-9)) @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, beta))


def prior_shift(clean: int, toxic: int, limit: int) -> float:
    """What the intercept of a model of at most ``limit`` documents of each class lacks to the odds of
    all labels."""
    if not clean or not toxic:
        return 0.0
    return math.log(toxic / clean) - math.log(min(toxic, limit) / min(clean, limit))


def terms_of(text: str) -> Iterator[tuple[str, str, int]]:
    """Each folded word and its prefixes as (kind, term, hash of the words around it)."""
    words = _WORD.findall(fold(text))
    for before, word, after in zip(["", *words], words, [*words[1:], ""]):
        around = crc32(f"{before} {after}".encode())
        if len(word) >= 3:
            yield "word", word, around
        for n in PREFIXES:
            if len(word) > n:
                yield "start", word[:n], around


def _sample(docs: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """``text`` and ``toxic`` of up to ``limit`` labelled documents of each class, by a hash."""
    order = F.xxhash64("doc_id")
    picked = [known.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(limit) for y in (0, 1)]
    # At most 2 * limit rows.
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    return docs.join(ids, "doc_id").select("text", "toxic")


def _contexts(toxic: DataFrame) -> DataFrame:
    """``kind, term, context`` in toxic documents; the distinct rows of a batch."""

    def run(batches):
        for batch in batches:
            seen = set()
            for text in batch.column("text").to_pylist():
                seen.update(terms_of(text or ""))
            columns = list(zip(*seen)) if seen else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))],
                ["kind", "term", "context"],
            )

    return toxic.select("text").mapInArrow(run, "kind STRING, term STRING, context BIGINT")


def _occurrences(clean: DataFrame, terms: DataFrame) -> DataFrame:
    """``kind, term, n`` of ``terms`` in clean documents, and of all words under an empty term."""

    def run(batches):
        found: Counter = Counter()

        def held():
            columns = list(zip(*((*key, n) for key, n in found.items()))) if found else [[]] * 3
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))],
                ["kind", "term", "n"],
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                for kind, term, _ in terms_of(text or ""):
                    found[kind, term] += 1
                    found[kind, ""] += 1
                if len(found) > HELD_COUNTS:
                    yield held()
        yield held()

    counts = clean.select("text").mapInArrow(run, "kind STRING, term STRING, n BIGINT")
    totals = clean.sparkSession.createDataFrame([("start", ""), ("word", "")], "kind STRING, term STRING")
    wanted = bounded(terms.select("kind", "term").unionByName(totals))
    return counts.join(wanted, ["kind", "term"], "left_semi").groupBy("kind", "term").agg(F.sum("n").alias("n"))


def _shorter_wins(weights: dict[tuple[str, str], float]) -> Lexicon:
    """Leave out terms that a shorter start covers with about the same weight."""
    starts: dict[str, float] = {}
    words: dict[str, float] = {}
    for (kind, term), w in sorted(weights.items(), key=lambda x: (len(x[0][1]), x[0])):
        covered = max((starts.get(term[:n], 0.0) for n in PREFIXES if n <= len(term)), default=0.0)
        if w > covered + 0.5:
            (starts if kind == "start" else words)[term] = w
    return Lexicon(starts, words)


def learn(docs: DataFrame, labels: DataFrame, train: Column | None = None, limit: int = SAMPLE) -> Lexicon:
    """A lexicon from ``labels`` (``doc_id``, ``toxic`` 0 or 1) of ``docs`` (``doc_id``, ``text``).

    Rows where ``train`` (over doc_id) is not true are never looked at. ``limit`` bounds the documents
    of each class, and the intercept is shifted to the odds of all of them; the driver sees term counts and four features of each such document. Without
    labels of both classes the lexicon is empty.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")
    known = known.filter("doc_id is not null and toxic is not null")
    train = F.lit(True) if train is None else train
    known = known.filter(train).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    classes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    sample = written(_sample(docs.select("doc_id", "text"), known, limit), "labelled")
    toxic, clean = sample.filter("toxic = 1"), sample.filter("toxic = 0")
    contexts = _contexts(toxic).distinct().groupBy("kind", "term").agg(F.count(F.lit(1)).alias("n"))
    contexts = written(contexts, "toxic_terms")
    everything = {r.kind: r.n for r in contexts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    frequent = contexts.filter(F.col("n") >= MIN_CONTEXTS)
    counted = written(_occurrences(clean, frequent), "clean_terms")
    total = {r.kind: r.n for r in counted.filter("term = ''").collect()}
    of_kind = lambda d: F.when(F.col("kind") == "start", d.get("start", 0)).otherwise(d.get("word", 0))
    rate = (F.col("n") + 0.5) / (of_kind(everything) + 1)
    usual = (F.coalesce("usual", F.lit(0)) + 0.5) / (of_kind(total) + 1)
    both = frequent.join(counted.withColumnRenamed("n", "usual"), ["kind", "term"], "left")
    heavy = both.withColumn("weight", F.log(rate / usual)).filter(F.col("weight") >= MIN_WEIGHT)
    weights = {(r.kind, r.term): r.weight for r in heavy.collect()} if total else {}
    lexicon = _shorter_wins(weights)
    rows = _featured(sample, lexicon, ["toxic"]).select("toxic", "features").collect()
    x = np.array([r.features for r in rows]).reshape(-1, 4)
    intercept, *slopes = fit_logit(x, np.array([r.toxic for r in rows]))
    lexicon.logit = (intercept + prior_shift(classes.get(0, 0), classes.get(1, 0), limit), *slopes)
    return lexicon


def _featured(docs: DataFrame, lexicon: Lexicon, kept: list[str]) -> DataFrame:
    def run(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = [matcher.features(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(found, pa.list_(pa.float64()))],
                    [*kept, "features"],
                )

    types = dict(docs.dtypes)
    ddl = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "features ARRAY<DOUBLE>"])
    return docs.mapInArrow(run, ddl)


def score(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5) of every row.

    Only the text matters. Edge cases: null and empty texts score as a text without terms; texts are
    matched whole; repeated rows score alike; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    terms = [F.lit(b) * F.element_at("features", k + 1) for k, b in enumerate(lexicon.logit)]
    logit = terms[0] + terms[1] + terms[2] + terms[3]
    bounded_logit = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), logit))
    score = 1 / (1 + F.exp(-bounded_logit))
    return _featured(rows, lexicon, ["doc_id"]).select(
        "doc_id", score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )
