"""Language identification by Bayesian fusion of evidence.

For each document the log posterior of a language is the sum of

* the likelihood of its text: byte trigrams under a model per language, and a uniform model of no
  known language, which wins where the text fits none;
* the likelihood of the language its markup declares, given that declarations err at a known rate;
* the likelihood of the suffix of its address, the same way;
* a prior of its host: the languages of the host's documents, smoothed towards its domain, and that
  towards the whole corpus. These are grouped sums of the posteriors without a host, over all rows.

The trigram counts come from a bounded sample of labelled documents; everything else is computed
over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.lookup import bounded
from martloom.session import written

LANGUAGES = ("en", "de", "fr", "es")
# Labelled documents of each language that the model is fitted on at most.
SAMPLE = 1_500
SLOTS = 1 << 16
# Trigrams of a text depend on each other: their likelihood counts by this power, and by no more
# than this many trigrams.
TEXT_POWER = 0.3
TEXT_TRIGRAMS = 2_000
DECLARED_ERRS = 0.1
SUFFIX_ERRS = 0.3
# Documents of a parent that count as much as one host's own.
SMOOTHING = 20.0
# Prior of a text in none of the languages, and the least posterior of an accepted one.
UNKNOWN = 1e-4
ACCEPT = 0.6
# Language of the last label of an address (fixed values; labels like "com" say nothing).
SUFFIXES = {"en": "en", "uk": "en", "us": "en", "ie": "en", "de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es"}

# ASCII letters fold to lower case; white space, digits and ASCII signs to one space.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x41:0x5B] = _FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)


def trigrams(text: bytes) -> np.ndarray:
    """Slots of the byte trigrams of a folded text; blank runs count once."""
    data = _FOLD[np.frombuffer(b" " + text + b" ", dtype=np.uint8)]
    blank = data == 0x20
    data = data[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, dtype=np.uint32)
    mixed = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761)
    return mixed >> np.uint32(16)


@dataclass
class Model:
    """Log likelihoods: one row a slot, one column a language and a last one for none of them."""

    languages: tuple[str, ...]
    table: np.ndarray

    def of(self, text: bytes) -> tuple[int, np.ndarray]:
        slots = trigrams(text)
        if not len(slots):
            return 0, np.zeros(self.table.shape[1])
        total = self.table[slots].sum(axis=0, dtype=np.float64)
        return len(slots), total * TEXT_POWER * min(1.0, TEXT_TRIGRAMS / len(slots))


def fit(docs: DataFrame, languages: Sequence[str] = LANGUAGES, limit: int = SAMPLE) -> Model:
    """A model from ``text`` and ``lang`` of up to ``limit`` documents of each language, by a hash
    of doc_id. The driver sees one count a slot and language."""

    def run(batches):
        counts = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                slots = trigrams((text or "").encode())
                found = np.bincount(slots, minlength=SLOTS)
                counts[lang] = counts[lang] + found if lang in counts else found
        for lang, found in counts.items():
            slot = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slot)), pa.array(slot, pa.int32()), pa.array(found[slot], pa.int64())],
                ["lang", "slot", "n"],
            )

    known = docs.select("doc_id", "lang").filter(F.col("lang").isin(*languages))
    order = F.xxhash64("doc_id")
    picked = [known.filter(F.col("lang") == x).orderBy(order, "doc_id").limit(limit) for x in languages]
    ids = picked[0]
    for more in picked[1:]:
        ids = ids.unionByName(more)
    sample = docs.join(F.broadcast(ids.distinct()), ["doc_id", "lang"]).select("text", "lang")
    counted = sample.mapInArrow(run, "lang STRING, slot INT, n BIGINT")
    table = np.zeros((SLOTS, len(languages) + 1))
    for r in counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect():
        table[r.slot, languages.index(r.lang)] = r.n
    table[:, -1] = table.sum() or 1
    smoothed = table + 0.02
    return Model(tuple(languages), np.log(smoothed / smoothed.sum(axis=0)).astype(np.float32))


def _text_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with the number of trigrams and the log likelihoods in place of ``text``."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = [model.of(t or b"") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([x.tolist() for _, x in found], pa.list_(pa.float64())),
                ],
                [*kept, "trigrams", "text_log"],
            )

    types = dict(rows.dtypes)
    ddl = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "trigrams BIGINT, text_log ARRAY<DOUBLE>"])
    return rows.mapInArrow(run, ddl)


def _said(value: Column, languages: Sequence[str], errs: float) -> list[Column]:
    """Log likelihood of a statement under each language and under none; nothing said, no evidence."""
    wrong = math.log(errs / len(languages))
    known = F.coalesce(value.isin(*languages), F.lit(False))
    one = [F.when(value == x, math.log(1 - errs)).otherwise(wrong) for x in languages]
    return [F.when(known, x).otherwise(0.0) for x in [*one, F.lit(math.log(1 / len(languages)))]]


def _posterior(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def _add(*lists: Column) -> Column:
    out = lists[0]
    for more in lists[1:]:
        out = F.zip_with(out, more, lambda x, y: x + y)
    return out


def _summed(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Per key the sums of the posteriors; partial sums come before the exchange."""
    sums = [F.sum(F.element_at("alone", k + 1)).alias(f"s{k}") for k in range(size)]
    return rows.groupBy(key).agg(*sums).select(key, F.array(*(f"s{k}" for k in range(size))).alias("own"))


def _smooth(own: Column, parent: Column) -> Column:
    """Rates of one level, with ``SMOOTHING`` documents of its parent mixed in."""
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(own, parent, lambda x, p: (x + SMOOTHING * p) / (total + SMOOTHING))


def identify(
    rows: DataFrame,
    model: Model,
    key: Column,
    text: Column,
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
) -> DataFrame:
    """``key, lang, posterior, accepted, text_lang, trigrams`` of every row.

    ``declared`` is a language tag ("de-AT" counts as "de"), ``host`` the name whose documents share
    a prior (its last two labels are the domain), ``suffix`` the label of the address that stands
    for a language. ``lang`` is null where no language is known for the text; ``accepted`` says that
    its posterior reaches 0.6.

    Edge cases: without text, or with no letters in it, the other evidence decides, and the row is
    not accepted. Null or unknown statements count as not made; rows without host take the prior of
    the corpus. Texts count whole. Repeated rows each get a result. An empty table gives no rows.
    ``rows`` may hold any other columns.
    """
    nothing = F.lit(None).cast("string")
    size = len(model.languages) + 1
    name = F.nullif(F.lower(F.trim(host)), F.lit("")) if host is not None else nothing
    tag = F.substring_index(F.lower(F.trim(declared)), "-", 1) if declared is not None else nothing
    last = F.lower(suffix) if suffix is not None else nothing
    place = F.element_at(F.create_map(*(F.lit(x) for kv in SUFFIXES.items() for x in kv)), last)
    facts = rows.select(
        key.alias("key"),
        text.alias("text"),
        F.coalesce(tag, F.lit("")).alias("tag"),
        F.coalesce(place, F.lit("")).alias("place"),
        name.alias("host"),
        F.substring_index(name, ".", -2).alias("domain"),
    )
    seen = _text_evidence(facts, model)
    base = F.array(
        *[F.lit(math.log((1 - UNKNOWN) / len(model.languages)))] * len(model.languages),
        F.lit(math.log(UNKNOWN)),
    )
    evidence = _add(
        F.col("text_log"),
        F.array(*_said(F.col("tag"), model.languages, DECLARED_ERRS)),
        F.array(*_said(F.col("place"), model.languages, SUFFIX_ERRS)),
    )
    seen = seen.withColumn("logs", evidence).withColumn("alone", _posterior(_add(F.col("logs"), base)))
    seen = written(seen.drop("tag", "place"), "evidence")

    flat = F.array(*[F.lit((1 - UNKNOWN) / len(model.languages))] * len(model.languages), F.lit(UNKNOWN))
    corpus = _summed(seen.withColumn("all", F.lit(0)), "all", size).select(_smooth(F.col("own"), flat))
    rates = (corpus.first() or [[1 / size] * size])[0]  # one number a language
    corpus = F.array(*map(F.lit, rates))
    domains = _summed(seen.filter("domain is not null"), "domain", size)
    domains = domains.select("domain", _smooth(F.col("own"), corpus).alias("of_domain"))
    hosts = _summed(seen.filter("host is not null"), "host", size)
    hosts = hosts.join(domains, F.substring_index(F.col("host"), ".", -2) == F.col("domain"))
    hosts = hosts.select("host", _smooth(F.col("own"), F.col("of_domain")).alias("of_host"))
    hosts = written(hosts, "host_priors")

    prior = F.transform(F.coalesce("of_host", corpus), lambda x: F.log(F.greatest(x, F.lit(1e-12))))
    labels = F.array(*map(F.lit, model.languages), nothing)
    best = lambda logs: F.element_at(labels, F.array_position(logs, F.array_max(logs)).cast("int"))
    fused = seen.join(bounded(hosts), "host", "left")
    fused = fused.withColumn("p", _posterior(_add(F.col("logs"), prior)))
    lang = best(F.col("p"))
    return fused.select(
        "key",
        lang.alias("lang"),
        F.array_max("p").alias("posterior"),
        (lang.isNotNull() & (F.array_max("p") >= ACCEPT) & (F.col("trigrams") > 0)).alias("accepted"),
        F.when(F.col("trigrams") > 0, best(F.col("text_log"))).alias("text_lang"),
        "trigrams",
    )
