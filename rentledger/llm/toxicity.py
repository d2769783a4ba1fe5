"""Toxicity classifier with counterfactual regularisation.

A logistic model over the presence of words and word beginnings. Besides the loss on labelled documents, training
penalises the change of a score when an identity term in a labelled sentence is swapped for another or for a neutral word;
mentions of a group then don't move a score by themselves. Features are chosen from counts over the training rows, made
by Spark; the model is fitted on the driver, on a bounded sample in which equal texts count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, numbered, row_number, type_of
from .tokens import text_batches

THRESHOLD = 0.7
# Bounds of the training: labelled rows and the size of the model in features.
ROWS, FEATURES = 20_000, 20_000
LEAST_DOCS, LEAST_LIFT = 3, 3.0
BEGINNINGS = (3, 4, 5, 6)
PENALTY, RIDGE, STEPS, RATE = 10.0, 1e-4, 400, 0.1

# Terms that name groups of people; those of one line replace each other, and each is replaced by the line's last, neutral one.
IDENTITY = tuple(
    tuple(line.split())
    for line in (
        "women men girls boys transgender nonbinary people",
        "woman man girl boy lady gentleman person",
        "gay lesbian bisexual queer straight heterosexual trans homosexual local",
        "black white asian latino hispanic african arab european indigenous local",
        "muslim christian jewish hindu buddhist sikh atheist catholic protestant religious",
        "muslims christians jews hindus buddhists sikhs atheists catholics protestants people",
        "immigrants refugees foreigners natives migrants citizens people",
        "mexican chinese indian american german french turkish polish russian nigerian local",
        "disabled blind deaf autistic elderly old young adult",
        "femmes hommes filles garçons personnes",
        "noirs blancs arabes asiatiques juifs musulmans chrétiens immigrés réfugiés personnes",
        "frauen männer mädchen jungen menschen",
        "schwarze weiße juden muslime christen türken flüchtlinge ausländer menschen",
        "mujeres hombres chicas chicos personas",
        "negros blancos judíos musulmanes cristianos gitanos inmigrantes refugiados personas",
    )
)
_WORD = re.compile(r"\w+")


class Model(NamedTuple):
    places: dict[str, int]  # feature to its place in weights
    weights: list[float]
    bias: float


def word_features(word: str) -> list[str]:
    """The word itself, and its beginnings marked by a trailing ``*``."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}


def swaps(text: str) -> Iterator[tuple[set[str], set[str]]]:
    """Features that a text loses and gains when an identity term is swapped in its sentences, for each term in it and both substitutes.

    A feature that another word of the text has as well is neither lost nor gained. Every term counts once, so there are at most twice as many
    swaps as terms.
    """
    words = set(_WORD.findall(text.lower()))
    held = Counter(f for w in words for f in word_features(w))
    for terms in IDENTITY:
        for k, term in enumerate(terms[:-1]):
            if term in words:
                for other in dict.fromkeys((terms[(k + 1) % (len(terms) - 1)], terms[-1])):
                    if other == term:
                        continue
                    gone = {f for f in word_features(term) if held[f] == 1}
                    come = set(word_features(other)) if other not in words else set()
                    yield gone - come, {f for f in come - gone if not held[f]}


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: the crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """``text, toxic`` of at most ``rows`` labelled documents outside the held-out part, the same on every run."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64(F.col("_id")), "_id").limit(rows)
    # At most ``rows`` pairs of numbers are broadcast.
    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return picked.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def _counts(rows: DataFrame) -> DataFrame:
    """``feature, toxic, docs``: in how many texts each feature is, partial sums."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            for toxic in (0, 1):
                items = list(counts[toxic].items())
                counts[toxic].clear()
                for i in range(0, len(items), 100_000):
                    names, n = zip(*items[i : i + 100_000])
                    columns = [pa.array(names, pa.string()), pa.array([toxic] * len(n), pa.int32()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["feature", "toxic", "docs"])

        for whole in batches:
            for batch in text_batches(whole, 64):
                for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    counts[int(toxic > 0)].update(features(text))
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield from flush()
        yield from flush()

    return rows.mapInArrow(run, "feature string, toxic int, docs long")


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, rows: int = ROWS, penalty: float = PENALTY) -> Model:
    """Fit on labelled rows only. Without toxic or without clean rows the model scores every text by the share of toxic ones.

    The model takes the ``FEATURES`` features that separate the training rows best; fewer are found on the tables at hand.
    """
    sample = scratch.save(training_rows(docs, labels, rows), "training")
    sides = {r["toxic"] > 0: r["count"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    toxic, clean = sides.get(True, 0), sides.get(False, 0)
    if not toxic or not clean:
        return Model({}, [], 30.0 if toxic else -30.0)
    counts = _counts(sample).groupBy("feature").agg(
        F.sum(F.col("docs") * F.col("toxic")).alias("toxic"), F.sum(F.col("docs") * (1 - F.col("toxic"))).alias("clean")
    )
    lift = (F.col("toxic") / toxic) / ((F.col("clean") + 1) / clean)
    rank = F.col("toxic") * F.log(lift)
    chosen = counts.where((F.col("toxic") >= LEAST_DOCS) & (lift >= LEAST_LIFT)).orderBy(rank.desc(), "feature").limit(FEATURES)
    places = {r["feature"]: k for k, r in enumerate(chosen.select("feature").collect())}

    def run(batches) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch in text_batches(whole, 64):
                rows: list[tuple] = []
                for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    there = features(text)
                    rows.append((int(toxic > 0), sorted(places[f] for f in there if f in places), None))
                    for gone, come in swaps(text):
                        lost, gained = (sorted(places[f] for f in x if f in places) for x in (gone, come))
                        if lost or gained:
                            rows.append((int(toxic > 0), lost, gained))
                kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays(columns, names=["toxic", "a", "b"])

    made = sample.mapInArrow(run, "toxic int, a array<int>, b array<int>").collect()
    return _fit(places, made, penalty)


def _fit(places: dict[str, int], made: list, penalty: float) -> Model:
    """Minimise balanced log loss + penalty * mean squared score change over the swaps + ridge, by Adam steps."""
    import numpy as np

    docs, swaps = [r for r in made if r["b"] is None], [r for r in made if r["b"] is not None]
    docs.sort(key=lambda r: (r["toxic"], r["a"]))
    swaps.sort(key=lambda r: (r["a"], r["b"]))

    def flat(lists):
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        return row, np.array([i for x in lists for i in x], np.int64)

    row, place = flat([r["a"] for r in docs])
    s_row, s_place = flat([r["a"] + r["b"] for r in swaps])
    sign = np.array([v for r in swaps for v in [1.0] * len(r["a"]) + [-1.0] * len(r["b"])])
    y = np.array([r["toxic"] for r in docs], float)
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    n, w, b = len(places), np.zeros(len(places)), 0.0
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = b + np.bincount(row, w[place], len(docs))
        r = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(place, r[row], n) + RIDGE * w
        if swaps:
            change = np.bincount(s_row, sign * w[s_place], len(swaps))
            g += 2 * penalty / len(swaps) * np.bincount(s_place, sign * change[s_row], n)
        gb = r.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9**step, 1 - 0.999**step
        w -= RATE * (m / fix) / (np.sqrt(v / fix2) + 1e-8)
        b -= RATE * (mb / fix) / (vb / fix2 + 1e-16) ** 0.5
    return Model(places, w.tolist(), float(b))


def score(docs: DataFrame, model: Model, number: str | None = None) -> DataFrame:
    """``doc_id, row_no, score`` of whole texts; null and empty texts get the score of the bias."""
    places, weights, bias = model

    def run(batches) -> Iterator:
        from math import exp

        import pyarrow as pa

        @lru_cache(1 << 18)
        def known(word: str) -> tuple[int, ...]:
            return tuple(places[f] for f in word_features(word) if f in places)

        for whole in batches:
            for batch in text_batches(whole):
                scores = []
                for text in batch.column(2).to_pylist():
                    there = {p for w in set(_WORD.findall((text or "").lower())) for p in known(w)}
                    z = bias + sum(weights[p] for p in sorted(there))
                    scores.append(1 / (1 + exp(-max(-30.0, min(30.0, z)))))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["doc_id", "row_no", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_number(number), "text")
    return rows.mapInArrow(run, f"doc_id long, row_no {type_of(rows, 'row_no')}, score double")


def classify(docs: DataFrame, labels: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, number: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, row_no``.

    Inputs of a score are the words of the text alone. Repeated rows are scored alike; labels of one id that differ count as toxic; a
    null doc_id isn't held out. Other columns are ignored.
    """
    scored = score(docs, train(docs, labels, scratch), number)
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "row_no")


def keep_clean(docs: DataFrame, labels: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, all columns."""
    rows, number = numbered(docs, scratch)
    clean = classify(rows, labels, scratch, threshold, number).where("predicted = 0").select(F.col("row_no").alias(number))
    return rows.join(clean, number, "left_semi").drop(number)
