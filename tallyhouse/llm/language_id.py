"""Language of a text in two steps: its family, then the language within the family.

Features are the shares of hashed byte n-grams of the lower-cased text. One linear support vector machine
per family, each against the rest, picks the family; within it every pair of languages has a linear support
vector machine of its own, and the language with the most votes wins (at a tie the one with the larger sum
of margins). All machines are trained by numpy stochastic subgradient descent on the hinge loss with a
quadratic penalty, averaged over the later steps, and scored at once: each n-gram gives one number per machine.

The machines are fitted on a bounded sample: per language ``max_per_language`` rows, those with the smallest
hash of the id. At most that many times the number of languages times ``buckets`` numbers reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm import features
from tallyhouse.llm.text import blocks, give_back

# Close relatives. A language that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic",
}
BUCKETS = 1 << 15
SIZES = (1, 2, 3)
MAX_PER_LANGUAGE = 500
EPOCHS = 12
PENALTY = 1e-4
START = 250
BIAS_SHARE = 1 / 800
UNKNOWN = "und"


@dataclass
class Model:
    """Machines as columns of ``weights``: first the families, then ``pairs`` of languages."""

    weights: np.ndarray
    bias: np.ndarray
    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]

    def predict(self, block) -> tuple[list[str], np.ndarray]:
        """Language and score of each document. The score is the product of the logistic values of the
        winning family's margin and of the winning language's mean margin."""
        found, docs = features.character_grams(block, SIZES, len(self.weights))
        margins = features.mean_of(self.weights[found], docs, len(block)) + self.bias
        n = len(self.families)
        family = margins[:, :n].argmax(axis=1)
        logistic = lambda x: 1 / (1 + np.exp(-np.clip(2 * x, -30, 30)))
        score = logistic(margins[np.arange(len(block)), family])
        names = [self.members[self.families[f]][0] for f in family]
        for f, name in enumerate(self.families):
            languages, rows = self.members[name], np.flatnonzero(family == f)
            if len(languages) == 1 or not len(rows):
                continue
            votes, total = np.zeros((len(rows), len(languages))), np.zeros((len(rows), len(languages)))
            for k, (a, b) in enumerate(self.pairs):
                if a in languages:
                    margin, i, j = margins[rows, n + k], languages.index(a), languages.index(b)
                    votes[:, i] += margin >= 0
                    votes[:, j] += margin < 0
                    total[:, i] += margin
                    total[:, j] -= margin
            best = np.lexsort((total, votes), axis=1)[:, -1]
            score[rows] *= logistic(total[np.arange(len(rows)), best] / (len(languages) - 1))
            for r, b in zip(rows, best):
                names[r] = languages[b]
        return names, score


def subgradient_step(weights: np.ndarray, bias: float, at: np.ndarray, values: np.ndarray, sign: int, cost: float,
                     pace: float) -> float:
    """One step down the penalised hinge loss of a row, weights in place; returns the new bias."""
    inside = sign * (values @ weights[at] + bias) < 1
    weights *= 1 - pace * PENALTY
    if inside:
        weights[at] += pace * cost * sign * values
        bias += pace * cost * sign * BIAS_SHARE
    return bias


def _machine(rows, signs: np.ndarray, buckets: int, epochs: int, random) -> tuple[np.ndarray, float]:
    """A linear support vector machine; both signs weigh the same.

    Steps fall as 1 / (penalty * (t + start)), the usual rate for this loss; the result is the mean of the
    weights after each step of the second half.
    """
    weights, bias = np.zeros(buckets), 0.0
    mean, mean_bias, averaged = np.zeros(buckets), 0.0, 0
    share = {s: max(1, (signs == s).sum()) for s in (-1, 1)}
    cost = {s: len(signs) / (2 * n) for s, n in share.items()}
    t = 0
    for epoch in range(epochs):
        for i in random.permutation(len(rows)):
            at, values = rows[i]
            bias = subgradient_step(weights, bias, at, values, signs[i], cost[signs[i]], 1 / (PENALTY * (t + START)))
            t += 1
            if 2 * epoch >= epochs - 1:
                averaged += 1
                mean += weights
                mean_bias += bias
    return mean / max(1, averaged), mean_bias / max(1, averaged)


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], families: dict[str, str] = FAMILIES,
          buckets: int = BUCKETS, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Fit all machines on rows of (buckets, counts, language); no rows give a model that knows nothing."""
    rows = [(f, c / c.sum(), lang) for f, c, lang in rows if len(f)]
    languages = sorted({lang for *_, lang in rows})
    members: dict[str, list[str]] = {}
    for lang in languages:
        members.setdefault(families.get(lang, f"only {lang}"), []).append(lang)
    names, random = sorted(members), np.random.default_rng(seed)
    pairs = [pair for name in names for pair in combinations(members[name], 2)]
    shares, known = [(f, v) for f, v, _ in rows], np.array([lang for *_, lang in rows])
    family_of = {lang: name for name, langs in members.items() for lang in langs}
    found = []
    for name in names:
        signs = np.array([1 if family_of[lang] == name else -1 for lang in known])
        found.append(_machine(shares, signs, buckets, epochs, random))
    for a, b in pairs:
        some = np.flatnonzero((known == a) | (known == b))
        found.append(_machine([shares[i] for i in some], np.where(known[some] == a, 1, -1), buckets, epochs, random))
    weights = np.stack([w for w, _ in found], 1) if found else np.zeros((buckets, 0))
    return Model(weights.astype(np.float32), np.array([b for _, b in found]), names, members, pairs)


def _letters(text: str) -> Column:
    """The lower-cased text with every run of other characters than letters as one space."""
    return F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{M}]+", " ")


def fit(docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text",
        lang_column: str = "lang", max_per_language: int = MAX_PER_LANGUAGE, families=FAMILIES,
        buckets: int = BUCKETS) -> Model:
    """Train on the rows with text and language for which ``learn`` holds (over the column ``id``).

    Languages are counted first; of each, the rows whose hash lies in the share of the hash range that
    should hold twice the wanted number are ranked by that hash, so the ranking has as few rows for a
    frequent language as for a rare one. The shares, one row per language, of which the model has a machine
    each, are broadcast: no row is shuffled before that filter.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"),
                       F.col(f"`{lang_column}`").alias("lang")).filter(
        learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    ids = rows.select("id", "lang", F.xxhash64("text").alias("hash"), F.xxhash64("id", "text").alias("place"))
    share = ids.groupBy("lang").agg((F.lit(2.0 * max_per_language) / F.count(F.lit(1))).alias("share"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    near = F.col("place") <= (F.col("share") - 0.5) * F.lit(2.0 ** 64)
    chosen = ids.join(F.broadcast(share), "lang").filter(near).withColumn("rank", rank) \
        .filter(F.col("rank") <= max_per_language).select("id", "lang", "hash").distinct()
    # At most max_per_language rows for each language, so the texts need no shuffle.
    texts = rows.withColumn("hash", F.xxhash64("text")).join(F.broadcast(chosen), ["id", "lang", "hash"], "left_semi") \
        .select("lang", _letters("text").alias("text"))

    def count(batches):
        for some, block in blocks(batches, "text"):
            found = features.counted(*features.character_grams(block, SIZES, buckets), len(block))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([f.astype("<i4").tobytes() for f, _ in found], pa.binary()),
                 pa.array([c.astype("<i4").tobytes() for _, c in found], pa.binary())], ["lang", "found", "counts"])

    counted = texts.mapInArrow(count, "lang string, found binary, counts binary")
    sample = [(np.frombuffer(r.found, "<i4"), np.frombuffer(r.counts, "<i4"), r.lang) for r in counted.collect()]
    sample.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))
    model = train(sample, families, buckets)
    del sample
    give_back()
    return model


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``lang_pred`` and ``score``.

    A text that is null or has no letter is ``und`` with score 0, as is every text if the model has learned
    no language. Other columns are left out, repeated rows stay.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_column].dataType.simpleString()
    known = bool(model.families)

    def run(batches):
        for rows, block in blocks(batches, "text"):
            letters = rows.column(2).to_numpy(zero_copy_only=False) & known
            names, scores = held.value.predict(block) if known else ([UNKNOWN] * len(block), np.zeros(len(block)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([n if ok else UNKNOWN for n, ok in zip(names, letters)]),
                 pa.array(np.where(letters, scores, 0.0))], ["id", "lang_pred", "score"])

    text = F.col(f"`{text_column}`")
    return docs.select(F.col(f"`{id_column}`").alias("id"), _letters(f"`{text_column}`").alias("text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters")).mapInArrow(
        run, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_column)
