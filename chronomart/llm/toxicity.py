"""Toxicity by weak supervision: many lexicon and pattern voters, one label model, one linear classifier.

Voters are words and beginnings of words that occur far more often in documents
labelled toxic (a grouped count over a bounded sample of labelled documents), and
a few patterns of form.  A generative model with a hidden label explains which
voters fire: expectation maximisation estimates how often each fires for toxic
and for other documents (its accuracy), and the correlation that is left between
voters given the label discounts voters that say the same thing (a word and its
beginning).  Given labels are one more voter, with errors of their own.  A linear
classifier is then trained on the model's posterior labels.

The driver holds the sample's fired voters (``labelled.SAMPLE_ROWS`` rows) and
``VOTERS`` voters at most; scoring is a map over whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm import labelled
from chronomart.llm.common import fresh, text_of

STARTS = (3, 4, 5, 6, 7, 8)
PUNCTUATION = "\"'.,;:!?*$%&#|()[]<>"
VOTERS = 400
#: A voter is found in so many toxic documents at least, and its odds are so much higher there (as logarithm).
LEAST_DOCUMENTS, LEAST_ODDS = 4, 2.0
ROUNDS, SETTLED = 30, 5
#: Correlations given the label count from here on.
LEAST_CORRELATION = 0.1
RIDGE, STEPS = 1e-3, 300


def words_of(text: str) -> tuple[set[str], int]:
    """The distinct words of a text in lower case without outer punctuation, and the number of all."""
    words = text.lower().split()
    return {w.strip(PUNCTUATION) for w in set(words)}, len(words)


def form(text: str, words: int) -> set[str]:
    """Patterns of form."""
    letters = sum(map(text.count, "aeiouAEIOU"))
    shouted = sum(map(text.count, "AEIOU"))
    found = set()
    if letters and shouted > 0.6 * letters:
        found.add("form:capitals")
    if text.count("!") > 0.2 * max(1, words):
        found.add("form:shouts")
    return found


def features(text: str) -> set[str]:
    words, count = words_of(text)
    found = form(text, count) | {f"word:{w}" for w in words if w}
    for k in STARTS:
        found |= {f"start:{w[:k]}" for w in words if len(w) > k}
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (label, text) -> how many texts of each label have a feature, within this task."""
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label].update(features(text))
    for label, found in enumerate(counts):
        names = list(found)
        for start in range(0, len(names), 50_000):
            some = names[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([label] * len(some), pa.int32()), pa.array([found[n] for n in some], pa.int64())],
                ["feature", "label", "n"],
            )


class Voters:
    """Which voters fire in a text."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        number = {n: i for i, n in enumerate(names)}
        self.words = {n[5:]: i for n, i in number.items() if n.startswith("word:")}
        self.forms = {n: i for n, i in number.items() if n.startswith("form:")}
        self.starts: dict[int, dict[str, int]] = {}
        for n, i in number.items():
            if n.startswith("start:"):
                self.starts.setdefault(len(n) - 6, {})[n[6:]] = i

    def fired(self, text: str) -> tuple[list[int], int, int]:
        """Voters that fire, the number of distinct words they fire for, and of all words."""
        words, count = words_of(text)
        hit = words & self.words.keys()
        found = {self.words[w] for w in hit}
        for k, table in self.starts.items():
            for w in words:
                if len(w) > k and w[:k] in table:
                    found.add(table[w[:k]])
                    hit.add(w)
        found |= {self.forms[f] for f in form(text, count) if f in self.forms}
        return sorted(found), len(hit), count


@dataclass(frozen=True)
class Model:
    """Voters, a weight for each and for the three numbers of ``numbers``, and an intercept."""

    names: list[str]
    weights: np.ndarray
    intercept: float


def numbers(hits: Iterable[int], words: Iterable[int]) -> np.ndarray:
    """How many words voters fire for, and how dense they are."""
    h, w = np.array(hits, np.float64), np.array(words, np.float64)
    return np.column_stack([np.log1p(h), np.minimum(1.0, 20 * h / np.maximum(w, 20)), h > 0])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def posterior(fires: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Probabilities of the hidden label, from voters (rows x voters, 0 or 1) and given labels.

    Starts where given labels are right nine times in ten.
    """
    q = np.where(given > 0, 0.9, 0.1)
    weight = np.ones(fires.shape[1])
    for i in range(ROUNDS):
        share = (q.sum() + 1) / (len(q) + 2)
        rate = lambda p, x: (p @ x + 0.5) / (p.sum() + 1)
        a, b = rate(q, fires), rate(1 - q, fires)
        la, lb = rate(q, given), rate(1 - q, given)
        if i >= SETTLED and i % SETTLED == 0:
            rest = fires - q[:, None] * a - (1 - q)[:, None] * b
            spread = np.sqrt((rest**2).mean(axis=0)) + 1e-9
            linked = np.abs(rest.T @ rest / len(q) / spread[:, None] / spread[None, :])
            weight = 1 / np.maximum(1.0, np.where(linked >= LEAST_CORRELATION, linked, 0).sum(axis=0))
        odds = np.log(share / (1 - share)) + np.log((1 - la) / (1 - lb)) + given * (np.log(la / lb) - np.log((1 - la) / (1 - lb)))
        silent = np.log((1 - a) / (1 - b)) * weight
        q = sigmoid(odds + silent.sum() + fires @ (np.log(a / b) * weight - silent))
    return q


def regress(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float]:
    """A ridge logistic regression on soft labels by accelerated gradient steps."""
    q = q.astype(x.dtype)
    step = 4 / (float(np.linalg.norm(x.T @ x / len(q), 2)) + 1 + 4 * RIDGE)
    w = v = np.zeros(x.shape[1], x.dtype)
    b = c = float(np.log((q.mean() + 1e-6) / (1 - q.mean() + 1e-6)))
    t = 1.0
    for _ in range(STEPS):
        error = sigmoid(x @ v + c) - q
        new, new_b = v - step * (x.T @ error / len(q) + RIDGE * v), c - step * float(error.mean())
        t, before = (1 + float(np.sqrt(1 + 4 * t * t))) / 2, t
        v, c = new + (before - 1) / t * (new - w), new_b + (before - 1) / t * (new_b - b)
        w, b = new, new_b
    return w.astype(np.float64), float(b)


def train(docs: DataFrame, labels: DataFrame, learnt: Column, label: str = "toxic") -> Model:
    """Fit on the documents with labels for which ``learnt`` (a column of ``labels``) holds.

    Without documents of both labels the score is a constant.
    """
    known = labelled.sampled(docs.select("doc_id", text_of().alias("text")), labelled.sample(labels, label, learnt))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    constant = Model([], np.zeros(3), float(np.log((toxic + 0.5) / (other + 0.5))))
    if not toxic or not other:
        return constant
    counts = known.select("label", "text").mapInArrow(_counted, "feature string, label int, n long")
    counts = counts.groupBy("feature").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("other"),
    )
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("other") + 0.5) / (other + 1))
    chosen = counts.withColumn("odds", odds).filter(
        (F.col("toxic") >= LEAST_DOCUMENTS) & (F.col("odds") >= LEAST_ODDS) | F.col("feature").startswith("form:")
    )
    names = [r["feature"] for r in chosen.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "feature").limit(VOTERS).collect()]
    if not names:
        return constant
    voters = Voters(names)

    def fired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [voters.fired(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                ["label", "fired", "hits", "words"],
            )

    rows = known.select("label", "text").mapInArrow(fired, "label int, fired array<int>, hits long, words long")
    rows = sorted(map(tuple, rows.collect()))  # a fixed order: sums depend on it
    fires = np.zeros((len(rows), len(names)), np.float32)
    for i, (_, found, _, _) in enumerate(rows):
        fires[i, found] = 1
    label_of, _, hits, words = zip(*rows, strict=True)
    q = posterior(fires, np.array(label_of, np.float32))
    return Model(names, *regress(np.hstack([fires, numbers(hits, words).astype(np.float32)]), q))


def _scorer(model: Model, text: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, weights = Voters(model.names), model.weights[: len(model.names)]
        for batch in batches:
            found = [voters.fired(t or "") for t in batch.column(text).to_pylist()]
            form = numbers([f[1] for f in found], [f[2] for f in found]) @ model.weights[len(model.names) :]
            margin = np.array([weights[f[0]].sum() for f in found]) + form + model.intercept
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(margin))], [*batch.schema.names, "score"])

    return run


def scored(docs: DataFrame, model: Model, to: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the probability of being toxic in a new column ``to``; null texts count as empty."""
    docs = docs.drop(to)
    (own,) = fresh(docs, "score")
    if own != "score":  # the worker's own name is taken
        return scored(docs.withColumnRenamed("score", own), model, to, text).withColumnRenamed(own, "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(_scorer(model, docs.columns.index(text)), schema).withColumnRenamed("score", to)
