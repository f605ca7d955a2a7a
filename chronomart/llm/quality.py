"""A quality classifier: a sparse ensemble of rules, compiled into Spark columns.

Shallow trees are boosted on statistics of labelled documents.  Every path from
a root to a node is a rule, a conjunction of comparisons.  A logistic model over
all rules is fitted with a lasso penalty, chosen on a part of the sample, and the
few rules with weights become one column expression.  The driver fits on a
bounded sample (``labelled.SAMPLE_ROWS`` rows of 20 statistics); scoring is a
map over all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.llm import labelled
from chronomart.llm.stats import NAMES, with_statistics

TREES, DEPTH, BINS, RATE = 40, 3, 32, 0.25
#: Rows and statistics that one tree sees.
ROWS_PART, NAMES_PART = 0.5, 0.6
PENALTIES = (0.03, 0.01, 0.003, 0.001)
STEPS = 250
SEED = 7

#: A comparison: statistic, whether it must be above, threshold.  A rule is a set of them.
Rule = frozenset[tuple[int, bool, float]]


@dataclass(frozen=True)
class Ensemble:
    """Rules with their weights and an intercept."""

    rules: list[Rule]
    weights: list[float]
    intercept: float

    def score(self) -> Column:
        """The probability of label 1 from columns named like the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            parts = [F.col(NAMES[i]) > t if above else F.col(NAMES[i]) <= t for i, above, t in sorted(rule)]
            holds = parts[0]
            for part in parts[1:]:
                holds = holds & part
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def grow(x: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray, names: np.ndarray) -> list[tuple[Rule, np.ndarray, float]]:
    """Nodes of a regression tree as (rule, rows, Newton step); ``x`` holds the bin of each value."""
    nodes: list[tuple[Rule, np.ndarray, float]] = []
    todo = [(frozenset(), np.arange(len(x)))]
    while todo:
        rule, rows = todo.pop()
        if len(rule) >= DEPTH or len(rows) < 10:
            continue
        g, w = gradient[rows], weight[rows]
        best = None
        for i in names:
            bins = x[rows, i]
            left_g = np.cumsum(np.bincount(bins, g, BINS))[:-1]
            left_w = np.cumsum(np.bincount(bins, w, BINS))[:-1]
            gain = left_g**2 / (left_w + 1) + (g.sum() - left_g) ** 2 / (w.sum() - left_w + 1) - g.sum() ** 2 / (w.sum() + 1)
            gain[: len(gain)][np.arange(BINS - 1) >= len(cuts[i])] = -1
            at = int(gain.argmax())
            if gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
                best = gain[at], i, at
        if best is None:
            continue
        _, i, at = best
        below = x[rows, i] <= at
        for above, part in ((False, rows[below]), (True, rows[~below])):
            if len(part):
                child = rule | {(int(i), above, float(cuts[i][at]))}
                nodes.append((child, part, float(gradient[part].sum() / (weight[part].sum() + 1))))
                todo.append((child, part))
    return nodes


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    result = np.ones(len(x), dtype=bool)
    for i, above, t in rule:
        result &= (x[:, i] > t) == above
    return result


def extract_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """All different paths of the boosted trees."""
    random = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)])
    margin, found = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), {}
    for _ in range(TREES):
        rows = np.flatnonzero(random.random(len(y)) < ROWS_PART)
        names = np.flatnonzero(random.random(x.shape[1]) < NAMES_PART)
        p = sigmoid(margin[rows])
        for rule, part, _ in (nodes := grow(binned[rows], cuts, y[rows] - p, p * (1 - p), names)):
            found.setdefault(rule, len(part))
        inner = {r - {c} for r, _, _ in nodes for c in r}
        for rule, _, step in nodes:
            if rule not in inner:  # a leaf
                margin += RATE * step * holds(rule, x)
    return list(found)


def lasso(r: np.ndarray, y: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model with an L1 penalty on standardised rules."""
    share = r.mean(axis=0)
    scale = np.sqrt(np.maximum(share * (1 - share), 1e-4))
    z = ((r - share) / scale).astype(np.float32)
    step = 4 / max(1e-9, np.linalg.norm(z.T @ z / len(y), 2) + 1)
    w, b, v, c, t = np.zeros(r.shape[1], np.float32), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)), None, None, 1.0
    v, c = w, b
    for _ in range(STEPS):
        error = (sigmoid(z @ v + c) - y).astype(np.float32)
        new = v - step * (z.T @ error / len(y))
        new = (np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)).astype(np.float32)
        new_b = c - step * error.mean()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, c = new + np.float32((before - 1) / t) * (new - w), new_b + (before - 1) / t * (new_b - b)
        w, b = new, new_b
    return (w / scale).astype(np.float64), float(b - (w / scale) @ share)


def log_loss(score: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(score, 1e-9, 1 - 1e-9)
    return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """An ensemble for statistics ``x`` (a row per document) and labels 0 and 1.

    With no rows or one class only, the score is a constant.
    """
    if not 0 < y.sum() < len(y):
        return Ensemble([], [], float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    # Of rules that hold for the same documents the shortest stands for all.
    distinct: dict[bytes, Rule] = {}
    for rule in sorted(extract_rules(x, y), key=lambda rule: (len(rule), sorted(rule))):
        distinct.setdefault(holds(rule, x).tobytes(), rule)
    rules = list(distinct.values())
    r = np.column_stack([holds(rule, x) for rule in rules]).astype(np.float32)
    test = np.arange(len(y)) % 5 == 0
    best = PENALTIES[-1]
    if 0 < y[~test].sum() < (~test).sum() and test.any():
        tried = [(p, lasso(r[~test], y[~test], p)) for p in PENALTIES]
        best = min(tried, key=lambda t: log_loss(sigmoid(r[test] @ t[1][0] + t[1][1]), y[test]))[0]
    w, b = lasso(r, y, best)
    used = np.flatnonzero(np.abs(w) > 1e-6)
    return Ensemble([rules[i] for i in used], w[used].tolist(), b)


def train(docs: DataFrame, labels: DataFrame, learnt: Column, label: str = "quality") -> Ensemble:
    """Fit on the documents with labels for which ``learnt`` (a column of ``labels``) holds."""
    known = labelled.sampled(docs.select("doc_id", "text"), labelled.sample(labels, label, learnt))
    # Repeated documents must come in an order of their own: the fit depends on it.
    rows = with_statistics(known, ["doc_id", "label"]).orderBy("doc_id", *NAMES).toPandas()
    return fit(rows[list(NAMES)].to_numpy(np.float64), rows["label"].to_numpy(np.float64))


def scored(docs: DataFrame, ensemble: Ensemble, kept: list[str]) -> DataFrame:
    """Columns ``kept`` of every document (whatever their names), and its score; null texts count as empty."""
    inner = [f"kept_{i}" for i in range(len(kept))]  # no statistic has such a name
    rows = docs.select(*[F.col(c).alias(i) for c, i in zip(kept, inner, strict=True)], "text")
    rows = with_statistics(rows, inner)
    return rows.select(*[F.col(i).alias(c) for c, i in zip(kept, inner, strict=True)], ensemble.score().alias("score"))
