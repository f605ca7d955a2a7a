import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import NASTY, documents

from chronomart.llm import labelled, quality, toxicity
from chronomart.llm.queries import REGISTRY
from chronomart.llm.stats import NAMES, statistics, with_statistics


def auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    return np.mean([np.mean(p > s[y == 0]) + 0.5 * np.mean(p == s[y == 0]) for p in s[y == 1]])


@pytest.mark.parametrize(
    ("name", "label", "parts", "held", "folder"),
    [("op5_quality", "quality", 5, 0, "/root/testdata/sf0.01"), ("op6_toxicity", "toxic", 4, 2, "/root/testdata/sf0.1")],
)
def test_held_out_labels_are_predicted(spark, name, label, parts, held, folder):
    rows = REGISTRY[name](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    known = rows.join(labels, "doc_id").collect()
    test = [r for r in known if r["held_out"]]
    assert {r["doc_id"] for r in test} == {r["doc_id"] for r in known if zlib_fold(r["doc_id"], parts) == held}
    assert auc([r["score"] for r in test], [r[label] for r in test]) > 0.9
    assert np.mean([r["predicted"] == r[label] for r in test]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in known)


def zlib_fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def labels_of(spark, values, label):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"doc_id long, {label} int")


def test_folds_of_documents(spark):
    df = spark.createDataFrame([(7,), (None,)], "doc_id long")
    assert [r[0] for r in df.select(labelled.remainder(F.col("doc_id"), 5)).collect()] == [zlib_fold(7, 5), 0]


def test_samples_are_bounded_and_rows_with_several_labels_count_once(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    found = {tuple(r) for r in labelled.sample(labels, "toxic", F.lit(True)).collect()}
    assert found == {(1, 1), (3, 0)}
    assert labelled.sample(labels, "toxic", F.lit(True), 1).count() == 1


def test_statistics_of_any_text(spark):
    for t in NASTY:
        values = statistics((t or "").encode())
        assert len(values) == len(NAMES) and all(np.isfinite(values))
    docs = documents(spark, NASTY).withColumn("words", F.lit("clash"))
    assert with_statistics(docs, ["doc_id"]).count() == len(NASTY)
    rows = quality.scored(docs, quality.Ensemble([frozenset({(0, True, 3.0)})], [1.0], 0.0), ["words", "text", "doc_id"])
    assert rows.columns == ["words", "text", "doc_id", "score"]
    for r in rows.collect():
        assert r["words"] == "clash" and r["text"] == NASTY[r["doc_id"]]
        assert (r["score"] > 0.5) == (len((r["text"] or "").encode().split()) > 3)


def test_rules_hold_as_columns_as_they_do_in_training(spark):
    random = np.random.default_rng(4)
    x = random.random((400, len(NAMES)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.4) | (x[:, 7] > 0.9)).astype(float)
    ensemble = quality.fit(x, y)
    assert 0 < len(ensemble.rules) < 200
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], ["i", *NAMES])
    scores = np.array([r[0] for r in df.orderBy("i").select(ensemble.score()).collect()])
    held = np.column_stack([quality.holds(r, x) for r in ensemble.rules])
    assert np.allclose(scores, quality.sigmoid(held @ np.array(ensemble.weights) + ensemble.intercept))
    assert auc(scores, y) > 0.97


def test_the_lasso_drops_rules_without_use():
    random = np.random.default_rng(5)
    r = (random.random((2000, 30)) < 0.3).astype(np.float32)
    y = (random.random(2000) < np.where(r[:, 0] > 0, 0.9, 0.1)).astype(float)
    w, _ = quality.lasso(r, y, 0.03)
    assert w[0] > 1 and np.abs(w[1:]).max() < 0.3 and (np.abs(w[1:]) < 1e-6).sum() > 15


def test_correlated_voters_are_discounted():
    random = np.random.default_rng(6)
    truth = random.random(4000) < 0.3
    fires = lambda hit, false: (random.random(4000) < np.where(truth, hit, false)).astype(float)
    noisy = fires(0.5, 0.2)
    given = np.where(random.random(4000) < 0.85, truth, ~truth).astype(float)
    votes = np.column_stack([fires(0.7, 0.02), fires(0.7, 0.02), fires(0.6, 0.02)] + [noisy] * 6)
    q = toxicity.posterior(votes, given)
    assert np.mean((q > 0.5) == truth) > 0.95 > np.mean((given > 0.5) == truth)


@pytest.mark.parametrize("values", [[], [0] * 12, [1] * 12, [None] * 12])
def test_without_two_classes_scores_are_constant(spark, values):
    docs = documents(spark, NASTY)
    model = toxicity.train(docs, labels_of(spark, values, "toxic"), F.lit(True))
    rows = toxicity.scored(docs.withColumn("score", F.lit("own")), model, "p").collect()
    assert len({r["p"] for r in rows}) == 1 and rows[0]["score"] == "own"
    rules = quality.train(docs, labels_of(spark, values, "quality"), F.lit(True))
    assert len({r["score"] for r in quality.scored(docs, rules, ["doc_id"]).collect()}) == 1


def test_small_samples_ties_and_empty_tables(spark):
    texts = [f"plain words number {i}" for i in range(30)] + [f"you are a zzbad person {i}" for i in range(10)]
    docs = documents(spark, texts)
    labels = labels_of(spark, [0] * 30 + [1] * 10, "toxic")
    model = toxicity.train(docs.union(docs.limit(3)), labels, F.lit(True))
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    assert min(scores[i] for i in range(30, 40)) > 0.3 > max(scores[i] for i in range(30))
    assert toxicity.scored(docs.limit(0), model).count() == 0
    rules = quality.train(docs, labels.withColumnRenamed("toxic", "quality"), F.lit(True))
    assert quality.scored(docs.limit(0), rules, ["doc_id"]).count() == 0
