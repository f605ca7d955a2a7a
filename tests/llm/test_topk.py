import numpy as np
import pytest
from pyspark.sql import functions as F

from chronomart.llm import topk


def brute(rows, k=5):
    floats = {i: [int(np.floor(256 * np.float64(x))) for x in v] for i, v in rows}
    result = []
    for q, w in floats.items():
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(w, v, strict=False)), i) for i, v in floats.items() if i != q)
            result += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(result)


def search(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(df, F.col("vec_id") % 50 == 0)
    return sorted(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(1)
    dense = [(i, random.normal(0, 0.2, 16).astype(np.float32).tolist()) for i in range(300)]
    sparse = [(300 + i, (random.random(16) < 0.2).astype(np.float32).tolist()) for i in range(200)]
    return dense + sparse


def test_against_brute_force_in_many_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 100)
    monkeypatch.setattr(topk, "STRIP", 32)
    assert search(spark, vectors) == brute(vectors)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.5]) for i in range(120)]
    assert search(spark, rows) == brute(rows)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 1.0]), (1, [1.0, None]), (2, [float("nan"), 1.0]), (3, None), (4, [float("inf"), 0.0]), (5, [0.5, 0.5])]
    rows += [(None, [9.0, 9.0]), (50, [float("nan"), 0.0]), (6, [])]
    assert search(spark, rows) == [(0, 1, 5, 2 * 256 * 128), (0, 2, 6, 0)]


def test_different_lengths_and_repeated_rows(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (1, [1.0]), (1, [1.0]), (2, [0.0, 0.0, 1.0, 7.0])]
    assert search(spark, rows) == [(0, 1, 2, 3 * 65536), (0, 2, 1, 65536), (0, 3, 1, 65536)]


def test_scores_beyond_integers(spark):
    rows = [(0, [3e30, 1.0]), (1, [3e30, 1.0]), (2, [-3e30, 1.0]), (3, [0.0, 2.0])]
    assert [(r[2], r[3]) for r in search(spark, rows)] == [(1, 2**63 - 1), (3, 2 * 65536), (2, -(2**63))]


def test_empty_table_and_no_queries(spark):
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0]), (2, [1.0])]) == []


@pytest.mark.parametrize("equal", [True, False])
def test_an_id_with_a_third_of_all_rows_fills_no_block(spark, vectors, monkeypatch, equal):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 100)
    monkeypatch.setattr(topk, "STRIP", 32)
    hot = [(7777, [9.0 if equal else 0.01 * i] * 16) for i in range(250)]
    df = spark.createDataFrame(vectors + hot, "vec_id long, embedding array<float>").repartition(6)
    once = topk.best

    def watched(queries, candidates, k):
        if candidates.num_rows > 200:
            raise ValueError(f"a block of {candidates.num_rows} rows")
        return once(queries, candidates, k)

    monkeypatch.setattr(topk, "best", watched)
    rows = topk.top_k(df, F.col("vec_id") % 50 == 0)
    found = sorted(map(tuple, rows.select("query_id", "rank", "vec_id", "score").collect()))
    scaled = [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v in vectors + hot]
    want = []
    for q, w in scaled:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(w, v, strict=True)), i) for i, v in scaled if i != q)[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert found == sorted(want)
