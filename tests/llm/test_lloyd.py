import hashlib
import math
import random

import numpy as np
import pytest

from chronomart.llm import lloyd

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, dims, k, rounds):
    """The same by hand, in Python integers; (vec_id, cluster, distance) and centroids."""
    kept = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, members in groups.items():
            centroids[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return sorted(((i, j, d) for i, v in kept for d, j in [nearest(v)]), key=str), centroids


def check(spark, rows, dims, k, rounds):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    found = lloyd.cluster(df, dims=dims, k=k, rounds=rounds).collect()
    expected, centroids = plain(rows, dims, k, rounds)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in found), key=str) == expected
    total = sum(d for _, _, d in expected)
    for r in found:
        assert r["inertia"] == total
        assert r["cluster_inertia"] == sum(d for _, j, d in expected if j == r["cluster"])
        text = ",".join(map(str, centroids[r["cluster"]]))
        assert r["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def vectors(rng, n, dims, spread=1.0):
    return [(i, np.float32([rng.gauss(0, spread) for _ in range(dims)]).tolist()) for i in range(n)]


@pytest.mark.parametrize("dims", [3, 32, 70])
def test_against_plain_integers(spark, monkeypatch, dims):
    monkeypatch.setattr(lloyd, "BLOCK_ROWS", 16)
    check(spark, vectors(random.Random(dims), 120, dims), dims, 7, 4)


def test_ties_repeats_nulls_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(lloyd, "BLOCK_ROWS", 8)
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-1, 1)), float(rng.randint(-1, 1))]) for i in range(80)]
    rows += [(5, [0.0, 0.0])] * 30 + [(None, [1.0, 1.0])] * 30 + [(7, [0.5, -0.001])]
    rows += [(200, None), (201, []), (202, [1.0]), (203, [1.0, None]), (204, [float("nan"), 0.0]), (205, [0.0, float("inf")])]
    check(spark, rows, 2, 5, 5)


def test_fewer_vectors_than_clusters_and_none(spark):
    check(spark, vectors(random.Random(3), 3, 4), 4, 10, 2)
    empty = lloyd.cluster(spark.createDataFrame([(1, None, 1)], SCHEMA), dims=4)
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert empty.count() == 0


def test_large_components_stay_exact_or_are_refused(spark):
    check(spark, vectors(random.Random(4), 40, 3, 2.0**19), 3, 4, 3)
    with pytest.raises(Exception, match="above"):
        check(spark, [(1, [1e30, 0.0, 0.0])], 3, 4, 3)


def test_names_of_the_caller_are_kept(spark):
    df = spark.createDataFrame([(f"k{i}", [float(i)], i) for i in range(5)], "cluster_id string, x array<double>, shard int")
    rows = lloyd.cluster(df, "cluster_id", "x", dims=1, k=2, rounds=1).collect()
    assert sorted(r["cluster_id"] for r in rows) == [f"k{i}" for i in range(5)]


def test_partial_distances_are_exact():
    rng = np.random.default_rng(1)
    for size in (100, 2**27):
        x, c = (rng.integers(-size, size, (50, 32)) for _ in range(2))
        exact = [[sum(int(a - b) ** 2 for a, b in zip(r, s, strict=True)) for s in c] for r in x]
        assert lloyd.partial_distances(x, c).tolist() == exact


def test_vectors_stay_in_their_buckets(spark):
    df = spark.createDataFrame([(i, [float(i)] * 2, 1) for i in range(50)], SCHEMA)
    own = df.select(df.vec_id.alias("id"), lloyd.integers(df.embedding).alias("x"))
    parts = lloyd.slices(own, 2)
    labels = lloyd.assign(parts, np.zeros((2, 2), np.int64))
    of_shards = labels.selectExpr("block", "0 AS shard", "labels").groupBy("block", "shard")
    joined = parts.table.select("block", "shard", "x").groupBy("block", "shard").cogroup(of_shards)
    plan = joined.applyInArrow(lambda a, b: a, "block long")._jdf.queryExecution().executedPlan().toString()
    vectors_side = plan.split("FlatMapCoGroupsInArrow")[1].split("Bucketed: true")[0]
    assert "Exchange" not in vectors_side
