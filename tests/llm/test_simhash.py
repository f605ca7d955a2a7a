import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from texts import NASTY, documents

from chronomart.llm import simhash


def exact(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, bits=2):
    root = list(range(len(points)))
    for i, p in enumerate(points):
        for j in range(i):
            if (p ^ points[j]).bit_count() <= bits:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def near_texts():
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(random.choice(words, 120)) for _ in range(12)]
    near = [b + " end" for b in base[:6]] + [b.upper() for b in base[6:9]]
    return base + near + base[:3] + [None, "", " \t "]


def test_fingerprints_and_components(spark):
    for texts in (NASTY, near_texts()):
        rows = simhash.near_duplicates(documents(spark, texts)).orderBy("doc_id").collect()
        assert [r["doc_id"] for r in rows] == list(range(len(texts)))
        points = [exact(t) for t in texts]
        assert [r["fingerprint"] % 2**64 for r in rows] == points
        assert [r["component_id"] for r in rows] == groups(points)


def test_spark_hashes_shingles_alike(spark):
    h = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert h % 2**64 == xxhash.xxh64_intdigest(b"one two three", seed=42)


def dense_points():
    random = np.random.default_rng(5)
    one = lambda n, m: np.uint64(1) << random.integers(0, m, n).astype(np.uint64)
    spread = random.integers(0, 2**64, 3000, dtype=np.uint64)
    cluster = spread[0] ^ one(1500, 64) ^ one(1500, 12) ^ one(1500, 12)
    return np.unique(np.r_[spread, cluster, spread[1:200] ^ one(199, 64), np.uint64(0), one(64, 64)])


@pytest.mark.parametrize("levels", [0, 1, 5])
def test_trees_lose_no_link(levels):
    points = dense_points()
    want = set()
    for i, p in enumerate(points):
        for q in points[i + 1 :][np.bitwise_count(points[i + 1 :] ^ p) <= 2]:
            want.add((int(p), int(q)))
    tree = simhash.fit(points[:: max(1, len(points) // (16 << levels))], levels)
    found = set()
    for _, own, visiting in simhash.route(points, tree, 2):
        for a, b in simhash.linked(np.sort(own), visiting, 2):
            found |= set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
    assert found == want


def test_points_that_are_all_equally_far():
    points = np.uint64(1) << np.arange(64, dtype=np.uint64)
    at = simhash.split(points)
    assert at is None or 0 < (simhash.distances(points, at[0]) <= at[1]).sum() < 64
    assert simhash.split(points[:1]) is None


def test_many_shards_in_spark(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 200)
    points = dense_points()
    rows = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fingerprint long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(rows)).collect()}
    got = [found.get(int(p), int(p)) for p in points.view(np.int64)]
    root = {}
    for p, r in zip(points.tolist(), got, strict=True):
        root.setdefault(r, []).append(p)
    a, b = simhash.forest(simhash.linked(points, points[:0], 2))
    whole = dict(zip(a.tolist(), b.tolist(), strict=True))
    expected = {}
    for p in points.view(np.int64).tolist():
        expected.setdefault(whole.get(p, p), []).append(p % 2**64)
    assert sorted(map(sorted, root.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200}


def test_one_document_of_each_group_stays(spark):
    texts = near_texts()
    docs = documents(spark, texts).withColumn("place", F.lit("kept")).withColumn("fingerprint", F.lit("kept"))
    kept = simhash.keep_one(docs.union(docs.limit(2)))  # two rows are repeated
    rows = kept.collect()
    roots = groups([exact(t) for t in texts])
    assert sorted(r["doc_id"] for r in rows) == sorted(set(roots))
    assert kept.columns == docs.columns and rows[0]["place"] == rows[0]["fingerprint"] == "kept"


def test_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (None, "x y z")], "doc_id long, text string")
    rows = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert rows == {(None, 5), (5, 5), (None, None)}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_null_and_repeated_ids_leave_one_row_of_each_group(spark):
    near = "w1 w2 w3 w4 w5 " * 30
    other = "entirely different words stand in this one here"
    rows = [(None, "a b c d", 1), (5, "a b c d", 2), (None, "x y z", 3), (None, "X y z", 4), (7, near, 5), (7, other, 6), (3, other, 7)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n long")).collect()
    roots = groups([exact(t) for _, t, _ in rows])
    assert len(set(roots)) == 4 and len(kept) == 4
    assert sorted(r["n"] for r in kept if r["doc_id"] is not None) == [2, 5, 7]
    assert [r["text"].lower() for r in kept if r["doc_id"] is None] == ["x y z"]
