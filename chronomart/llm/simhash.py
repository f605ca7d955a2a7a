"""SimHash near-duplicates: 64-bit fingerprints, linked at a small Hamming distance.

Fingerprints that occur are joined with themselves through vantage-point trees.
The upper levels of a tree are fitted on a bounded sample; a node splits by the
distance to its vantage point.  A fingerprint lives in one shard, and visits the
shards on the near side of a boundary that the triangle inequality cannot rule
out, so that each linked pair meets once.  In a shard the same tree goes on in
memory, and its leaves are compared in full.

A shard returns a spanning forest of its links, not all pairs, and the forests
are joined to components with star contractions (each a grouped minimum and a
join).  Equal fingerprints were one row all along, so groups of copies of any
size cost nothing here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import fresh, stored

SHINGLE_WORDS = 3
MOST_BITS = 2
SEED = 42
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Fingerprints that a shard should hold, and the sample a node is fitted on.
SHARD_ROWS = 1 << 13
NODE_SAMPLE = 16
#: Levels of the tree above the shards; with more rows than 2**MOST_LEVELS shards hold, shards grow.
MOST_LEVELS = 14
LEAF = 256


# Fingerprints ---------------------------------------------------------------------------------------


def fingerprint(text: bytes | None) -> int:
    """The SimHash of a UTF-8 text's word shingles, as an unsigned number; 0 without words."""
    words = (text or b"").translate(LOWER).split()  # bytes split at 0x09-0x0D and 0x20
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    starts = np.r_[0, ends[: n - 1]].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for part in range(0, n, 1 << 16):
        rows = hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(text: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = np.array([fingerprint(t) for t in batch.column(at).cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            rest = [i for i in range(batch.num_columns) if i != at]
            names = [batch.schema.names[i] for i in rest]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), pa.array(found)], [*names, "fingerprint"])

    return run


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the fingerprint (bits of a long) in the place of its text."""
    rest = [f for f in df.schema.fields if f.name not in (text, "fingerprint")]
    df = df.select(*[F.col(f.name) for f in rest], F.col(text).cast("string"))
    return df.mapInArrow(_fingerprints(text), T.StructType([*rest, T.StructField("fingerprint", T.LongType())]))


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


# Vantage-point trees --------------------------------------------------------------------------------


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point among ``points`` and a radius that leaves points on both sides."""
    for i in np.linspace(0, len(points) - 1, 9, dtype=int):
        d = distances(points, points[i])
        radius = int(np.median(d))
        if radius < d.max():
            return points[i], radius
        if (d < radius).any():
            return points[i], int(d[d < radius].max())
    return None


def fit(sample: np.ndarray, levels: int, path: int = 1) -> dict[int, tuple[int, int]]:
    """Vantage point and radius of the inner nodes, by heap position (children of n: 2n near, 2n + 1 far)."""
    if levels == 0 or len(sample) < 2 or (at := split(sample)) is None:
        return {}
    near = distances(sample, at[0]) <= at[1]
    return (
        {path: (int(at[0]), at[1])}
        | fit(sample[near], levels - 1, 2 * path)
        | fit(sample[~near], levels - 1, 2 * path + 1)
    )


def route(points: np.ndarray, tree: dict[int, tuple[int, int]], bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, its own points, its visitors) for a batch of points."""
    todo = [(1, points, points[:0])]
    while todo:
        path, own, visiting = todo.pop()
        if path not in tree:
            yield path, own, visiting
            continue
        vantage, radius = np.uint64(tree[path][0]), tree[path][1]
        d, v = distances(own, vantage), distances(visiting, vantage).astype(int)
        near = d <= radius
        todo.append((2 * path, own[near], np.r_[own[~near & (d <= radius + bits)], visiting[v <= radius + bits]]))
        todo.append((2 * path + 1, own[~near], visiting[v > radius - bits]))


def linked(own: np.ndarray, visiting: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs at most ``bits`` apart: each of ``own`` with the others and with ``visiting``."""
    todo = [(own, visiting)]
    while todo:
        own, visiting = todo.pop()
        at = split(own) if len(own) > LEAF else None
        if at is None:
            for start in range(0, len(own), LEAF):
                some = own[start : start + LEAF]
                rest = np.r_[own[start:], visiting]
                for first in range(0, len(rest), 1 << 14):
                    a, b = np.nonzero(np.bitwise_count(some[:, None] ^ rest[None, first : first + (1 << 14)]) <= bits)
                    apart = some[a] != rest[first + b]
                    yield some[a[apart]], rest[first + b[apart]]
            continue
        vantage, radius = at
        d, v = distances(own, vantage), distances(visiting, vantage).astype(int)
        near = d <= radius
        todo.append((own[near], np.r_[own[~near & (d <= radius + bits)], visiting[v <= radius + bits]]))
        todo.append((own[~near], visiting[v > radius - bits]))


def forest(pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A star for each set of connected points: (point, smallest point), without the centres."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    points = [x for x in parent if root(x) != x]
    as_longs = lambda x: np.array(x, np.uint64).view(np.int64)
    return as_longs(points), as_longs([root(x) for x in points])


def links(distinct: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints as all pairs up to ``bits`` apart would."""
    rows = distinct.count()
    levels = min(MOST_LEVELS, max(0, int(np.ceil(np.log2(max(1, rows / SHARD_ROWS))))))
    sample = distinct.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(NODE_SAMPLE << levels) if levels else None
    points = np.array([r[0] for r in sample.collect()] if levels else [], np.int64).view(np.uint64)
    tree = fit(points, levels)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for shard, home, away in route(own, tree, bits):
                every = np.r_[home, away].view(np.int64)
                lives = np.r_[np.ones(len(home), bool), np.zeros(len(away), bool)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(every), shard, np.int32)), pa.array(every), pa.array(lives)],
                    ["shard", "fingerprint", "lives"],
                )

    def meet(shard: pa.Table) -> pa.Table:
        every = shard.column("fingerprint").to_numpy().view(np.uint64)
        lives = shard.column("lives").to_numpy(zero_copy_only=False)
        a, b = forest(linked(np.sort(every[lives]), every[~lives], bits))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    sent = distinct.select("fingerprint").mapInArrow(send, "shard int, fingerprint long, lives boolean")
    return sent.groupBy("shard").applyInArrow(meet, "a long, b long")


# Components -----------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the smallest node it can reach.

    Alternates large and small stars until the edges stand still.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # After a large star every edge points from the larger to the smaller node.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        after = stored(small.filter("a <> b").distinct())
        moved = after.join(edges, ["a", "b"], "left_anti").limit(1).count() or after.count() != edges.count()
        edges = after
        if not moved:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def grouped(rows: DataFrame, bits: int) -> DataFrame:
    """(fingerprint, root, component_id) of the distinct fingerprints of ``rows`` (doc_id, fingerprint, ...).

    ``root`` is a fingerprint of the component, never null.
    """
    distinct = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fingerprint"), bits))
    # Both sides hold a fingerprint once; single ones are their own root.
    joined = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    named = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    return joined.join(named, "root").select("fingerprint", "root", "component_id")


def near_duplicates(df: DataFrame, bits: int = MOST_BITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``bits`` differing bits.  Null and empty texts have fingerprint 0 and link
    like any other; null ids are kept and never name a component unless all of
    it is null.  Repeated rows are returned each.
    """
    rows = stored(fingerprints(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))))
    named = grouped(rows, bits).select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(df: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """One row of each component: the first by doc_id (null ids last), then by a hash of its text, once if it is repeated.

    Of rows with equal id and text the one with the least hash over its columns
    stays; columns that hold maps, which have no order, are left out of that hash.
    """
    key, a, b, place = fresh(df, "key", "a", "b", "place")
    # A row is known by its id (a prefix tells null from any text) and 128 bits of its text.
    body = F.col("text").cast("string")
    known = F.coalesce(F.concat(F.lit("s"), F.col("doc_id").cast("string")), F.lit("n"))
    rows = df.withColumns({key: known, a: F.xxhash64(body), b: F.xxhash64(F.lit(1), body)})
    narrow = rows.select("doc_id", body.alias("text"), F.col(key).alias("key"), F.col(a).alias("a"), F.col(b).alias("b"))
    narrow = stored(fingerprints(narrow))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "a", "b", "key")).alias("first")
    kept = narrow.join(grouped(narrow, bits), "fingerprint").groupBy("root").agg(first)
    kept = kept.select(F.col("first.key").alias(key), F.col("first.a").alias(a), F.col("first.b").alias(b))
    # Join and window share their keys, so texts are exchanged once.
    hashed = [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString()]
    once = Window.partitionBy(key, a, b).orderBy(F.xxhash64(*hashed))
    return (
        rows.join(kept, [key, a, b], "left_semi")
        .withColumn(place, F.row_number().over(once))
        .filter(F.col(place) == 1)
        .drop(key, a, b, place)
    )
