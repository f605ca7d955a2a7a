"""Exact top-k search by integer inner product.

A vector is a sparse row: its terms are the positions of its non-zero weights.
Queries and candidates are hashed into blocks; every query block meets every
candidate block in a task of its own.  There the postings of one term after the
other are weighted and scattered into a dense score array, the best k of each
row are selected by partition, and the blocks' results are merged by Spark.

The queries are a stated set (a predicate); the work is queries times rows, and
what is shuffled is each row once per block of the other side.  Equal rows are
counted before that, and a block is a hash of id and vector, so that neither a
repeated row nor an id with many vectors fills a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256.0
QUERY_ROWS = 16_384
CANDIDATE_ROWS = 16_384
#: Queries and candidates whose scores are accumulated at a time: the array stays in a core's cache.
STRIP = 1024


def weights(vectors: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of all non-zero weights of a column of lists, by term and row."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(lists.offsets.to_numpy())
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    row = np.repeat(np.arange(len(lengths)), lengths)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    used = flat != 0
    row, term, flat = row[used], term[used], flat[used]
    order = np.lexsort((row, term))
    return row[order], term[order], flat[order]


def score_type(queries: np.ndarray, candidates: np.ndarray, terms: int) -> type:
    """The cheapest type that holds every score exactly."""
    most = lambda x: float(np.abs(x).max(initial=0))
    bound = most(queries) * most(candidates) * max(terms, 1)
    return np.int32 if bound < 2**31 else np.int64 if bound < 2**62 else object


def best(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of each query within one pair of blocks."""
    query_ids = queries.column("id").to_numpy()
    ids = candidates.column("id").to_numpy()
    by_id = np.argsort(ids, kind="stable")  # ties go to the smaller id
    ids, candidates = ids[by_id], candidates.take(by_id)
    q_row, q_term, q_weight = weights(queries.column("vector"))
    row, term, weight = weights(candidates.column("vector"))
    terms = np.intersect1d(q_term, term)
    kind = score_type(q_weight, weight, len(terms))
    exact = np.vectorize(int, otypes=[object]) if kind is object else (lambda x: x.astype(kind))
    q_weight, weight = (exact(w) if len(w) else w.astype(kind) for w in (q_weight, weight))
    asking = strips(q_row, q_term, q_weight, len(query_ids), terms)
    asked = strips(row, term, weight, len(ids), terms)
    found = [
        (q + start, strip[c], score)
        for start, q_strip in enumerate_strips(query_ids)
        for at, strip in enumerate_strips(ids)
        for q, c, score in [chosen(asking[start], asked[at], q_strip, strip, k, kind)]
    ]
    if not found:
        return RESULT.empty_table()
    q, c, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((c, -score, q)) if kind is not object else np.array(
        sorted(range(len(q)), key=lambda i: (q[i], -score[i], c[i])), dtype=int
    )
    q, c, score = q[order], c[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    top = place < k
    if kind is object:
        score = np.array([max(-(2**63), min(2**63 - 1, s)) for s in score], dtype=object)
    return pa.table(
        [pa.array(query_ids[q[top]]), pa.array(c[top]), pa.array(score[top].astype(np.int64))], schema=RESULT
    )


#: (row within the strip, weight) of the postings, and where those of each term start and end.
Postings = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def enumerate_strips(ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
    return [(start, ids[start : start + STRIP]) for start in range(0, len(ids), STRIP)]


def strips(row: np.ndarray, term: np.ndarray, weight: np.ndarray, rows: int, terms: np.ndarray) -> dict[int, Postings]:
    """The postings of each strip of rows, by its first row."""
    found = {}
    for start in range(0, rows, STRIP):
        inside = (row >= start) & (row < start + STRIP)
        own = term[inside]
        found[start] = (
            row[inside] - start, weight[inside], np.searchsorted(own, terms), np.searchsorted(own, terms, "right")
        )
    return found


def chosen(asking: Postings, asked: Postings, query_ids: np.ndarray, ids: np.ndarray, k: int, kind: type) -> tuple[np.ndarray, ...]:
    """(query, candidate, score) by place in their strips: at least the k best of each query, ties included."""
    q_row, q_weight, q_from, q_to = asking
    c_row, c_weight, c_from, c_to = asked
    scores = np.zeros((len(query_ids), len(ids)), dtype=kind)
    for a, b, c, d in zip(q_from, q_to, c_from, c_to, strict=True):
        part = np.multiply.outer(q_weight[a:b], c_weight[c:d])
        if part.shape == scores.shape:
            scores += part
        else:
            scores[np.ix_(q_row[a:b], c_row[c:d])] += part
    own = query_ids[:, None] == ids[None, :]
    scores[own] = -(2**200) if kind is object else np.iinfo(kind).min
    above = ~own
    if len(ids) > k:
        edge = np.sort(scores, axis=1)[:, -k] if kind is object else np.partition(scores, len(ids) - k, axis=1)[:, -k]
        above &= scores >= edge[:, None]
        # Candidates are in order of their ids, so of those at the edge the first k are enough.
        above &= (np.cumsum(above & (scores == edge[:, None]), axis=1) <= k) | (scores > edge[:, None])
    q, c = np.nonzero(above)
    return q, c, scores[q, c]


RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components, also after scaling."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def top_k(df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query.

    Weights are ``floor(256 * x)``; terms that one vector lacks add nothing.  A
    query never meets rows with its own id; of several rows with a query's id the
    smallest vector asks.  Repeated candidates count each.  Rows with a null id,
    or a vector that is null or holds a null or non-finite component, take no
    part; an empty vector scores 0 with all.  Scores beyond 64 bits are computed
    exactly and returned as the largest or smallest long.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    queries = rows.filter("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    # No query takes more than k copies of an equal row, so no more need to meet it.
    once = rows.groupBy("id", "vector").agg(F.count("*").alias("copies"))
    candidates = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k).cast("long")).cast("int"))))
    counted = rows.agg(F.count("*").alias("rows"), F.count_if("asks").alias("asking")).first()
    q_blocks = max(1, -(-counted["asking"] // QUERY_ROWS))
    c_blocks = max(1, -(-counted["rows"] // CANDIDATE_ROWS))
    block = lambda n: F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = queries.withColumn("q", block(q_blocks)).withColumn("c", every(c_blocks))
    asked = candidates.drop("copies", "copy").withColumn("c", block(c_blocks)).withColumn("q", every(q_blocks))
    scored = (
        asking.groupBy("q", "c")
        .cogroup(asked.groupBy("q", "c"))
        .applyInArrow(lambda a, b: best(a, b, k), "query_id long, vec_id long, score long")
    )
    merged = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(merged))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
