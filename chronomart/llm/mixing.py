"""Mix sources to target weights by entropy balancing.

Among all document rates with a source's wanted number of words, the entropy
balance is the one closest to uniform, where closeness counts every word alike.
Its rates are ``exp(lambda)`` with one dual variable per source; the convex dual
``sum(size * exp(lambda)) - lambda * target`` is solved by Newton steps, each an
aggregate over the cells of the data, until every constraint holds.

Rates become copies: every document gets ``floor(rate)``, and the fractions are
first spread evenly over the documents in order of size.  What a source then
lacks or has too much is settled on single documents, the largest that fits
first, so that it misses its target by less than its smallest document with a
choice.  Among documents of one size a hash of ``doc_id`` decides.

Only DataFrame functions run here.  Documents are reduced to cells (source,
size, 4,096 hash ranges) before anything is ordered, so that a source or a size
that holds most rows is spread over many tasks.  Windows over all sources, over
the sizes of a source and over the hash ranges of a size run on cells only; the
settlement holds the distinct sizes of one source in an array (as many as its
documents have different lengths, not as many as it has documents).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronomart.llm.common import fresh, stored

#: No document is taken more often.
MOST = 3
#: Sources in code point order weigh 1, 2, 3, 1, 2, 3, ...
CYCLE = 3
TOLERANCE = 1e-12
MOST_STEPS = 200


def targets(sources: DataFrame) -> DataFrame:
    """Wanted words of each source: ``sources`` has (source, source_size) with a row per source.

    All words are shared by weight; a source stops at ``MOST`` times its size,
    and what it cannot take is shared by the others.  With sources in order of
    size per weight this is a prefix that stops and a common level for the rest.
    """
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    by_room = Window.orderBy((F.col("room") / F.col("weight")), "weight", F.col("source").isNull(), "source")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    stops = F.col("room") * F.col("open_weight") < F.col("open_words") * F.col("weight")
    return (
        sources.withColumn("weight", ((F.row_number().over(ordered) - 1) % CYCLE + 1).cast("long"))
        .withColumn("room", F.col("source_size") * MOST)
        .withColumn("open_words", F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.max(F.when(~stops, F.col("open_words") / F.col("open_weight"))).over(everything))
        .withColumn("target", F.when(stops, F.col("room").cast("double")).otherwise(F.col("weight") * F.col("level")))
        .select("source", "source_size", "target")
    )


def balance(sources: DataFrame) -> DataFrame:
    """The rate of each source: Newton steps on the dual of its word constraint.

    ``sources`` has (source, source_size, target).  A step moves a dual variable
    by at most one.  A source without words has no constraint; its rate is 1.
    """
    free = F.col("source_size") == 0
    wanted = F.greatest(F.col("target"), F.lit(1e-300))
    state = sources.withColumn("dual", F.lit(0.0))
    for _ in range(MOST_STEPS):
        mass = F.col("source_size") * F.exp("dual")
        step = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (wanted - mass) / mass))
        state = stored(state.withColumn("dual", F.when(free, F.lit(0.0)).otherwise(F.col("dual") + step)))
        gap = F.abs(F.col("source_size") * F.exp("dual") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0))
        worst = state.agg(F.max(F.when(~free, gap)).alias("gap")).first()["gap"]
        if worst is None or worst <= TOLERANCE:
            break
    return state.withColumn("rate", F.least(F.lit(float(MOST)), F.round(F.exp("dual"), 9))).drop("dual")


def draw(doc_id: Column) -> Column:
    """A fixed order of documents of equal size: hexadecimal text."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))


#: What ``mix`` adds to a row.
COLUMNS = ("size", "source_size", "target", "rate", "copies")


def mix(df: DataFrame, size: Column, source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``df`` with size, source_size, target, rate and copies of each row.

    ``size`` counts the words of a row (null: 0).  Null sources form one source,
    last in order.  Repeated rows count each for itself; which of them gets the
    larger number of copies makes no difference.  An empty table stays empty.
    Columns of ``df`` with those names are replaced.
    """
    df = df.drop(*[c for c in COLUMNS if c not in (source, doc_id)])
    key, place, bucket, rank, first, total, salt = fresh(df, "key", "place", "bucket", "rank", "first", "total", "salt")
    # A null source must meet itself in joins: a prefix tells it from any text.
    rows = (
        df.withColumn("size", F.coalesce(size.cast("long"), F.lit(0)))
        .withColumn(key, F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")))
        .withColumn(place, draw(F.col(doc_id)))
        .withColumn(bucket, F.substring(place, 1, 3))
    )
    cells = stored(rows.groupBy(key, "size", bucket).agg(F.count("*").alias(total)))
    sizes = cells.groupBy(key, "size").agg(F.sum(total).alias(total))
    sources = sizes.groupBy(key).agg(F.sum(F.col("size") * F.col(total)).alias("source_size"))
    named = sources.withColumn("source", F.when(F.col(key) != "n", F.expr(f"substring(`{key}`, 2)")))
    wanted = targets(named.select("source", "source_size"))
    rates = balance(wanted).withColumn(key, F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))).drop("source")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(total).over(earlier(Window.partitionBy(key).orderBy("size"))), F.lit(0))
    part = F.col("rate") - F.floor("rate")
    spread = F.floor(part * (before + F.col(total)) + 0.5) - F.floor(part * before + 0.5)
    extras = settle(sizes.join(rates, key).withColumn(first, spread), key, total, first)
    in_size = earlier(Window.partitionBy(key, "size").orderBy(bucket))
    offsets = (
        cells.withColumn(salt, F.coalesce(F.sum(total).over(in_size), F.lit(0)))
        .drop(total)
        .join(extras, [key, "size"])
    )
    in_cell = Window.partitionBy(key, "size", bucket).orderBy(place, F.col(doc_id))
    one_more = (F.col(salt) + F.col(rank) <= F.col(first)).cast("int")
    return (
        rows.withColumn(rank, F.row_number().over(in_cell))
        .join(offsets, [key, "size", bucket])
        .withColumn("copies", F.floor("rate").cast("int") + one_more)
        .drop(key, place, bucket, rank, first, salt)
    )


def settle(sizes: DataFrame, key: str, total: str, extra: str) -> DataFrame:
    """``sizes`` with ``extra``, the documents of each size with one more copy, changed to meet the targets.

    The sizes of a source are gone through from the largest; as many documents
    change as fit into what is still missing (or too much).
    """
    (item,) = fresh(sizes, "item")
    words = F.col("size") * (F.floor("rate") * F.col(total) + F.col(extra))
    lower = F.when(F.floor("rate") < MOST, F.col(total) - F.col(extra)).otherwise(F.lit(0).cast("long"))
    entry = F.struct("size", lower.alias("lower"), F.col(extra).alias("higher"), F.lit(0).cast("long").alias("change"))
    gaps = (
        sizes.filter(F.col("size") > 0)
        .groupBy(key)
        .agg(
            (F.max("target") - F.sum(words).cast("double")).alias(item),
            F.sort_array(F.collect_list(entry), asc=False).alias("sizes"),
        )
    )
    changes = F.aggregate(
        "sizes",
        F.struct(F.col(item).alias("gap"), F.slice("sizes", 1, 0).alias("done")),
        lambda state, s: F.transform(
            F.array(
                F.when(state.gap >= 0, F.least(s.lower, F.floor(state.gap / s.size))).otherwise(
                    -F.least(s.higher, F.floor(-state.gap / s.size))
                )
            ),
            lambda n: F.struct(
                (state.gap - n * s.size).alias("gap"),
                F.when(n == 0, state.done)
                .otherwise(F.array_append(state.done, s.withField("change", n)))
                .alias("done"),
            ),
        )[0],
        lambda state: state.done,
    )
    changed = gaps.select(key, F.inline(changes)).select(key, "size", "change")
    return (
        sizes.join(changed, [key, "size"], "left")
        .withColumn(extra, F.col(extra) + F.coalesce(F.col("change"), F.lit(0)))
        .drop("change", total)
    )


def repeat(mixed: DataFrame, columns: list[str], copies: str = "copies") -> DataFrame:
    """Rows of ``mixed``, each as often as its copies say."""
    (n,) = fresh(mixed, "n")
    taken = mixed.filter(F.col(copies) > 0)
    return taken.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, 3 * source_size AS room,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS open_words,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight
  FROM s
  WINDOW w AS (ORDER BY 3 * source_size / weight, weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, max(CASE WHEN room * open_weight >= open_words * weight
                     THEN CAST(open_words AS DOUBLE) / CAST(open_weight AS DOUBLE) END) OVER () AS level
  FROM o
), t AS (
  SELECT source, source_size,
         CASE WHEN room * open_weight < open_words * weight THEN CAST(room AS DOUBLE) ELSE weight * level END AS target
  FROM l
), r AS (
  SELECT source, source_size, target,
         CASE WHEN source_size = 0 THEN 1.0 ELSE least(3.0, round(target / source_size, 9)) END AS rate
  FROM t
), g AS (
  SELECT source, size, count(*) AS total, coalesce(sum(count(*)) OVER (PARTITION BY source ORDER BY size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d GROUP BY source, size
), e AS (
  SELECT g.source, g.size, g.total, r.target, r.rate, r.source_size,
         CAST(floor((rate - floor(rate)) * (before + total) + 0.5) - floor((rate - floor(rate)) * before + 0.5) AS BIGINT) AS extra,
         row_number() OVER (PARTITION BY g.source ORDER BY g.size DESC) AS k
  FROM g JOIN r ON g.source IS NOT DISTINCT FROM r.source
), v AS (
  WITH RECURSIVE steps AS (
    SELECT source, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS size, CAST(0 AS BIGINT) AS change,
           max(target) - CAST(sum(size * (floor(rate) * total + extra)) AS DOUBLE) AS gap
    FROM e GROUP BY source
    UNION ALL
    SELECT source, k, size, n, gap - n * size FROM (
      SELECT e.source, e.k, e.size, s.gap,
             CAST(CASE WHEN e.size = 0 THEN 0
                       WHEN s.gap >= 0 THEN least(CASE WHEN floor(rate) < 3 THEN total - extra ELSE 0 END, floor(s.gap / e.size))
                       ELSE -least(extra, floor(-s.gap / e.size)) END AS BIGINT) AS n
      FROM steps s JOIN e ON e.source IS NOT DISTINCT FROM s.source AND e.k = s.k + 1)
  )
  SELECT source, size, change FROM steps WHERE size >= 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY source, size ORDER BY place, doc_id) AS place_in_size FROM d
)
SELECT n.doc_id, n.size, e.source_size, e.target,
       CAST(n.size * (floor(e.rate) + CASE WHEN place_in_size <= e.extra + v.change THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM n JOIN e ON n.source IS NOT DISTINCT FROM e.source AND n.size = e.size
       JOIN v ON n.source IS NOT DISTINCT FROM v.source AND n.size = v.size
"""
