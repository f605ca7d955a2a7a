"""The registered text queries and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomart.llm import (
    bpe, dialogue, digest, labelled, lloyd, mixing, pii, quality, reshard, simhash, tokencount, topk, toxicity, wordtable,
)
from chronomart.llm.common import fresh, stored, table, text_of, word_count

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def registered(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


@cache
def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> bpe.Ranks:
    return bpe.load(public_tokenizers.path(name), public_tokenizers.PATTERN)


@registered
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.col("token_ids")
    return bpe.encode(docs, vocabulary()).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(ids, vocabulary()), 256).alias("decoded_sha256"),
    )


@registered
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op2_topk"] = topk.SQL


@registered
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash.as_hex(F.col("fingerprint")))


#: The key of the registered query; a real run passes its own.
PSEUDONYM_KEY = "registered-query"


@registered
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, PSEUDONYM_KEY, spans="spans").select(
        "doc_id",
        "text",
        F.size("spans").cast("long").alias("n_replaced"),
        F.array_join(F.array_sort(F.array_distinct("spans.kind")), ",").alias("kinds"),
    )


#: Held-out folds, and the score from which a document counts as label 1.
QUALITY_FOLDS, QUALITY_HELD_OUT = 5, 0
THRESHOLD = 0.3


@registered
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    fold = labelled.remainder(F.col("doc_id"), QUALITY_FOLDS)
    rules = quality.train(docs, labels, fold != QUALITY_HELD_OUT)
    return quality.scored(docs, rules, ["doc_id"]).select(
        "doc_id",
        (fold == QUALITY_HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2


@registered
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    fold = labelled.remainder(F.col("doc_id"), TOXIC_FOLDS)
    model = toxicity.train(docs, labels, fold != TOXIC_HELD_OUT)
    return toxicity.scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (fold == TOXIC_HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@registered
def op7_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.compare_neighbours(table(spark, sf_dir, "documents"))


@registered
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, then after a deletion, an insertion and a replacement in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    kept = tokencount.trees(docs, vocabulary())
    quarter = lambda k: F.floor(F.length("text") * k / 4)
    shouted = F.upper(F.substring("text", (quarter(3) + 1).cast("int"), F.lit(30)))
    edits = [(quarter(1), 12, F.lit("")), (quarter(2), 0, F.substring("text", 1, 24)), (quarter(3), 30, shouted)]
    structs = [F.struct(a.alias("start"), F.lit(r).cast("long").alias("removed"), i.alias("inserted")) for a, r, i in edits]
    before = F.aggregate("piece_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = kept.withColumns({"edits": F.array(*structs).cast(tokencount.EDITS), "before": before})
    return tokencount.apply_edits(rows, vocabulary()).select(
        "doc_id",
        F.col("before").alias("n_tokens"),
        F.col("n_tokens").alias("edited_tokens"),
        F.size("piece_sizes").cast("long").alias("edited_pieces"),
        "reencoded",
        F.sha2(F.col("text").cast("binary"), 256).alias("edited_sha256"),
    )


#: The query's new shards, and the old layout it starts from: whole sources, so one is very large.
SHARDS = 40
ROW_BYTES = 16


@registered
def op9_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the files of the new layout have them: the old layout is written, planned anew, and its changed shards rewritten."""
    docs = table(spark, sf_dir, "documents")
    (row,) = fresh(docs, "row_id")
    layout = F.pmod(F.crc32(text_of("source").cast("binary")), F.lit(SHARDS)).cast("int")
    folder = reshard.lay_out(docs, layout, row)
    schema = docs.drop("shard", "slot", "old_shard", row).schema.add(row, "long").add("shard", "integer")
    old = spark.read.schema(schema).parquet(folder).withColumnRenamed("shard", "old_shard")
    size = F.octet_length(text_of()).cast("long") + ROW_BYTES
    sizes = old.select("doc_id", row, "old_shard", size.alias("size"))
    plan = stored(reshard.reshard(sizes, F.col("old_shard"), F.col("size"), SHARDS, row=row))
    folders = {j: f"{folder}/shard={j}" for j in range(SHARDS)}
    new = reshard.rewrite(spark, old, plan, folders, row=row)
    files = reshard.read(spark, new, schema.add("slot", "long").add("old_shard", "integer"))
    # Shards that kept their folder have files without slots: the plan numbers their rows.
    found = files.select(
        "doc_id", row, size.alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        "shard", "slot", F.coalesce("old_shard", "shard").alias("old_shard"),
    )
    kept = [j for j, f in new.items() if f == folders[j]]
    if kept:
        own = F.col("shard").isin(kept)
        numbered = found.filter(own).drop("slot").join(plan.filter(own).select(row, "slot"), row)
        found = found.filter(~own).unionByName(numbered)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


@registered
def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("words"))
    return mixing.mix(docs, F.col("words")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


ORACLE["op10_entropy_mix"] = mixing.SQL


@cache
def word_vocabulary() -> wordtable.Vocabulary:
    return wordtable.load(public_tokenizers.path("byte_bpe_50k.json"))


@registered
def op11_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.col("token_ids")
    return wordtable.decode(wordtable.encode(docs, word_vocabulary()), word_vocabulary()).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with one row in four spoilt, by a hash of conversation and turn; nulls of rows are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(kind == 4, "user").otherwise(spaced("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies)


@registered
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, also those that lost all rows."""
    rows = table(spark, sf_dir, "conversations")
    found = dialogue.repair(damaged(rows))
    every = rows.select(F.col("conv_id").alias("conv")).distinct()
    report = every.unionByName(found.report(), allowMissingColumns=True).unionByName(
        dialogue.digests(found.lines()), allowMissingColumns=True
    )
    number = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
    return report.groupBy(F.col("conv").alias("conv_id")).agg(
        *(number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("digest"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@registered
def op13_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster(table(spark, sf_dir, "embeddings"))


ORACLE["op13_lloyd"] = lloyd.sql()
