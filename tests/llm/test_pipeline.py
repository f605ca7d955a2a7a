import tiktoken
from pyspark.sql import functions as F
from test_mixing import wanted
from test_simhash import exact as brute_fingerprint
from test_simhash import groups as brute_groups
from texts import documents

import corpus_pipeline
from chronomart.llm import mixing, pii, stages, toxicity
from chronomart.llm.queries import ORACLE, REGISTRY, vocabulary

FOLDER = "/root/testdata/sf0.001"


def test_stages_are_those_of_the_pipeline():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "pii", "mix_sources", "byte_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert sorted(n.split("_")[0] for n in REGISTRY) == sorted(f"op{i}" for i in range(1, 11))
    assert set(ORACLE) <= set(REGISTRY)


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == [*docs.columns, "token_ids"]
    texts = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    clean = {r["doc_id"] for r in toxicity.scored(docs, model).filter("score < 0.3").collect()}
    kept = docs.filter(F.col("doc_id").isin(sorted(clean)))
    clean_ids = sorted(clean)
    roots = brute_groups([brute_fingerprint(texts[i]["text"]) for i in clean_ids])
    groups = {clean_ids[r] for r in roots}
    alike = {r["doc_id"]: r["text"] for r in pii.pseudonymize(kept, stages.PSEUDONYM_KEY).collect()}
    single = kept.filter(F.col("doc_id").isin(sorted(groups)))
    single = single.select("doc_id", "source").withColumn("text", F.col("doc_id").cast("string"))
    words = spark.createDataFrame([(i, len(t.split())) for i, t in alike.items()], "doc_id long, n long")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(single.join(words, "doc_id"), F.col("n")).collect()}
    ranks = {p: i for i, p in enumerate(vocabulary().pieces)}
    library = tiktoken.Encoding("exact", pat_str=vocabulary().pattern, mergeable_ranks=ranks, special_tokens={})
    found: dict = {}
    for r in rows.collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
        assert r["token_ids"] == library.encode_ordinary(r["text"])
        assert r["text"] == alike[r["doc_id"]]
        assert (r["lang"], r["source"], r["n_chars"]) == (texts[r["doc_id"]]["lang"], texts[r["doc_id"]]["source"], len(r["text"]))
    assert found == {i: n for i, n in copies.items() if n}
    sizes, taken = {}, {}
    for i in groups:
        source, n = texts[i]["source"], len(alike[i].split())
        sizes[source] = sizes.get(source, 0) + n
        taken[source] = taken.get(source, 0) + n * found.get(i, 0)
    for source, target in wanted(sizes).items():
        assert abs(taken[source] - target) <= max(len(alike[i].split()) for i in groups if texts[i]["source"] == source)


def test_stages_keep_other_columns_and_take_empty_tables(spark):
    docs = documents(spark, ["a b c", None, "", "mail ann@example.com now"], lambda i: "s").withColumns(
        {"words": F.lit("w"), "toxicity": F.lit("t"), "place": F.lit("p"), "before": F.lit("b"), "copies": F.lit("c"), "size": F.lit("s")}
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert stages.pseudonymize(spark, docs, FOLDER).filter("text like '%example%'").count() == 0


def test_values_of_clashing_columns_and_maps_survive(spark):
    """Columns named like the mixer's, in any case, and columns of maps."""
    own = {"size": 7, "source_size": 8, "target": 0.5, "rate": "r", "Copies": [1, 2]}
    docs = documents(spark, ["a b c", "d e f g", "h"], lambda i: "s").withColumns(
        {name: F.lit(value) for name, value in own.items()} | {"tags": F.create_map(F.lit("k"), F.col("doc_id")), "own_size": F.lit("o")}
    )
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        rows = stage(spark, docs, FOLDER).collect()
        assert rows
        for r in rows:
            assert {name: r[name] for name in own} == own
            assert r["tags"] == {"k": r["doc_id"]} and r["own_size"] == "o"
