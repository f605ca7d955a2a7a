import re

import pytest
from pyspark.sql import functions as F
from texts import documents

from chronomart.llm import mixing
from chronomart.llm.common import word_count


def wanted(sizes):
    """Targets by repeated sharing, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    targets, rest, total = {}, set(order), sum(sizes.values())
    while rest:
        left = total - sum(targets.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        full = {s for s in rest if share[s] > 3 * sizes[s]}
        if not full:
            return targets | share
        targets |= {s: 3 * sizes[s] for s in full}
        rest -= full
    return targets


def mix(spark, texts, source):
    docs = documents(spark, texts, source).withColumn("n", word_count(F.col("text")))
    return mixing.mix(docs, F.col("n"))


CASES = {
    "even": (["word " * (1 + i % 40) for i in range(600)], lambda i: f"s{i % 5}"),
    "capped": (["w " * (1 + i % 7) for i in range(300)], lambda i: "big" if i % 20 else f"small{i % 3}"),
    "nulls": ([None if i % 9 == 0 else "w " * (i % 13) for i in range(300)], lambda i: [None, "n", "s", "é"][i % 4]),
    "copies": (["same text here"] * 400, lambda i: "hot" if i % 3 else "b"),
    "single": (["one text"], lambda i: None),
}


@pytest.mark.parametrize("case", CASES)
def test_words_taken_come_near_the_targets(spark, case):
    texts, source = CASES[case]
    rows = mix(spark, texts, source).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    sizes, taken, longest = {}, {}, {}
    for r in rows:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or ""))
        assert r["size"] == words and 0 <= r["copies"] <= 3
        sizes[r["source"]] = sizes.get(r["source"], 0) + words
        taken[r["source"]] = taken.get(r["source"], 0) + words * r["copies"]
        longest[r["source"]] = max(longest.get(r["source"], 0), words)
    targets = wanted(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= longest[s]


def test_runs_agree_and_copies_are_spread(spark):
    texts, source = CASES["even"]
    one = sorted(map(tuple, mix(spark, texts, source).select("doc_id", "copies").collect()))
    two = sorted(map(tuple, mix(spark, texts, source).repartition(7).select("doc_id", "copies").collect()))
    assert one == two


def test_newton_steps_meet_extreme_constraints(spark):
    rows = [("a", 10**12, 3.0 * 10**12), ("b", 10**12, 1.0), ("c", 0, 0.0), (None, 7, 7.0)]
    found = {r["source"]: r["rate"] for r in mixing.balance(spark.createDataFrame(rows, "source string, source_size long, target double")).collect()}
    assert found["a"] == 3.0 and found["c"] == 1.0 and found[None] == 1.0 and found["b"] == pytest.approx(0, abs=1e-9)


def test_repeated_rows_clashing_columns_and_empty_tables(spark):
    docs = documents(spark, ["a b c", "d e"], lambda i: "s").withColumns({"rank": F.lit("r"), "target": F.lit("t"), "n": F.lit(2)})
    mixed = mixing.mix(docs.union(docs), F.col("n"))
    assert [r["rank"] for r in mixed.collect()] == ["r"] * 4
    assert mixing.mix(docs.limit(0), F.col("n")).count() == 0
    assert mixing.repeat(mixed, docs.columns).columns == docs.columns


def test_copies_become_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 3)], "doc_id long, copies int").withColumn("n", F.lit("own"))
    assert sorted(r["doc_id"] for r in mixing.repeat(df, ["doc_id", "n"]).collect()) == [2, 3, 3, 3]


def test_no_python_on_the_way(spark):
    plan = mix(spark, *CASES["even"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
