import hashlib

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from texts import NASTY, documents

from chronomart.llm import tokencount
from chronomart.llm.bpe import Encoder
from chronomart.llm.queries import REGISTRY, vocabulary


def counts(text):
    encoder = Encoder(vocabulary())
    numbers = encoder.encode_pieces([encoder.find(text)])[0]
    return encoder.sizes[numbers].tolist(), encoder.counts[numbers].tolist()


def edit(text, start, removed, inserted):
    start = min(max(start, 0), len(text))
    return text[:start] + inserted + text[min(start + max(removed, 0), len(text)) :]


LETTERS = st.text(alphabet="ab' \n\t1é!s ", max_size=80)


@settings(max_examples=150, deadline=None)
@given(LETTERS, st.lists(st.tuples(st.integers(-2, 90), st.integers(0, 40), LETTERS), max_size=4), st.integers(1, 6))
def test_trees_follow_any_edit(text, edits, leaf):
    before, tokencount.LEAF = tokencount.LEAF, leaf
    try:
        document = tokencount.Document(text, *counts(text))
        encoder = Encoder(vocabulary())
        for e in edits:
            place, pieces = document.cut(*e, encoder.match)
            numbers = encoder.encode_pieces([pieces])[0]
            document.mend(place, encoder.sizes[numbers].tolist(), encoder.counts[numbers].tolist())
            text = edit(text, *e)
            assert document.text == text
            assert document.pieces() == counts(text)
            assert document.count == sum(counts(text)[1])
            assert document.char_sums[1] == len(text)
    finally:
        tokencount.LEAF = before


def test_only_touched_regions_are_encoded_again(spark):
    docs = documents(spark, ["word " * 4000, "one"]).withColumn("edits", F.array(F.struct(
        F.lit(9000).alias("start"), F.lit(3).alias("removed"), F.lit("xyz").alias("inserted"))).cast(tokencount.EDITS))
    rows = tokencount.apply_edits(tokencount.trees(docs, vocabulary()), vocabulary()).orderBy("doc_id").collect()
    assert rows[0]["reencoded"] <= 6 and rows[0]["n_tokens"] == sum(counts(edit("word " * 4000, 9000, 3, "xyz"))[1])
    assert rows[1]["text"] == "onexyz"


def test_nulls_empty_tables_and_clashing_columns(spark):
    docs = documents(spark, NASTY).withColumn("piece_sizes", F.lit("replaced"))
    rows = tokencount.trees(docs, vocabulary()).withColumn("edits", F.lit(None).cast(tokencount.EDITS))
    for r in tokencount.apply_edits(rows, vocabulary()).collect():
        text = NASTY[r["doc_id"]] or ""
        assert (r["text"], r["reencoded"], r["n_tokens"]) == (text, 0, sum(counts(text)[1]))
    nulls = rows.withColumn("edits", F.array(F.struct(
        F.lit(None).alias("start"), F.lit(None).alias("removed"), F.lit(None).alias("inserted")), F.lit(None)).cast(tokencount.EDITS))
    for r in tokencount.apply_edits(nulls, vocabulary()).collect():
        assert r["text"] == (NASTY[r["doc_id"]] or "")
    assert tokencount.trees(docs.limit(0), vocabulary()).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = REGISTRY["op8_token_counts"](spark, folder).collect()
    assert len(rows) == len(texts)
    again = []
    for r in rows:
        text = texts[r["doc_id"]]
        n = len(text)
        changed = text
        for e in [(n // 4, 12, ""), (n // 2, 0, text[:24]), (3 * n // 4, 30, text[3 * n // 4 : 3 * n // 4 + 30].upper())]:
            changed = edit(changed, *e)
        sizes, tokens = counts(changed)
        assert r["n_tokens"] == sum(counts(text)[1]) and r["edited_tokens"] == sum(tokens)
        assert r["edited_pieces"] == len(sizes) == len(regex.findall(vocabulary().pattern, changed))
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        again.append(r["reencoded"])
    assert np.mean(again) < 30
