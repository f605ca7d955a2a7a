import base64
import hashlib

import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from texts import NASTY, documents

from chronomart.llm import bpe
from chronomart.llm.queries import REGISTRY, vocabulary

PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def exact():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("exact", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_text_is_encoded_as_by_the_library(spark, exact):
    rows = bpe.encode(documents(spark, NASTY), vocabulary()).collect()
    assert len(rows) == len(NASTY)
    for r in rows:
        assert r["token_ids"] == exact.encode_ordinary(NASTY[r["doc_id"]] or "")


def test_decoding_gives_the_bytes_back(spark):
    rows = bpe.encode(documents(spark, NASTY), vocabulary())
    for r in rows.select("doc_id", bpe.decode(F.col("token_ids"), vocabulary()).alias("bytes")).collect():
        assert bytes(r["bytes"]) == (NASTY[r["doc_id"]] or "").encode()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_blocks_agree_with_the_library(exact, texts):
    ids, offsets = bpe.Encoder(vocabulary()).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [exact.encode_ordinary(t) for t in texts]


def test_a_forgotten_dictionary_changes_nothing(exact, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 3)
    encoder = bpe.Encoder(vocabulary())
    for text in ("one two three four", "three four five six", "one"):
        assert encoder.encode([text])[0].tolist() == exact.encode_ordinary(text)


def test_clashing_columns_and_empty_tables(spark):
    docs = documents(spark, ["a b"]).withColumn("ids", F.lit("kept")).withColumn("token_ids", F.lit("replaced"))
    row = bpe.encode(docs, vocabulary()).first()
    assert row["ids"] == "kept" and len(row["token_ids"]) == 2
    assert bpe.encode(docs.limit(0), vocabulary()).count() == 0


def test_ranks_without_one_last_merge_are_refused(tmp_path):
    lines = [base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)] + [base64.b64encode(b"abc") + b" 256"]
    (tmp_path / "ranks").write_bytes(b"\n".join(lines))
    with pytest.raises(ValueError, match="last merge"):
        bpe.load(str(tmp_path / "ranks"), public.PATTERN)


def test_query(spark, exact):
    rows = REGISTRY["op1_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = exact.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
