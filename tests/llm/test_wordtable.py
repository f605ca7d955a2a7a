import hashlib
import json
import random

import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from texts import NASTY, documents
from tokenizers import Tokenizer

from chronomart.llm import wordtable
from chronomart.llm.queries import REGISTRY, word_vocabulary

PATH = public.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(PATH)


def ids_of(exact, text):
    return exact.encode(text or "", add_special_tokens=False).ids


def assert_equal_to_library(spark, exact, texts):
    vocab = word_vocabulary()
    rows = wordtable.decode(wordtable.encode(documents(spark, texts), vocab), vocab).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(exact, texts[r["doc_id"]])
        assert r["token_ids"] == ids
        assert r["decoded"] == exact.decode(ids, skip_special_tokens=False)


def test_texts_special_tokens_and_long_words(spark, exact):
    marked = [f"a  {SPECIAL}  b{SPECIAL}{SPECIAL} x", SPECIAL, f"{'y' * 700}{SPECIAL}", "<|endoftex", f" {SPECIAL} "]
    assert_equal_to_library(spark, exact, [*NASTY, *marked, "IT'S it's 'll", "z" * 40_000, "ab" * 9000])


def test_random_mixtures_of_classes(spark, exact):
    """Letters and numbers that the JVM's Unicode version lacks, all kinds of white space, parts of the special token."""
    rng = random.Random(5)
    some = "ab é你好\U0001f600\n\t　!?1२'sS<|>ࡰ\U0001df00\U00011bf0᠎​ \x85\xa0\x1c\x00"
    mixed = ["".join(rng.choices([*some, "end", SPECIAL], k=rng.randint(1, 60))) for _ in range(400)]
    assert_equal_to_library(spark, exact, mixed)


def test_every_code_point_is_split_as_by_the_library(spark, exact):
    points = [c for c in range(1, 0x32000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)} {chr(c)}1{chr(c)}" for c in points[i : i + 5000]) for i in range(0, len(points), 5000)]
    assert_equal_to_library(spark, exact, texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=40).filter(lambda t: " " not in t and "\n" not in t), max_size=6))
def test_words_are_merged_as_one_by_one(texts):
    """All words of a length at once, and each by the heap, give the same ids."""
    vocab = word_vocabulary()
    words = [t.encode() for t in texts] + [b"", b"a", b"the", b"thethethe"]
    counts, flat = wordtable.encode_words(words, vocab)
    ends = counts.cumsum()
    for word, start, end in zip(words, ends - counts, ends, strict=True):
        assert flat[start:end].tolist() == (wordtable._merge_long(word, vocab).tolist() if word else [])


def test_small_blocks_and_classes_change_nothing(spark, exact, monkeypatch):
    monkeypatch.setattr(wordtable, "BLOCK_BYTES", 300)
    monkeypatch.setattr(wordtable, "CLASS_BYTES", 500)
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["the", "same", "words", "anté", f"w{i}", SPECIAL], k=rng.randint(0, 40))) for i in range(300)]
    assert_equal_to_library(spark, exact, [*texts, None, "", *["the same copy"] * 300])


def test_columns_rows_and_empty_tables_are_kept(spark):
    vocab = word_vocabulary()
    docs = documents(spark, ["a b", "a b", None]).withColumns(
        {"token_ids": F.lit("own"), "w_block": F.lit("kept"), "decoded_text": F.create_map(F.lit("k"), F.lit(1)), "words": F.lit(3)}
    )
    rows = wordtable.decode(wordtable.encode(docs.union(docs), vocab), vocab).collect()
    assert len(rows) == 6
    assert all(r["w_block"] == "kept" and r["decoded_text"] == {"k": 1} and r["words"] == 3 for r in rows)
    assert sorted(r["decoded"] for r in rows) == ["", "", "a b", "a b", "a b", "a b"]
    assert wordtable.decode(wordtable.encode(docs.limit(0), vocab), vocab).count() == 0


def test_decoding_of_unknown_ids_and_broken_bytes(spark, exact):
    vocab = word_vocabulary()
    half = ids_of(exact, "é你")  # cut inside characters
    lists = [half[:1], half[1:], [], None, [50256, 99999, -1, None, 0], list(range(0, 50257, 7))]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, token_ids array<int>")
    for r in wordtable.decode(rows, vocab).collect():
        ids = lists[r["i"]]
        if ids is None:
            assert r["decoded"] is None
        else:
            known = [i for i in ids if i is not None and 0 <= i < 50257]
            assert r["decoded"] == exact.decode(known, skip_special_tokens=False)


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        wordtable.load(public.path("word_bpe_49k.json"))
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["added_tokens"][0]["lstrip"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="neighbouring"):
        wordtable.load(str(tmp_path / "t.json"))


def test_documents_are_not_exchanged(spark):
    plan = wordtable.encode(documents(spark, ["a b"]), word_vocabulary())._jdf.queryExecution().executedPlan().toString()
    docs = plan.split("FlatMapCoGroupsInArrow")[1].split("Bucketed: true")[0]
    assert "Exchange" not in docs


def test_query(spark, exact):
    rows = REGISTRY["op11_word_table"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(exact, texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
