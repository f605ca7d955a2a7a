import hashlib

import pytest
from pyspark.sql import functions as F
from texts import NASTY, documents

from chronomart.llm import digest

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards boil purple lentils near quiet rivers".split()


def text(seed, words=200):
    return " ".join(WORDS[(seed * 7 + i * i * (seed + 3)) % len(WORDS)] + str((seed * i) % 11) for i in range(words))


def brute(texts):
    """Rows by id, in descending order of ids and around the end."""
    rows = {}
    order = list(range(len(texts)))[::-1]
    for at, i in enumerate(order):
        own, after = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        third = len(own) // 3
        changed = own[: len(own) - third] + after[:third]
        a, b, c = (digest.digest(t.encode()) for t in (own, changed, after))
        sha = hashlib.sha256(changed.encode()).hexdigest()
        rows[i] = (len(own), sha, a.hex(), b.hex(), digest.likeness(a, b), digest.likeness(a, c))
    return rows


@pytest.mark.parametrize("range_bytes", [600, 8000, 8 << 20])
def test_neighbours_against_brute_force(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(digest, "RANGE_BYTES", range_bytes)
    texts = NASTY + [text(i) for i in range(40)] + [text(3)]
    rows = digest.compare_neighbours(documents(spark, texts).repartition(5)).collect()
    assert len(rows) == len(texts)
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == brute(texts)


def test_single_and_empty_tables_and_null_ids(spark):
    one = documents(spark, ["abcdef"])
    row = digest.compare_neighbours(one).first()
    assert row["near_next"] == 1.0 and row["n_chars"] == 6
    assert digest.compare_neighbours(one.limit(0)).count() == 0
    nulls = one.withColumn("doc_id", F.lit(None).cast("long"))
    assert digest.compare_neighbours(nulls.union(nulls)).count() == 2
    assert digest.compare_neighbours(nulls.union(one)).count() == 2


def test_repeated_rows_and_other_columns(spark):
    docs = documents(spark, ["some text", "other text"]).withColumns({"part": F.lit(1), "away": F.lit("x")})
    rows = digest.compare_neighbours(docs.union(docs)).collect()
    assert sorted(r["doc_id"] for r in rows) == [0, 0, 1, 1]


def test_likeness_falls_with_edits():
    base = text(1, 600)
    words = base.split()
    near = " ".join(["changed" if i % 40 == 0 else w for i, w in enumerate(words)])
    far = "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich. " * 40
    a, b, c = (digest.digest(t.encode()) for t in (base, near, far))
    assert digest.likeness(a, a) == 1.0
    assert 1.0 > digest.likeness(a, b) > 0.6 > digest.likeness(a, c) >= 0.0
    assert digest.likeness(a, b) == digest.likeness(b, a)


def test_equal_texts_have_equal_digests_of_fixed_length():
    assert {len(digest.digest((t or "").encode())) for t in NASTY} == {34}
    assert digest.digest(b"") == bytes(34)


@pytest.mark.parametrize("base,step", [(2**53, 1), (2**60, 1), (2**60, 1_000_003), (-(2**62), 3**37 // 1000)])
def test_large_and_null_ids_in_several_ranges(spark, monkeypatch, base, step):
    monkeypatch.setattr(digest, "RANGE_BYTES", 3000)
    texts = [text(i) for i in range(60)]
    rows = [(base + 2 * i * step + 1, t) for i, t in enumerate(texts)] + [(None, f"z{i}") for i in range(3)]
    found = digest.compare_neighbours(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    order = sorted((r for r in rows if r[0] is not None), reverse=True) + rows[60:]
    shas = []
    for (i, own), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        shas.append((str(i), hashlib.sha256(digest.edited(own, after).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in found) == sorted(shas)
