import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from chronomart.llm import dialogue
from chronomart.llm.queries import REGISTRY, damaged

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def cheapest(signs):
    """The least (cost, audit) by trying every edit from the end, over the four states of the grammar."""
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(i, state, inserts):
        ways = [(0, "")] if i == len(signs) and state in ("", "a") else []
        if inserts:
            ways += [(2 + c, "I" + a) for r in "ua" if (state, r) in go for c, a in best(i, go[state, r], inserts - 1)]
        if i < len(signs):
            sign = signs[i]
            ways += [(3 + c, "D" + a) for c, a in best(i + 1, state, 3)]
            if sign != "-":
                more = int(sign.isupper())
                if (state, sign.lower()) in go:
                    ways += [(more + c, "K" + a) for c, a in best(i + 1, go[state, sign.lower()], 3)]
                ways += [(more + 2 + c, "R" + a) for r in "ua" if (state, r) in go for c, a in best(i + 1, go[state, r], 3)]
        return [min(ways)] if ways else []

    for i in range(len(signs), 0, -1):  # from the end, so that calls stay shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 3)
    return best(0, "", 3)[0]


def by_hand(rows):
    """The contract's columns of one conversation, from its rows after damage, in order."""
    seen, signs, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        sign = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not text.strip(BLANK):
            counts["blank"] += 1
            sign = "-"
        elif (role, text) in seen:
            counts["duplicate"] += 1
            sign = "-"
        elif text.strip(BLANK)[-1] not in ".!?":
            counts["truncated"] += 1
            sign = sign.upper()
        seen.add((role, text))
        signs += sign
    cost, audit = cheapest(signs)
    lines, at, due = [], 0, "u"
    name = {"u": "user", "a": "assistant"}
    for edit in audit:
        if edit == "I":
            lines.append(f"{name[due]}:")
        else:
            _, role, text = rows[at]
            at += 1
            if edit == "D":
                continue
            lines.append(f"{role if edit == 'K' else name[due]}:{text}")
            if edit == "K" and role[:1] == "s":
                continue
        due = "a" if due == "u" else "u"
    initials = [r[:1] for _, r, _ in rows]
    turns = {t for t, _, _ in rows if t is not None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **counts,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def order_key(conv):
    def key(row):
        turn, role, text = row
        parts = ["false" if conv is not None else "true", "" if conv is None else str(conv), str(len(role)), role, text]
        return (turn is not None, turn or 0, role, hashlib.sha256(":".join(parts).encode()).hexdigest())

    return key


def expected(rows):
    """By conversation, from the rows before damage."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = convs.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: by_hand(sorted(own, key=order_key(c))) for c, own in convs.items()}


def query(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit("clash"), "conv": F.lit(1), "sign": F.lit(None).cast("string")})
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    return {r["conv_id"]: r.asDict() for r in REGISTRY["op12_repair"](spark, str(tmp_path)).collect()}


def random_rows(rng, convs, most):
    rows = []
    for conv in convs:
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "sys", "User"])
            text = rng.choice(["Yes.", "no", "Is it? ", " \t", "", None, "done!\n", "a. b", "x." * 50, "Yes."])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, text))
    return rows


def test_automaton_reads_the_grammar():
    auto = dialogue.AUTOMATON
    for n in range(8):
        for i in range(3**n):
            roles = "".join("sua"[i // 3**j % 3] for j in range(n))
            stacks = [(0,)]
            for role in roles:
                stacks = [new for s in stacks for new in auto.shift(s, role)]
            assert any(auto.accepts(s) for s in stacks) == bool(re.fullmatch("(s?(ua)+)?", roles))


def test_edits_against_trying_all():
    rng = random.Random(1)
    for _ in range(3000):
        signs = "".join(rng.choices("suaSUAxX-", k=rng.randint(0, 9)))
        assert dialogue.repaired(signs) == cheapest(signs), signs


def test_segments_chain_to_the_same_edits():
    rng = random.Random(2)
    for _ in range(1500):
        parts = ["".join(rng.choices("suaSUAx-", k=rng.randint(1, 4))) for _ in range(rng.randint(1, 5))]
        cost, audits, _ = dialogue.chain([dialogue.transfer(p) for p in parts])
        assert (cost, "".join(audits)) == cheapest("".join(parts)), parts


@pytest.mark.parametrize("bits", [1, 12])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(dialogue, "SEGMENT_BITS", bits)
    rows = random_rows(random.Random(bits), [None, *range(120)], 9)
    found, wanted = query(spark, tmp_path, rows), expected(rows)
    assert found.keys() == wanted.keys()
    for conv, row in wanted.items():
        assert found[conv] == {"conv_id": conv, **row}


def test_one_conversation_with_a_third_of_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dialogue, "SEGMENT_BITS", 5)
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Ja.", f"Wort {t}.", "nein"])) for t in range(700)]
    rows += [(7, 3, "user", "Same.")] * 300 + random_rows(rng, range(100, 400), 6)
    found, wanted = query(spark, tmp_path, rows), expected(rows)
    assert found.keys() == wanted.keys()
    for conv, row in wanted.items():
        assert found[conv] == {"conv_id": conv, **row}


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = {r["conv_id"]: r.asDict() for r in REGISTRY["op12_repair"](spark, "/root/testdata/sf0.001").collect()}
    wanted = expected([tuple(r) for r in rows])
    assert found == {c: {"conv_id": c, **row} for c, row in wanted.items()}


def test_empty_table_and_lines(spark, tmp_path):
    assert query(spark, tmp_path, []) == {}
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Why?"), (1, 2, "user", "Why?"), (1, 3, "tool", "Because."), (2, 0, "assistant", "Hm.")]
    lines = dialogue.repair(spark.createDataFrame(rows, SCHEMA)).lines().orderBy("conv", "pos", "line").collect()
    assert [(r["conv"], r["role"], r["text"]) for r in lines] == [
        (1, "system", "Be kind."), (1, "user", "Why?"), (1, "assistant", "Because."), (2, "user", ""), (2, "assistant", "Hm."),
    ]


def test_damage_covers_all_kinds(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert damaged(rows).filter("copy = 1").count() and damaged(rows).filter("text = ''").count()
