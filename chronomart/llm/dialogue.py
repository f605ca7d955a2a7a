"""Conversation repair: a generalised LR parse of the roles, with weighted edits.

A conversation's roles should read ``(s?(ua)+)?`` by their initials: an optional system row, then user and
assistant in turn.  The rows' roles run through an LR automaton of that grammar.  Its graph-structured stack
keeps every way to go on: a row is kept, deleted or given another role, and empty rows are inserted.  Equal
stack tops are merged by the least (cost, audit), the audit being the edits' initials in order.  (Two audits
of one cost over the same rows are never each other's beginning, so the least one stays the least.)

Rows are first put in order by a range sort over all conversations, so a conversation may lie across tasks.
``SEGMENT_BITS`` bounds the rows that are parsed together: longer conversations are cut into segments, each
parsed from every stack top it could start at, and the results are chained by segment.  Texts are not needed
for any of that; they join the edits by the row's position.

Order: turn (nulls first), then role, then a digest of role and text.  Null roles and texts are one space;
a null conversation id is a conversation.  Equal rows are rows of their own (the second is a duplicate).
Other columns are left out.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.llm.common import stored

# The grammar of roles, and the costs of edits.
GRAMMAR = (
    ("talk", ()),
    ("talk", ("turns",)),
    ("talk", ("s", "turns")),
    ("turns", ("u", "a")),
    ("turns", ("turns", "u", "a")),
)
FREE = {"u": "user", "a": "assistant"}  # the roles that a row may be given
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
#: Rows of a conversation that are parsed together: at most 2**SEGMENT_BITS.
SEGMENT_BITS = 12

#: A row's sign: its initial, in upper case if it is truncated; ``-`` if it has to go; ``x`` for other roles.
GONE, OTHER = "-", "x"


# The automaton -------------------------------------------------------------------------------------

Item = tuple[int, int]  # production, place of the dot
Stack = tuple[int, ...]


class Automaton:
    """LR(0) states of ``GRAMMAR``; conflicts are left to the graph-structured stack, which follows both ways."""

    def __init__(self, grammar: tuple = GRAMMAR, start: str = "talk") -> None:
        self.grammar, self.start = grammar, start
        first = self._closure(frozenset((i, 0) for i, (left, _) in enumerate(grammar) if left == start))
        self.states, self.goto = [first], []
        for state in self.states:  # grows while it is walked
            moves = {}
            for symbol in sorted({grammar[p][1][dot] for p, dot in state if dot < len(grammar[p][1])}):
                to = self._closure(
                    frozenset((p, dot + 1) for p, dot in state if dot < len(grammar[p][1]) and grammar[p][1][dot] == symbol)
                )
                if to not in self.states:
                    self.states.append(to)
                moves[symbol] = self.states.index(to)
            self.goto.append(moves)
        self.done = [[grammar[p] for p, dot in sorted(state) if dot == len(grammar[p][1])] for state in self.states]

    def _closure(self, items: frozenset[Item]) -> frozenset[Item]:
        found = set(items)
        for p, dot in (queue := list(items)):
            right = self.grammar[p][1]
            if dot < len(right):
                new = {(i, 0) for i, (left, _) in enumerate(self.grammar) if left == right[dot]} - found
                found |= new
                queue += new
        return frozenset(found)

    def _reduced(self, stack: Stack) -> tuple[list[Stack], bool]:
        """The stacks that reductions lead to, itself included, and whether one of them is the whole talk."""
        found, accepted = [stack], False
        for top in found:
            for left, right in self.done[top[-1]]:
                below = top[: len(top) - len(right)]
                if left == self.start:
                    accepted |= len(below) == 1
                elif left in self.goto[below[-1]]:
                    found.append((*below, self.goto[below[-1]][left]))
        return found, accepted

    @lru_cache(maxsize=None)  # noqa: B019  (left recursion bounds the stacks)
    def shift(self, stack: Stack, symbol: str) -> tuple[Stack, ...]:
        return tuple((*s, self.goto[s[-1]][symbol]) for s in self._reduced(stack)[0] if symbol in self.goto[s[-1]])

    @lru_cache(maxsize=None)  # noqa: B019
    def accepts(self, stack: Stack) -> bool:
        return self._reduced(stack)[1]

    @lru_cache(maxsize=None)  # noqa: B019
    def tops(self) -> dict[int, Stack]:
        """A stack for every top that a parse can reach."""
        found = {0: (0,)}
        queue = [(0,)]
        for stack in queue:
            for symbol in ("s", *FREE):
                for new in self.shift(stack, symbol):
                    if new[-1] not in found:
                        found[new[-1]] = new
                        queue.append(new)
        return found


AUTOMATON = Automaton()


class Best(NamedTuple):
    cost: int
    audit: str
    stack: Stack


def _merge(into: dict[int, Best], new: Best) -> bool:
    old = into.get(new.stack[-1])
    if old is None or (new.cost, new.audit) < (old.cost, old.audit):
        into[new.stack[-1]] = new
        return True
    return False


def _inserted(tops: dict[int, Best]) -> dict[int, Best]:
    """``tops`` and those that insertions lead to."""
    found, queue = dict(tops), list(tops.values())
    for best in queue:
        for role in FREE:
            for stack in AUTOMATON.shift(best.stack, role):
                new = Best(best.cost + INSERT, best.audit + "I", stack)
                if _merge(found, new):
                    queue.append(new)
    return found


def parse(tops: dict[int, Best], signs: str) -> dict[int, Best]:
    """The tops after the rows of ``signs``; insertions come before a row, never after the last."""
    for sign in signs:
        after: dict[int, Best] = {}
        own, more = sign.lower(), TRUNCATED if sign.isupper() else 0
        for cost, audit, stack in _inserted(tops).values():
            _merge(after, Best(cost + DELETE, audit + "D", stack))
            if sign == GONE:
                continue
            for kept in AUTOMATON.shift(stack, own):
                _merge(after, Best(cost + more, audit + "K", kept))
            for role in FREE:
                for changed in AUTOMATON.shift(stack, role):
                    _merge(after, Best(cost + more + REROLE, audit + "R", changed))
        tops = after
    return tops


def ended(tops: dict[int, Best]) -> tuple[int, str]:
    """The least (cost, audit) of a whole talk, insertions at its end included."""
    return min((b.cost, b.audit) for b in _inserted(tops).values() if AUTOMATON.accepts(b.stack))


@lru_cache(maxsize=1 << 14)
def repaired(signs: str) -> tuple[int, str]:
    """The cheapest edits of one whole conversation; short sequences of signs come again and again."""
    return ended(parse({0: Best(0, "", (0,))}, signs))


def transfer(signs: str) -> list[tuple[int, int, int, str]]:
    """(first top, last top, cost, audit) of a segment, for every top it could start at."""
    return [
        (top, best.stack[-1], best.cost, best.audit)
        for top, stack in AUTOMATON.tops().items()
        for best in parse({top: Best(0, "", stack)}, signs).values()
    ]


def chain(segments: Iterable[list[tuple[int, int, int, str]]]) -> tuple[int, list[str], list[int]]:
    """The cheapest way through all segments: its cost, the audit of each, and the top each starts at."""
    ways: dict[int, tuple[int, tuple[str, ...], tuple[int, ...]]] = {0: (0, (), ())}
    for moves in segments:
        after: dict[int, tuple[int, tuple[str, ...], tuple[int, ...]]] = {}
        for first, last, cost, audit in moves:
            if first in ways:
                so_far, audits, starts = ways[first]
                new = (so_far + cost, (*audits, audit), (*starts, first))
                if last not in after or new[:2] < after[last][:2]:
                    after[last] = new
        ways = after
    stacks = AUTOMATON.tops()
    found = []
    for top, (cost, audits, starts) in ways.items():
        for more in _inserted({top: Best(0, "", stacks[top])}).values():
            if AUTOMATON.accepts(more.stack):
                found.append((cost + more.cost, [*audits[:-1], audits[-1] + more.audit], starts))
    cost, audits, starts = min(found)
    return cost, audits, list(starts)


def spell(audit: str, signs: str, expected: str) -> tuple[list[str], list[str], str]:
    """What the edits make: roles inserted before each row, each row's role (empty: gone), and roles after the last.

    ``expected`` is the role due next; a kept system row leaves it as it is.
    """
    before, roles, inserted, at = [], [], "", 0
    for edit in audit:
        if edit == "I":
            inserted += expected
        else:
            own = signs[at].lower()
            role = "" if edit == "D" else own if edit == "K" else expected
            before.append(inserted)
            roles.append(role)
            inserted, at = "", at + 1
        if edit == "I" or (edit != "D" and role != "s"):
            expected = "a" if expected == "u" else "u"
    return before, roles, inserted


# Rows in order, with their signs ---------------------------------------------------------------------


def in_order(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with a position that follows their order: conv, turn, role, text, key, pos.  Stored."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role, text))
    own = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), role_.alias("role"), text_.alias("text"))
    # One key for equal role and text in a conversation; lengths keep the parts apart.
    parts = [F.col("conv").isNull().cast("string"), F.coalesce(F.col("conv").cast("string"), F.lit("")), F.length("role").cast("string")]
    key = F.sha2(F.concat_ws(":", *parts, "role", "text").cast("binary"), 256)
    # Equal rows are interchangeable; a number of their own lets a range of them be cut.
    keyed = own.withColumns({"key": key, "tie": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "key", "tie"]
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sorted_rows.drop("tie").withColumn("pos", F.monotonically_increasing_id()))


def signed(rows: DataFrame) -> DataFrame:
    """Positions with the rows' faults and signs, without texts."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv", "turn", "key", "pos",
        F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER).alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    first = narrow.groupBy("key").agg(F.min("pos").alias("first"))
    duplicate = ~F.col("blank") & (F.col("pos") > F.col("first"))
    truncated = ~F.col("blank") & ~duplicate & F.col("cut")
    sign = F.when(F.col("blank") | duplicate, GONE).when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial"))
    return narrow.join(first, "key").select(
        "conv", "turn", "pos", "initial", "blank", duplicate.alias("duplicate"), truncated.alias("truncated"), sign.alias("sign")
    )


def segments(signs: DataFrame) -> DataFrame:
    """Up to 2**SEGMENT_BITS rows of a conversation as one: conv, segment (its first position), places, signs, initials."""
    part = F.shiftright("pos", SEGMENT_BITS)
    entries = F.array_sort(F.collect_list(F.struct("pos", "sign", "initial")))
    return (
        signs.groupBy("conv", part.alias("part"))
        .agg(entries.alias("e"))
        .select(
            "conv",
            F.col("e")[0]["pos"].alias("segment"),
            F.col("e.pos").alias("places"),
            F.array_join("e.sign", "").alias("signs"),
            F.array_join("e.initial", "").alias("initials"),
        )
    )


# Edits ---------------------------------------------------------------------------------------------

EDITS = "segment long, audit string, expected string, cost long"


def _parse_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [repaired(s) for s in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([a for _, a in found], pa.string()),
                pa.array(["u"] * len(found), pa.string()),
                pa.array([c for c, _ in found], pa.int64()),
            ],
            names=["segment", "audit", "expected", "cost"],
        )


MOVES = "array<struct<first:int,last:int,cost:long,audit:string>>"


def _parse_part(conv_type: str):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
        names = ("first", "last", "cost", "audit")
        for batch in batches:
            moves = [[dict(zip(names, m, strict=True)) for m in transfer(s)] for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(moves, kind)], names=["conv", "segment", "moves"])

    return run, f"conv {conv_type}, segment long, moves {MOVES}"


def _chain_parts(table: pa.Table) -> pa.Table:
    table = table.sort_by("segment")
    parts = ([tuple(m.values()) for m in moves.as_py()] for moves in table.column("moves"))
    cost, audits, starts = chain(parts)
    due = ["a" if "a" in AUTOMATON.goto[top] else "u" for top in starts]
    costs = [cost] + [0] * (len(due) - 1)  # the conversation's cost stands with its first segment
    return pa.table(
        {
            "segment": table.column("segment"),
            "audit": pa.array(audits, pa.string()),
            "expected": pa.array(due, pa.string()),
            "cost": pa.array(costs, pa.int64()),
        }
    )


def edits(parts: DataFrame) -> DataFrame:
    """The cheapest edits, by segment: segment, audit, expected, cost."""
    conv_type = parts.schema["conv"].dataType.simpleString()
    ends = parts.groupBy("conv").agg(F.min("segment").alias("least"), F.max("segment").alias("most"))
    several = ends.filter("least < most").select(F.col("conv").alias("c"))
    apart = F.col("conv").eqNullSafe(F.col("c"))
    whole = parts.join(several, apart, "left_anti").select("segment", "signs").mapInArrow(_parse_whole, EDITS)
    run, schema = _parse_part(conv_type)
    moves = parts.join(several, apart, "left_semi").select("conv", "segment", "signs").mapInArrow(run, schema)
    return whole.unionByName(moves.groupBy("conv").applyInArrow(_chain_parts, EDITS))


def _spell_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for places, signs, audit, expected in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            before, roles, after = spell(audit, signs, expected)
            tails = [""] * (len(places) - 1) + [after]
            made += zip(places, before, roles, tails, strict=True)
        columns = list(zip(*made, strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["pos", "before", "becomes", "after"]
        )


class Repair(NamedTuple):
    """``rows`` in order, their ``signs``, the ``parts`` they are parsed in, and the ``edits`` of those.  All stored."""

    rows: DataFrame
    signs: DataFrame
    parts: DataFrame
    edits: DataFrame

    def lines(self) -> DataFrame:
        """The repaired conversations: conv, pos, line (order among one position), role, text."""
        spelled = self.parts.join(self.edits, "segment").select("places", "signs", "audit", "expected")
        spelled = spelled.mapInArrow(_spell_segments, "pos long, before string, becomes string, after string")
        named = F.create_map(*(F.lit(x) for pair in FREE.items() for x in pair))

        def inserted(column: str) -> Column:
            letters = F.filter(F.split(column, ""), lambda c: c != "")
            return F.transform(letters, lambda c: F.struct(named[c].alias("role"), F.lit("").alias("text")))

        initial = F.substring("role", 1, 1)
        role = F.when(initial == F.col("becomes"), F.col("role")).otherwise(named[F.col("becomes")])
        own = F.when(F.col("becomes") == "", F.array()).otherwise(F.array(F.struct(role.alias("role"), "text")))
        made = F.concat(inserted("before"), own, inserted("after"))
        rows = self.rows.select("conv", "pos", "role", "text").join(spelled, "pos")
        return rows.select("conv", "pos", F.posexplode(made).alias("line", "made")).select(
            "conv", "pos", "line", F.col("made.role").alias("role"), F.col("made.text").alias("text")
        )

    def report(self) -> DataFrame:
        """One row for each conversation: gaps, faults, illegal neighbours, cost and audit."""
        count = lambda c: F.count_if(F.col(c)).alias(c)
        gap = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
        faults = self.signs.groupBy("conv").agg(
            F.coalesce(gap, F.lit(0)).cast("long").alias("gaps"), count("blank"), count("duplicate"), count("truncated")
        )
        letters = F.col("initials")
        inside = F.length(letters) - 1 - F.regexp_count(letters, F.lit("(?=su|ua|au)"))
        of_parts = self.parts.join(self.edits, "segment").select(
            "conv", "segment", "cost", "audit", inside.alias("illegal"),
            F.struct("segment", F.substring(letters, 1, 1).alias("first"), F.substring(letters, -1, 1).alias("last")).alias("ends"),
        )
        in_turn = F.array_sort(F.collect_list(F.struct("segment", "audit")))
        ends = F.array_sort(F.collect_list("ends"))
        seams = of_parts.groupBy("conv").agg(
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(in_turn, lambda s: s["audit"]), "").alias("audit"),
            F.sum("illegal").alias("illegal"),
            ends.alias("ends"),
        )
        pairs = F.zip_with(
            F.slice("ends", 1, F.size("ends") - 1), F.slice("ends", 2, F.size("ends")), lambda a, b: F.concat(a["last"], b["first"])
        )
        wrong = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))
        seams = seams.select("conv", "cost", "audit", (F.col("illegal") + wrong).cast("long").alias("illegal"))
        both = faults.unionByName(seams, allowMissingColumns=True)  # grouping keeps a null id, a join would not
        return both.groupBy("conv").agg(*(F.max(c).alias(c) for c in both.columns if c != "conv"))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Parse and repair all conversations of ``df``."""
    rows = in_order(df, conv, turn, role, text)
    signs = stored(signed(rows))
    parts = stored(segments(signs))
    return Repair(rows, signs, parts, stored(edits(parts)))


def digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines.  Streams through sorted rows, holding one batch."""
    conv_type = lines.schema["conv"].dataType.simpleString()
    line = F.concat("role", F.lit(":"), "text").alias("whole")
    placed = lines.select("conv", "pos", "line", line).repartition("conv").sortWithinPartitions("conv", "pos", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            convs, found = [], []
            for conv, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if digest is not None and conv == now:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        convs.append(now)
                        found.append(digest.hexdigest())
                    now, digest = conv, hashlib.sha256()
                digest.update(whole.encode())
            yield pa.RecordBatch.from_arrays([pa.array(convs, batch.schema.types[0]), pa.array(found, pa.string())], names=["conv", "digest"])
            kind = batch.schema.types[0]
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([digest.hexdigest()], pa.string())], names=["conv", "digest"])

    return placed.select("conv", "whole").mapInArrow(run, f"conv {conv_type}, digest string")
