"""Token counts that follow edits.

A document keeps the sizes and token counts of its pieces (the pattern's matches)
under a segment tree: leaves are runs of pieces, inner nodes hold the sums of code
points and tokens below them.  An edit is found by descending over code points.
Pieces are matched anew from a little before the edit until a boundary coincides
with an old one behind it; from there on the rest must be as before, because a
match depends on the text after its start only.  The new pieces take the place of
the old and the sums above their leaf are updated.  Nothing else is encoded again.

Matches are assumed to look at most ``CONTEXT`` code points beyond their end, as
the public pattern does (two).  A task holds one block of documents; the edits of
a block are applied in rounds, so that new pieces of many documents are folded
together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronomart.llm.bpe import Encoder, Ranks
from chronomart.llm.common import blocks

CONTEXT = 4
#: Pieces in a leaf, and how many times more before the tree is built anew.
LEAF, MOST_LEAF = 32, 8

EDITS = "array<struct<start:bigint,removed:bigint,inserted:string>>"
TREE = [
    T.StructField("piece_sizes", T.ArrayType(T.IntegerType())),
    T.StructField("piece_tokens", T.ArrayType(T.IntegerType())),
]


class Document:
    """A text with the sums of its pieces."""

    def __init__(self, text: str, sizes: list[int], tokens: list[int]) -> None:
        self.text = text
        self.plant(sizes, tokens)

    def plant(self, sizes: list[int], tokens: list[int]) -> None:
        self.sizes = [sizes[i : i + LEAF] for i in range(0, len(sizes), LEAF)] or [[]]
        self.tokens = [tokens[i : i + LEAF] for i in range(0, len(tokens), LEAF)] or [[]]
        self.width = 1 << (len(self.sizes) - 1).bit_length()
        rest = [0] * (self.width - len(self.sizes))
        self.char_sums = [0] * self.width + [sum(x) for x in self.sizes] + rest
        self.token_sums = [0] * self.width + [sum(x) for x in self.tokens] + rest
        for node in range(self.width - 1, 0, -1):
            self._add(node)

    def _add(self, node: int) -> None:
        self.char_sums[node] = self.char_sums[2 * node] + self.char_sums[2 * node + 1]
        self.token_sums[node] = self.token_sums[2 * node] + self.token_sums[2 * node + 1]

    @property
    def count(self) -> int:
        return self.token_sums[1]

    def pieces(self) -> tuple[list[int], list[int]]:
        return [x for leaf in self.sizes for x in leaf], [x for leaf in self.tokens for x in leaf]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a code point, and where the leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.char_sums[node]:
                start += self.char_sums[node]
                node += 1
        return node - self.width, start

    def cut(self, start: int, removed: int, inserted: str, match: Callable) -> tuple[tuple[int, int, int, int], list[str]]:
        """Change the text; returns the place of the old pieces (first leaf and piece, last leaf and end) and the new pieces."""
        start = min(max(start, 0), len(self.text))
        end = min(start + max(removed, 0), len(self.text))
        text = self.text[:start] + inserted + self.text[end:]
        shift, fixed = len(text) - len(self.text), start + len(inserted)
        leaf, place = self.find(min(max(0, start - CONTEXT), max(0, len(self.text) - 1)))
        piece = 0
        while piece < len(self.sizes[leaf]) and place + self.sizes[leaf][piece] <= start - CONTEXT:
            place += self.sizes[leaf][piece]
            piece += 1
        first = leaf, piece
        old = at = place
        found: list[str] = []
        while True:
            if at >= fixed:
                while old < at - shift:
                    while piece == len(self.sizes[leaf]):
                        leaf, piece = leaf + 1, 0
                    old += self.sizes[leaf][piece]
                    piece += 1
                if old == at - shift:
                    break
            found.append(text[at : (at := match(text, at).end())])
        self.text = text
        return (*first, leaf, piece), found

    def mend(self, place: tuple[int, int, int, int], sizes: list[int], tokens: list[int]) -> None:
        """Put new pieces in the place of the old and update the sums above."""
        leaf, piece, last, end = place
        for lists, new in ((self.sizes, sizes), (self.tokens, tokens)):
            rest = lists[last][end:]
            head = lists[leaf][:piece]
            if last > leaf:
                lists[last] = rest
                rest = []
            lists[leaf] = head + new + rest
            for i in range(leaf + 1, last):
                lists[i] = []
        if len(self.sizes[leaf]) > LEAF * MOST_LEAF:
            self.plant(*self.pieces())
            return
        nodes = set()
        for i in range(leaf, last + 1):
            node = i + self.width
            self.char_sums[node], self.token_sums[node] = sum(self.sizes[i]), sum(self.tokens[i])
            nodes.add(node // 2)
        while nodes and max(nodes) > 0:
            for node in nodes:
                self._add(node)
            nodes = {n // 2 for n in nodes if n > 1}


def _flat(lists: list[list[list[int]]]) -> pa.Array:
    """A column of lists from the leaves of each row."""
    sizes = [sum(map(len, leaves)) for leaves in lists]
    values = np.fromiter(chain.from_iterable(map(chain.from_iterable, lists)), np.int32, sum(sizes))
    return _column(values, sizes)


def _column(values: np.ndarray, sizes: list[int]) -> pa.Array:
    offsets = np.cumsum([0, *sizes]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _rows(column: pa.ListArray) -> list[list[int]]:
    """Lists of plain numbers, empty for null."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
    values = column.flatten().to_numpy(zero_copy_only=False).tolist()
    return [values[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def trees(df: DataFrame, ranks: Ranks, text: str = "text") -> DataFrame:
    """``df`` with the leaves of its texts' trees: piece_sizes (code points) and piece_tokens.

    A null text counts as empty; an empty text has no pieces.  Columns with those
    names are replaced.
    """
    df = df.drop(*(f.name for f in TREE))
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks)
        for block in blocks(batches, text):
            numbers = encoder.encode_pieces(encoder.find(t or "") for t in block.column(at).to_pylist())
            every, lengths = np.concatenate(numbers), list(map(len, numbers))
            columns = [_column(encoder.sizes[every], lengths), _column(encoder.counts[every], lengths)]
            yield pa.RecordBatch.from_arrays([*block.columns, *columns], [*block.schema.names, *(f.name for f in TREE)])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *TREE]))


def apply_edits(df: DataFrame, ranks: Ranks, edits: str = "edits", text: str = "text") -> DataFrame:
    """Texts and trees of ``df`` after edits, with n_tokens and reencoded, the number of pieces matched anew.

    ``edits`` names an array of (start, removed, inserted), in code points of the
    text as the edits before it left it; places beyond the text mean its end,
    nulls mean 0 and the empty text.  A null array changes nothing, and a null
    text becomes empty.
    """
    df = df.drop("n_tokens", "reencoded")
    at = {name: df.columns.index(name) for name in (text, edits, *(f.name for f in TREE))}
    schema = T.StructType(
        [*df.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("reencoded", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks)
        for block in blocks(batches, text):
            texts, wanted = (block.column(at[n]).to_pylist() for n in (text, edits))
            sizes, tokens = (_rows(block.column(at[f.name])) for f in TREE)
            documents = [Document(t or "", s, c) for t, s, c in zip(texts, sizes, tokens, strict=True)]
            again = np.zeros(len(documents), np.int64)
            for turn in range(max((len(w or []) for w in wanted), default=0)):
                due = [i for i, w in enumerate(wanted) if w and len(w) > turn and w[turn]]
                cuts = []
                for i in due:
                    e = wanted[i][turn]
                    cuts.append(documents[i].cut(e["start"] or 0, e["removed"] or 0, e["inserted"] or "", encoder.match))
                found = encoder.encode_pieces(pieces for _, pieces in cuts)
                for i, (place, _), new in zip(due, cuts, found, strict=True):
                    documents[i].mend(place, encoder.sizes[new].tolist(), encoder.counts[new].tolist())
                    again[i] += len(new)
            new = {
                at[text]: pa.array([d.text for d in documents], pa.string()),
                at[TREE[0].name]: _flat([d.sizes for d in documents]),
                at[TREE[1].name]: _flat([d.tokens for d in documents]),
            }
            columns = [new.get(i, c) for i, c in enumerate(block.columns)]
            counts = pa.array([d.count for d in documents], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, counts, pa.array(again)], schema.names)

    return df.mapInArrow(run, schema)
