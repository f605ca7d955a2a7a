"""Byte-level BPE: encode texts to ids by ranked merges, decode ids to bytes.

A text is cut into pieces by the tokenizer's pattern.  Within a block of texts
every distinct piece is folded once: its bytes are ids at first, and the
lowest-ranked pair of neighbours is merged until none is left.  All pieces of a
block are folded together, a round merging the lowest pair of each.  Pieces
already folded in a task are looked up.  Decoding concatenates the bytes of ids
with Spark's own functions.  There is no shuffle.

A merge table takes the place of the ranks: ``load`` replays every token from
its bytes and keeps the one pair that completes it, and refuses ranks for which
that pair is not unique (then equal pairs could not be merged at once).

Null texts are empty, empty texts have no ids.  Memory per worker is bounded by
``BLOCK_CHARS`` and ``KNOWN_PIECES``, and by the longest text.  The time for one
piece grows with the number of different merges in it times its length.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import blocks, fresh

#: Distinct pieces that a task keeps folded; beyond, it starts a new dictionary.
KNOWN_PIECES = 300_000
NEVER = np.int32(2**31 - 1)


@dataclass(frozen=True)
class Ranks:
    """A vocabulary: the pattern, the bytes of each id, and its merges in order of their keys."""

    pattern: str
    pieces: list[bytes | None]
    byte_ids: np.ndarray
    merge_keys: np.ndarray
    merge_ids: np.ndarray

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids that pairs merge to, ``NEVER`` where they do not."""
        keys = left.astype(np.int64) * len(self.pieces) + right
        at = np.searchsorted(self.merge_keys, keys)
        at[at == len(self.merge_keys)] = 0
        return np.where(self.merge_keys[at] == keys, self.merge_ids[at], NEVER)


def _parts(token: bytes, limit: int, ranks: dict[bytes, int]) -> list[bytes]:
    """``token`` after all merges ranked below ``limit``."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= limit:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def load(path: str, pattern: str) -> Ranks:
    """Read a file of base64 tokens and ranks; the driver reads it, tasks get its arrays."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
    pieces: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    merges: dict[int, int] = {}
    for token, rank in ranks.items():
        pieces[rank] = token
        if len(token) > 1:
            pair = _parts(token, rank, ranks)
            if len(pair) != 2:
                raise ValueError(f"token {rank} is not made by one last merge")
            merges[ranks[pair[0]] * len(pieces) + ranks[pair[1]]] = rank
    keys = np.array(sorted(merges), dtype=np.int64)
    return Ranks(
        pattern,
        pieces,
        np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32),
        keys,
        np.array([merges[k] for k in keys.tolist()], dtype=np.int32),
    )


def fold(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after the other, and the number of each word's ids."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    ids = ranks.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    done_ids, done_words = [], []
    rank = np.full(len(ids), NEVER, dtype=np.int32)  # of the pair that starts here
    inner = np.flatnonzero(word[:-1] == word[1:])
    rank[inner] = ranks.lookup(ids[inner], ids[inner + 1])
    while len(ids):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[starts, len(word)])
        lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        live = lowest != NEVER
        if not live.all():
            done_ids.append(ids[~live])
            done_words.append(word[~live])
            ids, word, rank, lowest = ids[live], word[live], rank[live], lowest[live]
            if not len(ids):
                break
        at = np.flatnonzero(rank == lowest)
        # Of overlapping pairs (a run of one id) every second is merged, from the left.
        first = np.r_[True, np.diff(at) != 1]
        run = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        at = at[run % 2 == 0]
        ids[at] = lowest[at]
        kept = np.ones(len(ids), dtype=bool)
        kept[at + 1] = False
        new_at = at - np.arange(len(at))
        ids, word, rank = ids[kept], word[kept], rank[kept]
        for i in (new_at, new_at[new_at > 0] - 1):
            right = np.minimum(i + 1, len(ids) - 1)
            rank[i] = np.where((i + 1 < len(ids)) & (word[i] == word[right]), ranks.lookup(ids[i], ids[right]), NEVER)
    if not done_ids:
        return np.zeros(0, np.int32), lengths
    all_words = np.concatenate(done_words)
    order = np.argsort(all_words, kind="stable")
    return np.concatenate(done_ids)[order], np.bincount(all_words, minlength=len(words))


class _Dictionary(dict):
    """Numbers pieces in the order in which they are first met."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Encoder:
    """Encodes blocks of texts; keeps what it has folded."""

    def __init__(self, ranks: Ranks) -> None:
        pattern = regex.compile(ranks.pattern)
        self.ranks, self.find, self.match = ranks, pattern.findall, pattern.match
        self.reset()

    def reset(self) -> None:
        self.known = _Dictionary()
        self.ids = np.zeros(0, np.int32)
        # Of each known piece: where its ids start, how many they are, and its code points.
        self.starts, self.counts, self.sizes = (np.zeros(0, np.int64) for _ in range(3))

    def encode_pieces(self, texts: Iterable[list[str]]) -> list[np.ndarray]:
        """The numbers of each text's pieces in ``known``; pieces not met before are folded."""
        if len(self.known) > KNOWN_PIECES:
            self.reset()
        before, number = len(self.known), self.known.__getitem__
        numbers = [np.fromiter(map(number, pieces), dtype=np.int32) for pieces in texts]
        new = list(islice(self.known, before, None))
        if new:
            ids, counts = fold([w.encode() for w in new], self.ranks)
            self.sizes = np.r_[self.sizes, np.fromiter(map(len, new), np.int64, len(new))]
            self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(counts) - counts]
            self.counts = np.r_[self.counts, counts]
            self.ids = np.r_[self.ids, ids]
        return numbers

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of each text's."""
        pieces = self.encode_pieces(self.find(t or "") for t in texts)
        every = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
        lengths = self.counts[every]
        ends = np.cumsum(lengths)
        flat = self.ids[np.repeat(self.starts[every] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.cumsum([0, *map(len, pieces)])
        return flat, np.r_[0, ends][bounds]


def encoder(ranks: Ranks, text: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(ranks).encode
        for block in blocks(batches, text):
            at = block.schema.get_field_index(text)
            ids, offsets = encode(block.column(at).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*block.columns, lists], names=[*block.schema.names, "ids"])

    return run


def encode(df: DataFrame, ranks: Ranks, text: str = "text", to: str = "token_ids") -> DataFrame:
    """``df`` with the ids of its texts, without special tokens, in a new array column ``to``.

    Columns of any type are kept; one named ``to`` is replaced.
    """
    df = df.drop(to)
    (ids,) = fresh(df, "ids")
    schema = T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if ids != "ids":  # the worker's own name is taken
        return encode(df.withColumnRenamed("ids", ids), ranks, text, to).withColumnRenamed(ids, "ids")
    return df.mapInArrow(encoder(ranks, text), schema).withColumnRenamed("ids", to)


def decode(ids: Column, ranks: Ranks) -> Column:
    """The bytes that an array of ids stands for: its pieces, concatenated (null for null)."""
    hexes = F.split(F.lit(",".join((p or b"").hex() for p in ranks.pieces)), ",")
    pieces = F.transform(ids, lambda i: F.get(hexes, i))
    return F.unhex(F.array_join(pieces, ""))
