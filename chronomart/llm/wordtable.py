"""Byte-level BPE through a table of distinct words: encode each word once, join its ids back by position.

Spark splits the texts into words (the tokenizer's own pattern, texts cut at special tokens first).
Blocks of about ``BLOCK_BYTES`` number their distinct words and keep each document as word numbers.
A block's words go out in slips, one for each hash class, so that equal words of all blocks meet in one
class; there every distinct word is encoded once.  The ids return to their block by word number, and
each document takes them in the order of its positions.

Documents are written once, bucketed by block, and are not exchanged; only distinct words are.  A word
comes at most once from a block, however often it occurs, so no frequent word makes a large task.  The
number of classes grows with the text, and so do the blocks; a class and a block are bounded in size.

The text itself is not carried: ``decode`` gives it back through a join of ids with their pieces.
Null texts are empty; empty texts have no ids.  Rows are kept one for one, equal ones too.
"""

from __future__ import annotations

import heapq
import json
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from chronomart.llm.common import bucketed, fresh, text_of
from chronomart.sources.storage import MAX_BUCKETS

#: Text that one block of documents holds; a longer document is a block of its own.
BLOCK_BYTES = 16 << 20
#: Text behind one hash class of words (its distinct words are a fraction of that).
CLASS_BYTES = 32 << 20
#: Word numbers or ids that a worker expands at a time.
EXPANDED = 1 << 18
#: Words longer than this are merged one by one, in n log n steps.
LONG_WORD = 256
#: Words of one length that are merged at a time.
TOGETHER = 1 << 17
NEVER = np.int32(2**31 - 1)

# White space of the split pattern, and the code points up to which all Java versions know every letter.
SPACES = r"\x09-\x0D\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SETTLED = 0x52F
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


# The vocabulary ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """``pieces``: bytes of each id; merges in order of their keys, with rank and resulting id; special tokens."""

    pattern: str
    pieces: list[bytes]
    byte_ids: np.ndarray
    merge_keys: np.ndarray
    merge_ranks: np.ndarray
    merge_ids: np.ndarray
    specials: dict[str, int]

    def merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of each pair's merge; the rank is ``NEVER`` where there is none."""
        keys = left.astype(np.int64) * len(self.pieces) + right
        at = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[at] == keys, self.merge_ranks[at], NEVER), self.merge_ids[at]


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte; bytes without a mark take those from U+0100 on."""
    marked = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(marked)]
    return {chr(b): b for b in marked} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranges(anchor: str) -> str:
    """Code points above ``SETTLED`` that the library's split keeps in one word with ``anchor``, as a character class.

    The JVM's own classes follow its Unicode version, which may be older; letters and numbers are in planes 0 to 3.
    """
    points = [c for c in range(SETTLED + 1, 0x40000) if not 0xD800 <= c < 0xE000]
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    found: list[int] = []
    for part in range(0, len(points), 1 << 14):
        some = points[part : part + (1 << 14)]
        spans = {a: b for _, (a, b) in level.pre_tokenize_str("".join(f"{anchor}{chr(c)}\n" for c in some))}
        found += [c for i, c in enumerate(some) if spans.get(3 * i) == 3 * i + 2]
    runs: list[list[int]] = []
    for c in found:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs)


def split_pattern() -> str:
    """The byte-level split as a Java pattern that agrees with the library on all code points."""
    letters, numbers = _ranges("a"), _ranges("1")
    above = rf"[^\x00-\x{{{SETTLED:X}}}]"
    letter, number = (rf"[\p{{{k}}}[{above}&&[{r}]]]" for k, r in (("L", letters), ("N", numbers)))
    other = rf"[[^{SPACES}\p{{L}}\p{{N}}]&&[\x00-\x{{{SETTLED:X}}}[^{letters}{numbers}]]]"
    space = f"[{SPACES}]"
    return f"{CONTRACTIONS}| ?{letter}+| ?{number}+| ?{other}+|{space}+(?![^{SPACES}])|{space}+"


def load(path: str) -> Vocabulary:
    """Read a tokenizer file on the driver; tasks get its arrays.  Other kinds of tokenizer are refused."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    plain = all(not model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before["add_prefix_space"]
    if model["type"] != "BPE" or spec["normalizer"] or not (plain and byte_level):
        raise ValueError("not a plain byte-level BPE")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError("special tokens that take neighbouring characters are not known here")
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    alphabet, vocab = byte_alphabet(), model["vocab"]
    pieces = [b""] * (1 + max([*vocab.values(), *specials.values()]))
    for token, i in vocab.items():
        pieces[i] = bytes(alphabet[c] for c in token)
    for token, i in specials.items():
        pieces[i] = token.encode()
    merges = {}
    for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
        merges[vocab[a] * len(pieces) + vocab[b]] = (rank, vocab[a + b])  # a pair that is named twice keeps its last rank
    keys = np.array(sorted(merges), np.int64)
    ranks, ids = np.array([merges[k] for k in keys.tolist()], np.int32).T
    at = {b: c for c, b in alphabet.items()}
    byte_ids = np.array([vocab[at[b]] for b in range(256)], np.int32)
    return Vocabulary(split_pattern(), pieces, byte_ids, keys, ranks, ids, specials)


# Encoding words ------------------------------------------------------------------------------------


def _merge_same_length(ids: np.ndarray, vocab: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merge rows of ``ids`` until none can; gives (row numbers, their ids) as rows come to an end.

    Each round merges the lowest-ranked, then leftmost pair of every row, so all rows stay equally long.
    """
    rows = np.arange(len(ids))
    ranks, made = vocab.merges(ids[:, :-1], ids[:, 1:])
    while len(rows):
        if ids.shape[1] == 1:
            yield rows, ids
            return
        at = ranks.argmin(axis=1)
        ended = ranks[np.arange(len(rows)), at] == NEVER
        if ended.any():
            yield rows[ended], ids[ended]
            go = ~ended
            rows, ids, ranks, made, at = rows[go], ids[go], ranks[go], made[go], at[go]
        line, width = np.arange(len(rows)), ids.shape[1]
        ids[line, at] = made[line, at]
        kept = np.ones(ids.shape, bool)
        kept[line, at + 1] = False
        ids = ids[kept].reshape(len(rows), width - 1)
        kept = np.ones(ranks.shape, bool)
        kept[line, at] = False
        ranks, made = (x[kept].reshape(len(rows), width - 2) for x in (ranks, made))
        for near in (at - 1, at):  # the new id with its left and with its right neighbour
            on = np.flatnonzero((near >= 0) & (near < width - 2))
            col = near[on]
            ranks[on, col], made[on, col] = vocab.merges(ids[on, col], ids[on, col + 1])


def _merge_long(word: bytes, vocab: Vocabulary) -> np.ndarray:
    """One long word, by a heap of its pairs over a linked list."""
    ids = vocab.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    n = len(ids)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def merge(a: int, b: int) -> tuple[int, int]:
        if (a, b) not in known:
            rank, made = vocab.merges(np.array([a]), np.array([b]))
            known[a, b] = int(rank[0]), int(made[0])
        return known[a, b]

    heap = [(rank, i, made) for i in range(n - 1) for rank, made in [merge(ids[i], ids[i + 1])] if rank != NEVER]
    heapq.heapify(heap)
    while heap:
        rank, i, made = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j < 0 or merge(ids[i], ids[j]) != (rank, made):
            continue
        ids[i], ids[j] = made, -1
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (new := merge(ids[a], ids[b]))[0] != NEVER:
                heapq.heappush(heap, (new[0], a, new[1]))
    return np.array([i for i in ids if i >= 0], np.int32)


def encode_words(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The number of ids of each word, and all ids one word after the other."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = np.zeros(len(words), np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for size in np.unique(sizes).tolist():
        of_size = np.flatnonzero(sizes == size)
        for part in range(0, len(of_size), TOGETHER):
            some = of_size[part : part + TOGETHER]
            if size > LONG_WORD:
                ended: Iterable = ((np.array([i]), _merge_long(words[w], vocab)[None]) for i, w in enumerate(some.tolist()))
            else:
                flat = np.frombuffer(b"".join([words[w] for w in some.tolist()]), np.uint8)
                ended = _merge_same_length(vocab.byte_ids[flat].reshape(-1, size), vocab) if size else ()
            for rows, ids in ended:
                counts[some[rows]] = ids.shape[1]
                done.append((some[rows], ids))
    starts = np.cumsum(counts) - counts
    flat_ids = np.zeros(int(counts.sum()), np.int32)
    for rows, ids in done:
        flat_ids[starts[rows][:, None] + np.arange(ids.shape[1])] = ids
    return counts, flat_ids


def gather(numbers: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words ``numbers`` in order, and where each word's end."""
    starts, lengths = np.cumsum(counts) - counts, counts[numbers]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.repeat(starts[numbers] - (ends - lengths), lengths) + np.arange(total)], ends


# Arrays in rows ------------------------------------------------------------------------------------

ZSTD = "zstd"


def pack(values: np.ndarray) -> bytes:
    """A small compressed form of an array: first the low bytes of all values, then the next ones."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec(ZSTD).compress(planes, asbytes=True)


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec(ZSTD).decompress(data[8:], size), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def row_ranges(lists: pa.ListArray, most: int = EXPANDED) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` values; a longer row stands alone."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, length in enumerate(lengths.tolist()):
        if i > start and held + length > most:
            yield start, i
            start, held = i, 0
        held += length
    if start < len(lists):
        yield start, len(lists)


# Splitting and numbering ---------------------------------------------------------------------------


def split_words(text: Column, vocab: Vocabulary) -> Column:
    """The words of a text in order; special tokens are words of their own."""

    def words(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(vocab.pattern), F.lit(0))

    if not vocab.specials:
        return words(text)
    if len(vocab.specials) > 1:
        raise ValueError("more than one special token")
    (special,) = vocab.specials
    quoted = "".join(c if c.isalnum() else f"\\{c}" for c in special)
    parts = F.split(text, quoted, -1)
    with_marks = F.transform(
        parts, lambda part, i: F.when(i > 0, F.concat(F.array(F.lit(special)), words(part))).otherwise(words(part))
    )
    return F.when(F.contains(text, F.lit(special)), F.flatten(with_marks)).otherwise(words(text))


def _lists(ends: np.ndarray, values: pa.Array | np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values))


def _text_bytes(lists: pa.ListArray) -> np.ndarray:
    """Bytes of text in each list of strings, read off the offsets without a copy of the strings."""
    flat = lists.values
    offsets = np.frombuffer(flat.buffers()[1], np.int32) if len(flat) else np.zeros(1, np.int32)
    return np.diff(offsets[flat.offset + lists.offsets.to_numpy()].astype(np.int64))


class Numbering:
    """Turns batches of (columns, words) into numbered documents and slips of distinct words."""

    def __init__(self, names: dict[str, str], classes: int) -> None:
        self.names, self.classes = names, classes

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            # A batch may hold more text than a block: it is cut where the words add up.
            in_rows = _text_bytes(batch.column(batch.schema.get_field_index(self.names["words"])))
            start = 0
            for i, row in enumerate(in_rows.tolist()):
                size += row
                if size >= BLOCK_BYTES:
                    yield from self.block(block, [*held, batch.slice(start, i + 1 - start)])
                    block, held, size, start = block + 1, [], 0, i + 1
                    pa.default_memory_pool().release_unused()
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield from self.block(block, held)

    def block(self, block: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = pa.Table.from_batches(batches).combine_chunks()
        lists = docs.column(self.names["words"])
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
        numbered = lists.flatten().dictionary_encode()
        words = numbered.dictionary.cast(pa.binary()).to_pylist()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        del lists
        kept = [c for c in docs.column_names if c != self.names["words"]]
        columns = [docs.column(c) for c in kept]
        columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in columns]
        yield self.rows(docs, block, docs.num_rows, columns, {"numbers": _lists(ends, numbered.indices)})

        crc, n = zlib.crc32, self.classes
        of_word = np.fromiter((crc(w) % n for w in words), np.int64, len(words))
        order = np.argsort(of_word, kind="stable")  # of a class in order of their numbers
        classes, first = np.unique(of_word[order], return_index=True)
        slips = []
        for cls, locals_ in zip(classes.tolist(), np.split(order, first[1:]) if len(order) else [], strict=True):
            own = [words[i] for i in locals_.tolist()]
            sizes = np.fromiter(map(len, own), np.int32, len(own))
            text = np.frombuffer(b"".join(own), np.uint8)
            slips.append((cls, pack(np.diff(locals_, prepend=0).astype(np.int32)), pack(sizes), pack(text)))
        if slips:
            made = dict(zip(("cls", "locals", "sizes", "text"), zip(*slips, strict=True), strict=True))
            nothing = [pa.nulls(len(slips), c.type) for c in columns]
            yield self.rows(docs, block, len(slips), nothing, {k: pa.array(v, self.KINDS[k]) for k, v in made.items()})

    KINDS = {  # noqa: RUF012
        "numbers": pa.list_(pa.int32()), "cls": pa.int32(), "locals": pa.binary(), "sizes": pa.binary(), "text": pa.binary(),
    }

    def rows(self, docs: pa.Table, block: int, count: int, columns: list[pa.Array], made: dict[str, pa.Array]) -> pa.RecordBatch:
        kept = [c for c in docs.column_names if c != self.names["words"]]
        own = [made.get(k, pa.nulls(count, kind)) for k, kind in self.KINDS.items()]
        names = [*kept, self.names["block"], *(self.names[k] for k in self.KINDS)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(count, block, np.int64)), *own], names=names)


# Joining -------------------------------------------------------------------------------------------


def _encode_class(vocab: Vocabulary, names: dict[str, str]):  # noqa: ANN202
    def run(slips: pa.Table) -> pa.Table:
        sizes = [unpack(b.as_py(), np.int32) for b in slips.column(names["sizes"])]
        text = np.concatenate([unpack(b.as_py(), np.uint8) for b in slips.column(names["text"])])
        offsets = np.r_[0, np.cumsum(np.concatenate(sizes), dtype=np.int64)]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text)])
        numbered = words.dictionary_encode()
        every, distinct = numbered.indices.to_numpy(), numbered.dictionary.to_pylist()
        counts, ids = encode_words(distinct, vocab)
        for special, i in vocab.specials.items():  # a special token's text is one id, never merged bytes
            if special.encode() in distinct:
                at = distinct.index(special.encode())
                start = int(counts[:at].sum())
                ids = np.r_[ids[:start], np.int32(i), ids[start + int(counts[at]) :]]
                counts[at] = 1
        rows = []
        for numbers in np.split(every, np.cumsum([len(x) for x in sizes])[:-1]):
            flat, _ = gather(numbers, counts, ids)
            rows.append((pack(counts[numbers].astype(np.int32)), pack(flat)))
        return pa.table(
            {
                names["block"]: slips.column(names["block"]),
                names["locals"]: slips.column(names["locals"]),
                names["counts"]: pa.array([c for c, _ in rows], pa.binary()),
                names["ids"]: pa.array([i for _, i in rows], pa.binary()),
            }
        )

    return run


def _place(names: dict[str, str], kept: list[str], to: str):  # noqa: ANN202
    def values(table: pa.Table, name: str) -> np.ndarray:
        parts = [unpack(b.as_py(), np.int32) for b in table.column(names[name])]
        if name == "locals":
            parts = [np.cumsum(p, dtype=np.int32) for p in parts]
        return np.concatenate([np.zeros(0, np.int32), *parts])

    def run(docs: pa.Table, slips: pa.Table) -> pa.Table:
        order = np.argsort(values(slips, "locals"), kind="stable")
        # The ids as they came, slip by slip, put in the order of the block's numbers.
        counts = values(slips, "counts").astype(np.int64)
        ids, _ = gather(order, counts, values(slips, "ids"))
        counts, found = counts[order], []
        for numbers in docs.column(names["numbers"]).chunks:
            for start, end in row_ranges(numbers):
                part = numbers.slice(start, end - start)
                flat, ends = gather(part.flatten().to_numpy(), counts, ids)
                found.append(_lists(np.r_[0, ends][np.cumsum(pc.list_value_length(part).to_numpy())], flat))
        pa.default_memory_pool().release_unused()
        return docs.select(kept).append_column(to, pa.chunked_array(found, pa.list_(pa.int32())))

    return run


def encode(df: DataFrame, vocab: Vocabulary, text: str = "text", to: str = "token_ids") -> DataFrame:
    """``df`` without ``text``, with the ids of its texts in a new array column ``to`` (replaced if there is one).

    Other columns of any type are kept as they are, whatever their names.  The numbered documents are
    written to the shared folder, so a lost executor costs the parts of one step.
    """
    spark = df.sparkSession
    df = df.withColumn(text, text_of(text)).drop(*[c for c in df.columns if c == to and to != text])
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    classes = max(1, math.ceil(total / CLASS_BYTES))
    cores = spark.sparkContext.defaultParallelism
    buckets = min(MAX_BUCKETS, max(1, math.ceil(total / BLOCK_BYTES), min(cores, math.ceil(total / (4 << 20)))))
    wished = ["block", "words", "numbers", "cls", "locals", "sizes", "text", "counts", "ids"]
    names = dict(zip(wished, fresh(df, *(f"w_{w}" for w in wished)), strict=True))
    kept = [c for c in df.columns if c != text]

    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema if f.name != text]
    many, packed, block = T.ArrayType(T.IntegerType()), T.BinaryType(), names["block"]
    kinds = {"block": T.LongType(), "numbers": many, "cls": T.IntegerType(), "locals": packed, "sizes": packed, "text": packed}
    rows = T.StructType([*fields, *(T.StructField(names[k], kind) for k, kind in kinds.items())])
    split = df.select(*kept, split_words(F.col(text), vocab).alias(names["words"]))
    numbered = bucketed(split.mapInArrow(Numbering(names, classes), rows), buckets, block)

    slips = numbered.filter(F.col(names["cls"]).isNotNull()).select(*(names[k] for k in kinds if k != "numbers"))
    encoded = slips.groupBy(names["cls"]).applyInArrow(
        _encode_class(vocab, names),
        T.StructType([T.StructField(block, T.LongType()), *(T.StructField(names[k], packed) for k in ("locals", "counts", "ids"))]),
    )
    docs = numbered.filter(F.col(names["cls"]).isNull()).select(*kept, block, names["numbers"])
    placed = T.StructType([*docs.select(*kept).schema.fields, T.StructField(to, many)])
    return docs.groupBy(block).cogroup(encoded.groupBy(block)).applyInArrow(_place(names, kept, to), placed)


def decode(df: DataFrame, vocab: Vocabulary, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids, special tokens included, in a new column ``to`` (replaced if there is one).

    Ids are joined with the table of pieces, which every task holds (its size is the vocabulary's), and a
    document's pieces are put together in order.  Ids that the vocabulary lacks and null ids stand for
    nothing; bytes that are not UTF-8 become U+FFFD; null ids of a whole document give null.
    """
    df = df.drop(*[c for c in df.columns if c == to and to != ids])
    pieces, known = pa.array([*vocab.pieces, b""], pa.binary()), len(vocab.pieces)
    (own,) = fresh(df, "decoded_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for start, end in row_ranges(batch.column(at)):
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*part.columns, texts(part.column(at))], names=[*part.schema.names, own])

    def texts(lists: pa.ListArray) -> pa.Array:
        flat = pc.fill_null(lists.flatten(), known)
        at = pc.if_else(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, known)), flat, known)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.r_[0, ends], pa.int64()), pieces.take(at)), b"")
        joined = pc.if_else(lists.is_null(), pa.scalar(None, pa.binary()), joined.cast(pa.binary()))
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([None if b is None else b.decode(errors="replace") for b in joined.to_pylist()], pa.string())

    schema = T.StructType([*df.schema.fields, T.StructField(own, T.StringType())])
    return df.mapInArrow(run, schema).withColumnRenamed(own, to)
