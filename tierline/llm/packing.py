"""Packing token sequences: first-fit decreasing over a tournament tree of bin capacities, in randomised groups."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import give_back, numbered, plain_names, told_apart
from tierline.llm.parts import Known, distinct_parts, ids_of_parts, parted, parts_of
from tierline.llm.words import blocks

#: Bytes of text that are tokenized at once, about; and bytes, about, that a worker spends on remembering the ids of their parts.
BLOCK_BYTES, REMEMBERED = 2 << 20, 32 << 20


@functools.cache
def token_ids(path: str) -> TokenIds:
    """One a worker: its tokenizer, and what it remembers within its bounds, outlive a task: tasks share most of their words."""
    return TokenIds(path)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in such vocabularies: itself, or, if not printable, from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TokenIds:
    """Ids of whole texts by a byte-level BPE tokenizer file, as little-endian 32-bit bytes; and the bytes of each id.

    Such a tokenizer begins a piece wherever white space follows another character, so a text's ids are those of its parts
    (`parts.py`). A file that does not cut so gets whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        letters = {v: k for k, v in _byte_letters().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self.known = Known(self._learn, REMEMBERED)
        probe = " Ab caf\u00e9s, x.\n\n \ty  z\u00a0  1!\n- it's  "  # does this file cut as assumed?
        self.direct = parted(self.bytes) and np.array_equal(np.concatenate([self.encode(x) for x in parts_of([probe.encode()])[0]]), self.encode(probe.encode()))

    def encode(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, parts: list[bytes]) -> pa.LargeBinaryArray:
        order, ids, counts = ids_of_parts(parts, self.encode, self.sizes)
        ends = np.append(0, 4 * np.cumsum(counts))
        told = pa.Array.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4"))])
        return told.take(pa.array(np.argsort(order)))

    def texts(self, texts: list[bytes]) -> list[bytes]:
        parts, which, firsts = distinct_parts(texts, self.direct)
        if not len(parts):
            return [b""] * len(texts)
        told = self.known.of(parts).take(pa.array(which))
        _, at, raw = told.buffers()
        at, raw = np.frombuffer(at, np.int64)[firsts].tolist(), raw.to_pybytes()
        return [raw[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]

    def text(self, text: str) -> bytes:
        return self.texts([text.encode()])[0]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Each document's ids and then end_id, cut every capacity ids: key, start, length, ids_crc32, doc_tokens (and ids).

    A null text counts as empty: one piece of end_id alone. Rows with a null key or equal keys are documents like others. An
    empty table gives an empty result; other columns are not read, whatever their names.
    """
    schema = f"`{key}` long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_ids(tokenizer_path)
        for part, texts in blocks(batches, "text", BLOCK_BYTES):
            rows = []
            for k, ids in zip(part.column(0).to_pylist(), tokens.texts(texts), strict=True):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    own = ids[at : at + 4 * capacity]
                    rows.append((k, at // 4, len(own) // 4, zlib.crc32(own), len(ids) // 4, *([own] * with_ids)))
            kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[key, "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(kinds)])
            give_back()

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(cut, schema)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and offset of each item, in items' order; sizes must fall. Each goes to the first bin with room.

    The tree's leaves are the bins' free room and each inner node is the larger of its two, so that the walk from the root
    to the first bin with room takes log2(bins) steps.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    for n, size in enumerate(sizes.tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        bins[n], offsets[n] = at - leaves, capacity - tree[at]
        tree[at] -= size
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
    return bins, offsets


def pack(items: DataFrame, capacity: int = 1024, groups: int | None = None, seed: int = 1, key: str = "doc_id", each: int = 4000) -> DataFrame:
    """items (key, start, length and any other columns) with sequence_id and offset (gapless from 0 in each sequence).

    No length may exceed capacity (cut longer ones first: pieces). Groups are random in what a row holds and, among equal
    rows, in a number, so that rows without a key, or that repeat, spread like others, and reruns agree however items are
    split; each is packed by itself, so a piece's place depends on its group's rows only. Without groups, they are sized to about `each` pieces. An empty table gives an empty result. Columns
    of items may have any names; sequence_id and offset give way to the result's.
    """
    spare = items.drop("sequence_id", "offset")
    rows, of = plain_names(spare, spare.columns)
    rows = told_apart(rows, "row")
    groups = groups or max(1, -(-rows.count() // each))
    hashed = [f.name for f in rows.schema.fields if f.name != "row" and not isinstance(f.dataType, T.MapType)]
    grouped = numbered(rows, "row", hashed).withColumn("bin", F.pmod(F.xxhash64("mark", "nth", F.lit(seed)), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(of["length"], "descending"), (of[key], "ascending"), (of["start"], "ascending"), ("mark", "ascending"), ("nth", "ascending")])
        bins, offsets = first_fit_decreasing(table[of["length"]].to_numpy(), capacity)
        group = table["bin"][0].as_py()
        return table.drop_columns(["row", "mark", "nth", "bin"]).append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(offsets))

    schema = T.StructType([*(T.StructField(of[f.name], f.dataType) for f in spare.schema.fields), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    packed = grouped.groupBy("bin").applyInArrow(run, schema)
    return packed.toDF(*spare.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0, key: str = "doc_id", seed: int = 1, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack whole documents: the columns of pieces, sequence_id and offset."""
    return pack(pieces(docs, tokenizer_path, capacity, end_id, key=key, with_ids=with_ids), capacity, seed=seed, key=key)


def padding(packed: DataFrame, capacity: int = 1024) -> DataFrame:
    """One row: sequences, tokens, padded (cells of padding when a sequence whose length is a power of two stays as it is)."""
    lengths = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    whole = F.bit_count("n") == 1
    return lengths.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(F.when(whole, 0).otherwise(capacity - F.col("n"))).alias("padded"))
