"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tierline.llm.common import give_back

SPACES = b" \t\n\x0b\x0c\r"
_SOLID = np.ones(256, bool)
_SOLID[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOW_BYTES = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
#: Words longer than this many bytes are hashed one by one.
LONG = 64
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each of some ranges of data, which goes on for LONG bytes or more behind the last."""
    sizes = ends - begins
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = mix(sizes.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    todo = np.flatnonzero(sizes <= LONG)
    at = 0
    while len(todo):
        part = eights[begins[todo] + at] & _LOW_BYTES[np.minimum(sizes[todo] - at, 8)]
        out[todo] = mix(out[todo] ^ part)
        at += 8
        todo = todo[sizes[todo] > at]
    for i in np.flatnonzero(sizes > LONG):
        out[i] = xxhash.xxh64_intdigest(data[begins[i] : ends[i]].tobytes())
    return out


class Words:
    """The words of a block of texts: starts and ends in data, the number of each text's words, and a hash a word."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.texts = texts
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.edges = np.concatenate(([0], np.cumsum(sizes)))
        data = np.frombuffer(b"".join([*texts, b" " * LONG]), np.uint8)
        self.data = _LOWER[data] if lower else data
        n = int(self.edges[-1])
        solid = _SOLID[data[:n]]
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        inner = self.edges[:-1][sizes > 0]
        begins[inner] = solid[inner]
        last = self.edges[1:][sizes > 0] - 1
        ends[last] = solid[last]
        self.begins = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begins, self.edges)  # of each text, among all words
        self.counts = np.diff(self.first)
        self.hashes = hashes(self.data, self.begins, self.ends)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.counts)

    def place(self) -> np.ndarray:
        """Of each word, in its own text."""
        return np.arange(len(self.begins)) - np.repeat(self.first[:-1], self.counts)


def join_pairs(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return mix(a * U(0x9E3779B97F4A7C15) + (b ^ U(salt)))


def runs(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """A hash of every run of length hashes (also those that cross texts), from runs of half the length."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    have, size, out, done = hashes, 1, None, 0
    while size <= length:
        if length & size:
            piece = have[done : len(hashes) - length + done + 1]
            out = piece if out is None else join_pairs(out, piece, salt + length)
            done += size
        if size * 2 <= length:
            have = join_pairs(have[:-size], have[size:], salt + size)
        size *= 2
    return out


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches whose texts have about most bytes together (one text at least), with the texts; null is empty.

    Only a slice's texts are copied out of its batch; after the last one, freed memory goes back to the system.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = done = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(sizes, done + most, "right")))
            own = batch.slice(begin, end - begin)
            yield own, [x or b"" for x in own.column(at).cast(pa.large_binary()).to_pylist()]
            begin, done = end, int(sizes[end - 1])
    give_back()
