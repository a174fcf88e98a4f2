"""Parts of texts whose tokens do not depend on what stands around them, and what a worker remembers of them.

A part begins with a space or newline behind a character that is not white space, or with its text. Tokenizers that cut words
apart cut there too, so a text's ids are those of its parts. Parts repeat: each is tokenized once a block at most.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tierline.llm.words import LONG, hashes

#: Bytes at whose end white space may stand: nothing is cut behind them. (Beyond ASCII, some other characters are taken for it.)
_MAY_BE_WHITE = re.compile(rb"(?:[\x00-\x20]|\xc2[\x85\xa0]|[\xe1-\xe3]..)\Z", re.S)
#: Parts that are tokenized as one text.
TOGETHER = 1000


def _begins(data: bytes) -> np.ndarray:
    """Where in data a space or newline stands behind a character that is not white space."""
    d = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(((d[1:] == 32) | (d[1:] == 10)) & (d[:-1] > 32)) + 1
    before = d[at - 1]
    if (before >= 128).any():
        two, three = d[np.maximum(at - 2, 0)], d[np.maximum(at - 3, 0)]
        white = (two == 0xC2) & ((before == 0x85) | (before == 0xA0)) | (before >= 128) & (three >= 0xE1) & (three <= 0xE3)
        at = at[~white]
    return at


def parted(tokens: list[bytes]) -> bool:
    """Whether no token holds a place where parts begin."""
    return not any(len(_begins(x)) for x in tokens if x)


def distinct_parts(texts: list[bytes], cut: bool = True) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """The distinct parts of texts (whole texts, unless cut); the number of each part, text by text; how many begin before each text."""
    data = b"".join(texts)
    if not data:
        return pa.array([], pa.large_binary()), np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    begin = np.zeros(len(data) + 1, bool)
    if cut:
        begin[_begins(data)] = True
    begin[0] = True
    begin[ends] = True
    edges = np.flatnonzero(begin)
    parts = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
    return parts.dictionary, parts.indices.to_numpy(), np.searchsorted(edges, np.append(0, ends))


def parts_of(texts: list[bytes], cut: bool = True) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The same, the parts as a list."""
    parts, which, firsts = distinct_parts(texts, cut)
    return parts.to_pylist(), which, firsts


def _hashes(parts: pa.LargeBinaryArray) -> np.ndarray:
    _, at, held = parts.buffers()
    at = np.frombuffer(at, np.int64)[parts.offset : parts.offset + len(parts) + 1]
    data = np.append(np.frombuffer(held or b"", np.uint8)[: at[-1]], np.zeros(LONG, np.uint8))
    return hashes(data, at[:-1], at[1:])


def ids_of_parts(parts: list[bytes], encode: Callable[[bytes], np.ndarray], sizes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """An order of all parts, their ids in it end to end, and how many are each part's. sizes: the bytes of each id.

    Parts are encoded many at a time, where each ends before white space that cannot belong to it, and the ids are told apart by
    their bytes; if these do not meet the parts' ends, by halves.
    """
    joined = [i for i, p in enumerate(parts) if p[0] in b" \n" and (32 < p[-1] < 128 or not _MAY_BE_WHITE.search(p))]
    alone = sorted(set(range(len(parts))).difference(joined))
    found, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]

    def cut(own: list[int]) -> None:
        ids = encode(b"".join(parts[i] for i in own))
        ends, want = np.cumsum(sizes[ids]), np.cumsum([len(parts[i]) for i in own])
        at = np.searchsorted(ends, want)
        if len(own) > 1 and not (len(ends) and ends[-1] == want[-1] and np.array_equal(ends[at], want)):
            cut(own[: len(own) // 2])
            cut(own[len(own) // 2 :])
            return
        found.append(ids)
        counts.append(np.diff(at, prepend=-1) if len(own) > 1 else np.array([len(ids)]))

    for own in [*(joined[low : low + TOGETHER] for low in range(0, len(joined), TOGETHER)), *([i] for i in alone)]:
        cut(own)
    return joined + alone, np.concatenate(found), np.concatenate(counts)


class Known:
    """What was learned of parts, in some bytes at most: end to end in a few arrays, as objects of their own would take several
    times that. When they are full, the rarer half of the parts is forgotten."""

    def __init__(self, learn: Callable[[list[bytes]], pa.LargeBinaryArray], most: int):
        self.learn, self.most = learn, most
        self.parts = self.told = pa.array([], pa.large_binary())
        self.uses = np.empty(0, np.uint32)
        self.hashes, self.number = np.empty(0, np.uint64), np.empty(0, np.int32)  # in the order of hashes

    @property
    def held(self) -> int:
        return self.parts.nbytes + self.told.nbytes + self.uses.nbytes + self.hashes.nbytes + self.number.nbytes

    def of(self, parts: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """What is known of each of some distinct parts."""
        own = _hashes(parts)
        number = np.full(len(parts), -1, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
            met = np.flatnonzero(self.hashes[at] == own)
            at = self.number[at[met]]
            same = pc.equal(self.parts.take(pa.array(at)), parts.take(pa.array(met))).to_numpy(zero_copy_only=False)
            number[met[same]] = at[same]
            self.uses[at[same]] += np.uint32(1)
        missed = np.flatnonzero(number < 0)
        if len(missed):
            number[missed] = len(self.parts) + np.arange(len(missed))
            self._hold(new := parts.take(pa.array(missed)), self.learn(new.to_pylist()), np.zeros(len(missed), np.uint32), own[missed])
        found = self.told.take(pa.array(number))
        while self.held > self.most:
            self._shed()
        return found

    def _hold(self, parts: pa.LargeBinaryArray, told: pa.LargeBinaryArray, uses: np.ndarray, own: np.ndarray) -> None:
        order = np.argsort(own)
        own, number = np.append(self.hashes, own[order]), np.append(self.number, (len(self.parts) + order).astype(np.int32))
        order = np.argsort(own, kind="stable")  # two runs in order
        self.hashes, self.number = own[order], number[order]
        self.parts, self.told = pa.concat_arrays([self.parts, parts]), pa.concat_arrays([self.told, told])
        self.uses = np.append(self.uses, uses)

    def _shed(self) -> None:
        keep = self.uses > np.median(self.uses)
        kept = keep[self.number]
        self.hashes, self.number = self.hashes[kept], (np.cumsum(keep, dtype=np.int32) - 1)[self.number[kept]]
        self.parts, self.told = self.parts.filter(pa.array(keep)), self.told.filter(pa.array(keep))
        self.uses = self.uses[keep] // np.uint32(2)
