"""Which hashes repeat across a corpus, and where: packed arrays of keys and places, dealt to buckets by key.

A block of texts sends each key once, with its first place; a key that the block has itself seen several times needs no
other block to be known as repeated, so a key that a third of all documents have sends one entry a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from tierline.llm.common import NO_ID, give_back
from tierline.llm.words import U, mix

#: twin tells texts of one doc apart: 64 bits of a hash of the text.
PLACE = np.dtype([("doc", "<i8"), ("twin", "<i8"), ("at", "<i4")])
PACKED = "bucket int, known boolean, keys binary, places binary"
BY_DOCUMENT = "doc long, twin long, ats binary"


def _planes(x: np.ndarray) -> bytes:
    """Values byte by byte: all lowest bytes, then all second ones, so that compression sees that the high ones are alike."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T).tobytes()


def _of_planes(data: bytes, kind: str, count: int, at: int) -> tuple[np.ndarray, int]:
    size = np.dtype(kind).itemsize
    x = np.ascontiguousarray(np.frombuffer(data, np.uint8, size * count, at).reshape(size, count).T).view(kind).ravel()
    return x, at + size * count


def _pack(bucket: int, known: bool, keys: np.ndarray, places: np.ndarray) -> tuple:
    """Places must be sorted by document: each document is told once, with the number of its places."""
    new = np.ones(len(places), bool)
    new[1:] = (places["doc"][1:] != places["doc"][:-1]) | (places["twin"][1:] != places["twin"][:-1])
    edges = np.flatnonzero(new)
    counts = np.diff(np.append(edges, len(places))).astype("<i4")
    head = np.array([len(edges)], "<i8").tobytes()
    return bucket, known, _pack_keys(keys), b"".join((head, _planes(places["doc"][edges]), _planes(places["twin"][edges]), _planes(counts), _planes(places["at"])))


def _pack_keys(keys: np.ndarray) -> bytes:
    """The first word of each key, and the low half of the second if there is one: 64 or 96 bits a key."""
    if keys.ndim == 1 or keys.shape[1] == 1:
        return keys.tobytes()
    return np.ascontiguousarray(keys[:, 0]).tobytes() + keys[:, 1].astype(np.uint32).tobytes()


def _unpack_keys(data: bytes, width: int) -> np.ndarray:
    if width == 1:
        return np.frombuffer(data, np.uint64).reshape(-1, 1)
    n = len(data) // 12
    return np.stack([np.frombuffer(data, np.uint64, n), np.frombuffer(data, np.uint32, n, 8 * n).astype(np.uint64)], axis=1)


def _unpack(data: bytes) -> np.ndarray:
    docs = int(np.frombuffer(data, "<i8", 1)[0])
    at = 8
    doc, at = _of_planes(data, "<i8", docs, at)
    twin, at = _of_planes(data, "<i8", docs, at)
    counts, at = _of_planes(data, "<i4", docs, at)
    out = np.empty(int(counts.sum()), PLACE)
    out["doc"], out["twin"] = np.repeat(doc, counts), np.repeat(twin, counts)
    out["at"] = _of_planes(data, "<i4", len(out), at)[0]
    return out


def packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "known", "keys", "places"])


def _distinct(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by key and place, each pair once: rows that repeat both doc and text have the same places, and are no repeats."""
    order = np.lexsort((places["twin"], places["at"], places["doc"], *keys.T[::-1]))
    keys, places = keys[order], places[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    for f in PLACE.names:
        new[1:] |= places[f][1:] != places[f][:-1]
    return (keys, places) if new.all() else (keys[new], places[new])


def _dealt(places: np.ndarray) -> np.ndarray:
    """A number a place by its text, so that texts without a doc, or of one doc, spread like others."""
    return mix(places["doc"].astype(np.uint64) ^ mix(places["twin"].astype(np.uint64)))


def send(keys: np.ndarray, places: np.ndarray, buckets: int, all_repeat: bool, with_keys: bool = False) -> list[tuple]:
    """Rows for the buckets. keys: uint64, of shape (n, 1), or (n, 2), of which the second counts by its low half only.

    Of equal keys the first place goes to the key's bucket. The others are already known to repeat, and so is the first if
    all_repeat; places known to repeat go to any bucket, which only hands them on. The key of a known first place still goes
    to its bucket, with doc NO_ID and at -1.
    """
    if keys.shape[1] == 2:
        keys = np.stack([keys[:, 0], keys[:, 1] & U(0xFFFFFFFF)], axis=1)
    keys, places = _distinct(keys, places)
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    firsts = places[new].copy()
    known, known_keys = places[~new], keys[~new]
    if all_repeat:
        twice = np.diff(np.append(np.flatnonzero(new), len(keys))) > 1
        known, known_keys = np.concatenate([known, firsts[twice]]), np.concatenate([known_keys, keys[new][twice]])
        firsts["doc"][twice], firsts["twin"][twice], firsts["at"][twice] = NO_ID, 0, -1
    out = []
    keys = keys[new]
    to = (keys[:, 0] >> U(20)) % U(buckets)
    order = np.lexsort((firsts["at"], firsts["twin"], firsts["doc"], to))
    keys, firsts, to = keys[order], firsts[order], to[order]
    edges = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
    out += [_pack(b, False, keys[i:j], firsts[i:j]) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if i < j]
    if len(known):
        order = np.lexsort((known["at"], known["twin"], known["doc"]))
        anywhere = int(_dealt(known[:1])[0] % U(buckets))
        out.append(_pack(anywhere, True, known_keys[order] if with_keys else keys[:0], known[order]))
    return out


def _met(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which entries can say anything of another: their key's first word is there again, or marked as known to repeat.

    Most keys are alone, so what follows sorts few entries by all their columns.
    """
    first = np.ascontiguousarray(keys[:, 0])
    order = np.argsort(first)
    same = np.zeros(len(first), bool)
    equal = first[order[1:]] == first[order[:-1]]
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    return same | (places["at"] < 0)


def resolve(width: int, judge: Callable[[np.ndarray, np.ndarray], np.ndarray], by_doc: int = 0):
    """In each bucket: which of the places repeat. One row a place, with its key; or, if by_doc, packed for as many buckets
    by document, whose rows gather() makes one a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, places, known_places = [], [], []
        for batch in batches:
            for at in range(batch.num_rows):
                known, k, p = (batch.column(i)[at].as_py() for i in (1, 2, 3))
                if known and not by_doc:
                    yield from _by_key(np.frombuffer(k, np.uint64), _unpack(p))
                elif known:
                    known_places.append(_unpack(p))
                else:
                    keys.append(_unpack_keys(k, width))
                    places.append(_unpack(p))
        if keys:
            k, p = np.concatenate(keys), np.concatenate(places)
            del keys, places
            use = _met(k, p)
            k, p = _distinct(k[use], p[use])
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]).any(axis=1)
            found = judge(new, p)
            if by_doc:
                known_places.append(p[found])
            else:
                yield from _by_key(k[found, 0], p[found])
            del k, p
        if known_places:
            found = np.concatenate(known_places)
            known_places.clear()
            to = _dealt(found) % U(by_doc)
            order = np.lexsort((found["at"], found["twin"], found["doc"], to))
            found, to = found[order], to[order]
            edges = np.searchsorted(to, np.arange(by_doc + 1, dtype=np.uint64))
            rows = [_pack(b, True, np.empty(0, np.uint64), found[i:j]) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if i < j]
            if rows:
                yield packed_batch(rows)
        give_back()

    return run


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document: doc, twin, ats (32-bit)."""
    found = [_unpack(p) for batch in batches for p in batch.column(3).to_pylist()]
    if found:
        yield from _by_document(np.concatenate(found))
    give_back()


def several(new: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Anchors: all places of a key that has several, or whose block had several."""
    edges = np.append(np.flatnonzero(new), len(new))
    count = np.diff(edges)
    seen = np.add.reduceat((places["at"] < 0).astype(np.int64), edges[:-1]) > 0 if len(new) else count > 0
    return np.repeat((count > 1) | seen, count) & (places["at"] >= 0)


def later(new: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Windows: all places but the first of each key. Places of a key are distinct."""
    return ~new


def _by_key(keys: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(keys), 10_000):
        own = slice(low, low + 10_000)
        columns = [np.ascontiguousarray(keys[own]).view(np.int64), *(np.ascontiguousarray(places[f][own]) for f in PLACE.names)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", *PLACE.names])


def _by_document(places: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(places):
        return
    places = np.sort(places)
    new = np.ones(len(places), bool)
    new[1:] = (places["doc"][1:] != places["doc"][:-1]) | (places["twin"][1:] != places["twin"][:-1])
    edges = np.append(np.flatnonzero(new), len(places))
    ats = np.ascontiguousarray(places["at"])
    for low in range(0, len(edges) - 1, 10_000):
        own = edges[low : low + 10_001]
        lists = [ats[i:j].tobytes() for i, j in zip(own[:-1], own[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(places["doc"][own[:-1]]), pa.array(places["twin"][own[:-1]]), pa.array(lists, pa.binary())], names=["doc", "twin", "ats"])
