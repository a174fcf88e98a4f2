"""Two tokenizers aligned over whole documents: groups that end together, overlapping pairs, and how common each pair is.

Both tokenizers cut the same bytes, and both cut where parts of a text begin (`parts.py`), so a document is aligned part by part.
Words repeat, so parts do: a part is tokenized by both and aligned once, and remembered. A pair's count is the number of documents that hold it linked. Counts are summed in each task
and then by pair; the most common pairs, a bounded number of them, are sent to all tasks, and the rest are joined by pair.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import durable, give_back, plain_names
from tierline.llm.packing import TokenIds
from tierline.llm.parts import ids_of_parts, parted, parts_of
from tierline.llm.words import blocks

#: Bytes of text that are aligned at once, about; and pairs that a task holds before it counts them.
BLOCK_BYTES, PAIRS = 1 << 20, 1_000_000
#: Bytes, about, that a worker spends on remembering parts of texts.
REMEMBERED = 240 << 20
#: Pairs whose counts are sent to all tasks, at most: 12 bytes each.
COMMON = 1 << 20
_STORED = "row long, key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
_FACTS = ("row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


class ByteBpe(TokenIds):
    """Ids of a byte-level BPE file, where the strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True


class PieceBpe:
    """Ids of a sentence-piece model, which puts a space before the text itself; and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self.lead = self.model.encode_as_ids(".")
        self.direct = parted(self.bytes)

    def encode(self, part: bytes) -> np.ndarray:
        """Ids of a part. The model puts a space before it itself, but before nothing; a dot is, and is cut off, where it must not."""
        if part[:1] == b" " and len(part) > 1:
            return np.array(self.model.encode_as_ids(part[1:].decode()), "<u4")
        return np.array(self.model.encode_as_ids("." + part.decode())[len(self.lead) :], "<u4")


class _Growing:
    """Numbers that are added to in bulk."""

    def __init__(self):
        self.held, self.size = np.empty(1024, np.uint64), 0

    def __len__(self) -> int:
        return self.size

    def append_many(self, x: np.ndarray) -> None:
        if self.size + len(x) > len(self.held):
            self.held = np.concatenate([self.held[: self.size], np.empty(self.size + 2 * len(x), np.uint64)])
        self.held[self.size : self.size + len(x)] = x
        self.size += len(x)


def _in_order(doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """pair, doc and times by doc and pair; sorted as one number each where they fit in one."""
    p, t = int(pair.max()).bit_length(), int(times.max()).bit_length()
    if int(doc.max()).bit_length() + p + t > 63:
        order = np.lexsort((pair, doc))
        return pair[order], doc[order], times[order]
    one = np.sort((doc.astype(np.uint64) << np.uint64(p + t)) | (pair << np.uint64(t)) | times.astype(np.uint64))
    return one >> np.uint64(t) & np.uint64((1 << p) - 1), (one >> np.uint64(p + t)).astype(np.int64), (one & np.uint64((1 << t) - 1)).astype(np.int64)


class Aligner:
    """What a worker knows of a pair of tokenizers, and the parts that it has seen."""

    def __init__(self, a: ByteBpe, b: PieceBpe):
        self.sides = (a, b)
        self.sizes = [s.sizes for s in self.sides]
        self.direct = a.direct and b.direct
        self.names: list[bytes] = []  # each id with the marks that may stand behind it
        self.named: list[int] = []
        for side, marks in enumerate((b",|", b",;")):
            for mark in marks:
                self.named.append(len(self.names))
                self.names += [b"%d%c" % (i, mark) for i in range(len(self.sides[side].bytes))]
        self.forget()

    def forget(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.told: list[bytes] = []  # of each part: its groups as text, how many, how many ids of each side, and its links from first on
        self.n_a, self.n_b, self.n_groups, self.links, self.first = (_Growing() for _ in range(5))
        self.whole, self.uses = _Growing(), _Growing()  # whether both sides cut it whole; blocks that had it
        self.first.append_many(np.zeros(1, np.uint64))
        self.held = 0

    def _shed(self) -> None:
        """Forget the rarer half of the parts, or more."""
        n = len(self.told)
        keep = np.flatnonzero(self.uses.held[:n] > np.median(self.uses.held[:n]))
        names, told = list(self.seen), self.told  # in the order of their numbers
        from_, to = self.first.held[keep].astype(np.int64), self.first.held[keep + 1].astype(np.int64)
        size = to - from_
        links = self.links.held[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - from_, size)]
        old = [x.held[keep] for x in (self.n_a, self.n_b, self.n_groups, self.whole, self.uses)]
        self.forget()
        self._hold([names[i] for i in keep.tolist()], [told[i] for i in keep.tolist()], links, size, *old[:4])
        self.uses.held[: len(keep)] = old[4] // np.uint64(2)

    def _hold(self, parts: list[bytes], told: list[bytes], links: np.ndarray, size: np.ndarray, *numbers: np.ndarray) -> None:
        self.seen.update(zip(parts, range(len(self.told), len(self.told) + len(parts)), strict=True))
        self.told += told
        self.first.append_many((len(self.links) + np.cumsum(size)).astype(np.uint64))
        self.links.append_many(links)
        for held, x in zip((self.n_a, self.n_b, self.n_groups, self.whole), numbers, strict=True):
            held.append_many(x)
        self.uses.append_many(np.zeros(len(parts), np.uint64))
        self.held += 250 * len(parts) + sum(map(len, parts)) + sum(map(len, told)) + 8 * len(links)

    def _cut(self, parts: list[bytes]) -> tuple[list[int], np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """An order of parts; in it, whether both sides cut each whole; and, of those, each side's ids and their numbers."""
        ids, counts = [], []
        for s in self.sides:
            order, own, n = ids_of_parts(parts, s.encode, s.sizes)  # in the same order for both
            ids.append(own)
            counts.append(n)
        parts = [parts[i] for i in order]
        whole, text = np.ones(len(parts), bool), b"".join(parts)
        for s, own, n in zip(self.sides, ids, counts, strict=True):
            tokens = list(map(s.bytes.__getitem__, own.tolist()))
            if b"".join(tokens) != text:
                ends = np.cumsum(n).tolist()
                whole &= np.array([b"".join(tokens[i:j]) == p for p, i, j in zip(parts, [0, *ends[:-1]], ends, strict=True)])
        ids = [own[np.repeat(whole, n)] for own, n in zip(ids, counts, strict=True)]
        return order, whole, ids, [n[whole] for n in counts]

    def _learn(self, parts: list[bytes]) -> None:
        """Align parts that are new, all of them end to end: both sides of each have equally many bytes."""
        order, whole, ids, counts = self._cut(parts)
        other = [parts[i] for i, w in zip(order, whole.tolist(), strict=True) if not w]
        parts = [parts[i] for i, w in zip(order, whole.tolist(), strict=True) if w]
        if other:
            none = np.zeros(len(other), np.uint64)
            self._hold(other, [b""] * len(other), none[:0], none, none, none, none, none)
        if not parts:
            return
        ends = [np.cumsum(n[x]) for n, x in zip(self.sizes, ids, strict=True)]
        marks = np.zeros(int(ends[0][-1]) + 1, np.uint8)
        for side in (0, 1):
            marks[ends[side]] |= 1 << side
        every, shared = np.flatnonzero(marks), np.flatnonzero(marks == 3)
        last = ends[0][np.cumsum(counts[0]) - 1]  # where each part ends
        a, b = (x[np.searchsorted(e, every)] for x, e in zip(ids, ends, strict=True))  # from one end to the next, one token of each side: a link
        size = np.diff(np.searchsorted(every, last, "right"), prepend=0)
        links = a.astype(np.uint64) * np.uint64(len(self.sides[1].bytes)) + b
        n_groups = np.diff(np.searchsorted(shared, last, "right"), prepend=0)
        # A's tokens of a group and then B's, each with what stands behind it; each part without its last mark.
        group = np.concatenate([2 * np.searchsorted(shared, e) + side for side, e in enumerate(ends)])
        shown = np.concatenate([x + self.named[2 * side] + np.where(marks[e] == 3, self.named[2 * side + 1] - self.named[2 * side], 0) for side, (x, e) in enumerate(zip(ids, ends, strict=True))])
        names = [self.names[x] for x in shown[np.argsort(group, kind="stable")].tolist()]
        edges = np.append(0, np.cumsum(counts[0] + counts[1])).tolist()
        told = [b"".join(names[i:j])[:-1] for i, j in zip(edges[:-1], edges[1:], strict=True)]
        self._hold(parts, told, links, size, *(x.astype(np.uint64) for x in (*counts, n_groups, np.ones(len(parts)))))

    def align(self, texts: list[str]) -> list[tuple]:
        """n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs and how often each, for each text."""
        none = (0, 0, 0, 0, "", b"", b"")
        out, asked = [none] * len(texts), [i for i, x in enumerate(texts) if x]
        if not asked:
            return out
        parts, which, firsts = parts_of([b" " + texts[i].encode() for i in asked], self.direct)
        numbers = list(map(self.seen.get, parts))
        if None in numbers:
            self._learn([p for p, x in zip(parts, numbers, strict=True) if x is None])
            numbers = list(map(self.seen.__getitem__, parts))
        numbers = np.array(numbers)
        self.uses.held[numbers] += np.uint64(1)
        first, which = firsts[:-1], numbers[which]
        n_a, n_b, n_groups = (np.add.reduceat(x.held[which], first).astype(np.int64).tolist() for x in (self.n_a, self.n_b, self.n_groups))
        is_whole = np.minimum.reduceat(self.whole.held[which], first) == 1
        doc = np.repeat(np.arange(len(asked)), np.diff(firsts))
        own, times = np.unique((doc << 32 | which)[is_whole[doc]], return_counts=True)
        if not len(own):
            return out
        doc, number = own >> 32, own & 0xFFFFFFFF
        from_, to = self.first.held[number].astype(np.int64), self.first.held[number + 1].astype(np.int64)
        size = to - from_
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - from_, size)
        pair, doc, times = _in_order(np.repeat(doc, size), self.links.held[at], np.repeat(times, size))
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
        starts = np.flatnonzero(new)
        times, pair, doc = np.add.reduceat(times, starts), pair[starts], doc[starts]
        n_links = np.bincount(doc, times, len(asked)).astype(np.int64).tolist()
        cut = np.searchsorted(doc, np.arange(len(asked) + 1)).tolist()
        ends, which = firsts.tolist(), which.tolist()
        for n in np.flatnonzero(is_whole).tolist():
            told = hashlib.sha256(b";".join(map(self.told.__getitem__, which[ends[n] : ends[n + 1]]))).hexdigest()
            own = slice(cut[n], cut[n + 1])
            out[asked[n]] = (n_a[n], n_b[n], n_groups[n], n_links[n], told, pair[own].astype("<u8").tobytes(), times[own].astype("<u4").tobytes())
        if self.held > REMEMBERED:
            self._shed()
        return out


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One a worker: its tokenizers, and what they remember within their bounds, outlive a task."""
    return Aligner(ByteBpe(a_path), PieceBpe(b_path))


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
        for part, texts in blocks(batches, "text", BLOCK_BYTES):
            told = both.align([x.decode() for x in texts])
            columns = [pa.array(c, t) for c, t in zip(zip(*told, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=[*_FACTS, "pairs", "times"])
        give_back()

    return run


def _doc_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair and the number of this task's documents that hold it, now and then in between."""
    held: list[np.ndarray] = []
    size = 0

    def tell() -> pa.RecordBatch:
        pairs, docs = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(docs)], names=["pair", "docs"])

    for batch in batches:
        for x in batch.column(0).to_pylist():
            held.append(np.frombuffer(x, "<u8"))
            size += len(held[-1])
            if size > 4 * PAIRS:
                yield tell()
                held.clear()
                size = 0
    if size:
        yield tell()
    give_back()


def _score(common: pa.Table, pieces: int, with_rare: bool):
    """Each document's facts with the sums over its common pairs; or, with_rare, a row for each of its other pairs."""
    known = common["pair"].to_numpy()
    docs, best = common["docs"].to_numpy(), common["best"].to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [np.frombuffer(x, "<u8").view(np.int64) for x in batch.column(batch.num_columns - 2).to_pylist()]
            if not pairs:
                continue
            doc = np.repeat(np.arange(len(pairs)), [len(x) for x in pairs])
            pair, times = np.concatenate(pairs), np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            is_known = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            if with_rare:
                rare = ~is_known
                for i in range(0, int(rare.sum()), 10_000):
                    own = np.flatnonzero(rare)[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc[own])), pa.array(pair[own]), pa.array(times[own])], names=["row", "pair", "times"])
                continue
            doc, at, times = doc[is_known], at[is_known], times[is_known]
            sums = [np.zeros(len(pairs), np.int64) for _ in range(2)]
            np.add.at(sums[0], doc, np.where(best[at], times, 0) if len(known) else times)
            np.add.at(sums[1], doc, times * docs[at] if len(known) else times)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(_FACTS)], pa.array(sums[0]), pa.array(sums[1])], names=[*_FACTS, "n_best", "count_sum"])
        give_back()

    return run


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id", common: int = COMMON) -> tuple[DataFrame, DataFrame]:
    """Two tables. The documents: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; one row for each row of
    docs. The pairs: pair (A id times B's size plus B id), docs (documents that hold it linked), best (no pair of its A id
    has more).

    A is a byte-level BPE file and B a sentence-piece model; both cut a space and the text. A null or empty text, or one that
    does not come back whole from either, has no tokens: zeros and ''. Rows with null or equal keys, and rows that repeat, are
    documents like others; an empty table gives empty results; other columns are not read, whatever their names. The `common`
    pairs of the highest counts, at most, are sent to all tasks; all others are joined by pair, each held by fewer documents.
    """
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    rows, of = plain_names(docs, [key, text])
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(of[key]).cast("long").alias("key"), F.col(of[text]).alias("text"))
    stored = durable(rows.mapInArrow(_align(a_path, b_path), _STORED))
    counted = stored.select("pairs").mapInArrow(_doc_counts, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs"))
    counted = durable(counted.withColumn("a", F.floor(F.col("pair") / F.lit(pieces)).cast("int")))
    top = F.broadcast(counted.groupBy("a").agg(F.max("docs").alias("top")))  # a row for each A id: as many as A's vocabulary
    pairs = durable(counted.join(top, "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")))
    by_size = dict(pairs.groupBy(F.floor(F.log2("docs")).cast("int").alias("power")).count().collect())
    least, held = 64, 0
    while least > 0 and held + by_size.get(least - 1, 0) <= common:
        least -= 1
        held += by_size.get(least, 0)
    known = pairs.where(F.floor(F.log2("docs")).cast("int") >= least).orderBy("pair").toArrow()
    told = stored.mapInArrow(_score(known, pieces, False), "row long, key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    if held < sum(by_size.values()):
        rare = stored.select("row", "pairs", "times").mapInArrow(_score(known, pieces, True), "row long, pair long, times long")
        rare = rare.join(pairs, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
        told = told.join(rare, "row", "left")
        told = told.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return told.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), pairs
