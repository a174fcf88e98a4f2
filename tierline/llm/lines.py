"""Line dedup by a segment-partition edit join.

A line splits into threshold + 1 segments; a line within the threshold has at least one of them whole, at a place that its
own and both lines' lengths bound. So every line sends the hash of its segments, and of the substrings of its own that may
be a segment of an equally long or shorter line, to buckets; lines that meet no other line there have no neighbour. Only the
others are sent in full, compared key by key, in tiles, and verified by banded bit-parallel edit distance. Equal lines are
found before that, by a hash of the whole line, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import NO_ID, durable, give_back, let_go, lookup, partitions_for, plain_names
from tierline.llm.places import BY_DOCUMENT, PACKED, PLACE, gather, later, packed_batch, resolve, send, several
from tierline.llm.words import U, blocks, mix

#: Bytes of text handled at once; hashes that one bucket takes; bytes of lines that one task compares.
BLOCK, BUCKET, SHOWN = 1 << 20, 1_000_000, 16 << 20
#: Lines and bytes of a tile, and bits of a line's bitmap of 3-grams.
TILE, TILE_BYTES, BITS = 1024, 4 << 20, 1024
GRAM = 3


def _alike(a: str, b: str, step: int) -> int:
    """How many code points a and b begin (step 1) or end (step -1) with alike."""
    if step < 0:
        a, b = a[::-1], b[::-1]
    most, n = min(len(a), len(b)), 0
    while n < most and a[n : n + 64] == b[n : n + 64]:
        n += 64
    n = min(n, most)
    while n < most and a[n] == b[n]:
        n += 1
    return n


def _least(plus: int, minus: int, score: int, wide: int) -> int:
    """The least value of a column of the band, from its lowest cell and the vertical differences."""
    out = score
    for at in range(wide - 2, -1, -1):
        score -= (plus >> at & 1) - (minus >> at & 1)
        out = min(out, score)
    return out


def within(a: str, b: str, threshold: int) -> bool:
    """Whether the edit distance of a and b is at most threshold, by a bit-parallel band of 2 * threshold + 1 diagonals.

    The band slides one row down a column: bit i of the vectors belongs to diagonal i - threshold. A match keeps a column's
    value on its diagonal; vertical differences of +1 and -1 are carried as two bit vectors (Hyyro's form of Myers' method).
    """
    if abs(len(a) - len(b)) > threshold:
        return False
    n = _alike(a, b, 1)
    a, b = a[n:], b[n:]
    n = _alike(a, b, -1)
    a, b = a[: len(a) - n], b[: len(b) - n]
    if not a or not b:
        return max(len(a), len(b)) <= threshold
    if len(a) < len(b):  # a has the rows, b the columns
        a, b = b, a
    wide = 2 * threshold + 1
    mask, top = (1 << wide) - 1, 1 << (wide - 1)
    # Column 0: row r costs r, so vertical differences are +1 below row 0; rows above the table count as level with it. The
    # tracked cell moves down the band's lowest diagonal, from row threshold.
    plus, minus, score = mask ^ ((1 << threshold) - 1), 0, threshold
    for j, c in enumerate(b):
        equal = 0
        for i in range(wide):
            row = j - threshold + i
            if 0 <= row < len(a) and a[row] == c:
                equal |= 1 << i
        zero = ((((equal & plus) + plus) ^ plus) | equal | minus) & mask
        up, down = (minus | ~(zero | plus)) & mask, zero & plus
        if not zero & top:
            score += 1
        shifted = zero >> 1
        plus, minus = (down | ~(shifted | up)) & mask, up & shifted
        if j % 8 == 7 and _least(plus, minus, score, wide) > threshold:  # it never falls from column to column
            return False
    # score is now the cell at row len(b) + threshold of the last column; walk up the band to row len(a).
    row = len(b) + threshold
    at = wide - 2
    while row > len(a):
        score -= (plus >> at & 1) - (minus >> at & 1)
        row, at = row - 1, at - 1
    return score <= threshold


def _split(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All lines of the texts, each line's text, and its place in it."""
    each = [x.split(b"\n") for x in texts]
    counts = np.fromiter(map(len, each), np.int64, len(each))
    of = np.repeat(np.arange(len(each)), counts)
    return [line for lines in each for line in lines], of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def _placed(batch: pa.RecordBatch, texts: np.ndarray, ats: np.ndarray) -> np.ndarray:
    out = np.empty(len(texts), PLACE)
    out["doc"], out["twin"] = (batch.column(i).to_numpy()[texts] for i in (0, 1))
    out["at"] = ats
    return out


def _code_points(lines: list[bytes]) -> np.ndarray:
    """Bytes that do not continue a character, by line."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = np.cumsum(sizes)
    starts = (np.frombuffer(b"".join(lines), np.uint8) & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(starts)])
    return before[ends] - before[ends - sizes]


def _whole(least: int, buckets: int):
    """Lines by a hash of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text", BLOCK):
            lines, of, at = _split(texts)
            use = np.flatnonzero(_code_points(lines) >= least)
            if len(use):
                keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(lines[i]) for i in use.tolist()), np.uint64).reshape(-1, 2)
                yield packed_batch(send(keys, _placed(batch, of[use], at[use]), buckets, False))

    return run


def edits(size, threshold: int, per: int):
    """How many edits a line of so many code points may differ by: one for each `per` of them, threshold at most."""
    return np.minimum(threshold, size // per)


def segment_keys(lines: list[str], threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their line's number. Two lines within the threshold share a key.

    A line of fewer than 2 * threshold + 1 code points has segments without any; it, and the lines that may be near it, have
    what is left without up to threshold of their code points as keys instead: lines within the threshold share one of those.
    """
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    begins = np.cumsum(sizes) - sizes
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    powers, unpowers = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + U(1)) * powers[: len(codes)], out=sums[1:])
    keys, owners = [], []
    pieces = threshold + 1
    for shorter in range(threshold + 1):
        length = sizes - shorter
        short, extra = length // pieces, length % pieces
        for i in range(pieces):
            size = short + (i >= pieces - extra)
            start = i * short + np.maximum(0, i - (pieces - extra))
            low = np.maximum(np.maximum(0, start - i), start + shorter - (threshold - i))
            high = np.minimum(np.minimum(sizes - size, start + i), start + shorter + (threshold - i))
            for step in range(2 * threshold + 1):
                at = low + step
                ok = np.flatnonzero((at <= high) & (size > 0))
                if not len(ok):
                    continue
                x = begins[ok] + at[ok]
                value = (sums[x + size[ok]] - sums[x]) * unpowers[x]
                keys.append(mix(mix(value + U(i)) ^ length[ok].astype(np.uint64)))
                owners.append(ok)
    for k in np.flatnonzero(sizes <= 3 * threshold).tolist():
        left = {"".join(x) for n in range(threshold + 1) for x in combinations(lines[k], max(0, len(lines[k]) - n))}
        keys.append(np.frombuffer(b"".join(xxhash.xxh3_64_digest(x.encode()) for x in left), np.uint64))
        owners.append(np.full(len(left), k))
    return np.concatenate(keys or [np.empty(0, np.uint64)]), np.concatenate(owners or [np.empty(0, np.int64)])


#: The base of a line's hash, odd so that it has an inverse.
_BASE = 0x9E3779B97F4A7C15
_TABLES = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(count: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, count at least. They are kept for the next block, as long as blocks are of usual size."""
    if len(_TABLES[0]) >= count:
        return _TABLES
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        out = np.full(count, base, np.uint64)
        out[0] = 1
        tables.append(np.multiply.accumulate(out))
    if count <= 2 * BLOCK:
        _TABLES[:] = tables
    return tables


def _gone(marks: list[bytes] | None) -> np.ndarray:
    return np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in marks])) if marks else np.empty(0, np.int32)


def _segments(least: int, threshold: int, per: int, buckets: int):
    """Keys of the lines that are the first of their kind and long enough to be near another that is not equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text", BLOCK):
            lines, of, at = _split(texts)
            use = _code_points(lines) >= max(least, per)
            starts = np.searchsorted(of, np.arange(len(texts)))
            for i, marks in enumerate(batch.column(3).to_pylist()):
                use[starts[i] + _gone(marks)] = False
            every = np.flatnonzero(use)
            for own in np.array_split(every, -(-len(every) // 4096) or 1):  # a few lines at a time: each has many keys
                keys, owners = segment_keys([lines[i].decode() for i in own.tolist()], threshold)
                if len(keys):
                    # One line's equal keys are one: they say nothing of other lines.
                    order = np.lexsort((keys, owners))
                    keys, owners = keys[order], owners[order]
                    new = np.r_[True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])]
                    keys, owners = keys[new], own[owners[new]]
                    yield packed_batch(send(keys[:, None], _placed(batch, of[owners], at[owners]), buckets, True, True))

    return run


def _attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, twin, text, tasks) to one row a task, with its line; rows that repeat the one before are the same document."""
    names = ["key", "doc", "twin", "at", "size", "line"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    last, rows, held = None, [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            doc, twin, text, tasks = (batch.column(c)[i].as_py() for c in range(4))
            if (doc, twin, text) != last:
                last = doc, twin, text
                lines = text.split("\n")
                for t in tasks:
                    line = lines[t["at"]]
                    rows.append((t["key"], doc, twin, t["at"], len(line.encode()), line))
                    held += 100 + rows[-1][4]
                    if held > TILE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    give_back()


def grams(line: str) -> np.ndarray:
    """A bitmap of the line's 3-grams. An edit takes away and adds at most three, so lines within t edits differ in 6 t bits."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    value = codes[:-2] * U(0x9E3779B1) + codes[1:-1] * U(0x85EBCA77C2B2AE63) + codes[2:] * U(0xC2B2AE3D27D4EB4F)
    out = np.zeros(BITS, np.uint8)
    out[(mix(value) >> U(20)) % U(BITS)] = 1
    return np.packbits(out).view(np.uint64)


def _neighbours(threshold: int, per: int):
    """Rows (key, tile, side, doc, twin, at, line), sorted by key and tile: the lines that have an earlier one near them.

    One tile is in memory at a time. A line that is known to have an earlier neighbour is not looked at again.
    """

    def near_of(tile: list[tuple], found: set[tuple[int, int, int]]) -> None:
        lines = [r[6] for r in tile]
        sizes = np.fromiter(map(len, lines), np.int64, len(tile))
        places = [(r[3], r[5], r[4]) for r in tile]
        rank = np.empty(len(tile), np.int64)
        rank[sorted(range(len(tile)), key=places.__getitem__)] = np.arange(len(tile))
        side = np.fromiter((r[2] for r in tile), np.int64, len(tile))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for own, earlier in _candidates(lines, sizes, rank, left, right if len(right) else left, threshold):
            if places[own] in found:
                continue
            for other in earlier.tolist():
                if places[other] != places[own] and within(lines[other], lines[own], int(edits(min(sizes[other], sizes[own]), threshold, per))):
                    found.add(places[own])
                    break

    def told(found: set[tuple[int, int, int]]) -> pa.RecordBatch:
        docs, ats, twins = (list(c) for c in zip(*sorted(found), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(twins, pa.int64()), pa.array(ats, pa.int32())], names=["doc", "twin", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for low in range(0, batch.num_rows, 256) for row in zip(*[c.to_pylist() for c in batch.slice(low, 256).columns], strict=True))
        found: set[tuple[int, int, int]] = set()
        for _, group in groupby(rows, key=lambda r: (r[0], r[1])):
            tile = list(group)
            if len(tile) > 1:
                near_of(tile, found)
            if len(found) > 50_000:
                yield told(found)
                found = set()
        if found:
            yield told(found)
        give_back()

    return run


def _candidates(lines: list[str], sizes: np.ndarray, rank: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: int) -> Iterator[tuple[int, np.ndarray]]:
    """Lines of either side, each with the earlier ones of the other side (or of its own) that may be near it.

    Near lines have near lengths and bitmaps that differ in few bits. Work is in proportion to lines, and only the bitmaps are
    compared pair by pair: of many lines near one another, each needs one that is earlier.
    """
    same = left is right
    if len(left) * len(right) <= 64:
        for a, b in [(left, right)] if same else [(left, right), (right, left)]:
            for p in a.tolist():
                earlier = b[(rank[b] < rank[p]) & (np.abs(sizes[b] - sizes[p]) <= threshold)]
                if len(earlier):
                    yield p, earlier
        return
    maps_b = np.stack([grams(lines[k]) for k in right.tolist()])
    maps_a = maps_b if same else np.stack([grams(lines[k]) for k in left.tolist()])
    for low in range(0, len(left), 128):
        own = left[low : low + 128]
        differ = np.zeros((len(own), len(right)), np.int32)
        for word in range(BITS // 64):
            differ += np.bitwise_count(maps_a[low : low + 128, word, None] ^ maps_b[None, :, word])
        near = (differ <= 2 * GRAM * threshold) & (np.abs(sizes[own, None] - sizes[None, right]) <= threshold)
        after = rank[own, None] > rank[None, right]
        for n in np.flatnonzero((near & after).any(axis=1)).tolist():
            yield int(own[n]), right[near[n] & after[n]]
        if not same:
            for n in np.flatnonzero((near & ~after).any(axis=0)).tolist():
                yield int(right[n]), own[near[:, n] & ~after[:, n]]


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, twin, text, marks, carried columns) to doc, n_lines, n_removed, kept_text and the carried columns."""
    for batch, texts in blocks(batches, "text", BLOCK):
        rows = []
        for text, marks in zip(texts, batch.column(3).to_pylist(), strict=True):
            gone = set(_gone(marks).tolist())
            kept = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone) if gone else text
            rows.append((text.count(b"\n") + 1, len(gone), kept.decode()))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *batch.columns[4:]], names=["doc", "n_lines", "n_removed", "kept_text", *batch.schema.names[4:]])


def dedup_lines(docs: DataFrame, threshold: int = 2, least: int = 1, per: int = 10, text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of docs: key, n_lines, n_removed, kept_text, and the columns named in carry.

    Lines are what newlines part. A line is removed if an earlier line, in a row with a smaller key or before it in the same
    row, is near it; so of each line the first stays. Near are equal lines of any length, and lines within threshold edits
    (insert, delete or replace a code point), of which the shorter one has at least `per` code points for each edit: words
    of a few letters that differ in one are different lines. Lines of fewer than least code points always stay and count for
    no other line; by default these are the empty ones. A null key is the smallest; rows that share a key are ordered by line
    number, then by a hash of the text; rows that repeat both are one document, treated alike. A null text is one empty line,
    and becomes empty. An empty table gives an empty result. Columns of docs that are not named are not read and may have any
    names; of those in carry, one that is called like a column of the result's own gives way to it.
    """
    spark = docs.sparkSession
    text_and = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    carry = tuple(c for c in carry if c not in (key, "n_lines", "n_removed", "kept_text"))
    extra, name_of = plain_names(docs, [key, text, *carry])
    size = docs.agg(F.sum(F.octet_length(text_and) - F.octet_length(F.replace(text_and, F.lit("\n"), F.lit(""))) + 1).alias("lines"), F.sum(F.octet_length(text_and)).alias("bytes")).first()
    # A line has at most its length in bytes of positions, and about 20 keys.
    buckets = partitions_for(spark, size["lines"] or 0, BUCKET)
    more = partitions_for(spark, 20 * min(size["lines"] or 0, (size["bytes"] or 0) / per), BUCKET)
    held = [name_of[c] for c in carry]
    body = F.coalesce(F.col(name_of[text]), F.lit(""))
    rows = extra.select(F.coalesce(F.col(name_of[key]), F.lit(NO_ID)).cast("long").alias("doc"), F.xxhash64(body).alias("twin"), body.alias("text"), *held)

    def marked(found: DataFrame, *columns: str) -> DataFrame:
        gathered = found.groupBy("doc", "twin").agg(F.collect_list("ats").alias("marks"))
        return rows.join(gathered, ["doc", "twin"], "left").select("doc", "twin", "text", "marks", *columns)

    whole = rows.select("doc", "twin", "text").mapInArrow(_whole(least, buckets), PACKED)
    dealt = whole.repartition(buckets, "bucket").mapInArrow(resolve(2, later, buckets), PACKED).repartition(buckets, "bucket")
    again = durable(dealt.mapInArrow(gather, BY_DOCUMENT))
    sent = marked(again).mapInArrow(_segments(least, threshold, per, more), PACKED)
    met = sent.repartition(more, "bucket").mapInArrow(resolve(1, several), "key long, doc long, twin long, at int")
    by_doc = met.groupBy("doc", "twin").agg(F.collect_list(F.struct("key", "at")).alias("tasks"))
    shown = durable(rows.join(by_doc, ["doc", "twin"]).select("doc", "twin", "text", "tasks").mapInArrow(_attach, "key long, doc long, twin long, at int, size long, line string"))
    let_go(spark)
    total = shown.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    groups = durable(shown.groupBy("key").agg(F.count("*").alias("lines"), F.sum("size").alias("bytes")).where("lines > 1"), total["n"] // 2)
    tiles = F.greatest(F.ceil(F.col("lines") / F.lit(TILE)), F.ceil(F.col("bytes") / F.lit(TILE_BYTES))).cast("int")
    own = F.pmod(F.xxhash64("doc", "twin", "at"), tiles).cast("int")
    tile = F.transform(F.sequence(F.lit(0), tiles - 1), lambda o: F.struct(F.xxhash64(F.least("own", o), F.greatest("own", o)).alias("tile"), (F.col("own") > o).cast("int").alias("side")))
    tasks = lookup(shown, groups, ["key"], "lines", total["n"]).withColumn("own", own).select("key", F.explode(tile).alias("t"), "doc", "twin", "at", "line")
    parts = max(partitions_for(spark, total["n"], 50_000), partitions_for(spark, total["bytes"] or 0, SHOWN))
    dealt = tasks.select("key", "t.tile", "t.side", "doc", "twin", "at", "line").repartition(parts, "key", "tile").sortWithinPartitions("key", "tile", "side", "doc", "at", "twin")
    near = dealt.mapInArrow(_neighbours(threshold, per), "doc long, twin long, at int").distinct()
    as_bytes = F.unhex(F.concat(*[F.lpad(F.hex(F.pmod(F.shiftright("at", 8 * i), F.lit(256))), 2, "0") for i in range(4)]))
    found = again.unionByName(near.select("doc", "twin", as_bytes.alias("ats")))
    kinds = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in held)
    kept = marked(found, *held).mapInArrow(_keep, "doc long, n_lines long, n_removed long, kept_text string" + kinds)
    return kept.select(F.nullif(F.col("doc"), F.lit(NO_ID)).alias(key), "n_lines", "n_removed", "kept_text", *[F.col(name_of[c]).alias(c) for c in carry])
