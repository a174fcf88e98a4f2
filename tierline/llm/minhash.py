"""Near duplicates: MinHash signatures, banding, verification on full sets, connected components.

1. Documents with equal shingle sets are one class (equal in size and in two independent sums of 64 bits over the set);
   only its least document goes on.
2. Bands of minima of universal hashes put documents into buckets. Each bucket links its documents to its least one; these
   links, as many as documents, are confirmed on the full sets, and components are made of them.
3. A bucket whose documents are then not all in one component may hold more links. Its documents outside its largest
   component are compared with all of it, in tiles, by bitmaps of their sets: two bitmaps differ in no more bits than the
   sets in elements, so this drops no link. The few pairs that pass are confirmed on the full sets and join components.

So a group of near copies costs in proportion to its size once its copies are linked; only documents that share a bucket and
are not alike are compared pair by pair, and no rows are made of pairs that the bitmaps rule out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import durable, give_back, let_go, lookup, partitions_for
from tierline.llm.components import components
from tierline.llm.words import U, Words, blocks, mix, runs

#: Bytes of text handled at once, and documents of a tile.
BLOCK, TILE = 1 << 20, 1024
#: Chance that no band of two documents just alike enough agrees.
MISS = 1e-6
ROWS = 5


def bands_for(percent: int, rows: int = ROWS) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))


def shingles(words: Words, size: int) -> list[np.ndarray]:
    """Each text's set of hashes of its runs of size words; a shorter text has its whole sequence as one."""
    all_runs = runs(words.hashes, size)
    short = {n: runs(words.hashes, n, salt=n << 50) for n in set(words.counts[words.counts < size].tolist()) - {0}}
    out = []
    for first, count in zip(words.first[:-1].tolist(), words.counts.tolist(), strict=True):
        if count >= size:
            out.append(np.unique(all_runs[first : first + count - size + 1]))
        else:
            out.append(short[count][first : first + 1] if count else np.empty(0, np.uint64))
    return out


def _features(size: int, bands: int, rows: int):
    rng = np.random.default_rng(20)
    factors = (rng.integers(0, 2**63, bands * rows, np.uint64) << U(1)) | U(1)
    terms = rng.integers(0, 2**63, bands * rows, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text", BLOCK):
            sets = shingles(Words(texts, lower=True), size)
            counts = np.array([len(s) for s in sets])
            full = np.flatnonzero(counts)
            keys = np.zeros((len(sets), bands), np.uint64)
            prints = np.zeros((len(sets), 2), np.uint64)
            if len(full):
                every = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
                for i, x in enumerate((mix(every ^ U(0xA5A5)), mix(every + U(0x5A5A)))):
                    prints[full, i] = np.add.reduceat(x, starts)
                room = np.empty_like(every)
                for band in range(bands):
                    key = np.full(len(full), band + 1, np.uint64)
                    for j in range(band * rows, band * rows + rows):
                        np.multiply(every, factors[j], out=room)
                        np.add(room, terms[j], out=room)
                        key = mix(key ^ np.minimum.reduceat(room, starts))
                    keys[full, band] = key
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(prints[:, 0].view(np.int64)), pa.array(prints[:, 1].view(np.int64)), lists], names=["id", "n", "f1", "f2", "bands"])

    return run, "id long, n long, f1 long, f2 long, bands array<long>"


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "text", BLOCK):
            sets = shingles(Words(texts, lower=True), size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "elements"])

    return run, "id long, elements binary"


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        give_back()

    return run


def bitmap(elements: np.ndarray) -> np.ndarray:
    """A power of two of bits, about 8 an element: bit i is set if an element hashes to i."""
    bits = min(max(1024, 1 << int(8 * len(elements)).bit_length()), 1 << 17)
    out = np.zeros(bits, np.uint8)
    out[(elements >> U(7)) % U(bits)] = 1
    return np.packbits(out).view(np.uint64)


def _fold(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of one length, the least: longer ones are folded, which keeps bits that differ a lower bound."""
    least = min(map(len, maps))
    return np.stack([np.bitwise_or.reduce(m.reshape(-1, least), axis=0) if len(m) > least else m for m in maps])


def alike(maps_a: list[np.ndarray], maps_b: list[np.ndarray], sizes_a: np.ndarray, sizes_b: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs that may be percent alike: bits that differ are no more than elements that may. Sizes must rise."""
    t = percent / 100
    step = 64
    for low in range(0, len(sizes_a), step):
        own = slice(low, min(low + step, len(sizes_a)))
        begin = np.searchsorted(sizes_b, np.floor(sizes_a[own.start] * t))
        end = np.searchsorted(sizes_b, np.ceil(sizes_a[own.stop - 1] / t), "right")
        for at in range(begin, end, 256):
            other = slice(at, min(at + 256, end))
            folded = _fold(maps_a[own] + maps_b[other])
            x, y = folded[: own.stop - own.start], folded[own.stop - own.start :]
            differ = np.zeros((len(x), len(y)), np.int32)
            for word in range(x.shape[1]):
                differ += np.bitwise_count(x[:, word, None] ^ y[None, :, word])
            total = sizes_a[own][:, None] + sizes_b[other][None, :]
            for i, j in np.argwhere(differ <= (1 - t) / (1 + t) * total + 1e-6).tolist():
                yield low + i, at + j


def _compare(percent: int):
    """Tiles of one comparison each: rows (key, tile, side, id, component, n, map); pairs that may be links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_batches = [b for b in batches if b.num_rows]
        if not own_batches:
            return
        table = pa.Table.from_batches(own_batches).combine_chunks()
        key, tile, side, ident, component, n = (table.column(i).to_numpy() for i in range(6))
        maps = table.column(6)
        order = np.lexsort((ident, n, side, tile, key))
        edges = np.flatnonzero(np.r_[True, (key[order][1:] != key[order][:-1]) | (tile[order][1:] != tile[order][:-1]), True])
        a: list[int] = []
        b: list[int] = []
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            own = order[i:j]
            if component[own].min() == component[own].max():
                continue
            left, right = own[side[own] == 0], own[side[own] == 1]
            if not len(right):  # a tile against itself
                right = left
            x, y = ([np.frombuffer(maps[k].as_buffer(), np.uint64) for k in rows.tolist()] for rows in (left, right))
            for p, q in alike(x, y, n[left], n[right], percent):
                p, q = left[p], right[q]
                if component[p] != component[q]:
                    a.append(min(ident[p], ident[q]))
                    b.append(max(ident[p], ident[q]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        give_back()

    return run


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [bitmap(np.frombuffer(x, np.uint64)).tobytes() for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(maps, pa.binary())], names=["id", "map"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of pairs whose full sets are percent alike. A set in very many pairs is a skewed join, which Spark splits."""
    x = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    joined = pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y")
    return joined.mapInArrow(_confirm(percent), "a long, b long")


def _open_tiles(members: DataFrame, comps: DataFrame, total: int) -> DataFrame:
    """Tiles to compare of the buckets whose members are in several components: (key, tile, side, id, component, n)."""
    rows = durable(members.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id")))
    by = rows.groupBy("key", "component").agg(F.count("*").alias("k"))
    buckets = by.groupBy("key").agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.max("k").alias("inside"), F.sum("k").alias("all"), F.count("*").alias("several"))
    buckets = durable(buckets.where("several > 1").drop("several"), total)
    told = lookup(rows.select("key", "id", "component", "n"), buckets, ["key"], "all", rows.count())
    n_in = F.ceil(F.col("inside") / F.lit(TILE)).cast("int")
    n_out = F.ceil((F.col("all") - F.col("inside")) / F.lit(TILE)).cast("int")
    main = F.col("component") == F.col("main")
    own = F.pmod(F.xxhash64("id", F.lit(3)), F.when(main, n_in).otherwise(n_out)).cast("int")
    told = told.select("key", "id", "component", "n", main.alias("inside"), n_in.alias("n_in"), n_out.alias("n_out"), own.alias("own"))
    # An outsider meets each tile of the main component (o x m) and each tile of outsiders (O: o x o, once a pair of tiles).
    tile = lambda kind, i, j: F.concat(F.lit(kind), i.cast("string"), F.lit("."), j.cast("string"))
    count = lambda n: F.sequence(F.lit(0), n - 1)
    pick = lambda t, s: F.struct(t.alias("tile"), s.cast("int").alias("side"))
    inside = F.transform(count(F.col("n_out")), lambda o: pick(tile("m", o, F.col("own")), F.lit(1)))
    outside = F.concat(
        F.transform(count(F.col("n_in")), lambda m: pick(tile("m", F.col("own"), m), F.lit(0))),
        F.transform(count(F.col("n_out")), lambda o: pick(tile("o", F.least("own", o), F.greatest("own", o)), (F.col("own") > o).cast("int"))),
    )
    return told.select("key", "id", "component", "n", F.explode(F.when(F.col("inside"), inside).otherwise(outside)).alias("t")).select("key", F.xxhash64("t.tile").alias("tile"), "t.side", "id", "component", "n")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each row of docs: key, n_shingles, component_id, kept.

    Words are lower-cased (A-Z only). A document's set has its distinct runs of shingle words; with fewer words, the whole
    sequence as one; with none, or a null text, nothing, and it is linked with nothing. Two documents are linked if 100 times
    the intersection of their sets is at least percent times the union; component_id is the least key reachable and kept
    says that it is the document's own. A null key is linked with nothing and kept, its component_id null. Rows that share a
    key are one document with several texts. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    run, schema = _features(shingle, bands_for(percent), ROWS)
    features = durable(rows.mapInArrow(run, schema))
    total = features.count()
    linked = features.where("n > 0 AND id IS NOT NULL")
    same = ["n", "f1", "f2"]
    classes = durable(linked.groupBy(*same).agg(F.min("id").alias("id"), F.count("*").alias("size")), total)
    firsts = linked.join(classes.select("id", *same), ["id", *same], "left_semi")
    members = firsts.select(F.explode("bands").alias("key"), "id", "n")
    buckets = durable(members.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("size")).where("size > 1"), total)
    filled = durable(members.join(buckets.drop("size"), "key"))  # a skewed join, which Spark splits
    stars = filled.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    run, schema = _sets(shingle)
    sets = durable(rows.join(filled.select("id").distinct(), "id", "left_semi").mapInArrow(run, schema))
    links = durable(confirmed(stars, sets, percent))
    let_go(spark)
    comps = components(links)
    tiles = _open_tiles(filled.select("key", "id", "n"), comps, total)
    maps = sets.mapInArrow(_maps, "id long, map binary")
    tasks = partitions_for(spark, tiles.count(), 20_000)
    shown = tiles.join(maps, "id").select("key", "tile", "side", "id", "component", "n", "map").repartition(tasks, "key", "tile")
    more = durable(confirmed(shown.mapInArrow(_compare(percent), "a long, b long").distinct(), sets, percent))
    comps = components(links.unionByName(more))
    known = classes.join(comps, "id", "left").select(*same, F.coalesce("component", "id").alias("component"), "size")
    found = lookup(linked.drop("bands"), durable(known, total), same, "size", total)
    alone = features.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component"))
    out = found.select("id", "n", "component").unionByName(alone)
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
