"""Hard negatives by cover trees: for each anchor and positive, the rows of other labels that score nearly as high.

Rows are dealt to cells around centres of a bounded sample, large cells by chance to several blocks, and each block becomes a
cover tree (covertree.py), one row of a durable table. An anchor is sent to the blocks of the cells whose bounds meet what it
asks for; what a block finds, its first few rows of each window, is merged by anchor and window. The first pass finds the
positives and the second the negatives, in the windows that the positives' scores set. The sample also gives each window a
score that so many rows reach at least, so that blocks can leave out what lies below it. All figures are exact; the sample,
cells and blocks only decide what need not be read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import durable, give_back, partitions_for
from tierline.llm.covertree import CoverTree, Queries, angles, augmented, bounds, search

#: Rows of the sample that gives cells and floors; cells; rows of a block; and anchors that meet a block in one task, at most.
SAMPLE, CELLS, BLOCK, TOGETHER = 4096, 1024, 65_536, 65_536
#: Positives of an anchor, and negatives of a positive.
FIRST = 5
_NO_ID = np.iinfo(np.int64).max
_ROWS = "row long, id long, label long, v binary"


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which lists take part, and floor(256 x) of their components, short lists filled up with 0."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(sizes)), sizes)
    sound = lists.is_valid().to_numpy(zero_copy_only=False)
    sound[of[~np.isfinite(flat)]] = False
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore", invalid="ignore"):
        out[of, at] = np.floor(256 * flat)
    return sound, out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = rows = anchors = 0
    longest = peak = 0.0
    for batch in batches:
        sound, x = _matrix(batch.column(0))
        sound &= batch.column(1).to_numpy(zero_copy_only=False)
        x = x[sound]
        size, rows, anchors = max(size, x.shape[1]), rows + len(x), anchors + int(batch.column(2).to_numpy(zero_copy_only=False)[sound].sum())
        peak, longest = max(peak, float(np.abs(x).max(initial=0))), max(longest, float((x * x).sum(axis=1).max(initial=0)))
    yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (size, rows, anchors, longest, peak)], names=["size", "rows", "anchors", "longest", "peak"])


def _quantise(size: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sound, x = _matrix(batch.column(2))
            own = batch.filter(pa.array(sound))
            wide = np.zeros((own.num_rows, size), kind)
            wide[:, : x.shape[1]] = x[sound]
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array([v.tobytes() for v in wide], pa.binary())], names=["id", "label", "v"])

    return run


def _vectors(column: pa.ChunkedArray | pa.Array, kind: str, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), size)


def _whole(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return pc.fill_null(column, _NO_ID).to_numpy() if isinstance(column, pa.ChunkedArray) else pc.fill_null(column, _NO_ID).to_numpy(zero_copy_only=False)


class _Plan:
    """What every task is told: form and bounds of the vectors, the sample's tree, and the cells' centres, radii and blocks."""

    def __init__(self, kind: str, size: int, longest: float):
        self.kind, self.size, self.longest = kind, size, longest
        self.sample: CoverTree | None = None
        self.centres = np.empty((0, size + 1))
        self.radii = np.empty(0)
        self.blocks: list[tuple[int, int]] = []  # of each cell: its first, and how many

    def cell(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty(len(vectors), np.int64)
        for i in range(0, len(vectors), 1024):
            out[i : i + 1024] = angles(augmented(vectors[i : i + 1024], self.longest), self.centres).argmin(axis=1)
        return out


def _cells(plan: _Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = plan.cell(_vectors(batch.column(3), plan.kind, plan.size))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return run


def _plant(plan: _Plan):
    """A block's cover tree, around the centre of its cell."""

    def run(rows: pa.Table) -> pa.Table:
        cell = rows["cell"][0].as_py()
        tree = CoverTree.build(_vectors(rows["v"], plan.kind, plan.size), _whole(rows["id"]), rows["label"].to_numpy(), rows["row"].to_numpy(), plan.longest, plan.centres[cell])
        out = pa.table({"block": [rows["block"][0].as_py()], "cell": [cell], "radius": [float(tree.radii[0])], "tree": pa.array([pickle.dumps(tree)], pa.binary())})
        give_back()
        return out

    return run


def _asked(part: pa.RecordBatch | pa.Table, plan: _Plan, same: bool) -> Queries:
    """Queries of rows (row, id, label, v, low, high): all rows of their label, or those of other labels in their windows."""
    vectors, n = _vectors(part.column(3), plan.kind, plan.size).astype(float), part.num_rows
    low = np.frombuffer(b"".join(part.column(4).to_pylist()), "<f8").reshape(n, -1)
    high = np.frombuffer(b"".join(part.column(5).to_pylist()), "<f8").reshape(n, -1)
    return Queries(vectors, part.column(0).to_numpy(), part.column(2).to_numpy(), low, high, same)


def _route(plan: _Plan, same: bool, parts: int):
    """Each query with its floors raised by the sample, once for each block of the cells that may hold what it asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                own = batch.slice(at, 512)
                asked = _asked(own, plan, same)
                found = search(plan.sample, asked, FIRST)
                low = asked.low.copy()
                slot = found.query * low.shape[1] + found.window
                full = np.bincount(slot, minlength=low.size).reshape(low.shape) == FIRST
                least = np.full(low.size, np.inf)
                np.minimum.at(least, slot, found.score)
                low[full] = np.maximum(low, least.reshape(low.shape))[full]
                below, above = bounds(asked.vectors, plan.longest, plan.centres, plan.radii)
                open_ = np.zeros(below.shape, bool)
                for w in range(low.shape[1]):
                    open_ |= (above >= low[:, w, None]) & (below <= asked.high[:, w, None])
                q, c = np.nonzero(open_ & (plan.radii >= 0))
                first, count = np.array(plan.blocks)[c].T
                q, block = np.repeat(q, count), np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                floors = pa.array([x.tobytes() for x in low], pa.binary())
                for i in range(0, len(q), 4096):
                    rows = own.take(pa.array(q[i : i + 4096]))
                    part = pc.bit_wise_and(rows.column(0), 0x7FFFFFFF).to_numpy(zero_copy_only=False) % parts
                    columns = [rows.column(n) if n != 4 else floors.take(pa.array(q[i : i + 4096])) for n in range(rows.num_columns)]
                    yield pa.RecordBatch.from_arrays([pa.array(block[i : i + 4096]), pa.array(part.astype(np.int64)), *columns], names=["block", "part", *rows.schema.names])
        give_back()

    return run


def _ask(plan: _Plan, same: bool):
    """The first rows of each window that one block has for the queries sent to it."""

    def run(trees: pa.Table, asked: pa.Table) -> pa.Table:
        out = {n: pa.array([], pa.int64()) for n in ("row", "id", "slot", "found", "score", "found_row")}
        if trees.num_rows and asked.num_rows:
            tree = pickle.loads(trees["tree"][0].as_py())
            asked = asked.select(["row", "id", "label", "v", "low", "high"])
            got = search(tree, _asked(asked, plan, same), FIRST)
            ids = tree.ids[got.place]
            asker = pa.array(got.query)
            out = {
                "row": asked["row"].take(asker), "id": asked["id"].take(asker), "slot": pa.array(got.window), "found": pa.array(ids, mask=ids == _NO_ID),
                "score": pa.array(got.score), "found_row": pa.array(tree.rows[got.place]),
            }
            give_back()
        return pa.table(out)

    return run


def _first_of_each(queries: DataFrame, trees: DataFrame, plan: _Plan, same: bool, parts: int) -> DataFrame:
    """row, id, slot, found, score, found_row and rank (from 1): the first rows of each query's windows."""
    routed = queries.mapInArrow(_route(plan, same, parts), "block long, part long, row long, id long, label long, v binary, low binary, high binary")
    dealt = trees.select("block", "tree", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    found = dealt.groupBy("block", "part").cogroup(routed.groupBy("block", "part")).applyInArrow(_ask(plan, same), "row long, id long, slot long, found long, score long, found_row long")
    by = Window.partitionBy("row", "slot").orderBy(F.desc("score"), F.asc_nulls_last("found"), "found_row")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= FIRST)


def hard_negatives(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", anchors: int = 100, least: int = 80, most: int = 100, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components count as floor(256 x). Anchors are the rows whose key `anchors` divides; an anchor's positives are the first 5
    other rows of its label, and a positive's negatives the first 5 rows of other labels whose score is from least to most
    percent of the positive's; first by falling inner product with the anchor, then by key (null last), then by row. Rows
    with a null label or vector, or a component that is null or not finite, take no part. Short vectors end in zeros. Rows that
    repeat are rows like others: each repeat of an anchor is an anchor and a positive of the rest. A positive whose window is
    empty (a negative score) has no rows. Inner products beyond 64 bits count as the largest number of 64 bits. An empty table
    gives an empty result; other columns are not read, whatever their names.

    On the driver are at most SAMPLE rows and CELLS centres.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    ids, x = F.col(f"`{key}`").cast("long"), F.col(f"`{vector}`").cast("array<double>")
    told = vectors.select(x.alias("x"), F.col(f"`{label}`").isNotNull().alias("labelled"), F.coalesce(F.pmod(ids, F.lit(anchors)) == 0, F.lit(False)).alias("asks")).mapInArrow(_measure, "size long, rows long, anchors long, longest double, peak double")
    size, total, asking, longest, peak = told.agg(F.max("size"), F.sum("rows"), F.sum("anchors"), F.max("longest"), F.max("peak")).first()
    if not asking:
        return spark.createDataFrame([], schema)
    plan = _Plan("<i2" if peak <= 32_767 else "<f8", size, longest)
    labelled = vectors.where(F.col(f"`{label}`").isNotNull()).select(ids.alias("id"), F.col(f"`{label}`").cast("long").alias("label"), x.alias("x"))
    rows = durable(labelled.mapInArrow(_quantise(size, plan.kind), "id long, label long, v binary")).select(F.monotonically_increasing_id().alias("row"), "id", "label", "v")

    sample = rows.where(F.pmod(F.xxhash64("row"), F.lit(max(1, total // SAMPLE))) == 0).limit(SAMPLE).toArrow() if total > SAMPLE else rows.limit(SAMPLE).toArrow()
    sample = sample if sample.num_rows else rows.limit(SAMPLE).toArrow()
    tree_of = lambda leaf: CoverTree.build(_vectors(sample["v"], plan.kind, size), _whole(sample["id"]), sample["label"].to_numpy(), sample["row"].to_numpy(), longest, leaf=leaf)
    plan.sample = tree_of(256)
    block = max(min(block, -(-total // spark.sparkContext.defaultParallelism)), 1)
    wanted = min(CELLS, -(-total // block))
    around = tree_of(-(-sample.num_rows // wanted))
    plan.centres = around.centres[around.leaves[:, 0]][:CELLS]

    dealt = durable(rows.mapInArrow(_cells(plan), f"{_ROWS}, cell long"))
    counts = dict(dealt.groupBy("cell").count().collect())
    done = 0
    for c in range(len(plan.centres)):
        plan.blocks.append((done, -(-counts.get(c, 0) // block)))
        done += plan.blocks[-1][1]
    known = F.broadcast(spark.createDataFrame([(c, f, n) for c, (f, n) in enumerate(plan.blocks)], "cell long, first long, blocks long"))
    of_block = dealt.join(known, "cell").withColumn("block", F.col("first") + F.pmod(F.xxhash64("row"), F.col("blocks"))).select("row", "id", "label", "v", "cell", "block")
    trees = durable(of_block.groupBy("block").applyInArrow(_plant(plan), "block long, cell long, radius double, tree binary"))
    radii = dict(trees.groupBy("cell").agg(F.max("radius")).collect())
    plan.radii = np.array([radii.get(c, -1.0) for c in range(len(plan.centres))])

    parts = partitions_for(spark, asking, TOGETHER) if asking > TOGETHER else 1
    number = lambda *x: F.lit(np.array(x, "<f8").tobytes())
    askers = rows.where(F.pmod("id", F.lit(anchors)) == 0)
    positives = durable(_first_of_each(askers.withColumns({"low": number(-np.inf), "high": number(np.inf)}), trees, plan, True, parts))
    by_anchor = positives.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("had"))  # 5 at most
    windows = askers.join(by_anchor, "row").mapInArrow(_windows(least, most), f"{_ROWS}, low binary, high binary")
    found = _first_of_each(windows, trees, plan, False, parts)
    of = positives.select("row", (F.col("rank") - 1).cast("long").alias("slot"), F.col("id").alias("anchor_id"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.select("row", "slot", "rank", F.col("found").alias("negative_id"), F.col("score").alias("negative_score")).join(of, ["row", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _windows(least: int, most: int):
    """Queries of the second pass: one window a positive, from least to most percent of its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for had in batch.column(4).to_pylist():
                scores = [x["score"] for x in had]
                room = FIRST - len(scores)
                low.append(np.array([-(-least * s // 100) for s in scores] + [np.inf] * room, "<f8").tobytes())
                high.append(np.array([most * s // 100 for s in scores] + [-np.inf] * room, "<f8").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(low, pa.binary()), pa.array(high, pa.binary())], names=["row", "id", "label", "v", "low", "high"])

    return run
