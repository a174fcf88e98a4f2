"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Every input partition learns from the matrix how many of its rows go to every destination, permutes its rows locally, and
sends them; every destination then permutes what it received. A destination is a slice of one shard, so that no task holds
a whole shard. The counts are multivariate hypergeometric with exact margins, so each permutation of all rows is as likely
as any other. The matrix is never built whole: a partition draws its own row of it by walking down a binary tree of
partitions, whose nodes' seeds and sizes all tasks agree on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import durable, plain_names


def capacities(total: int, parts: int) -> np.ndarray:
    """total in parts whole numbers at most one apart, the larger first."""
    return total // parts + (np.arange(parts) < total % parts)


def split_draw(rng: np.random.Generator, room: np.ndarray, rows: int) -> np.ndarray:
    """How many of rows items fall to each destination with so much room: a multivariate hypergeometric draw."""
    out, left, need = np.zeros(len(room), np.int64), int(room.sum()), int(rows)
    for i, r in enumerate(room.tolist()):
        if need == 0:
            break
        left -= r
        out[i] = _hypergeometric(rng, r, left, need)
        need -= int(out[i])
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One exact draw. numpy takes populations below 10^9 only; larger ones are drawn by inversion around the mode.

    The chances of neighbouring counts have a rational ratio, so running products to both sides of the mode give all of
    them, up to a factor; ten standard deviations away they are below what a double can add to one.
    """
    if good == 0 or draws == 0:
        return 0
    if bad == 0:
        return draws
    n = good + bad
    if n < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(draws, good)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (n + 2)))
    reach = int(10 * (draws / n * (1 - draws / n) * good / n * bad) ** 0.5) + 60
    above = np.arange(mode, min(high, mode + reach), dtype=float)  # from x to x + 1
    below = np.arange(mode, max(low, mode - reach), -1, dtype=float)  # from x to x - 1
    rise = np.cumprod((good - above) * (draws - above) / ((above + 1) * (bad - draws + above + 1)))
    fall = np.cumprod(below * (bad - draws + below) / ((good - below + 1) * (draws - below + 1)))
    sums = np.cumsum(np.concatenate([fall[::-1], [1.0], rise]))
    return int(mode - len(fall) + min(len(sums) - 1, np.searchsorted(sums, rng.random() * sums[-1], "right")))


def matrix_row(counts: np.ndarray, room: np.ndarray, which: int, seed: int) -> np.ndarray:
    """Row which of the communication matrix: the rows of that partition that go to each destination."""
    low, high, room = 0, len(counts), room.astype(np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left = split_draw(np.random.default_rng([seed, low, high]), room, int(counts[low:middle].sum()))
        low, high, room = (low, middle, left) if which < middle else (middle, high, room - left)
    return room


def hypergeometric_shuffle(df: DataFrame, shards: int, seed: int = 1, rows_a_slice: int | None = None) -> DataFrame:
    """All rows and columns of df with shard (0 to shards - 1; counts at most one apart) and slot (gapless from 0 in it).

    Columns of df may have any names; those called shard or slot are replaced. Rows are placed whatever they hold: nulls,
    ties and repeated rows are rows like others. An empty table gives an empty result. A slice has about rows_a_slice rows,
    by default 20 times the root of the row count (4,096 at least), so that both its rows and the number of slices grow with
    the root of the input. Reruns over the same partitions agree; a lost executor's rows are redone from the durable copy,
    with the same draws.
    """
    spare = df.drop("shard", "slot")
    rows = durable(plain_names(spare, spare.columns)[0])
    counted = {r[0]: r[1] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    counts = np.zeros(max(counted, default=-1) + 1, np.int64)
    for p, n in counted.items():
        counts[p] = n
    total = int(counts.sum())
    slices = max(1, -(-total // shards // (rows_a_slice or max(4096, int(20 * total**0.5)))))
    room = np.concatenate([capacities(n, slices) for n in capacities(total, shards).tolist()])
    starts = [int(x) for s in room.reshape(shards, slices) for x in np.cumsum(s) - s]
    names = rows.columns

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        p = TaskContext.get().partitionId()
        to = None
        at = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if to is None:  # the local permutation: destinations in random order for the rows as they come
                to = np.repeat(np.arange(len(room), dtype=np.int32), matrix_row(counts, room, p, seed))
                np.random.default_rng([seed, p]).shuffle(to)
            n = batch.num_rows
            extra = [pa.array(to[at : at + n]), pa.array((np.int64(p) << np.int64(40)) + np.arange(at, at + n))]
            at += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*names, "to", "row"])

    schema = T.StructType([*rows.schema.fields, T.StructField("to", T.IntegerType()), T.StructField("row", T.LongType())])
    sent = rows.mapInArrow(send, schema)
    first = F.element_at(F.array(*map(F.lit, starts)), F.col("to") + 1) if len(starts) <= 64 else None
    again = Window.partitionBy("to").orderBy(F.xxhash64("row", F.lit(seed)), "row")
    placed = sent.withColumn("rank", F.row_number().over(again) - 1)
    if first is None:  # as many rows as slices, of which there are few: they grow with the root of the input
        known = df.sparkSession.createDataFrame(list(enumerate(starts)), "to int, first long")
        placed, first = placed.join(F.broadcast(known), "to"), F.col("first")
    placed = placed.select(*names, (F.floor(F.col("to") / F.lit(slices))).cast("int").alias("shard"), (first + F.col("rank")).cast("long").alias("slot"))
    return placed.toDF(*spare.columns, "shard", "slot")
