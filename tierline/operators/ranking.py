"""Ranks over a whole table without one task that holds it."""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.sources.shared import durable


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rn", slices: int = 64) -> DataFrame:
    """df with name, 1 for the first row in order, and so on; order must be total, or ties fall either way.

    A range partitioning puts neighbouring rows together; row numbers in each partition are shifted by the rows before it,
    of which there is one figure a partition. Rows need be sorted only within partitions.
    """
    parts = df.repartitionByRange(slices, *order).withColumn("_part", F.spark_partition_id())
    counts = parts.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = counts.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"))
    local = parts.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return local.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_local")).drop("_part", "_local", "_before")


def split_points(df: DataFrame, order: Sequence[Column], slices: int, rows: int) -> list:
    """At most slices - 1 rows of order values that part df, of so many rows, about evenly, from a sample of bounded size.

    The sample is of rows, so a value that many rows share is as often in it; points that repeat are one, and such a value's
    rows are a slice of their own.
    """
    want = min(50 * slices, SAMPLE)
    keys = df.select(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]).alias("k"))
    some = keys if rows <= want else keys.sample(min(1.0, 1.2 * want / rows), seed=1)
    found = [r["k"] for r in some.limit(2 * want).orderBy("k").collect()]
    step = max(1, len(found) // slices)
    points = found[step::step][: slices - 1]
    return [p for n, p in enumerate(points) if not n or p != points[n - 1]]


def slice_of(key: Column, points: Sequence, kinds) -> Column:
    """How many of the sorted points are at or below key, by halving them."""
    if not points:
        return F.lit(0)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        fixed = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(points[middle], kinds.fields, strict=True)])
        return F.when(key >= fixed, between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(points))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rn", slices: int | None = None, of: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """As global_row_number, for ascending order columns, with partitions that do not depend on how a shuffle is redone.

    The slice of a row is the number of split points at or below it, so a rerun of any task puts each row where it was.
    Slices follow from the number of rows unless they are given. of is a table with the same values of the order columns
    that is cheaper to read twice than df, such as a durable copy of what df was made from; total is its number of rows.
    """
    of = df if of is None else of
    total = of.count() if total is None else total
    if (slices_for(total) if slices is None else slices) == 1:  # no more rows than one task sorts
        return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    points = split_points(of, order, slices_for(total) if slices is None else slices, total)
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    slice_ = slice_of(key, points, df.select(key.alias("k")).schema["k"].dataType)
    rows = df.withColumn("_slice", slice_)
    counts = of.groupBy(slice_.alias("_slice")).agg(F.count("*").alias("_rows"))
    before = counts.select("_slice", (F.sum("_rows").over(Window.orderBy("_slice")) - F.col("_rows")).alias("_before"))
    local = rows.withColumn("_local", F.row_number().over(Window.partitionBy("_slice").orderBy(*order)))
    return local.join(F.broadcast(before), "_slice").withColumn(name, F.col("_before") + F.col("_local")).drop("_slice", "_local", "_before")


def tile_of(rank: Column, rows: Column, tiles: int) -> Column:
    """The ntile of the rank-th of rows rows: the first rows % tiles tiles have one row more."""
    r, base = rank - 1, F.floor(rows / tiles)
    extra = rows % tiles
    wide = extra * (base + 1)
    return F.when(r < wide, F.floor(r / (base + 1)) + 1).otherwise(extra + F.floor((r - wide) / F.greatest(base, F.lit(1))) + 1).cast("int")


#: Rows of a slice, about; slices of a table, at most; and rows of the sample that parts it. A row is compared with log2(slices) points.
SLICE_ROWS, SLICES, SAMPLE = 250_000, 4096, 50_000


def slices_for(rows: int) -> int:
    return min(SLICES, max(1, -(-rows // SLICE_ROWS)))


def ntile(df: DataFrame, tiles: int, order: Sequence[Column], name: str, rows: int | None = None, of: DataFrame | None = None) -> DataFrame:
    """NTILE(tiles) OVER (ORDER BY order) on a table of any size; rows is its number of rows, counted if not given."""
    rows = (df if of is None else of).count() if rows is None else rows
    return ranked(df, order, "_rank", of=of, total=rows).withColumn(name, tile_of(F.col("_rank"), F.lit(rows), tiles)).drop("_rank")


def quantiles(df: DataFrame, column: str, at: Sequence[float]) -> list[float | None]:
    """Exact quantiles, between two values in proportion: the values at the wanted ranks, of which there are two each at most.

    Rows are first counted by value, so a value that a third of them have is one row. The values are parted in slices, whose
    counts are added up before them, and only slices that hold a wanted rank are sorted.
    """
    counts = durable(df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull()).groupBy("v").agg(F.count("*").alias("n")))
    distinct = counts.count()
    if not distinct:
        return [None] * len(at)
    key = F.struct(F.col("v").alias("k0"))
    points = split_points(counts, [F.col("v")], slices_for(distinct), distinct)
    sliced = counts.withColumn("_slice", slice_of(key, points, counts.select(key.alias("k")).schema["k"].dataType))
    sums = sorted(sliced.groupBy("_slice").agg(F.sum("n").alias("n")).collect())  # one row a slice
    ends = list(itertools.accumulate(n for _, n in sums))
    n = ends[-1]
    spots = [q * (n - 1) for q in at]
    wanted = sorted({int(s) + k for s in spots for k in (1, 2) if int(s) + k <= n})
    holding = {bisect.bisect_left(ends, w) for w in wanted}
    before = {sums[h][0]: ends[h] - sums[h][1] for h in holding}
    run = Window.partitionBy("_slice").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ahead = F.coalesce(*[F.when(F.col("_slice") == k, F.lit(b)) for k, b in before.items()])
    own = sliced.where(F.col("_slice").isin(*before)).withColumn("_upto", ahead + F.sum("n").over(run))
    held = F.filter(F.array(*map(F.lit, wanted)), lambda w: (w <= F.col("_upto")) & (w > F.col("_upto") - F.col("n")))
    found = {r["rank"]: r["v"] for r in own.select("v", F.explode(held).alias("rank")).collect()}
    return [found[int(s) + 1] + (s - int(s)) * (found.get(int(s) + 2, found[int(s) + 1]) - found[int(s) + 1]) for s in spots]


def discrete_quantiles(df: DataFrame, column: str, by: Sequence[str], parts: int) -> DataFrame:
    """by, q1 to q{parts - 1}: of each group, the exact least values that a part, two parts and so on of its rows do not exceed
    (PERCENTILE_DISC); nulls do not count, and a group without values has null.

    Rows are first counted by group and value. Groups and values are parted in slices, whose counts are added up before them in
    each group, and only slices that hold a wanted rank are sorted. Nothing passes through the driver but the slices' ends.
    """
    counts = durable(df.groupBy(*by, F.col(column).alias("_v")).agg(F.count(column).alias("_n")))
    distinct = counts.count()
    order = [F.col(c) for c in (*by, "_v")]
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    points = split_points(counts, order, slices_for(distinct), distinct)
    sliced = counts.withColumn("_slice", slice_of(key, points, counts.select(key.alias("k")).schema["k"].dataType))
    group = Window.partitionBy(*by)
    sums = sliced.groupBy(*by, "_slice").agg(F.sum("_n").alias("_rows"))
    ends = sums.withColumns({"_end": F.sum("_rows").over(group.orderBy("_slice")), "_all": F.sum("_rows").over(group)})
    ranks = [F.expr(f"(_all * {i} + {parts - 1}) div {parts}") for i in range(1, parts)]  # rounded up
    wanted = reduce(or_, [(r <= F.col("_end")) & (r > F.col("_end") - F.col("_rows")) for r in ranks], F.col("_all") == 0)
    s, h = sliced.alias("s"), ends.where(wanted).alias("h")
    on = reduce(and_, [F.col(f"s.{c}").eqNullSafe(F.col(f"h.{c}")) for c in by], F.col("s._slice") == F.col("h._slice"))
    run = Window.partitionBy("_slice", *by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    own = s.join(h, on).select("s.*", "h._end", "h._rows", "h._all").withColumn("_upto", F.col("_end") - F.col("_rows") + F.sum("_n").over(run))
    return own.groupBy(*by).agg(*[F.max(F.when((r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_n")), F.col("_v"))).alias(f"q{i + 1}") for i, r in enumerate(ranks)])


def last_two(df: DataFrame, key: str, order: Sequence[tuple[str, int]], *more: Column) -> DataFrame:
    """key, last and prior (structs of the order columns), and the aggregates in more: a key's last row and the one before it.

    order are whole numbers from 0, each with the decimal digits that it has at most, 38 together: a row becomes one decimal
    number, whose maximum is kept in place while rows stream by, where a window would sort them. Rows are dealt by key once;
    the last is the maximum, and the one before it the maximum of what is below, or the last again if two rows have it.
    prior is null for a key of one row; rows without a key are left out. An order column that is null or has more digits raises
    an error.
    """
    digits = sum(n for _, n in order)
    if digits > 38:
        raise ValueError(f"{digits} digits do not fit one number")
    parts = []
    for c, n in order:
        sound = F.col(c).between(F.lit(0), F.lit(min(10**n, 2**63) - 1))
        wrong = F.raise_error(F.concat(F.lit(f"{c} is no number of {n} digits: "), F.coalesce(F.col(c).cast("string"), F.lit("null"))))
        parts.append(F.when(sound, F.lpad(F.col(c).cast("string"), n, "0")).otherwise(wrong))
    rows = df.select(key, F.concat(*parts).cast("decimal(38,0)").alias("_row"), *[c for c in df.columns if c != key]).where(F.col(key).isNotNull()).repartition(key)
    first = rows.groupBy(key).agg(F.max("_row").alias("_last"), *more)
    rest = rows.select(key, "_row").join(first.select(key, "_last").hint("shuffle_hash"), key).groupBy(key).agg(F.max(F.when(F.col("_row") < F.col("_last"), F.col("_row"))).alias("_below"), F.count_if(F.col("_row") == F.col("_last")).alias("_top"))
    both = first.join(rest.hint("shuffle_hash"), key).withColumn("_prior", F.when(F.col("_top") > 1, F.col("_last")).otherwise(F.col("_below")))

    def unpacked(number: str) -> Column:
        parts, below = [], digits
        for c, n in order:
            below -= n
            parts.append(F.substring(F.lpad(F.col(number).cast("string"), digits, "0"), digits - below - n + 1, n).cast("long").alias(c))
        return F.when(F.col(number).isNotNull(), F.struct(*parts))

    names = [c for c in first.columns if c not in (key, "_last")]
    return both.select(key, unpacked("_last").alias("last"), unpacked("_prior").alias("prior"), *names)
