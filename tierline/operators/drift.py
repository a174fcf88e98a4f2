"""Drift of a feature between two tables: PSI, Kolmogorov-Smirnov, shift of the mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.operators.ranking import quantiles, slices_for
from tierline.sources.shared import durable

#: Added to each bin's share, and the limits of a drift (fixed values).
EPSILON, PSI_LIMIT, KS_LIMIT, SHIFT_LIMIT = 1e-4, 0.2, 0.1, 0.1


def breakpoints(baseline: DataFrame, column: str, bins: int = 10) -> list[float]:
    """Inner quantiles of the baseline, exact, without repeats: a few numbers, whatever the table's size."""
    at = [i / bins for i in range(1, bins)]
    return sorted({q for q in quantiles(baseline, column, at) if q is not None})


def bin_counts(df: DataFrame, column: str, points: list[float]) -> DataFrame:
    which = F.lit(0)
    for p in points:
        which = which + F.when(F.col(column).cast("double") > F.lit(p), 1).otherwise(0)
    return df.where(F.col(column).isNotNull()).groupBy(which.alias("bin")).agg(F.count("*").alias("n"))


def psi(baseline: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """One row: psi, over the baseline's quantile bins."""
    points = breakpoints(baseline, column, bins)
    spark = baseline.sparkSession
    every = spark.range(len(points) + 1).select(F.col("id").cast("int").alias("bin"))
    a, b = (bin_counts(df, column, points).withColumnRenamed("n", n) for df, n in ((baseline, "a"), (current, "b")))
    joined = every.join(F.broadcast(a), "bin", "left").join(F.broadcast(b), "bin", "left").na.fill(0)
    totals = joined.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    p, q = F.col("a") / F.col("ta") + EPSILON, F.col("b") / F.col("tb") + EPSILON
    return joined.crossJoin(F.broadcast(totals)).agg(F.sum((q - p) * F.log(q / p)).alias("psi"))


def ks(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """One row: ks, the largest distance of the two distributions. Prefix sums over range partitions: no task sorts all values."""
    tag = lambda df, a, b: df.where(F.col(column).isNotNull()).select(F.col(column).alias("v"), F.lit(a).alias("a"), F.lit(b).alias("b"))
    values = tag(baseline, 1, 0).unionByName(tag(current, 0, 1)).groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    values = durable(values)
    parts = values.repartitionByRange(slices_for(values.count()), "v").withColumn("_part", F.spark_partition_id())
    sums = parts.groupBy("_part").agg(F.sum("a").alias("pa"), F.sum("b").alias("pb"))
    upto = Window.orderBy("_part")
    before = sums.select("_part", (F.sum("pa").over(upto) - F.col("pa")).alias("ba"), (F.sum("pb").over(upto) - F.col("pb")).alias("bb"))
    totals = sums.agg(F.sum("pa").alias("ta"), F.sum("pb").alias("tb"))
    own = Window.partitionBy("_part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = parts.withColumns({"ra": F.sum("a").over(own), "rb": F.sum("b").over(own)}).join(F.broadcast(before), "_part").crossJoin(F.broadcast(totals))
    return run.agg(F.max(F.abs((F.col("ra") + F.col("ba")) / F.col("ta") - (F.col("rb") + F.col("bb")) / F.col("tb"))).alias("ks"))


def mean_shift(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """One row: the change of the mean in shares of the baseline's."""
    mean = lambda df, n: df.agg((F.sum(column).cast("double") / F.count(column)).alias(n))
    return mean(baseline, "a").crossJoin(mean(current, "b")).select((F.abs(F.col("b") - F.col("a")) / F.greatest(F.abs("a"), F.lit(1e-9))).alias("mean_shift"))


def drift(baseline: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """One row: feature, psi, ks, mean_shift, drifted."""
    row = psi(baseline, current, column).crossJoin(ks(baseline, current, column)).crossJoin(mean_shift(baseline, current, column))
    bad = (F.col("psi") > PSI_LIMIT) | (F.col("ks") > KS_LIMIT) | (F.col("mean_shift") > SHIFT_LIMIT)
    return row.select(F.lit(column).alias("feature"), "psi", "ks", "mean_shift", bad.alias("drifted"))
