"""What must hold of a pipeline's layers: rows, keys, days, expected counts and business days, in one report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.time import business_date


@dataclass(frozen=True)
class Layer:
    """A stored table. day: its partition column, if it has one; whole: its days up to the report's count together (facts), else
    the report's day alone (snapshots and marts). current: which rows are one a key. ts: the instant that its day follows from.
    expected: the rows that it must have."""

    name: str
    path: str
    keys: tuple[str, ...]
    day: str | None = None
    whole: bool = False
    current: str | None = None
    ts: str | None = None
    expected: int | None = None


def footer_counts(spark: SparkSession, path: str, day: str | None) -> DataFrame:
    """Rows by day from the files' footers alone: the count is pushed into the scan, which reads no column. Its session is of
    its own, as only the newer reader of files can do so."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", True)
    rows = session.read.parquet(path)
    return rows.groupBy(day).agg(F.count("*").alias("n")) if day else rows.agg(F.count("*").alias("n"))


def layer_report(spark: SparkSession, layers: Sequence[Layer], as_of: dt.date) -> DataFrame:
    """One row a layer: rows, distinct_keys, repeated_keys, newest_day, has_day, diverging, expected, status.

    Rows and days come from footers and the listing of partitions, one figure a day; keys are read in their own columns. Of
    a layer with current, keys are those of its current rows, none of which may repeat. diverging counts rows whose day is not
    the business day of ts. status is OK, or what is wrong: NO_DAY, COUNT, REPEATED, DIVERGING, in this order.
    """
    told = None
    for layer in layers:
        counts = footer_counts(spark, layer.path, layer.day).collect()
        if layer.day:
            upto = {r[layer.day]: r["n"] for r in counts if r[layer.day] is not None and r[layer.day] <= as_of}
            newest, has_day = max((r[layer.day] for r in counts if r[layer.day] is not None), default=None), as_of in upto
            rows = sum(upto.values()) if layer.whole else upto.get(as_of, 0)
        else:
            newest, has_day, rows = None, None, counts[0]["n"]
        table = spark.read.parquet(layer.path)
        if layer.day:
            table = table.where(F.col(layer.day) <= F.lit(as_of)) if layer.whole else table.where(F.col(layer.day) == F.lit(as_of))
        current = table.where(layer.current) if layer.current else table
        keys = current.groupBy(*layer.keys).agg(F.count("*").alias("n")).agg(F.count("*").alias("distinct_keys"), F.count_if(F.col("n") > 1).alias("repeated_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("current_rows"))
        apart = table.agg(F.count_if(business_date(F.col(layer.ts)) != F.col(layer.day)).alias("diverging")) if layer.ts and layer.day else spark.range(1).select(F.lit(None).cast("bigint").alias("diverging"))
        own = keys.crossJoin(apart).select(  # one row each
            F.lit(layer.name).alias("layer"), F.lit(rows).cast("bigint").alias("rows"), "distinct_keys", "repeated_keys", F.lit(newest).cast("date").alias("newest_day"), F.lit(has_day).cast("boolean").alias("has_day"), "diverging",
            F.lit(layer.expected).cast("bigint").alias("expected"), F.lit(not layer.whole or bool(layer.current)).alias("_one_a_key"), F.when(F.lit(bool(layer.current)), F.col("current_rows")).otherwise(F.lit(rows)).alias("_counted"),
        )
        told = own if told is None else told.unionByName(own)
    status = (
        F.when(~F.coalesce("has_day", F.lit(True)), "NO_DAY").when(F.col("expected") != F.col("_counted"), "COUNT").when(F.col("_one_a_key") & (F.col("repeated_keys") > 0), "REPEATED").when(F.col("diverging") > 0, "DIVERGING").otherwise("OK")
    )
    return told.select("layer", "rows", "distinct_keys", "repeated_keys", "newest_day", "has_day", "diverging", "expected", status.alias("status"))
