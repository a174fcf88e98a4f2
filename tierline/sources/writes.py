"""Writes of layered tables: days overwritten, logs appended, schemas guarded, files laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.checks import is_safe

DAY_COLUMN = "cob_dt"


class SchemaBreak(ValueError):
    """A write would drop a column or change what one means."""


def plan_write(target: T.StructType, incoming: T.StructType) -> list[T.StructField]:
    """Columns to add to the target; SchemaBreak if the write lacks one or changes a type beyond a safe promotion."""
    have = {f.name: f.dataType for f in incoming}
    missing = [f.name for f in target if f.name not in have]
    changed = [f.name for f in target if f.name in have and have[f.name] != f.dataType and not is_safe(have[f.name], f.dataType)]
    if missing or changed:
        raise SchemaBreak(f"missing: {missing}, changed: {changed}")
    known = set(target.names)
    return [f for f in incoming if f.name not in known]


def assert_partitioned(spark: SparkSession, table: str, column: str = DAY_COLUMN) -> None:
    """Overwriting by partition a table that is not partitioned would replace all of it."""
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts != [column]:
        raise ValueError(f"{table} is partitioned by {parts}, not by {column}")


def overwrite_days(df: DataFrame, table: str, layout: Sequence[str] = (), files: int = 1) -> None:
    """Replace the days that df has in a Parquet table, which is made if need be; other days stay. Rerunning changes nothing.

    New columns are added to the table first (old rows have null); a breaking change of schema stops the write before it
    begins. With layout, files hold neighbouring rows: by one column a range, by several a z-order. Else a day is dealt to as
    many tasks as its size asks for, so that one large day is not one task's.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        assert_partitioned(spark, table)
        old = spark.table(table).schema
        add = plan_write(old, df.schema)
        if add:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in add)})")
        kinds = {f.name: f.dataType for f in spark.table(table).schema}
        rows = df.select(*[F.col(c).cast(t).alias(c) for c, t in kinds.items()])
    else:
        rows = df.select(*[c for c in df.columns if c != DAY_COLUMN], DAY_COLUMN)
    laid = clustered(rows, layout, files) if layout else by_size(rows, DAY_COLUMN)
    writer = laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format("parquet")
    if spark.catalog.tableExists(table):
        writer.insertInto(table, overwrite=True)
    else:
        writer.partitionBy(DAY_COLUMN).saveAsTable(table)


def by_size(df: DataFrame, by: str) -> DataFrame:
    """Rows of one value of by together, in partitions near the session's advisory size: large ones split, small ones joined."""
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE(`{by}`) */ * FROM {{df}}", df=df)


def append(df: DataFrame, path: str, by: str) -> None:
    """Rows are added whatever is there: an event log, whose readers tell repeats apart themselves."""
    df.write.mode("append").partitionBy(by).parquet(path)


def replace_log(df: DataFrame, path: str, keys: Sequence[str] = (DAY_COLUMN, "suite")) -> None:
    """The rows of a day and suite replace those of an earlier run."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def add_missing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both logs as one: columns that either lacks are null there."""
    return old.unionByName(new, allowMissingColumns=True)


def z_value(columns: Sequence[str], df: DataFrame, bits: int = 8) -> Column:
    """A key that is near for rows near in all columns: the bits of their ranks (by approximate quantiles), interleaved."""
    cuts = df.approxQuantile(list(columns), [i / 2**bits for i in range(1, 2**bits)], 0.25 / 2**bits)
    out = F.lit(0).cast("bigint")
    for j, (c, points) in enumerate(zip(columns, cuts, strict=True)):
        rank = F.size(F.filter(F.array(*[F.lit(float(p)) for p in points]), lambda p: p <= F.col(c))) if points else F.lit(0)
        for b in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(rank.cast("bigint"), b).bitwiseAND(F.lit(1)), b * len(columns) + j))
    return out


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """df in files ranges of the columns (of their z-order if several, which must be numeric), sorted in each."""
    if len(columns) == 1:
        return df.repartitionByRange(files, columns[0]).sortWithinPartitions(columns[0])
    keyed = df.withColumn("_z", z_value(columns, df))
    return keyed.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z")


def compact(spark: SparkSession, path: str, target: str, by: str = DAY_COLUMN, file_mb: int = 256, least_files: int = 3) -> DataFrame:
    """Rewrite to target the partitions of path that have least_files files or more, in files of about file_mb; swap them after.

    Returns (by, files, new_files): sizes come from the listing, which executors make, and only those partitions are read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    sizes = listed.select(F.regexp_extract("path", rf"/{by}=([^/]+)/", 1).alias(by), "length").groupBy(by).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    plan = sizes.where(F.col("files") >= least_files).select(by, "files", F.greatest(F.lit(1), F.ceil(F.col("bytes") / (file_mb << 20))).cast("int").alias("new_files")).where("new_files < files")
    rows = spark.read.parquet(path)
    kind = rows.schema[by].dataType
    chosen = rows.join(F.broadcast(plan.withColumn(by, F.col(by).cast(kind))), by).withColumn("_file", F.pmod(F.xxhash64(*[c for c in rows.columns if c != by]), F.col("new_files")))
    chosen.repartition(by, "_file").drop("_file", "files", "new_files").write.mode("overwrite").partitionBy(by).parquet(target)
    return plan


def repartition_table(df: DataFrame, path: str, by: str = DAY_COLUMN, dry_run: bool = False) -> DataFrame:
    """A copy of an unpartitioned table, partitioned; the caller swaps the two. Returns (by, n), and only that if dry_run."""
    if not dry_run:
        by_size(df, by).write.mode("overwrite").partitionBy(by).parquet(path)
    return df.groupBy(by).agg(F.count("*").alias("n"))
