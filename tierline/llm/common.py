"""What the corpus operators share: durable intermediate tables, joins that stand hot keys, and names that cannot clash."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than the space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows without a doc_id sort before all others.
NO_ID = -(2**63)
#: A key is hot from this share of all rows on, so at most 1 / HOT_SHARE keys are hot.
HOT_SHARE = 0.001


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only in local mode, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


#: Rows of one file of a durable table of known size, about.
FILE_ROWS = 20_000


def in_few(df: DataFrame, rows: int) -> DataFrame:
    """df, of about so many rows, in as few tasks as these ask for, whatever the number of shuffle partitions."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def durable(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df, computed once and kept in the shared checkpoint folder, so that a lost executor takes nothing with it.

    Given about how many rows it has, a table that an aggregate makes goes into few files if it is small: every file costs
    several calls to the file system, on some of them a process each. Tables that are costly to make are not given it, as their
    tasks would be joined too.
    """
    shared_folder(df.sparkSession)
    return (df if rows is None else in_few(df, rows)).checkpoint()


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark then deletes the shuffle files of jobs whose results are durable.

    By itself it does so whenever the driver's memory happens to fill, and several copies of the texts lie on disks until then.
    """
    for _ in range(2):  # Python's references are released by a thread of their own, and plans hold one another
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables, wherever Spark keeps it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def told_apart(df: DataFrame, name: str) -> DataFrame:
    """A durable copy of df with a number in name that no two rows share, whatever they hold: partition and place in it."""
    return durable(df).withColumn(name, F.monotonically_increasing_id())


def numbered(df: DataFrame, row: str, columns: Sequence[str], mark: str = "mark", nth: str = "nth") -> DataFrame:
    """df with a hash of the columns in mark and, among rows that are equal in it, a number from 0 in nth.

    The two depend on what the rows hold and not on how their files are split: rows that change places are equal. row
    tells rows apart, as told_apart numbers them; df is read several times. Repeated rows are numbered by partition, and these
    by prefix sums, so that no task meets all copies of a row.
    """
    marked = df.withColumn(mark, F.xxhash64(*[F.col(c) for c in columns]))
    again = durable(marked.groupBy(mark).count().where("count > 1").select(mark))
    if again.isEmpty():
        return marked.withColumn(nth, F.lit(0).cast("long"))
    part = F.shiftright(F.col(row), 33)
    copies = marked.select(mark, row, part.alias("_part")).join(again, mark, "left_semi")
    here = Window.partitionBy(mark, "_part")
    copies = copies.withColumn("_here", F.row_number().over(here.orderBy(row)))
    sizes = copies.groupBy(mark, "_part").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(mark).orderBy("_part")) - F.col("_size")
    places = copies.join(sizes.select(mark, "_part", before.alias("_before")), [mark, "_part"]).select(row, (F.col("_before") + F.col("_here") - 1).alias(nth))
    return marked.join(places, row, "left").withColumn(nth, F.coalesce(F.col(nth), F.lit(0).cast("long")))


def plain_names(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """The columns of df under names (c0, c1, ...) that an operator's own cannot clash with, and the name of each."""
    of = {c: f"c{i}" for i, c in enumerate(columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in of.items()]), of


def lookup(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """Join left to right, which has one row a key and in weight the number of left rows with that key.

    Keys that hold more than HOT_SHARE of all rows number 1 / HOT_SHARE at most, so their side is broadcast and their rows
    stay where they are; only rows with other keys shuffle. right must be durable, as it is read three times.
    """
    is_hot = F.col(weight) > F.lit(float(total) * HOT_SHARE)
    hot = F.broadcast(right.where(is_hot))
    near = left.join(hot, keys, "inner")
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return near.unionByName(rest.join(right.where(~is_hot), keys, how))


def partitions_for(spark: SparkSession, amount: float, each: float) -> int:
    """Enough partitions for amount at each a partition, and no fewer than the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-amount // each)))


def give_back() -> None:
    """Return freed memory to the system: workers are used again, and would else keep the most that any task took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it decides itself
        pass
