"""Exact duplicates by two-pass Bloom filtering, in DataFrame functions only.

The filter is a blocked Bloom filter: a digest belongs to one block of 64 cells and sets a few of them, its pattern. Pass 1
counts patterns by block, summed in each partition first, and keeps of every block the cells of the patterns that came twice or
more. Pass 2 probes these blocks: a document with a cell that is not in its block has a text of its own and passes straight
through. Only the others, possibly repeated, are grouped by their digest. Texts never shuffle, and neither do digests that no
other document has.

Pass 1 is one job for the whole table, and what it leaves is in proportion to the repeated texts. Where this is more than one
broadcast may hold, pass 2 takes it by ranges of blocks. Blocks go by the first bits of a hash of the digest, and the digests
are written once, sorted by this hash within their files, so that a range reads its own part of each file only.
"""

from __future__ import annotations

import string
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import durable, lookup, remove_folder, shared_folder

#: Cells of a block, as bits of a long; rows a block; and bytes that a block takes where it is broadcast, at most.
CELLS, ROWS_A_BLOCK, BLOCK_BYTES = 64, 8, 64


def fold_case(text: Column) -> Column:
    """A-Z in lower case, all else unchanged; lower() does the same, faster, where every character is ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def placed(digests: DataFrame, bits: int, hashes: int) -> DataFrame:
    """digests (with their hash in range) with the block of each, by the first bits of range, and its pattern, of hashes cells or fewer."""
    cell = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64("digest", F.lit(i)), F.lit(CELLS)).cast("int"))
    pattern = reduce(lambda a, b: a.bitwiseOR(b), [cell(i) for i in range(hashes)])
    upward = F.col("range").bitwiseXOR(F.lit(-(2**63)))  # in the order of unsigned numbers
    block = F.shiftrightunsigned(upward, 64 - bits) if bits else F.lit(0).cast("long")
    return digests.withColumns({"block": block, "pattern": pattern})


def repeated_cells(digests: DataFrame) -> DataFrame:
    """Pass 1: (block, cells), the cells of all patterns that two or more rows have. Blocks without such are left out."""
    counted = digests.groupBy("block", "pattern").count()
    return counted.where(F.col("count") > 1).groupBy("block").agg(F.bit_or("pattern").alias("cells"))


def probe(digests: DataFrame, filter_: DataFrame) -> DataFrame:
    """Pass 2: digests with maybe, which is false only for a digest that no other row has. The filter's size is bounded."""
    joined = digests.join(F.broadcast(filter_), "block", "left")
    maybe = F.coalesce(F.col("cells").bitwiseAND(F.col("pattern")) == F.col("pattern"), F.lit(False))
    return joined.select("id", "digest", maybe.alias("maybe"))


def filtered(rows: DataFrame, hashes: int, broadcast_bytes: int) -> tuple[DataFrame, int]:
    """rows (id, digest) with maybe, and their number: pass 1 at once, pass 2 by as many ranges as its filter takes."""
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/exact-{uuid.uuid4().hex}"
    rows.withColumn("range", F.xxhash64("digest")).sortWithinPartitions("range").write.parquet(folder)
    digests = spark.read.schema("id long, digest binary, `range` long").parquet(folder)
    total = digests.count()
    bits = max(0, (total // ROWS_A_BLOCK).bit_length())
    own = placed(digests, bits, hashes)
    cells = durable(repeated_cells(own), total // 8)
    ranges = min(-(-cells.count() * BLOCK_BYTES // broadcast_bytes) or 1, 1 << bits)
    edges = [(i << bits) // ranges for i in range(ranges + 1)]
    out = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        hashed = F.col("range").between(F.lit((low << 64 - bits) - 2**63), F.lit((high << 64 - bits) - 2**63 - 1))
        out.append(durable(probe(own.where(hashed), cells.where(F.col("block").between(low, high - 1)))))
    remove_folder(spark, folder)
    return reduce(DataFrame.unionByName, out), total


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", hashes: int = 3, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """One row for each row of docs: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after fold_case; null counts as the empty text. Of equal texts the row with the largest
    key stays (keep_id; null is the smallest key, so keep_id is null only where all keys are). Rows that repeat both text
    and key count in group_size and are all kept, as nothing tells them apart. An empty table gives an empty result; other
    columns of docs are not read, whatever their names. broadcast_bytes bounds the part of the filter that is broadcast at
    once: tables with more repeated texts take more ranges, one after the other, and nothing else changes.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.unhex(F.sha2(fold_case(body), 256)).alias("digest"))
    probed, total = filtered(rows, hashes, broadcast_bytes)
    maybe = probed.where("maybe").drop("maybe")
    groups = durable(maybe.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")), total // 4)
    found = lookup(maybe, groups, ["digest"], "group_size", total)
    alone = probed.where("NOT maybe").select("digest", "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
    return found.unionByName(alone).select(
        F.col("id").alias(key), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
