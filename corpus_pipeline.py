"""From documents to packed training sequences: five stages, each a corpus operator at work on what the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tierline.llm.common import NO_ID, WORD, durable, plain_names, remove_folder, shared_folder, told_apart
from tierline.llm.lines import dedup_lines
from tierline.llm.minhash import near_duplicates
from tierline.llm.mixing import mix_sources
from tierline.llm.packing import pack_documents
from tierline.llm.quality import classify
from tierline.llm.queries import quality_model, tokenizer_path


# Each stage takes documents with any columns, whatever their names, and handles nulls, empty texts, texts of any length, repeated
# rows and empty tables; what it does with them is told by the operator that it calls. Rows are told apart by their number in
# a durable copy where a decision must find its row again, so null and repeated doc_ids are documents like others; what is decided
# hangs on what rows hold, and not on these numbers.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality. The classifier is fitted on a bounded sample of the labelled ones.

    A null text is an empty one, and is judged by its site and section; rows that repeat are judged alike.
    """
    rows, of = plain_names(docs, docs.columns)
    told = classify(rows, quality_model(spark, sf_dir), of["text"], of["source"], of["lang"], tuple(rows.columns))
    return told.where("kept").select(*rows.columns).toDF(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that were in the corpus before, in a smaller doc_id; one that has nothing left goes.

    Lines of fewer than 20 characters stay: headings and marks of lists are no boilerplate. n_chars follows the text. A null
    doc_id comes first; rows that repeat doc_id and text are treated alike; a null text becomes empty, and stays.
    """
    rows, of = plain_names(docs, docs.columns)
    key, text = of["doc_id"], of["text"]
    carry = tuple(c for c in rows.columns if c not in (key, text))
    kept = dedup_lines(rows, least=20, text=text, key=key, carry=carry)
    kept = kept.where((F.col("n_removed") == 0) | (F.trim("kept_text") != ""))
    out = {c: F.col(c) for c in rows.columns} | {text: F.col("kept_text")}
    if "n_chars" in docs.columns:
        out[of["n_chars"]] = F.when(F.col("n_removed") == 0, F.col(of["n_chars"])).otherwise(F.char_length("kept_text")).cast(docs.schema["n_chars"].dataType)
    return kept.select(*[out[c].alias(c) for c in rows.columns]).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of 0.8 or more.

    Of a group the row with the smallest doc_id stays (null first); of equal ones the first by a hash of all it holds. Rows
    that repeat are a group like any other, whatever their doc_id. Documents without words are no one's duplicates.
    """
    rows, of = plain_names(docs, docs.columns)
    rows = told_apart(rows, "row")
    linked = near_duplicates(rows, shingle=5, percent=80, text=of["text"], key="row").select("row", "component_id")
    hashed = [n for n in of.values() if not isinstance(rows.schema[n].dataType, MapType)]
    order = F.struct(F.coalesce(F.col(of["doc_id"]).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(*hashed).alias("mark"), F.col("row"))
    several = linked.groupBy("component_id").count().where("count > 1").select("component_id")
    linked = durable(linked.join(several, "component_id", "left_semi").join(rows.select("row", order.alias("order")), "row"))
    stays = linked.groupBy("component_id").agg(F.min("order").alias("stays"))
    gone = linked.join(stays, "component_id").where("row <> stays.row").select("row")
    return rows.join(gone, "row", "left_anti").select(*of.values()).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it. Null sources are a source; documents without words count 0."""
    rows, of = plain_names(docs, docs.columns)
    size = F.coalesce(F.regexp_count(F.col(of["text"]), F.lit(WORD)), F.lit(0))
    carry = tuple(c for c in rows.columns if c not in (of["doc_id"], of["source"]))
    taken = mix_sources(rows, size, of["source"], of["doc_id"], carry=carry).where("copies > 0")
    return taken.withColumn("turn", F.explode(F.sequence(F.lit(1), "copies"))).select(*rows.columns).toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of at most 1,024 tokens. A null text is the end token alone.

    Rows that repeat, and rows with null or equal doc_ids, are documents like others. The columns are the pieces' own, whatever
    those of the input are called; an empty table gives an empty result. Which sequence a piece is in hangs on what it holds.
    """
    return pack_documents(docs, tokenizer_path(), capacity=1024, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", mix),
    ("packing", packing),
]

#: Sampling, edit distance and tokenizing are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage returns is written to the cluster's shared folder, read again, and deleted
    once the next stage is written; the result is a durable copy."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")
    packed = durable(STAGES[-1][1](spark, docs, sf_dir))
    remove_folder(spark, folder)
    return packed
