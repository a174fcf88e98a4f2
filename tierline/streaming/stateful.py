"""Streams with memory: the latest payment of each merchant, kept current, and a ledger of the events that have had their effect."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierline.sources.shared import remove_folder
from tierline.streaming.events import _numbers, classify_replays, fingerprint

#: What a payment notification tells of the latest payment.
TOLD = ("event_id", "ts", "amount", "pay_channel")


def latest_payments(payments: DataFrame) -> DataFrame:
    """The latest successful payment of each merchant, of a table or a stream; of equal times the largest event_id."""
    best = F.max_by(F.struct(*TOLD), F.struct("ts", "event_id"))
    return payments.where("status = 'SUCCESS' AND merchant_id IS NOT NULL").groupBy("merchant_id").agg(best.alias("e")).select("merchant_id", "e.*")


def run_latest_payments(payments: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """A stream of payments into a table of one row a merchant; all data there is, then ends.

    The state has one row a merchant, and only merchants whose row changed reach the sink. A batch writes the whole table anew,
    from the one of the batch before and its changes, as a version of its own; so a batch that is redone after a crash writes
    the same version, whatever it had written. The version before stays for readers, older ones go.
    """
    spark = payments.sparkSession

    def each(changed: DataFrame, number: int) -> None:
        versions = sorted(n for n in _numbers(spark, out) if n < number)
        table = changed
        if versions:
            old = spark.read.parquet(f"{out}/batch_id={versions[-1]}")
            table = old.join(changed.select("merchant_id"), "merchant_id", "left_anti").unionByName(changed)
        table.write.mode("overwrite").parquet(f"{out}/batch_id={number}")
        for n in versions[:-1]:
            remove_folder(spark, f"{out}/batch_id={n}")

    return latest_payments(payments).writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_latest_payments(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/batch_id={max(_numbers(spark, out))}")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream that a checkpoint belongs to: one id for all its restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def seen_before(spark: SparkSession, ledger: str, stream: str, number: int) -> DataFrame:
    """The ledger without what this very batch recorded, should it be redone."""
    schema = "topic string, event_id bigint, fingerprint string, stream string, batch_id bigint"
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger).where((F.col("stream") != stream) | (F.col("batch_id") != number))


def run_once_each(events: DataFrame, ledger: str, out: str, checkpoint: str, effect: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """A stream of events (topic, event_id, payload, offset, ...) of which each has its effect once; all data there is, then ends.

    An event that the ledger has with the same payload is a replay, with another one a conflict; both go to out/rejected with
    their verdict, and have no effect. The others are given to effect, and only after it are they recorded. effect gets the
    batch's number and must replace what it wrote under that number: a batch that stops between effect and record is redone,
    comes to the same verdicts, as it does not look at its own records, and adds nothing. The ledger outlives the stream: another
    stream with a checkpoint of its own knows what the first has done.
    """
    spark = events.sparkSession

    def write(df: DataFrame, to: str, stream: str, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{to}/stream={stream}/batch_id={number}")

    def each(batch: DataFrame, number: int) -> None:
        stream = stream_id(spark, checkpoint)
        stamped = batch.withColumn("fingerprint", fingerprint(F.col("payload"))).persist()
        try:
            keys = stamped.select("topic", "event_id").distinct()
            known = seen_before(spark, ledger, stream, number).join(keys, ["topic", "event_id"], "left_semi")  # the batch is the small side
            judged = classify_replays(stamped, known).persist()
            new = judged.where("verdict = 'NEW'").drop("verdict", "fingerprint")
            effect(new, number)
            write(judged.where("verdict <> 'NEW'"), f"{out}/rejected", stream, number)
            write(judged.where("verdict = 'NEW'").select("topic", "event_id", "fingerprint"), ledger, stream, number)
            judged.unpersist()
        finally:
            stamped.unpersist()

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
