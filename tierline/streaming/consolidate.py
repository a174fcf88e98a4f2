"""From a change log to the current state: incremental, guarded, and safe to redo."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators import scd


@dataclass(frozen=True)
class Consolidation:
    """A current-state table: its keys, and how columns of the log become typed (see scd.cdc_cast)."""

    name: str
    keys: tuple[str, ...]
    casts: Mapping[str, str]
    op: str = "__cdc_operation"
    ts: str = "__cdc_timestamp_ms"
    offset: str = "__kafka_offset"
    batch: str = "batch_id"


def typed(log: DataFrame, spec: Consolidation) -> DataFrame:
    return log.withColumns({c: scd.cdc_cast(kind, F.col(c)) for c, kind in spec.casts.items()})


def last_mark(spark: SparkSession, path: str, name: str) -> tuple[int, str] | None:
    """The last batch that the state of name holds, and where that state is."""
    try:
        marks = spark.read.parquet(path).where(F.col("name") == name)
    except AnalysisException:
        return None
    row = marks.agg(F.max_by(F.struct("last_batch", "state"), "last_batch").alias("m")).first()["m"]
    return (row["last_batch"], row["state"]) if row else None


def consolidate(spark: SparkSession, log: DataFrame, folder: str, spec: Consolidation, order: Sequence[str] = ()) -> str | None:
    """Merge what the log has beyond the last mark into the state; returns the state's path, or None if there is nothing new.

    The end of the read is fixed before anything is read. A new state is written beside the old one and the mark, which names
    it, last: after a crash in between, the next run reads the same events again and gives the same state.
    """
    mark = last_mark(spark, f"{folder}/marks", spec.name)
    head = log.agg(F.max(spec.batch)).first()[0]
    plan = scd.plan_read(mark[0] if mark else None, head)
    if plan[0] == "skip":
        return None
    events = typed(scd.read_changes(log, plan, spec.batch), spec)
    order = order or (spec.ts, spec.batch, spec.offset)
    changes = scd.latest_change(events, spec.keys, order)
    state = changes if mark is None else scd.merge_current(spark.read.parquet(mark[1]), changes, spec.keys, spec.op, spec.ts, order)
    path = f"{folder}/{spec.name}/{uuid.uuid4().hex}"
    state.write.parquet(path)
    spark.createDataFrame([(spec.name, head, path)], "name string, last_batch bigint, state string").write.mode("append").parquet(f"{folder}/marks")
    return path


def route(batch: DataFrame, violations: str, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events to take and dead letters: a broken contract or a conflict with the ledger is dead, a replay is neither.

    batch has topic, event_id, fingerprint, offset and violations (array<string>).
    """
    from tierline.streaming.events import classify_replays

    broken = batch.where(F.size(violations) > 0).withColumn("reason", F.array_join(violations, "; "))
    told = classify_replays(batch.where(F.size(violations) == 0), ledger)
    conflicts = told.where("verdict = 'CONFLICT'").drop("verdict").withColumn("reason", F.lit("fingerprint conflict"))
    return told.where("verdict = 'NEW'").drop("verdict"), broken.unionByName(conflicts)
