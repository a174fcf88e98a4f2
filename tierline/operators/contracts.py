"""Contracts of tables: what must hold of each, and of its keys in other tables, enforced in one report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators.checks import Check, run_checks

#: Finds a table by name; None if there is none.
Tables = Callable[[str], DataFrame | None]


@dataclass(frozen=True)
class Reference:
    """Every value of column that is not null is in the parent's column."""

    column: str
    parent: str
    parent_column: str
    severity: str = "FAIL"

    @property
    def name(self) -> str:
        return f"references:{self.column}"


@dataclass(frozen=True)
class Reconciliation:
    """The table has about as many distinct keys as its source: within so many percent of the source's."""

    source: str
    column: str
    percent: float
    severity: str = "FAIL"

    @property
    def name(self) -> str:
        return f"reconciles:{self.column}"


@dataclass(frozen=True)
class Contract:
    table: str
    checks: tuple[Check, ...]
    references: tuple[Reference, ...] = ()
    reconciliations: tuple[Reconciliation, ...] = ()


def _told(table: str, name: str, severity: str, counts: DataFrame) -> DataFrame:
    """A row of the report from one of failed and total."""
    status = F.when(F.col("failed") == 0, "PASS").when(F.lit(severity) == "WARN", "WARN").otherwise("FAIL")
    return counts.select(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), status.alias("status"), F.col("failed").cast("bigint").alias("failed"), F.col("total").cast("bigint").alias("total"))


def enforce(contract: Contract, tables: Tables, now: dt.date | None = None) -> DataFrame:
    """One row a check, reference and reconciliation: table_name, check_name, severity, status, failed, total.

    The table's own checks are one read of it. A reference is one join of its values, each once with its number of rows, to the
    parent's keys. A table, parent or source that is not there fails what needs it (failed is null), and a warning never fails.
    """
    df = tables(contract.table)
    if df is None:
        nothing = [Check("row_count", severity="FAIL")]
        spark = _any_session()
        return spark.createDataFrame([(contract.table, c.name, c.severity, "FAIL", None, None) for c in nothing], "table_name string, check_name string, severity string, status string, failed bigint, total bigint")
    out = run_checks(df, contract.table, contract.checks, now)
    missing = df.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("failed"), F.lit(None).cast("bigint").alias("total"))
    for ref in contract.references:
        parent = tables(ref.parent)
        if parent is None or ref.column not in df.columns:
            counts = missing
        else:
            values = df.where(F.col(ref.column).isNotNull()).groupBy(F.col(ref.column).alias("_key")).agg(F.count("*").alias("n"))
            known = parent.select(F.col(ref.parent_column).alias("_key")).distinct().withColumn("_known", F.lit(1))
            counts = values.join(known, "_key", "left").agg(F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("failed"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
        out = out.unionByName(_told(contract.table, ref.name, ref.severity, counts))
    for rec in contract.reconciliations:
        source = tables(rec.source)
        if source is None:
            counts = missing
        else:
            keys = lambda t, n: t.agg(F.count_distinct(rec.column).alias(n))  # noqa: B023, E731
            apart = F.abs(F.col("s") - F.col("t")) * 100 > F.col("s") * rec.percent
            counts = keys(source, "s").crossJoin(keys(df, "t")).select(F.when(apart, 1).otherwise(0).alias("failed"), F.col("t").alias("total"))  # one row each
        out = out.unionByName(_told(contract.table, rec.name, rec.severity, counts))
    return out


def _any_session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def enforce_all(contracts: Sequence[Contract], tables: Tables, now: dt.date | None = None) -> DataFrame:
    out = None
    for c in contracts:
        told = enforce(c, tables, now)
        out = told if out is None else out.unionByName(told)
    return out
