"""Reconciliation of what should agree: counts, totals and aggregates by key, joined on executors."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import money
from tierline.functions.time import in_days

#: Outcomes of a comparison and the status that logs have for them (fixed values).
STATUS = {"MATCHED": "PASS", "MISMATCH": "FAIL", "MISSING_LEFT": "FAIL", "MISSING_RIGHT": "FAIL", "DUPLICATE": "FAIL", "PENDING": "WARN", "NOT_COMPARABLE": "WARN"}


def status_of(outcome: Column) -> Column:
    """The log status of an outcome; an unknown outcome fails."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in STATUS.items() for x in kv]), outcome), F.lit("FAIL"))


def three_way(source: DataFrame, stream: DataFrame, batch: DataFrame, entity: str, tolerance: float = 0.0) -> DataFrame:
    """Three rows: the row counts of source, stream and batch compared two by two, with a tolerance in shares of the left."""
    counted = source.agg(F.count("*").alias("a")).crossJoin(stream.agg(F.count("*").alias("b"))).crossJoin(batch.agg(F.count("*").alias("c")))
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(x).alias("expected"), F.col(y).alias("actual")) for n, x, y in (("source_stream", "a", "b"), ("source_batch", "a", "c"), ("stream_batch", "b", "c"))])
    rows = counted.select(F.explode(pairs).alias("p")).select(F.lit(entity).alias("entity"), "p.*")
    return rows.withColumn("status", F.when(F.abs(F.col("expected") - F.col("actual")) <= F.col("expected") * tolerance, "PASS").otherwise("FAIL"))


def control_total(left: DataFrame, right: DataFrame, amount: str, entity: str, tolerance: str = "0.00") -> DataFrame:
    """Sums of money on both sides, as decimals to the end."""
    rows = left.agg(money(F.coalesce(F.sum(amount), F.lit(0))).alias("expected")).crossJoin(right.agg(money(F.coalesce(F.sum(amount), F.lit(0))).alias("actual")))
    return rows.select(F.lit(entity).alias("entity"), "expected", "actual", F.when(F.abs(F.col("expected") - F.col("actual")) <= F.lit(tolerance).cast("decimal(18,2)"), "PASS").otherwise("FAIL").alias("status"))


def by_key(paths: dict[str, DataFrame], keys: Sequence[str], metrics: dict[str, Column], absent: float | None = None, tolerance: float = 0.0) -> DataFrame:
    """Each metric of each key over all paths: keys, metric, a column a path, status. One aggregation of tagged rows.

    A path without the key has absent; null is a difference to all but null. The paths may differ from the first by tolerance.
    """
    tagged = None
    for name, df in paths.items():
        part = df.groupBy(*keys).agg(*[m.alias(k) for k, m in metrics.items()]).withColumn("_path", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    pivoted = tagged.groupBy(*keys).agg(*[F.max(F.when(F.col("_path") == p, F.col(m))).alias(f"{m}__{p}") for m in metrics for p in paths])
    told = lambda c: F.coalesce(c, F.lit(absent)).cast("decimal(18,2)")
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), *[told(F.col(f"{m}__{p}").cast("decimal(18,2)")).alias(p) for p in paths]) for m in metrics])
    out = pivoted.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")
    first, *rest = paths
    same = F.lit(True)
    for p in rest:
        near = F.abs(F.col(first) - F.col(p)) <= F.lit(tolerance).cast("decimal(18,2)")
        same = same & F.coalesce(near, F.col(first).eqNullSafe(F.col(p)))
    return out.withColumn("status", F.when(same, "PASS").otherwise("FAIL"))


#: The ways to pay that source, batch and stream must agree on.
COHORT_CHANNELS = ("QR", "POS")


def cohort(payments: DataFrame, day: dt.date, ts: str = "ts", merchant: str = "merchant_id", channel: str = "pay_channel") -> DataFrame:
    """The payments that are reconciled: those of a merchant, by the cohort's channels, of one business day."""
    return payments.where(in_days(F.col(ts), day) & F.col(merchant).isNotNull() & F.col(channel).isin(*COHORT_CHANNELS))


def settlement(txns: DataFrame, settled: DataFrame, keys: Sequence[str], tolerance: str = "0.01") -> DataFrame:
    """Transactions aggregated by key against settlement rows: the first of these that holds, or PASS.

    DUPLICATE (a key settled twice), MISSING_TXN, MISSING_SETTLEMENT, GROSS_MISMATCH, TXN_COUNT_MISMATCH. txns has amount;
    settled has gross_amount and txn_count.
    """
    left = txns.groupBy(*keys).agg(money(F.sum("amount")).alias("txn_gross"), F.count("*").alias("txn_n"))
    right = settled.groupBy(*keys).agg(money(F.sum("gross_amount")).alias("settled_gross"), F.sum("txn_count").alias("settled_n"), F.count("*").alias("copies"))
    joined = left.join(right, list(keys), "full_outer")
    outcome = (
        F.when(F.col("copies") > 1, "DUPLICATE").when(F.col("txn_n").isNull(), "MISSING_TXN").when(F.col("copies").isNull(), "MISSING_SETTLEMENT")
        .when(F.abs(F.col("txn_gross") - F.col("settled_gross")) > F.lit(tolerance).cast("decimal(18,2)"), "GROSS_MISMATCH").when(F.col("txn_n") != F.col("settled_n"), "TXN_COUNT_MISMATCH").otherwise("PASS")
    )
    return joined.select(*keys, "txn_gross", "settled_gross", "txn_n", "settled_n", outcome.alias("outcome"))


def loan_payments(expected: DataFrame, observed: DataFrame, tolerance: str = "1.00") -> DataFrame:
    """Each loan and day: what was scheduled against what was paid, and an outcome.

    NOT_COMPARABLE if a payment id repeats, PENDING if any payment is, MISSING_RIGHT if all are MISSED or none is there, else
    MATCHED or MISMATCH by the tolerance (inclusive). expected has loan_id, cob_dt, scheduled; observed has loan_id, cob_dt,
    payment_id, payment_status, paid.
    """
    due = expected.groupBy("loan_id", "cob_dt").agg(money(F.sum("scheduled")).alias("scheduled"))
    ids = observed.groupBy("loan_id", "cob_dt", "payment_id").agg(F.count("*").alias("copies"), F.sum("paid").alias("paid"), F.max(F.when(F.col("payment_status") == "PENDING", 1).otherwise(0)).alias("pending"), F.min(F.when(F.col("payment_status") == "MISSED", 1).otherwise(0)).alias("missed"))
    paid = ids.groupBy("loan_id", "cob_dt").agg(money(F.sum("paid")).alias("paid"), F.max("copies").alias("copies"), F.max("pending").alias("pending"), F.min("missed").alias("missed"))
    outcome = (
        F.when(F.col("paid").isNull(), "MISSING_RIGHT").when(F.col("copies") > 1, "NOT_COMPARABLE").when(F.col("pending") == 1, "PENDING").when(F.col("missed") == 1, "MISSING_RIGHT")
        .when(F.abs(F.col("scheduled") - F.col("paid")) <= F.lit(tolerance).cast("decimal(18,2)"), "MATCHED").otherwise("MISMATCH")
    )
    rows = due.join(paid, ["loan_id", "cob_dt"], "left").select("loan_id", "cob_dt", "scheduled", "paid", outcome.alias("outcome"))
    return rows.withColumn("status", status_of(F.col("outcome")))


def log_rows(checks: DataFrame, day: Column, suite: str, name: Column, status: Column, detail: Column) -> DataFrame:
    """Any check's rows in the common shape of the log."""
    return checks.select(day.cast("date").alias("cob_dt"), F.lit(suite).alias("suite"), name.alias("check_name"), status.alias("status"), detail.cast("string").alias("detail"))


def report(log: DataFrame, status: str | None = None, limit: int = 100) -> DataFrame:
    """The newest rows of the log, of one status or all."""
    rows = log if status is None else log.where(F.col("status") == status)
    return rows.orderBy(F.desc("cob_dt"), "suite", "check_name").limit(limit)
