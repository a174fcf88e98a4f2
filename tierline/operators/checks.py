"""Data-quality checks as rows: all checks of a table are one aggregation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.ranking import discrete_quantiles


@dataclass(frozen=True)
class Check:
    """kind: row_count, not_null, unique, range, accepted, positive, not_future, fresh. A warning never fails a table.

    unique may name several columns, with commas between them: no two rows share all of these. fresh: the newest day is no
    more than high days old.
    """

    kind: str
    column: str | None = None
    low: object = None
    high: object = None
    values: tuple = ()
    severity: str = "FAIL"

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}" if self.column else self.kind


KINDS = ("row_count", "not_null", "unique", "range", "accepted", "positive", "not_future", "fresh")


def _failed(check: Check, now: dt.date | None) -> Column:
    several = check.kind == "unique" and "," in (check.column or "")
    c = F.struct(*check.column.split(",")) if several else F.col(check.column) if check.column else None
    if check.kind == "row_count":
        n = F.count("*")
        out = F.lit(False)
        if check.low is not None:
            out = out | (n < F.lit(check.low))
        if check.high is not None:
            out = out | (n > F.lit(check.high))
        return F.when(out, 1).otherwise(0).cast("bigint")
    if check.kind == "not_null":
        return F.count_if(c.isNull())
    if check.kind == "unique":  # null counts as one value
        return F.count("*") - F.count_distinct(c) - F.max(F.when(c.isNull(), 1).otherwise(0))
    if check.kind == "range":  # 0 is a bound like others; null passes
        out = F.lit(False)
        if check.low is not None:
            out = out | (c < F.lit(check.low))
        if check.high is not None:
            out = out | (c > F.lit(check.high))
        return F.count_if(out)
    if check.kind == "accepted":
        return F.count_if(~c.isin(*check.values))
    if check.kind == "fresh":
        return F.when(F.coalesce(F.date_diff(F.lit(now), F.max(c)) > F.lit(check.high), F.lit(True)), 1).otherwise(0).cast("bigint")
    if check.kind == "positive":
        return F.count_if(c <= 0)
    return F.count_if(c > F.lit(now))


def run_checks(df: DataFrame, table: str, checks: Sequence[Check], now: dt.date | None = None) -> DataFrame:
    """One row a check: table_name, check_name, severity, status (PASS, WARN, FAIL, SKIPPED), failed, total.

    A column that the table lacks fails its check; a kind that is not known is skipped. The table is read once: of several
    distinct counts Spark makes two aggregations over rows expanded by column, values counted in each task first.
    """
    known = [c for c in checks if c.kind in KINDS and (c.column is None or all(x in df.columns for x in (c.column.split(",") if c.kind == "unique" else [c.column])))]
    row = df.agg(F.count("*").alias("total"), *[F.coalesce(_failed(c, now), F.lit(0)).alias(f"x{i}") for i, c in enumerate(known)])
    told = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"x{i}").cast("bigint").alias("failed"), F.lit("").alias("note")) for i, c in enumerate(known)]
    for c in checks:
        if c not in known:
            told.append(F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.lit(None).cast("bigint").alias("failed"), F.lit("missing" if c.kind in KINDS else "unknown").alias("note")))
    status = F.when(F.col("r.note") == "unknown", "SKIPPED").when((F.col("r.failed") == 0) & (F.col("r.note") == ""), "PASS").when(F.col("r.severity") == "WARN", "WARN").otherwise("FAIL")
    return row.select("total", F.explode(F.array(*told)).alias("r")).select(F.lit(table).alias("table_name"), "r.check_name", "r.severity", status.alias("status"), "r.failed", "total")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct values of column that the parent lacks; null is no orphan."""
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    return values.join(parent.select(F.col(parent_column).alias("value")).distinct(), "value", "left_anti")


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("copies")).where("copies > 1")


def violations(df: DataFrame, rules: Mapping[str, Column], table: str, detected: dt.datetime) -> DataFrame:
    """Rows that break rules, once a rule: the table's columns, violation_type, source_table, violation_detail, detected_at.

    One scan for all rules. Write the result by overwriting the partition of its day, so that a rerun adds nothing.
    """
    broken = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]), lambda x: x.isNotNull())
    return df.withColumn("violation_type", F.explode(broken)).select(
        *df.columns, "violation_type", F.lit(table).alias("source_table"), F.concat(F.col("violation_type"), F.lit(" on "), F.lit(table)).alias("violation_detail"), F.lit(detected).cast("timestamp_ntz").alias("detected_at")
    )


def quarantine_status(found: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row a rule with its action (QUARANTINE or WARN): how many rows, and PASS, WARNED or QUARANTINED."""
    spark = found.sparkSession
    all_rules = spark.createDataFrame(list(rules.items()), "violation_type string, action string")
    counts = found.groupBy("violation_type").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return all_rules.join(counts, "violation_type", "left").select("violation_type", n.alias("violations"), F.when(n == 0, "PASS").when(F.col("action") == "WARN", "WARNED").otherwise("QUARANTINED").alias("status"))


def volume_anomaly(rows: DataFrame, day: dt.date, partition: str, tolerance: float) -> DataFrame:
    """The day's rows against the mean of the days before: one row with n, mean, status."""
    counts = rows.where(F.col(partition) <= F.lit(day)).groupBy(partition).agg(F.count("*").alias("n"))
    today, before = F.sum(F.when(F.col(partition) == F.lit(day), F.col("n"))), F.sum(F.when(F.col(partition) < F.lit(day), F.col("n")))
    days = F.count_if(F.col(partition) < F.lit(day))
    mean = before.cast("double") / F.nullif(days.cast("double"), F.lit(0.0))
    n = F.coalesce(today, F.lit(0))
    return counts.agg(n.alias("n"), mean.alias("mean"), F.when(F.abs(n - mean) > mean * tolerance, "ANOMALY").otherwise("NORMAL").alias("status"))


def outliers(df: DataFrame, column: str, by: Sequence[str], z: float) -> DataFrame:
    """Rows further than z deviations from their group's mean. Sums are exact where the column is a decimal."""
    c = F.col(column)
    stats = df.groupBy(*by).agg(F.count(c).alias("_n"), F.sum(c).cast("double").alias("_s"), F.sum(c * c).cast("double").alias("_q"))
    n, s, q = (F.col(x) for x in ("_n", "_s", "_q"))
    spread = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(q - s * s / n, n - 1)))
    return df.join(stats, list(by)).where((n > 1) & (F.abs(c.cast("double") - s / n) > spread * z)).drop("_n", "_s", "_q")


def quartiles(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """by, q1, q2, q3: exact values of the column, on a table of any size."""
    return discrete_quantiles(df, column, by, 4)


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Rows outside the quartiles by factor times their distance."""
    q = quartiles(df, column).select(F.col("q1").cast("double").alias("_a"), F.col("q3").cast("double").alias("_b"))
    reach = (F.col("_b") - F.col("_a")) * factor
    c = F.col(column).cast("double")
    return df.crossJoin(F.broadcast(q)).where((c < F.col("_a") - reach) | (c > F.col("_b") + reach)).drop("_a", "_b")


def column_anomalies(df: DataFrame, expected: Mapping[str, tuple[str | None, object, object]]) -> DataFrame:
    """One row a column of expected (type or part of it, least, greatest): FAIL if df lacks it, WARN with what is odd, PASS.

    All columns' bounds come from one aggregation.
    """
    kinds = dict(df.dtypes)
    there = [c for c in expected if c in kinds]
    ends = df.agg(F.lit(1).alias("_one"), *[f(c).alias(f"_{n}{i}") for i, c in enumerate(there) for n, f in (("low", F.min), ("high", F.max))])
    rows = []
    for c, (kind, low, high) in expected.items():
        if c not in kinds:
            rows.append((c, F.lit("FAIL"), F.array(F.lit("not found"))))
            continue
        i = there.index(c)
        issues = [F.lit(f"type {kinds[c]}, not {kind}")] if kind and kind not in kinds[c] else []
        if low is not None:
            issues.append(F.when(F.col(f"_low{i}") < F.lit(low), F.concat(F.lit("below "), F.lit(str(low)))))
        if high is not None:
            issues.append(F.when(F.col(f"_high{i}") > F.lit(high), F.concat(F.lit("above "), F.lit(str(high)))))
        found = F.filter(F.array(*issues, F.lit(None).cast("string")), lambda x: x.isNotNull())
        rows.append((c, F.when(F.size(found) > 0, "WARN").otherwise("PASS"), found))
    told = F.array(*[F.struct(F.lit(c).alias("column_name"), s.alias("status"), F.array_join(d, "; ").alias("details")) for c, s, d in rows])
    return ends.select(F.explode(told).alias("r")).select("r.*")


def partition_freshness(df: DataFrame, table: str, today: dt.date, limit_days: int = 1, partition: str = "cob_dt") -> DataFrame:
    """The age in days of a table's newest partition: FAIL beyond the limit or without any, WARN if it has no such column."""
    if partition not in df.columns:
        return df.sparkSession.range(1).select(F.lit(table).alias("table_name"), F.lit(None).cast("date").alias("newest"), F.lit(None).cast("int").alias("age_days"), F.lit("WARN").alias("status"))
    newest = df.agg(F.max(F.col(partition).cast("date")).alias("newest"))
    age = F.date_diff(F.lit(today), F.col("newest"))
    return newest.select(F.lit(table).alias("table_name"), "newest", age.alias("age_days"), F.when(age <= limit_days, "PASS").otherwise("FAIL").alias("status"))


def freshness(df: DataFrame, table: str, column: str, now: dt.datetime, limit_hours: float) -> DataFrame:
    """Hours since the newest value. A date is as old as the end of its business day; other types than date and timestamp warn."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        newest = F.max(F.col(column).cast("timestamp_ntz") + F.expr("INTERVAL 17 HOURS"))  # midnight of the next day, UTC+7
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        newest = F.max(F.col(column).cast("timestamp_ntz"))
    else:
        return df.limit(1).agg(F.lit(table).alias("table_name"), F.lit(None).cast("double").alias("age_hours"), F.lit("WARN").alias("status"))
    seconds = F.unix_timestamp(F.lit(now).cast("timestamp_ntz").cast("timestamp")) - F.unix_timestamp(F.col("newest").cast("timestamp"))
    age = seconds.cast("double") / 3600.0
    return df.agg(newest.alias("newest")).select(F.lit(table).alias("table_name"), age.alias("age_hours"), F.when(F.col("newest").isNull(), "FAIL").when(age > limit_hours, "FAIL").otherwise("PASS").alias("status"))


#: Type changes that lose nothing, as Spark writes types.
_SAFE = {("int", "bigint"), ("float", "double"), ("smallint", "int"), ("smallint", "bigint"), ("tinyint", "int")}


def is_safe(old: T.DataType, new: T.DataType) -> bool:
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old.scale == new.scale and old.precision <= new.precision
    return (old.simpleString(), new.simpleString()) in _SAFE


def schema_drift(declared: T.StructType, actual: T.StructType) -> list[tuple[str, str, str, str, str]]:
    """(column, change, declared type, actual type, severity); severity is ADDITIVE or BREAKING. No row: no drift."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in declared}
    out = [(c, "removed", t.simpleString(), "", "BREAKING") for c, t in want.items() if c not in have]
    out += [(c, "added", "", t.simpleString(), "ADDITIVE") for c, t in have.items() if c not in want]
    for c, t in want.items():
        if c in have and have[c] != t:
            out.append((c, "type", t.simpleString(), have[c].simpleString(), "ADDITIVE" if is_safe(t, have[c]) else "BREAKING"))
    return sorted(out)


def drift_report(spark, table: str, declared: T.StructType, actual: T.StructType) -> DataFrame:
    rows = [(table, *r) for r in schema_drift(declared, actual)]
    return spark.createDataFrame(rows, "table_name string, column_name string, change string, declared string, actual string, severity string")


def scd2_integrity(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: versions, current_rows, duplicate_current, open_ended, overlapping. Overlaps by order in each key."""
    from tierline.operators.scd import OPEN_END, overlaps

    per_key = dimension.groupBy(*keys).agg(F.count("*").alias("v"), F.sum("is_current").alias("c"), F.count_if(F.col("effective_to") == F.lit(OPEN_END)).alias("o"))
    totals = per_key.agg(F.sum("v").alias("versions"), F.sum("c").cast("bigint").alias("current_rows"), F.count_if(F.col("c") > 1).alias("duplicate_current"), F.sum("o").alias("open_ended"))
    return totals.crossJoin(overlaps(dimension, keys).agg(F.count("*").alias("overlapping")))
