"""Queries that go through storage: what is written is read back."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import money, zero
from tierline.functions.time import business_date, business_window
from tierline.operators import invariants, scd
from tierline.operators.checks import drift_report as drift_of
from tierline.plans.registry import query
from tierline.plans.roles import DAY, Roles
from tierline.plans.stream_queries import _kept, _shared
from tierline.sources import specs, writes
from tierline.sources.shared import durable


def _week(r: Roles) -> DataFrame:
    return business_window(r.account_txn, DAY, 30).select("txn_id", "customer_id", "amount", "cob_dt")


def _table() -> str:
    return f"t_{uuid.uuid4().hex}"


def _dropped(rows: DataFrame, table: str) -> DataFrame:
    """A durable copy of what was read from a table, which then goes."""
    out = durable(rows)
    rows.sparkSession.sql(f"DROP TABLE {table}")
    return out


@query(
    "snk1_overwrite_days",
    "SELECT txn_id, customer_id, CAST(CASE WHEN cob_dt = DATE '2001-06-30' THEN amount + 1 ELSE amount END AS DECIMAL(18,2)) AS amount, cob_dt FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'",
)
def overwrite_days(r: Roles) -> DataFrame:
    """A month is written, then its last day again with other amounts, twice: only that day changes, and once."""
    table = _table()
    writes.overwrite_days(_week(r), table, ["amount"], files=2)
    again = _week(r).where(F.col("cob_dt") == F.lit(DAY)).withColumn("amount", money(F.col("amount") + 1))
    for _ in range(2):
        writes.overwrite_days(again, table)
    return _dropped(r.spark.table(table), table)


@query(
    "snk4_schema_evolution",
    "SELECT txn_id, amount, CASE WHEN cob_dt = DATE '2001-06-30' THEN 'new' END AS note, cob_dt FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'",
)
def schema_evolution(r: Roles) -> DataFrame:
    table = _table()
    rows = _week(r).drop("customer_id")
    writes.overwrite_days(rows.where(F.col("cob_dt") < F.lit(DAY)), table)
    writes.overwrite_days(rows.where(F.col("cob_dt") == F.lit(DAY)).withColumn("note", F.lit("new")), table)
    return _dropped(r.spark.table(table).select("txn_id", "amount", "note", "cob_dt"), table)


@query("snk8_compacted_days", "SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) AS cob_dt, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM event GROUP BY 1")
def compacted(r: Roles) -> DataFrame:
    """Payments by day, each day in many small files, as compaction leaves them."""
    folder = _shared(r)
    days = r.event.select("event_id", "amount", business_date(F.col("ts")).alias("cob_dt"))
    days.repartition(16, "event_id").write.partitionBy("cob_dt").parquet(f"{folder}/many")
    writes.compact(r.spark, f"{folder}/many", f"{folder}/few")
    return _kept(r.spark.read.parquet(f"{folder}/few").groupBy("cob_dt").agg(F.count("*").alias("n"), zero(F.sum("amount")).alias("amount")), folder)


@query("snk10_log_rerun", "SELECT cob_dt, 'volume' AS suite, 'rows' AS check_name, CASE WHEN count(*) >= 5 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(count(*) AS VARCHAR) AS detail FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30' GROUP BY cob_dt")
def log_rerun(r: Roles) -> DataFrame:
    """A suite logged twice is in the log once."""
    from tierline.operators.reconcile import log_rows

    folder = _shared(r)
    counts = _week(r).groupBy("cob_dt").agg(F.count("*").alias("n"))
    rows = log_rows(counts, F.col("cob_dt"), "volume", F.lit("rows"), F.when(F.col("n") >= 5, "PASS").otherwise("FAIL"), F.col("n"))
    for _ in range(2):
        writes.replace_log(rows, f"{folder}/log")
    return _kept(r.spark.read.parquet(f"{folder}/log").select("cob_dt", "suite", "check_name", "status", "detail"), folder)


@query("src6_csv_settlement", "SELECT merchant_id, strftime(cob_dt, '%Y-%m') AS month, CAST(sum(amount) AS DECIMAL(18,2)) AS gross, count(*) AS txns, DATE '2001-06-30' AS cob_dt FROM card_txn WHERE status = 'SUCCESS' GROUP BY 1, 2")
def csv_settlement(r: Roles) -> DataFrame:
    """A settlement feed as files with a header, a separator of its own and a declared schema."""
    folder = _shared(r)
    rows = r.card_txn.where("status = 'SUCCESS'").groupBy("merchant_id", F.date_format("cob_dt", "yyyy-MM").alias("month")).agg(zero(F.sum("amount")).alias("gross"), F.count("*").alias("txns"))
    rows.write.option("header", True).option("sep", "|").csv(f"{folder}/feed")
    return _kept(specs.read_csv(r.spark, f"{folder}/feed/*.csv", DAY, "merchant_id bigint, month string, gross decimal(18,2), txns bigint", "|"), folder)


@query("src5_incremental_load", "SELECT txn_id, amount, cob_dt FROM account_txn WHERE cob_dt BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'")
def incremental_load(r: Roles) -> DataFrame:
    spec = specs.LoadSpec("account_txn", "orders", "incremental", "txn_ts")
    return specs.load(spec, lambda: r.account_txn.drop("cob_dt"), DAY, dt.date(2001, 6, 1)).select("txn_id", "amount", "cob_dt")


@query("snk3_append", "SELECT cob_dt, count(*) * 2 AS n, CAST(sum(amount) * 2 AS DECIMAL(18,2)) AS amount FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30' GROUP BY cob_dt")
def appended(r: Roles) -> DataFrame:
    """A month appended twice is there twice."""
    folder = _shared(r)
    for _ in range(2):
        writes.append(_week(r), f"{folder}/log", "cob_dt")
    return _kept(r.spark.read.parquet(f"{folder}/log").groupBy("cob_dt").agg(F.count("*").alias("n"), zero(F.sum("amount")).alias("amount")), folder)


@query("snk5_added_columns", "SELECT txn_id, CASE WHEN cob_dt < DATE '2001-06-15' THEN amount END AS amount, CASE WHEN cob_dt >= DATE '2001-06-15' THEN customer_id END AS customer_id FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'")
def added_columns(r: Roles) -> DataFrame:
    """Two logs with a column of their own each, as one that is written and read back."""
    folder, late = _shared(r), F.col("cob_dt") >= F.lit(DAY.replace(day=15))
    old, new = _week(r).where(~late).select("txn_id", "amount"), _week(r).where(late).select("txn_id", "customer_id")
    writes.add_missing(old, new).write.parquet(f"{folder}/log")
    return _kept(r.spark.read.parquet(f"{folder}/log"), folder)


@query("snk6_repartitioned", "SELECT cob_dt, count(*) AS n, count(*) AS planned FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30' GROUP BY cob_dt")
def repartitioned(r: Roles) -> DataFrame:
    """A table without partitions, planned first, then copied into partitions by day."""
    folder = _shared(r)
    plan = writes.repartition_table(_week(r), f"{folder}/days", dry_run=True).withColumnRenamed("n", "planned")
    writes.repartition_table(_week(r), f"{folder}/days")
    found = r.spark.read.parquet(f"{folder}/days").groupBy("cob_dt").agg(F.count("*").alias("n"))
    return _kept(found.join(plan, "cob_dt", "left"), folder)


@query("snk7_clustered", "SELECT count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount, true AS files_are_narrow FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'")
def clustered(r: Roles) -> DataFrame:
    """Files in z-order of two columns: each spans about half of either column's range, where unsorted ones span all."""
    folder = _shared(r)
    rows = _week(r).select("txn_id", F.col("amount").cast("double").alias("a"), F.col("customer_id").cast("double").alias("c"), "amount")
    writes.clustered(rows, ["a", "c"], 16).write.parquet(f"{folder}/z")
    back = r.spark.read.parquet(f"{folder}/z").withColumn("file", F.input_file_name())
    span = lambda c: F.max(c) - F.min(c)
    whole = back.agg(span("a").alias("wa"), span("c").alias("wc"), F.count("*").alias("n"), zero(F.sum("amount")).alias("amount"))
    files = back.groupBy("file").agg(span("a").alias("fa"), span("c").alias("fc")).agg(F.avg("fa").alias("fa"), F.avg("fc").alias("fc"))
    return _kept(whole.crossJoin(F.broadcast(files)).select("n", "amount", ((F.col("fa") * F.col("fc")) < F.col("wa") * F.col("wc") / 3).alias("files_are_narrow")), folder)


@query(
    "wn1_latest_copy",
    "SELECT txn_id, customer_id, amount, cob_dt FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY cob_dt DESC) AS rn FROM account_copies WHERE cob_dt BETWEEN DATE '2001-06-01' AND DATE '2001-06-30') WHERE rn = 1",
)
def newest_copies(r: Roles) -> DataFrame:
    """A month of stored days, some of whose rows came again, corrected, on a later day; a day after the month is stored too."""
    folder = _shared(r)
    rows = r.account_copies.where(F.col("cob_dt").between(F.lit(dt.date(2001, 6, 1)), F.lit(dt.date(2001, 7, 3))))
    writes.append(rows.select("txn_id", "customer_id", "amount", "cob_dt"), f"{folder}/days", "cob_dt")
    stored = r.spark.read.parquet(f"{folder}/days")
    return _kept(scd.latest_copy(stored, ["txn_id"], "cob_dt", DAY).select("txn_id", "customer_id", "amount", "cob_dt"), folder)


_LAYERS_SQL = """
    WITH b AS (SELECT * FROM account_copies WHERE cob_dt BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'),
    k AS (SELECT txn_id, count(*) AS n FROM b GROUP BY 1),
    s AS (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY cob_dt DESC) AS rn FROM b),
    g AS (SELECT customer_id, max(cob_dt) AS last FROM s WHERE rn = 1 GROUP BY 1)
    SELECT 'bronze.txn_account' AS layer, (SELECT count(*) FROM b) AS rows, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys, (SELECT max(cob_dt) FROM account_copies WHERE cob_dt BETWEEN DATE '2001-06-01' AND DATE '2001-07-02') AS newest_day,
           (SELECT count(*) FROM b WHERE cob_dt = DATE '2001-06-30') > 0 AS has_day,
           (SELECT count(*) FROM b WHERE CAST(txn_ts + INTERVAL 7 HOUR AS DATE) <> cob_dt) AS diverging, CAST(NULL AS BIGINT) AS expected,
           CASE WHEN (SELECT count(*) FROM b WHERE cob_dt = DATE '2001-06-30') = 0 THEN 'NO_DAY' WHEN (SELECT count(*) FROM b WHERE CAST(txn_ts + INTERVAL 7 HOUR AS DATE) <> cob_dt) > 0 THEN 'DIVERGING' ELSE 'OK' END AS status FROM k
    UNION ALL SELECT 'silver.fact_txn_account', count(*), count(DISTINCT txn_id), 0, max(cob_dt), count(*) FILTER (cob_dt = DATE '2001-06-30') > 0, NULL, (SELECT count(*) FROM k),
           CASE WHEN count(*) FILTER (cob_dt = DATE '2001-06-30') > 0 THEN 'OK' ELSE 'NO_DAY' END FROM s WHERE rn = 1
    UNION ALL SELECT 'silver.dim_customer', (SELECT count(*) FROM customer_versions), count(*), 0, NULL, NULL, NULL, count(*) + 1, 'COUNT' FROM customer_versions WHERE is_current = 1
    UNION ALL SELECT 'gold.spenders', count(*), count(*), 0, DATE '2001-06-30', true, NULL, NULL, 'OK' FROM g
    UNION ALL SELECT 'gold.stale', 0, 0, 0, DATE '2001-06-29', false, NULL, NULL, 'NO_DAY'"""


@query("dq23_layer_metrics", _LAYERS_SQL)
def layer_metrics(r: Roles) -> DataFrame:
    """A month through three layers, a mart whose day is missing, and a dimension of another size than expected."""
    folder = _shared(r)
    rows = r.account_copies.where(F.col("cob_dt").between(F.lit(dt.date(2001, 6, 1)), F.lit(dt.date(2001, 7, 2)))).select("txn_id", "customer_id", "txn_ts", "amount", "cob_dt")
    writes.append(rows, f"{folder}/bronze", "cob_dt")
    writes.append(scd.latest_copy(r.spark.read.parquet(f"{folder}/bronze"), ["txn_id"], "cob_dt", DAY), f"{folder}/fact", "cob_dt")
    r.customer_versions.write.parquet(f"{folder}/dimension")
    spent = r.spark.read.parquet(f"{folder}/fact").groupBy("customer_id").agg(zero(F.sum("amount")).alias("amount"))
    writes.append(spent.withColumn("cob_dt", F.lit(DAY)), f"{folder}/mart", "cob_dt")
    writes.append(spent.withColumn("cob_dt", F.lit(DAY - dt.timedelta(days=1))), f"{folder}/stale", "cob_dt")
    keys = rows.where(F.col("cob_dt") <= F.lit(DAY)).select("txn_id").distinct().count()
    customers = r.customer_versions.where("is_current = 1").count()
    layers = [
        invariants.Layer("bronze.txn_account", f"{folder}/bronze", ("txn_id",), "cob_dt", whole=True, ts="txn_ts"), invariants.Layer("silver.fact_txn_account", f"{folder}/fact", ("txn_id",), "cob_dt", whole=True, expected=keys),
        invariants.Layer("silver.dim_customer", f"{folder}/dimension", ("customer_id",), current="is_current = 1", expected=customers + 1), invariants.Layer("gold.spenders", f"{folder}/mart", ("customer_id",), "cob_dt"),
        invariants.Layer("gold.stale", f"{folder}/stale", ("customer_id",), "cob_dt"),
    ]
    return _kept(invariants.layer_report(r.spark, layers, DAY), folder)


@query(
    "dq15_drift_report",
    """SELECT 'account_txn' AS table_name, * FROM (VALUES ('amount', 'type', 'decimal(18,2)', 'decimal(20,2)', 'ADDITIVE'), ('channel', 'removed', 'string', '', 'BREAKING'), ('customer_id', 'type', 'bigint', 'string', 'BREAKING'),
      ('note', 'added', '', 'string', 'ADDITIVE')) AS v(column_name, change, declared, actual, severity)""",
)
def drift_report(r: Roles) -> DataFrame:
    """A table as it was declared against what its newest files hold: a column went, one came, one is wider, one means another thing."""
    folder = _shared(r)
    declared = r.account_txn.select("txn_id", "customer_id", "amount", "channel")
    now = declared.select("txn_id", F.col("customer_id").cast("string").alias("customer_id"), F.col("amount").cast("decimal(20,2)").alias("amount"), F.lit("x").alias("note"))
    now.write.parquet(f"{folder}/t")
    return _kept(drift_of(r.spark, "account_txn", declared.schema, r.spark.read.parquet(f"{folder}/t").schema), folder)


def _refused(run: Callable[[], object], error: type[Exception] = ValueError) -> bool:
    try:
        run()
    except error:
        return True
    return False


@query(
    "snk2_guarded_writes",
    "SELECT count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount, true AS flat_refused, true AS lost_column_refused, true AS changed_type_refused FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30'",
)
def guarded_writes(r: Roles) -> DataFrame:
    """Writes that would replace a whole table, lose a column or change what one means are refused, and leave the table as it was."""
    table, flat = _table(), _table()
    rows = _week(r)
    writes.overwrite_days(rows, table)
    rows.write.saveAsTable(flat)
    told = [_refused(lambda: writes.overwrite_days(rows, flat)), _refused(lambda: writes.overwrite_days(rows.drop("customer_id"), table), writes.SchemaBreak), _refused(lambda: writes.overwrite_days(rows.withColumn("amount", F.lit("x")), table), writes.SchemaBreak)]
    names = ("flat_refused", "lost_column_refused", "changed_type_refused")
    r.spark.sql(f"DROP TABLE {flat}")
    return _dropped(r.spark.table(table).agg(F.count("*").alias("n"), zero(F.sum("amount")).alias("amount")).withColumns({n: F.lit(t) for n, t in zip(names, told, strict=True)}), table)


@query(
    "mrg6_load_guards",
    "SELECT count(*) AS versions, CAST(sum(is_current) AS BIGINT) AS current_versions, true AS empty_refused, true AS earlier_refused FROM customer_versions",
)
def load_guards(r: Roles) -> DataFrame:
    """A load of nothing would close every version, and one of a day before the last would rewrite what is known: both are refused."""
    dimension, source = r.customer_versions, r.customer.select("customer_id", "segment")
    empty = _refused(lambda: scd.check_load(dimension, source.limit(0), DAY))
    earlier = _refused(lambda: scd.check_load(dimension, source, dt.date(1995, 1, 1)))
    return dimension.agg(F.count("*").alias("versions"), F.sum("is_current").cast("bigint").alias("current_versions")).withColumns({"empty_refused": F.lit(empty), "earlier_refused": F.lit(earlier)})
