"""Queries of the operators that no mart uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import flag, zero
from tierline.operators import checks, contracts, reconcile
from tierline.plans.registry import query
from tierline.plans.roles import DAY, Roles
from tierline.plans.stream_queries import SPEC, _shared, envelopes
from tierline.sources import catalogues
from tierline.streaming import consolidate as con
from tierline.streaming import events as ev


@query("tk2_latest_per_type", "SELECT event_type, event_id, customer_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type, customer_id ORDER BY ts DESC, event_id DESC) AS k FROM event) WHERE k = 1")
def latest_per_type(r: Roles) -> DataFrame:
    last = F.max_by(F.struct("event_id", "ts"), F.struct("ts", "event_id"))
    return r.event.groupBy("event_type", "customer_id").agg(last.alias("e")).select("event_type", "e.event_id", "customer_id", "e.ts")


@query("tk3_ready_gate", "SELECT customer_id, CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END AS ready FROM (SELECT customer_id, status, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, event_id DESC) AS k FROM event) WHERE k = 1")
def ready_gate(r: Roles) -> DataFrame:
    """Whether the newest flag of each job says success."""
    return r.event.groupBy("customer_id").agg(flag(F.max_by("status", F.struct("ts", "event_id")) == "SUCCESS").alias("ready"))


@query(
    "jn11_recomputed_metrics",
    """WITH s AS (SELECT product, CAST(sum(outstanding) AS DECIMAL(18,2)) AS total FROM loan GROUP BY product), b AS (SELECT product, CAST(sum(outstanding) AS DECIMAL(18,2)) AS total FROM loan WHERE loan_id % 1000 <> 0 GROUP BY product)
    SELECT product, s.total AS stored, b.total AS recomputed, CASE WHEN s.total IS DISTINCT FROM b.total THEN 1 ELSE 0 END AS differs FROM s FULL JOIN b USING (product)""",
)
def recomputed_metrics(r: Roles) -> DataFrame:
    total = lambda df, n: df.groupBy("product").agg(zero(F.sum("outstanding")).alias(n))
    both = total(r.loan, "stored").join(total(r.loan.where("loan_id % 1000 <> 0"), "recomputed"), "product", "full_outer")
    return both.withColumn("differs", flag(~F.col("stored").eqNullSafe(F.col("recomputed"))))


@query(
    "rc9_failed_report",
    """SELECT cob_dt, 'volume' AS suite, 'rows' AS check_name, 'FAIL' AS status, CAST(n AS VARCHAR) AS detail FROM (SELECT cob_dt, count(*) AS n FROM account_txn GROUP BY cob_dt HAVING count(*) < 5) ORDER BY cob_dt DESC LIMIT 100""",
)
def failed_report(r: Roles) -> DataFrame:
    counts = r.account_txn.groupBy("cob_dt").agg(F.count("*").alias("n"))
    log = reconcile.log_rows(counts, F.col("cob_dt"), "volume", F.lit("rows"), F.when(F.col("n") >= 5, "PASS").otherwise("FAIL"), F.col("n"))
    return reconcile.report(log, "FAIL")


@query(
    "dq17_enforced_contract",
    """WITH x AS (SELECT count(*) AS n, count(*) FILTER (txn_id IS NULL) AS a, count(*) - count(DISTINCT txn_id) AS b, count(*) FILTER (amount < 0) AS c, count(*) FILTER (cob_dt > DATE '2001-06-30') AS d, count(*) FILTER (channel NOT IN ('1-URGENT', '2-HIGH')) AS e FROM account_txn)
    SELECT 'account_txn' AS table_name, u.k AS check_name, CASE WHEN failed = 0 THEN 'PASS' WHEN u.k = 'accepted:channel' THEN 'WARN' ELSE 'FAIL' END AS status, failed FROM x, LATERAL (VALUES ('row_count', CAST(CASE WHEN n < 1 THEN 1 ELSE 0 END AS BIGINT)), ('not_null:txn_id', a), ('unique:txn_id', b), ('range:amount', c), ('not_future:cob_dt', d), ('accepted:channel', e)) AS u(k, failed)""",
)
def enforced_contract(r: Roles) -> DataFrame:
    rules = catalogues.fact_rules("txn_id", "amount", ("1-URGENT", "2-HIGH"))
    return checks.run_checks(r.account_txn, "account_txn", rules, DAY).select("table_name", "check_name", "status", "failed")


@query("dq2_composite_unique", "SELECT order_id, line, count(*) AS copies FROM card_txn GROUP BY order_id, line HAVING count(*) > 1")
def composite_unique(r: Roles) -> DataFrame:
    return checks.duplicates(r.card_txn, ["order_id", "line"])


@query("flt3_as_of_slice", "SELECT customer_id, segment, effective_from FROM customer_versions WHERE DATE '2000-06-30' BETWEEN effective_from AND effective_to")
def as_of_slice(r: Roles) -> DataFrame:
    import datetime as dt

    from tierline.operators.scd import as_of

    return as_of(r.customer_versions, dt.date(2000, 6, 30)).select("customer_id", "segment", "effective_from")


@query(
    "mrg12_consolidated_state",
    """WITH e AS (SELECT event_id, customer_id, amount, event_type, event_id % 50 AS k, ts FROM event), v AS (SELECT * FROM e WHERE k NOT IN (6, 7, 8, 9, 10)),
    l AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS i FROM v) SELECT customer_id, event_id, amount FROM l WHERE i = 1 AND event_type <> 'error'""",
)
def consolidated_state(r: Roles) -> DataFrame:
    """The log consolidated in two runs, with a run in between that finds nothing new."""
    folder = _shared(r)
    spec = con.Consolidation("online", ("customer_id",), {})
    good = ev.valid(ev.validate(envelopes(r), SPEC), SPEC)
    log = good.withColumn("batch_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(2))
    con.consolidate(r.spark, log.where("batch_id = 1"), folder, spec, ("__cdc_timestamp_ms", "__kafka_offset"))
    con.consolidate(r.spark, log.where("batch_id = 1"), folder, spec, ("__cdc_timestamp_ms", "__kafka_offset"))
    con.consolidate(r.spark, log, folder, spec, ("__cdc_timestamp_ms", "__kafka_offset"))
    state = r.spark.read.parquet(con.last_mark(r.spark, f"{folder}/marks", "online")[1])
    from tierline.operators.scd import live

    return live(state, "__cdc_operation").select("customer_id", "event_id", "amount")


@query("st13_routed_events", "SELECT event_id, concat_ws('; ', CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'event_type: not allowed' END, CASE WHEN event_type IN ('click', 'view', 'purchase') AND event_id % 7 = 0 THEN 'fingerprint conflict' END) AS reason FROM events WHERE event_type NOT IN ('click', 'view', 'purchase') OR event_id % 7 = 0")
def routed_events(r: Roles) -> DataFrame:
    fields = {"event_id": ev.Field("bigint"), "event_type": ev.Field("string", enum=("click", "view", "purchase"))}
    payload = F.to_json(F.struct("event_id", "event_type"))
    batch = r.table("events").select(F.lit("online").alias("topic"), "event_id", ev.fingerprint(payload).alias("fingerprint"), F.col("event_id").alias("offset"), ev.contract_violations(payload, fields).alias("violations"))
    ledger = batch.where("event_id % 7 = 0").select("topic", "event_id", F.lit("another").alias("fingerprint"))
    return con.route(batch, "violations", ledger)[1].select("event_id", "reason")


@query("m29_versions_by_day", "SELECT effective_from, count(*) AS versions, CAST(sum(is_current) AS BIGINT) AS current_rows FROM (SELECT effective_from, is_current FROM customer_versions) GROUP BY effective_from")
def versions_by_day(r: Roles) -> DataFrame:
    return r.customer_versions.groupBy("effective_from").agg(F.count("*").alias("versions"), F.sum("is_current").cast("bigint").alias("current_rows"))


@query("m25_penalty_by_late_rate", "WITH l AS (SELECT loan_id, CAST(count(*) FILTER (payment_status = 'LATE') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate, sum(penalty) AS penalty FROM payment GROUP BY loan_id) SELECT CASE WHEN rate > 0.5 THEN 'high' WHEN rate > 0.2 THEN 'middle' ELSE 'low' END AS late_rate, count(*) AS loans, CAST(sum(penalty) AS DECIMAL(18,2)) AS penalty FROM l GROUP BY 1")
def penalty_by_late_rate(r: Roles) -> DataFrame:
    from tierline.functions.columns import ladder, ratio

    loans = r.payment.groupBy("loan_id").agg(ratio(F.count_if(F.col("payment_status") == "LATE"), F.count("*")).alias("rate"), F.sum("penalty").alias("penalty"))
    return loans.groupBy(ladder(F.col("rate"), [(0.5, "high"), (0.2, "middle")], "low", least=False).alias("late_rate")).agg(F.count("*").alias("loans"), zero(F.sum("penalty")).alias("penalty"))


@query(
    "dq17_whole_contract",
    """WITH x AS (
      SELECT count(*) AS n, count(*) FILTER (customer_id IS NULL) AS a, count(*) - count(DISTINCT (customer_id, txn_ts, channel)) AS b, count(*) FILTER (cob_dt > DATE '2001-06-30') AS c,
             CASE WHEN DATE '2001-06-30' - max(cob_dt) > 2 THEN 1 ELSE 0 END AS d, count(*) FILTER (amount < 1000 OR amount > 400000) AS e, count(*) FILTER (customer_id NOT IN (SELECT customer_id FROM dim_customer)) AS f
      FROM account_txn)
    SELECT 'account_txn' AS table_name, k AS check_name, severity, CASE WHEN failed = 0 THEN 'PASS' WHEN severity = 'WARN' THEN 'WARN' ELSE 'FAIL' END AS status, failed, total
    FROM x, LATERAL (VALUES ('row_count', 'FAIL', CAST(CASE WHEN n < 100 THEN 1 ELSE 0 END AS BIGINT), n), ('not_null:customer_id', 'FAIL', a, n), ('not_null:branch_code', 'FAIL', NULL, n), ('unique:customer_id,txn_ts,channel', 'WARN', b, n),
      ('not_future:cob_dt', 'FAIL', c, n), ('fresh:cob_dt', 'FAIL', CAST(d AS BIGINT), n), ('range:amount', 'WARN', e, n), ('references:customer_id', 'FAIL', f, n), ('references:channel', 'FAIL', NULL, NULL)) AS v(k, severity, failed, total)""",
)
def whole_contract(r: Roles) -> DataFrame:
    """Required columns, rows, a key of several columns, days not ahead and not too old, amounts, and keys in other tables, one of
    which is not there."""
    checks_ = (
        checks.Check("row_count", low=100), checks.Check("not_null", "customer_id"), checks.Check("not_null", "branch_code"), checks.Check("unique", "customer_id,txn_ts,channel", severity="WARN"), checks.Check("not_future", "cob_dt"),
        checks.Check("fresh", "cob_dt", high=2), checks.Check("range", "amount", low=1000, high=400_000, severity="WARN"),
    )
    contract = contracts.Contract("account_txn", checks_, (contracts.Reference("customer_id", "customer", "customer_id"), contracts.Reference("channel", "channels", "channel")))
    return contracts.enforce(contract, {"account_txn": r.account_txn, "customer": r.customer}.get, DAY)
