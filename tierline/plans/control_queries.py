"""Queries of quality, reconciliation, privacy and dimension loads over the role tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions import privacy
from tierline.functions.columns import flag, money
from tierline.functions.time import business_date
from tierline.operators import checks, reconcile, scd
from tierline.operators.checks import Check
from tierline.plans.registry import query
from tierline.plans.roles import DAY, Roles

LOAD = dt.date(2001, 7, 1)


@query(
    "dq1_account_checks",
    """
    WITH x AS (SELECT count(*) AS n, count(*) FILTER (channel IS NULL) AS a, count(*) - count(DISTINCT txn_id) AS b, count(*) FILTER (amount < 1000 OR amount > 400000) AS c, count(*) FILTER (dc NOT IN ('D', 'C')) AS d,
                      count(*) FILTER (amount <= 0) AS e, count(*) FILTER (cob_dt > DATE '2001-06-30') AS f FROM account_txn)
    SELECT 'account_txn' AS table_name, u.name AS check_name, u.sev AS severity, CASE WHEN u.name = 'mystery' THEN 'SKIPPED' WHEN u.name = 'not_null:nothing' THEN 'FAIL' WHEN failed = 0 THEN 'PASS' WHEN sev = 'WARN' THEN 'WARN' ELSE 'FAIL' END AS status, failed, n AS total
    FROM x, LATERAL (VALUES ('row_count', 'FAIL', CAST(CASE WHEN n < 1 THEN 1 ELSE 0 END AS BIGINT)), ('not_null:channel', 'FAIL', a), ('unique:txn_id', 'FAIL', b), ('range:amount', 'WARN', c), ('accepted:dc', 'FAIL', d), ('positive:amount', 'FAIL', e), ('not_future:cob_dt', 'FAIL', f),
                            ('not_null:nothing', 'FAIL', NULL), ('mystery', 'FAIL', NULL)) AS u(name, sev, failed)""",
)
def account_checks(r: Roles) -> DataFrame:
    rules = [
        Check("row_count", low=1), Check("not_null", "channel"), Check("unique", "txn_id"), Check("range", "amount", 1000, 400_000, severity="WARN"), Check("accepted", "dc", values=("D", "C")), Check("positive", "amount"), Check("not_future", "cob_dt"),
        Check("not_null", "nothing"), Check("mystery"),
    ]
    return checks.run_checks(r.account_txn, "account_txn", rules, now=DAY)


@query("dq5_orphan_merchants", "SELECT DISTINCT card_id AS value FROM card_txn WHERE card_id NOT IN (SELECT merchant_id FROM merchant)")
def orphan_merchants(r: Roles) -> DataFrame:
    return checks.orphans(r.card_txn, "card_id", r.merchant, "merchant_id")


@query("dq6_key_reconciliation", "SELECT count(DISTINCT loan_id) AS expected, (SELECT count(DISTINCT loan_id) FROM payment) AS actual, CASE WHEN abs(count(DISTINCT loan_id) - (SELECT count(DISTINCT loan_id) FROM payment)) <= count(DISTINCT loan_id) * 0.02 THEN 'PASS' ELSE 'FAIL' END AS status FROM loan")
def key_reconciliation(r: Roles) -> DataFrame:
    n = lambda df, c: df.select("loan_id").distinct().agg(F.count("*").alias(c))
    rows = n(r.loan, "expected").crossJoin(n(r.payment, "actual"))
    return rows.withColumn("status", F.when(F.abs(F.col("expected") - F.col("actual")) <= F.col("expected") * 0.02, "PASS").otherwise("FAIL"))


@query(
    "dq9_volume_anomaly",
    """WITH c AS (SELECT cob_dt, count(*) AS n FROM account_txn WHERE cob_dt <= DATE '2001-06-30' GROUP BY cob_dt),
    x AS (SELECT CAST(coalesce(sum(CASE WHEN cob_dt = DATE '2001-06-30' THEN n END), 0) AS BIGINT) AS n, CAST(sum(CASE WHEN cob_dt < DATE '2001-06-30' THEN n END) AS DOUBLE) / count(*) FILTER (cob_dt < DATE '2001-06-30') AS mean FROM c)
    SELECT n, mean, CASE WHEN abs(n - mean) > mean * 0.3 THEN 'ANOMALY' ELSE 'NORMAL' END AS status FROM x""",
)
def volume_anomaly(r: Roles) -> DataFrame:
    return checks.volume_anomaly(r.account_txn, DAY, "cob_dt", 0.3)


@query(
    "dq10_outliers",
    """WITH s AS (SELECT channel, count(amount) AS n, CAST(sum(amount) AS DOUBLE) AS s, CAST(sum(amount * amount) AS DOUBLE) AS q FROM account_txn GROUP BY channel)
    SELECT txn_id, channel, amount FROM account_txn JOIN s USING (channel) WHERE n > 1 AND abs(CAST(amount AS DOUBLE) - s / n) > sqrt(greatest(0, (q - s * s / n) / (n - 1))) * 1.7""",
)
def outliers(r: Roles) -> DataFrame:
    return checks.outliers(r.account_txn, "amount", ["channel"], 1.7).select("txn_id", "channel", "amount")


@query("dq10_iqr_outliers", "WITH q AS (SELECT CAST(quantile_disc(amount, 0.25) AS DOUBLE) AS a, CAST(quantile_disc(amount, 0.75) AS DOUBLE) AS b FROM account_txn) SELECT txn_id, amount FROM account_txn, q WHERE CAST(amount AS DOUBLE) < a - (b - a) * 0.3 OR CAST(amount AS DOUBLE) > b + (b - a) * 0.3")
def iqr_outliers(r: Roles) -> DataFrame:
    return checks.iqr_outliers(r.account_txn, "amount", 0.3).select("txn_id", "amount")


@query("ag5_quartiles", "SELECT channel, quantile_disc(amount, 0.25) AS q1, quantile_disc(amount, 0.5) AS q2, quantile_disc(amount, 0.75) AS q3 FROM account_txn GROUP BY channel")
def channel_quartiles(r: Roles) -> DataFrame:
    return checks.quartiles(r.account_txn, "amount", ["channel"])


@query(
    "dq11_column_anomalies",
    """WITH x AS (SELECT min(amount) AS a, max(amount) AS b, max(hour) AS h FROM account_txn)
    SELECT 'amount' AS column_name, CASE WHEN a < 5000 OR b > 100000000 THEN 'WARN' ELSE 'PASS' END AS status, concat_ws('; ', CASE WHEN a < 5000 THEN 'below 5000' END, CASE WHEN b > 100000000 THEN 'above 100000000' END) AS details FROM x
    UNION ALL SELECT 'hour', CASE WHEN h > 23 THEN 'WARN' ELSE 'PASS' END, CASE WHEN h > 23 THEN 'above 23' ELSE '' END FROM x UNION ALL SELECT 'channel', 'WARN', 'type string, not int' UNION ALL SELECT 'nothing', 'FAIL', 'not found'""",
)
def column_anomalies(r: Roles) -> DataFrame:
    return checks.column_anomalies(r.account_txn, {"amount": ("decimal", 5000, 100_000_000), "hour": ("int", 0, 23), "channel": ("int", None, None), "nothing": (None, 0, 1)})


@query(
    "dq13_partition_freshness",
    """SELECT 'account_txn' AS table_name, max(cob_dt) AS newest, CAST(DATE '2001-08-04' - max(cob_dt) AS INTEGER) AS age_days, CASE WHEN DATE '2001-08-04' - max(cob_dt) <= 1 THEN 'PASS' ELSE 'FAIL' END AS status FROM account_txn
    UNION ALL SELECT 'card_txn', max(cob_dt), CAST(DATE '2001-08-04' - max(cob_dt) AS INTEGER), CASE WHEN DATE '2001-08-04' - max(cob_dt) <= 1 THEN 'PASS' ELSE 'FAIL' END FROM card_txn UNION ALL SELECT 'loan', NULL, NULL, 'WARN'""",
)
def partition_freshness(r: Roles) -> DataFrame:
    today = dt.date(2001, 8, 4)
    parts = [checks.partition_freshness(df, name, today) for name, df in (("account_txn", r.account_txn), ("card_txn", r.card_txn), ("loan", r.loan))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("dq12_freshness", "SELECT 'account_txn' AS table_name, CAST(epoch(TIMESTAMP '2001-08-10 00:00:00' - (CAST(max(cob_dt) AS TIMESTAMP) + INTERVAL 17 HOUR)) AS DOUBLE) / 3600.0 AS age_hours, CASE WHEN epoch(TIMESTAMP '2001-08-10 00:00:00' - (CAST(max(cob_dt) AS TIMESTAMP) + INTERVAL 17 HOUR)) / 3600.0 > 48 THEN 'FAIL' ELSE 'PASS' END AS status FROM account_txn")
def freshness(r: Roles) -> DataFrame:
    return checks.freshness(r.account_txn, "account_txn", "cob_dt", dt.datetime(2001, 8, 10), 48)


@query(
    "dq18_quarantine",
    """SELECT txn_id, amount, unnest(list_filter([CASE WHEN amount > 450000 THEN 'too_large' END, CASE WHEN hour < 2 AND dc = 'D' THEN 'night_debit' END], lambda x: x IS NOT NULL)) AS violation_type, 'account_txn' AS source_table FROM account_txn""",
)
def quarantine(r: Roles) -> DataFrame:
    rules = {"too_large": F.col("amount") > 450_000, "night_debit": (F.col("hour") < 2) & (F.col("dc") == "D")}
    return checks.violations(r.account_txn, rules, "account_txn", dt.datetime(2001, 7, 1)).select("txn_id", "amount", "violation_type", "source_table")


@query(
    "dq18_quarantine_status",
    """SELECT * FROM (SELECT 'too_large' AS violation_type, count(*) FILTER (amount > 450000) AS violations, CASE WHEN count(*) FILTER (amount > 450000) = 0 THEN 'PASS' ELSE 'QUARANTINED' END AS status FROM account_txn
    UNION ALL SELECT 'night_debit', count(*) FILTER (hour < 2 AND dc = 'D'), CASE WHEN count(*) FILTER (hour < 2 AND dc = 'D') = 0 THEN 'PASS' ELSE 'WARNED' END FROM account_txn)""",
)
def quarantine_status(r: Roles) -> DataFrame:
    return checks.quarantine_status(quarantine(r), {"too_large": "QUARANTINE", "night_debit": "WARN"})


@query("dq21_negative_balances", "SELECT customer_id, balance FROM dim_customer WHERE balance < 0")
def negative_balances(r: Roles) -> DataFrame:
    return r.customer.where("balance < 0").select("customer_id", "balance")


@query(
    "dq22_scd2_integrity",
    """WITH k AS (SELECT customer_id, count(*) AS v, sum(is_current) AS c, count(*) FILTER (effective_to = DATE '9999-12-31') AS o FROM customer_versions GROUP BY customer_id),
    o AS (SELECT count(*) AS n FROM customer_versions a JOIN customer_versions b ON a.customer_id = b.customer_id AND a.effective_from < b.effective_from AND b.effective_from <= a.effective_to)
    SELECT CAST(sum(v) AS BIGINT) AS versions, CAST(sum(c) AS BIGINT) AS current_rows, count(*) FILTER (c > 1) AS duplicate_current, CAST(sum(o) AS BIGINT) AS open_ended, any_value(o.n) AS overlapping FROM k, o""",
)
def scd2_integrity(r: Roles) -> DataFrame:
    return checks.scd2_integrity(r.customer_versions, ["customer_id"])


# Reconciliation.


@query(
    "rc1_three_way",
    """WITH n AS (SELECT (SELECT count(*) FROM account_txn) AS a, (SELECT count(*) FROM account_txn WHERE txn_id % 100 <> 0) AS b, (SELECT count(*) FROM account_txn) AS c)
    SELECT 'account' AS entity, u.k AS check_name, u.x AS expected, u.y AS actual, CASE WHEN abs(u.x - u.y) <= u.x * 0.001 THEN 'PASS' ELSE 'FAIL' END AS status FROM n, LATERAL (VALUES ('source_stream', a, b), ('source_batch', a, c), ('stream_batch', b, c)) AS u(k, x, y)""",
)
def three_way(r: Roles) -> DataFrame:
    return reconcile.three_way(r.account_txn, r.account_txn.where("txn_id % 100 <> 0"), r.account_txn, "account", 0.001)


@query("rc2_control_total", "SELECT 'loan' AS entity, CAST((SELECT sum(amount) FROM account_txn) AS DECIMAL(18,2)) AS expected, CAST((SELECT sum(loan_amount) FROM loan) AS DECIMAL(18,2)) AS actual, CASE WHEN (SELECT sum(amount) FROM account_txn) = (SELECT sum(loan_amount) FROM loan) THEN 'PASS' ELSE 'FAIL' END AS status")
def control_total(r: Roles) -> DataFrame:
    return reconcile.control_total(r.account_txn, r.loan.withColumnRenamed("loan_amount", "amount"), "amount", "loan")


@query(
    "rc3_merchant_paths",
    """WITH e AS (SELECT *, CASE WHEN merchant_id % 4 = 0 THEN 'USD' ELSE 'VND' END AS currency FROM event WHERE CAST(ts + INTERVAL 7 HOUR AS DATE) = DATE '2024-01-15' AND pay_channel IN ('QR', 'POS') AND merchant_id IS NOT NULL),
    p AS (SELECT 's' AS path, * FROM e UNION ALL SELECT 'b', * FROM e WHERE NOT (merchant_id = 3 AND event_id % 5 = 0) UNION ALL SELECT 't', * FROM e WHERE merchant_id <> 7),
    k AS (SELECT path, merchant_id, pay_channel, currency, count(*) FILTER (status = 'SUCCESS') AS n, coalesce(sum(amount) FILTER (status = 'SUCCESS'), 0) AS a, count(*) FILTER (status = 'SUCCESS' AND refund_flag = 1) AS f FROM p GROUP BY ALL),
    j AS (SELECT merchant_id, pay_channel, currency, u.metric, CAST(coalesce(max(CASE WHEN path = 's' THEN u.v END), 0) AS DECIMAL(18,2)) AS source, CAST(coalesce(max(CASE WHEN path = 'b' THEN u.v END), 0) AS DECIMAL(18,2)) AS batch, CAST(coalesce(max(CASE WHEN path = 't' THEN u.v END), 0) AS DECIMAL(18,2)) AS stream
          FROM k, LATERAL (VALUES ('success_count', CAST(n AS DECIMAL(18,2))), ('gross_amount', CAST(a AS DECIMAL(18,2))), ('refund_count', CAST(f AS DECIMAL(18,2)))) AS u(metric, v) GROUP BY ALL)
    SELECT *, CAST(stream - batch AS DECIMAL(18,2)) AS delta, CASE WHEN source = batch AND source = stream THEN 'PASS' ELSE 'FAIL' END AS status FROM j""",
)
def merchant_paths(r: Roles) -> DataFrame:
    """Source, batch fact and current stream state of one business day, by merchant, channel and currency; a key that a path lacks is 0 there."""
    paid = reconcile.cohort(r.event, dt.date(2024, 1, 15)).withColumn("currency", F.when(F.col("merchant_id") % 4 == 0, "USD").otherwise("VND"))
    good = F.col("status") == "SUCCESS"
    metrics = {"success_count": F.count_if(good), "gross_amount": F.sum(F.when(good, F.col("amount"))), "refund_count": F.count_if(good & (F.col("refund_flag") == 1))}
    paths = {"source": paid, "batch": paid.where("NOT (merchant_id = 3 AND event_id % 5 = 0)"), "stream": paid.where("merchant_id <> 7")}
    return reconcile.by_key(paths, ["merchant_id", "pay_channel", "currency"], metrics, absent=0).withColumn("delta", money(F.col("stream") - F.col("batch")))


def _settled(r: Roles) -> tuple[DataFrame, DataFrame]:
    """Daily sums of card payments, as a settlement file would have them, with faults by merchant."""
    txns = r.card_txn.where("status = 'SUCCESS'").select("merchant_id", "amount", F.date_format("cob_dt", "yyyy-MM").alias("month"))
    sums = txns.groupBy("merchant_id", "month").agg(money(F.sum("amount")).alias("gross_amount"), F.count("*").alias("txn_count"))
    k = F.col("merchant_id") % 10
    rows = sums.where(k != 1).select("merchant_id", "month", F.when(k == 2, F.col("gross_amount") + 5).otherwise(F.col("gross_amount")).cast("decimal(18,2)").alias("gross_amount"), (F.col("txn_count") + flag(k == 3)).alias("txn_count"))
    return txns.where(F.col("merchant_id") % 10 != 5), rows.unionByName(rows.where("merchant_id % 10 = 4"))


@query(
    "rc4_settlement",
    """WITH t AS (SELECT merchant_id, strftime(cob_dt, '%Y-%m') AS month, CAST(sum(amount) AS DECIMAL(18,2)) AS g, count(*) AS n FROM card_txn WHERE status = 'SUCCESS' GROUP BY ALL),
    s AS (SELECT merchant_id, month, CASE WHEN merchant_id % 10 = 2 THEN g + 5 ELSE g END AS g, n + CASE WHEN merchant_id % 10 = 3 THEN 1 ELSE 0 END AS n, CASE WHEN merchant_id % 10 = 4 THEN 2 ELSE 1 END AS copies FROM t WHERE merchant_id % 10 <> 1)
    SELECT merchant_id, month, a.g AS txn_gross, CAST(s.g * copies AS DECIMAL(18,2)) AS settled_gross, a.n AS txn_n, CAST(s.n * copies AS BIGINT) AS settled_n,
           CASE WHEN copies > 1 THEN 'DUPLICATE' WHEN a.n IS NULL THEN 'MISSING_TXN' WHEN copies IS NULL THEN 'MISSING_SETTLEMENT' WHEN abs(a.g - s.g) > 0.01 THEN 'GROSS_MISMATCH' WHEN a.n <> s.n THEN 'TXN_COUNT_MISMATCH' ELSE 'PASS' END AS outcome
    FROM (SELECT * FROM t WHERE merchant_id % 10 <> 5) a FULL JOIN s USING (merchant_id, month)""",
)
def settlement(r: Roles) -> DataFrame:
    return reconcile.settlement(*_settled(r), ["merchant_id", "month"])


@query(
    "rc5_loan_payments",
    """WITH d AS (SELECT loan_id, strftime(due, '%Y-%m') AS cob_dt, CAST(sum(scheduled) AS DECIMAL(18,2)) AS scheduled FROM payment GROUP BY ALL),
    i AS (SELECT loan_id, strftime(due, '%Y-%m') AS cob_dt, payment_id, count(*) AS copies, sum(paid) AS paid, max(CASE WHEN payment_status = 'LATE' THEN 1 ELSE 0 END) AS pending, min(CASE WHEN payment_status = 'MISSED' THEN 1 ELSE 0 END) AS missed FROM payment GROUP BY ALL),
    p AS (SELECT loan_id, cob_dt, CAST(sum(paid) AS DECIMAL(18,2)) AS paid, max(copies) AS copies, max(pending) AS pending, min(missed) AS missed FROM i GROUP BY ALL),
    o AS (SELECT loan_id, cob_dt, scheduled, paid, CASE WHEN paid IS NULL THEN 'MISSING_RIGHT' WHEN copies > 1 THEN 'NOT_COMPARABLE' WHEN pending = 1 THEN 'PENDING' WHEN missed = 1 THEN 'MISSING_RIGHT' WHEN abs(scheduled - paid) <= 3 THEN 'MATCHED' ELSE 'MISMATCH' END AS outcome FROM d LEFT JOIN p USING (loan_id, cob_dt))
    SELECT *, CASE outcome WHEN 'MATCHED' THEN 'PASS' WHEN 'PENDING' THEN 'WARN' WHEN 'NOT_COMPARABLE' THEN 'WARN' ELSE 'FAIL' END AS status FROM o""",
)
def loan_payments(r: Roles) -> DataFrame:
    rows = r.payment.withColumn("cob_dt", F.date_format("due", "yyyy-MM")).withColumn("payment_status", F.when(F.col("payment_status") == "LATE", "PENDING").otherwise(F.col("payment_status")))
    return reconcile.loan_payments(rows, rows, "3.00")


# Dimension loads: the source of the second day is the current customers with changes by key.


def _day_two(r: Roles) -> DataFrame:
    k = F.col("customer_id") % 20
    base = r.customer_versions.where("is_current = 1").select("customer_id", "full_name", "segment", "balance")
    return base.where(k != 9).select(
        "customer_id", F.when(k == 4, F.concat("full_name", F.lit(" X"))).otherwise(F.col("full_name")).alias("full_name"), F.when(k == 5, "NEW").when(k == 6, None).otherwise(F.col("segment")).alias("segment"), "balance"
    ).unionByName(base.where(k == 1).select((F.col("customer_id") + 10_000_000).alias("customer_id"), "full_name", "segment", "balance"))


_DAY_TWO = """
    base AS (SELECT customer_id, full_name, segment, balance FROM customer_versions WHERE is_current = 1),
    day_two AS (SELECT customer_id, CASE WHEN customer_id % 20 = 4 THEN full_name || ' X' ELSE full_name END AS full_name, CASE WHEN customer_id % 20 = 5 THEN 'NEW' WHEN customer_id % 20 = 6 THEN NULL ELSE segment END AS segment, balance FROM base WHERE customer_id % 20 <> 9
                UNION ALL SELECT customer_id + 10000000, full_name, segment, balance FROM base WHERE customer_id % 20 = 1)"""


@query(
    "mrg2_scd2_changes",
    f"""WITH {_DAY_TWO} SELECT coalesce(s.customer_id, t.customer_id) AS customer_id, CASE WHEN t.customer_id IS NULL THEN 'new' WHEN s.customer_id IS NULL THEN 'missing' WHEN s.segment IS DISTINCT FROM t.segment THEN 'tracked'
        WHEN s.full_name IS DISTINCT FROM t.full_name OR s.balance IS DISTINCT FROM t.balance THEN 'type1' ELSE 'same' END AS change FROM day_two s FULL JOIN base t ON s.customer_id = t.customer_id""",
)
def scd2_changes(r: Roles) -> DataFrame:
    current = r.customer_versions.where("is_current = 1").select("customer_id", "full_name", "segment", "balance")
    return scd.classify(current, _day_two(r), ["customer_id"], ["segment"])


@query(
    "mrg3_scd2_load",
    f"""WITH {_DAY_TWO}, c AS (SELECT v.*, s.customer_id AS k, s.full_name AS n, CASE WHEN v.is_current = 0 THEN 'old' WHEN s.customer_id IS NULL THEN 'missing' WHEN s.segment IS DISTINCT FROM v.segment THEN 'tracked' ELSE 'kept' END AS what FROM customer_versions v LEFT JOIN day_two s ON s.customer_id = v.customer_id)
    SELECT customer_id, CASE WHEN what = 'kept' THEN n ELSE full_name END AS full_name, segment, balance, effective_from, CASE WHEN what IN ('missing', 'tracked') THEN DATE '2001-06-30' ELSE effective_to END AS effective_to, CASE WHEN what IN ('missing', 'tracked') THEN 0 ELSE is_current END AS is_current, customer_sk FROM c
    UNION ALL SELECT s.customer_id, s.full_name, s.segment, s.balance, DATE '2001-07-01', DATE '9999-12-31', 1, sha256(s.customer_id || '|2001-07-01') FROM day_two s LEFT JOIN base t ON s.customer_id = t.customer_id WHERE t.customer_id IS NULL OR s.segment IS DISTINCT FROM t.segment""",
)
def scd2_load(r: Roles) -> DataFrame:
    return scd.apply_scd2(r.customer_versions.drop("branch_id"), _day_two(r), ["customer_id"], ["segment"], LOAD, "customer_sk")


@query("mrg1_scd1_upsert", f"WITH {_DAY_TWO} SELECT * FROM day_two UNION ALL SELECT * FROM base WHERE customer_id NOT IN (SELECT customer_id FROM day_two)")
def scd1_upsert(r: Roles) -> DataFrame:
    base = r.customer_versions.where("is_current = 1").select("customer_id", "full_name", "segment", "balance")
    return scd.upsert(base, _day_two(r), ["customer_id"])


@query("mrg5_scd2_rerun", f"""WITH {_DAY_TWO}, t AS (SELECT customer_id, count(*) AS n FROM customer_versions GROUP BY customer_id) SELECT coalesce(t.customer_id, s.customer_id) AS customer_id,
    CAST(coalesce(n, 0) + CASE WHEN s.customer_id IS NOT NULL AND (b.customer_id IS NULL OR s.segment IS DISTINCT FROM b.segment) THEN 1 ELSE 0 END AS BIGINT) AS versions FROM t FULL JOIN day_two s ON s.customer_id = t.customer_id LEFT JOIN base b ON b.customer_id = coalesce(t.customer_id, s.customer_id)""")
def scd2_rerun(r: Roles) -> DataFrame:
    """Loading a day twice leaves as many versions as loading it once."""
    once = scd2_load(r)
    twice = scd.apply_scd2(once, _day_two(r), ["customer_id"], ["segment"], LOAD, "customer_sk")
    return twice.groupBy("customer_id").agg(F.count("*").alias("versions"))


@query("mrg7_scd1_to_scd2", "SELECT sha256(merchant_id || '|1900-01-01') AS merchant_sk, merchant_id, merchant_name, DATE '1900-01-01' AS effective_from, DATE '9999-12-31' AS effective_to, 1 AS is_current FROM merchant")
def scd1_to_scd2(r: Roles) -> DataFrame:
    return scd.upgrade(r.merchant.select("merchant_id", "merchant_name"), ["merchant_id"], "merchant_sk")


def _change_log(r: Roles) -> DataFrame:
    """Events as a change log of customers: op by type, batch by day, offset by id."""
    op = F.when(F.col("event_type") == "error", "DELETE").when(F.col("event_type") == "signup", "INSERT").otherwise("UPDATE")
    return r.event.select("customer_id", "amount", op.alias("op"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), F.dayofmonth("ts").alias("batch_id"), F.col("event_id").alias("kafka_offset"))


_LOG = "log AS (SELECT customer_id, amount, CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS op, epoch_us(ts) // 1000 AS ts_ms, CAST(day(ts) AS INTEGER) AS batch_id, event_id AS kafka_offset FROM event)"


@query("mrg9_latest_change", f"WITH {_LOG} SELECT customer_id, amount, op, ts_ms, batch_id, kafka_offset FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts_ms DESC, batch_id DESC, kafka_offset DESC) AS k FROM log) WHERE k = 1")
def latest_change(r: Roles) -> DataFrame:
    return scd.latest_change(_change_log(r), ["customer_id"], ["ts_ms", "batch_id", "kafka_offset"])


@query(
    "mrg10_current_state",
    f"""WITH {_LOG}, k AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts_ms DESC, batch_id DESC, kafka_offset DESC) AS i FROM log) SELECT customer_id, amount, op, ts_ms, batch_id, kafka_offset FROM k WHERE i = 1 AND op <> 'DELETE'""",
)
def current_state(r: Roles) -> DataFrame:
    """Three incremental reads of the log, merged in turn, give what one read of it all gives."""
    log = _change_log(r)
    state, mark = None, None
    for head in (10, 20, 31):
        plan = scd.plan_read(mark, head)
        changes = scd.latest_change(scd.read_changes(log, plan), ["customer_id"], ["ts_ms", "batch_id", "kafka_offset"])
        state = changes if state is None else scd.merge_current(state, changes, ["customer_id"], "op", "ts_ms")
        mark = head
    return scd.live(state, "op")


@query(
    "mrg11_cdc_casts",
    """SELECT event_id, DATE '1970-01-01' + CAST(event_id % 20000 AS INTEGER) AS day, CASE WHEN event_id % 7 = 0 THEN NULL ELSE make_timestamp(CAST(event_id AS BIGINT) * 1000000) END AS at, TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'x' ELSE CAST(event_id AS VARCHAR) END AS INTEGER) AS n,
       TRY_CAST(CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(amount AS VARCHAR) END AS DECIMAL(18,2)) AS amount FROM event""",
)
def cdc_casts(r: Roles) -> DataFrame:
    text = r.event.select(
        "event_id", (F.col("event_id") % 20000).cast("string").alias("d"), F.when(F.col("event_id") % 7 == 0, "").otherwise((F.col("event_id") * 1_000_000).cast("string")).alias("u"),
        F.when(F.col("event_id") % 5 == 0, "x").otherwise(F.col("event_id").cast("string")).alias("i"), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("amount").cast("string")).alias("m"),
    )
    c = scd.cdc_cast
    return text.select("event_id", c("epoch_days", F.col("d")).alias("day"), c("epoch_micros", F.col("u")).cast("timestamp_ntz").alias("at"), c("int", F.col("i")).alias("n"), c("decimal", F.col("m")).alias("amount"))


@query("mrg13_resolve_quarantine", "SELECT loan_id, CASE WHEN loan_status = 'CLOSED' AND outstanding > 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE outstanding END AS outstanding, CASE WHEN loan_status = 'CLOSED' AND outstanding > 0 THEN 'CLOSED_RESOLVED' ELSE loan_status END AS loan_status FROM loan")
def resolve_quarantine(r: Roles) -> DataFrame:
    bad = r.loan.where("loan_status = 'CLOSED' AND outstanding > 0").select("loan_id", F.lit(True).alias("bad"))
    rows = r.loan.join(bad, "loan_id", "left")
    return rows.select("loan_id", money(F.when(F.col("bad"), F.lit(0)).otherwise(F.col("outstanding"))).alias("outstanding"), F.when(F.col("bad"), "CLOSED_RESOLVED").otherwise(F.col("loan_status")).alias("loan_status"))


@query("rc8_cdc_counts", f"WITH {_LOG} SELECT batch_id, count(*) AS events, count(DISTINCT customer_id) AS keys, count(*) FILTER (op = 'DELETE') AS deletes FROM log GROUP BY batch_id")
def cdc_counts(r: Roles) -> DataFrame:
    fine = _change_log(r).groupBy("batch_id", "customer_id").agg(F.count("*").alias("n"), F.count_if(F.col("op") == "DELETE").alias("d"))
    return fine.groupBy("batch_id").agg(F.sum("n").alias("events"), F.count("*").alias("keys"), F.sum("d").alias("deletes"))


# Privacy.


@query(
    "pv1_masked_customers",
    """SELECT customer_id, CASE WHEN len(string_split(n, ' ')) >= 3 THEN string_split(n, ' ')[1] || ' *** ' || string_split(n, ' ')[-1] WHEN len(string_split(n, ' ')) = 2 THEN string_split(n, ' ')[1] || ' ***' ELSE left(n, 1) || '***' END AS name,
       left(p, 3) || '****' || right(p, 3) AS phone, left(e, 1) || '***@' || split_part(e, '@', 2) AS email, sha256(CAST(customer_id AS VARCHAR) || 'pepper') AS customer_hash, CAST(floor(a / 10) * 10 AS INTEGER) AS age_decade
    FROM (SELECT customer_id, CASE customer_id % 3 WHEN 0 THEN full_name || ' Van An' WHEN 1 THEN full_name || ' Binh' ELSE full_name END AS n, '09' || lpad(CAST(customer_id AS VARCHAR), 8, '0') AS p, 'user' || customer_id || '@bank.example' AS e, customer_id % 80 AS a FROM dim_customer)""",
)
def masked_customers(r: Roles) -> DataFrame:
    k = F.col("customer_id") % 3
    rows = r.customer.select(
        "customer_id", F.when(k == 0, F.concat("full_name", F.lit(" Van An"))).when(k == 1, F.concat("full_name", F.lit(" Binh"))).otherwise(F.col("full_name")).alias("name"), F.concat(F.lit("09"), F.lpad(F.col("customer_id").cast("string"), 8, "0")).alias("phone"),
        F.concat(F.lit("user"), F.col("customer_id").cast("string"), F.lit("@bank.example")).alias("email"), (F.col("customer_id") % 80).alias("age"),
    )
    masked = privacy.apply_masks(rows, {"name": "name", "phone": "phone", "email": "email"})
    return masked.select("customer_id", "name", "phone", "email", privacy.join_hash(F.col("customer_id"), "pepper").alias("customer_hash"), privacy.decade(F.col("age")).alias("age_decade"))


@query("pv5_role_masks", "SELECT txn_id, CAST('****' || right(channel, 4) AS VARCHAR) AS channel, 'REDACTED' AS dc, date_trunc('year', cob_dt)::DATE AS cob_dt, CAST(NULL AS DECIMAL(18,2)) AS amount FROM account_txn")
def role_masks(r: Roles) -> DataFrame:
    roles = {"reader": (None, {"channel": "last4", "dc": "redacted"}), "auditor": ("reader", {"cob_dt": "year", "amount": "null"})}
    return privacy.masked_copy(r.account_txn, ["txn_id", "channel", "dc", "cob_dt", "amount"], privacy.policy_for(roles, "auditor"))


@query("prj1_serving_slice", "SELECT event_id, customer_id, amount FROM event WHERE CAST(ts + INTERVAL 7 HOUR AS DATE) = DATE '2024-01-15'")
def serving_slice(r: Roles) -> DataFrame:
    """The rows of the day asked for, never of the newest; a missing day is an error."""
    from tierline.sources.tables import serve_slice

    days = r.event.withColumn("cob_dt", business_date(F.col("ts")))
    return serve_slice(days, dt.date(2024, 1, 15)).select("event_id", "customer_id", "amount")


@query("fn1_scalar_functions", """SELECT txn_id, CAST(floor(date_diff('month', CAST(cob_dt AS DATE), DATE '2001-12-31')) AS INTEGER) AS m, strftime(cob_dt, '%Y-%m') AS month, greatest(amount, 1000.00::DECIMAL(18,2)) AS at_least, CAST(year(cob_dt) AS INTEGER) AS y,
    split_part(channel, '-', 1) AS code, CAST(length(channel) AS INTEGER) AS n FROM account_txn""")
def scalar_functions(r: Roles) -> DataFrame:
    months = (F.lit(2001) - F.year("cob_dt")) * 12 + 12 - F.month("cob_dt")
    return r.account_txn.select(
        "txn_id", months.alias("m"), F.date_format("cob_dt", "yyyy-MM").alias("month"), F.greatest("amount", F.lit(1000).cast("decimal(18,2)")).alias("at_least"), F.year("cob_dt").alias("y"), F.get(F.split("channel", "-"), F.lit(0)).alias("code"), F.length("channel").alias("n")
    )


@query("st14_stream_lag", "SELECT event_type, count(*) AS n, CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) - epoch_us(max(ts)) // 1000000 AS lag_seconds, count(*) FILTER (ts >= TIMESTAMP '2024-01-30 00:00:00') AS last_day FROM event GROUP BY event_type")
def stream_lag(r: Roles) -> DataFrame:
    now = F.lit(dt.datetime(2024, 1, 31)).cast("timestamp_ntz")
    lag = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.max("ts").cast("timestamp"))
    return r.event.groupBy("event_type").agg(F.count("*").alias("n"), lag.alias("lag_seconds"), F.count_if(F.col("ts") >= F.lit(dt.datetime(2024, 1, 30)).cast("timestamp_ntz")).alias("last_day"))


@query("dq20_daily_counts", "SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) AS day, count(*) AS n FROM event GROUP BY 1")
def daily_counts(r: Roles) -> DataFrame:
    return r.event.groupBy(business_date(F.col("ts")).alias("day")).agg(F.count("*").alias("n"))
