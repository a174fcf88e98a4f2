"""The silver layer by query: twelve dimensions loaded for two days, and six facts with the keys of their dimensions.

A snapshot is a base table seen with the dimension's columns; its expressions are plain SQL, the same for Spark and DuckDB.
Between the days some columns of some keys change, some keys go, and some come.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators import contracts
from tierline.operators.scd import OPEN_END, apply_scd2, as_of, upsert
from tierline.plans import customer_marts, merchant_marts
from tierline.plans.registry import ORACLES, query
from tierline.plans.roles import DAY, Roles
from tierline.sources.catalogues import GOLD_RULES, QUARANTINE, SILVER_RULES, Dimension, dimensions
from tierline.sources.shared import durable, shared_folder

FIRST, SECOND = dt.date(2001, 6, 1), dt.date(2001, 6, 30)
_MONEY = "DECIMAL(18,2)"

#: Of each dimension: its base table, and its columns by expression.
SNAPSHOTS: dict[str, tuple[str, Mapping[str, str]]] = {
    "dim_customer": ("customer", {
        "customer_id": "c_custkey", "cccd": "concat('079', lpad(CAST(c_custkey AS STRING), 9, '0'))", "full_name": "c_name", "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END", "date_of_birth": "DATE '1980-03-01'",
        "phone": "concat('09', lpad(CAST(c_custkey AS STRING), 8, '0'))", "email": "concat('c', CAST(c_custkey AS STRING), '@mail.example')", "address": "concat('No ', CAST(c_custkey % 200 AS STRING))", "city": "concat('City ', CAST(c_nationkey % 5 AS STRING))",
        "district": "concat('District ', CAST(c_nationkey AS STRING))", "branch_code": "concat('B', CAST(c_nationkey AS STRING))", "customer_segment": "c_mktsegment", "kyc_status": "CASE WHEN c_custkey % 4 = 0 THEN 'PENDING' ELSE 'VERIFIED' END",
        "register_date": "DATE '1995-01-01'", "is_active": "CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE 1 END"}),
    "dim_account": ("customer", {
        "account_id": "c_custkey * 10 + 1", "account_no": "concat('A', CAST(c_custkey AS STRING))", "customer_id": "c_custkey", "product_code": "concat('P', CAST(c_custkey % 20 AS STRING))", "branch_code": "concat('B', CAST(c_nationkey AS STRING))",
        "account_type": "CASE WHEN c_custkey % 3 = 0 THEN 'TIME_DEPOSIT' ELSE 'CASA' END", "currency": "'VND'", "balance": f"CAST(c_acctbal AS {_MONEY})", "open_date": "DATE '1996-01-01'", "close_date": "CASE WHEN c_custkey % 8 = 5 THEN DATE '2001-01-01' END",
        "status": "CASE WHEN c_custkey % 8 = 5 THEN 'CLOSED' ELSE 'ACTIVE' END"}),
    "dim_branch": ("nation", {
        "branch_code": "concat('B', CAST(n_nationkey AS STRING))", "branch_name": "n_name", "region": "concat('R', CAST(n_regionkey AS STRING))", "city": "concat('City ', CAST(n_nationkey % 5 AS STRING))", "district": "concat('District ', CAST(n_nationkey AS STRING))",
        "address": "concat('Square ', CAST(n_nationkey AS STRING))", "manager_name": "CASE WHEN n_nationkey % 6 = 1 THEN '' ELSE concat('Manager ', CAST(n_nationkey AS STRING)) END", "open_date": "DATE '1990-01-01'", "status": "CASE WHEN n_nationkey % 7 = 3 THEN 'CLOSED' ELSE 'OPEN' END"}),
    "dim_product": ("part", {
        "product_code": "concat('P', CAST(p_partkey AS STRING))", "product_name": "p_name", "product_group": "p_brand", "product_type": "p_type", "currency": "'VND'", "is_active": "CASE WHEN p_size % 5 = 0 THEN 0 ELSE 1 END", "launch_date": "DATE '1997-01-01'"}),
    "dim_merchant": ("supplier", {
        "merchant_id": "s_suppkey", "merchant_name": "s_name", "merchant_category": "concat('Category ', CAST(s_nationkey % 5 AS STRING))", "mcc_code": "CAST(5000 + s_nationkey % 5 AS STRING)", "city": "concat('City ', CAST(s_nationkey % 5 AS STRING))",
        "state": "concat('State ', CAST(s_nationkey AS STRING))", "risk_category": "CASE WHEN s_acctbal < 0 THEN 'HIGH' ELSE 'LOW' END", "is_active": "1"}),
    "dim_store": ("supplier", {
        "store_id": "s_suppkey * 2", "merchant_id": "s_suppkey", "store_name": "concat(s_name, ' store')", "store_type": "CASE WHEN s_suppkey % 3 = 0 THEN 'ONLINE' ELSE 'SHOP' END", "address": "concat('Street ', CAST(s_suppkey AS STRING))",
        "city": "concat('City ', CAST(s_nationkey % 5 AS STRING))", "district": "concat('District ', CAST(s_nationkey AS STRING))", "is_active": "1"}),
    "dim_card": ("customer", {
        "card_id": "c_custkey * 10 + 1", "card_no_masked": "concat('****', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))", "customer_id": "c_custkey", "account_id": "c_custkey * 10 + 1", "product_code": "concat('P', CAST(c_custkey % 20 AS STRING))",
        "card_type": "CASE WHEN c_custkey % 4 = 0 THEN 'DEBIT' ELSE 'CREDIT' END", "card_brand": "'LOCAL'", "credit_limit": f"CAST((c_custkey % 50 + 1) * 1000 AS {_MONEY})", "issue_date": "DATE '2000-01-01'", "expiry_date": "DATE '2005-01-01'",
        "status": "CASE WHEN c_custkey % 6 = 1 THEN 'BLOCKED' ELSE 'ACTIVE' END"}),
    "dim_deposit": ("customer", {
        "deposit_id": "c_custkey * 10 + 2", "account_id": "c_custkey * 10 + 1", "customer_id": "c_custkey", "product_code": "concat('P', CAST(c_custkey % 20 AS STRING))", "principal_amount": f"CAST(abs(c_acctbal) AS {_MONEY})", "interest_rate": "CAST(0.05 AS DECIMAL(5,4))",
        "term_months": "CAST(12 + c_custkey % 24 AS INT)", "open_date": "DATE '2000-06-01'", "maturity_date": "DATE '2002-06-01'", "status": "'ACTIVE'"}),
    "dim_device": ("customer", {
        "device_id": "c_custkey * 3", "customer_id": "c_custkey", "device_type": "CASE WHEN c_custkey % 2 = 0 THEN 'PHONE' ELSE 'TABLET' END", "device_fingerprint": "concat('f', CAST(c_custkey * 7919 AS STRING))", "operating_system": "CASE WHEN c_custkey % 3 = 0 THEN 'A' ELSE 'B' END",
        "ip_address": "concat('10.0.', CAST(c_custkey % 256 AS STRING), '.1')", "is_trusted": "CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END", "first_seen": "DATE '2000-01-01'", "last_seen": "DATE '2001-05-31'"}),
    "dim_employee": ("supplier", {
        "employee_id": "s_suppkey", "full_name": "concat('Employee ', CAST(s_suppkey AS STRING))", "branch_code": "concat('B', CAST(s_nationkey AS STRING))", "role": "CASE WHEN s_suppkey % 4 = 0 THEN 'MANAGER' ELSE 'TELLER' END", "hire_date": "DATE '1999-01-01'",
        "salary": f"CAST(abs(s_acctbal) AS {_MONEY})", "status": "'ACTIVE'"}),
    "dim_loan": ("orders", {
        "loan_id": "o_orderkey", "customer_id": "o_custkey", "product_code": "concat('P', CAST(o_orderkey % 20 AS STRING))", "branch_code": "concat('B', CAST(o_orderkey % 25 AS STRING))", "loan_amount": f"CAST(o_totalprice AS {_MONEY})",
        "outstanding_balance": f"CAST(CAST(o_totalprice AS {_MONEY}) * CAST(o_orderkey % 7 AS INT) AS {_MONEY})", "interest_rate": "CAST(0.09 AS DECIMAL(5,4))", "term_months": "CAST(6 + o_orderkey % 60 AS INT)", "disbursement_date": "CAST(o_orderdate AS DATE)",
        "maturity_date": "DATE '2010-01-01'", "loan_status": "CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' WHEN o_orderstatus = 'P' THEN 'OVERDUE' ELSE 'ACTIVE' END"}),
    "dim_location": ("nation", {
        "location_id": "n_nationkey", "merchant_name": "concat('Place ', CAST(n_nationkey AS STRING))", "merchant_category": "'SHOP'", "city": "n_name", "state": "n_name", "latitude": "CAST(n_nationkey AS DOUBLE)", "longitude": "CAST(n_regionkey AS DOUBLE)",
        "is_high_risk_area": "CASE WHEN n_nationkey % 7 = 0 THEN 1 ELSE 0 END"}),
}

#: Of each dimension: the base table's key; a column that differs on the second day for every fifth key, with what it is then; and one of type 1 for every fifth + 2.
CHANGES: dict[str, tuple[str, str, str, str | None, str | None]] = {
    "dim_customer": ("c_custkey", "city", "'Moved'", "is_active", "0"),
    "dim_account": ("c_custkey", "status", "'FROZEN'", "currency", "'USD'"),
    "dim_branch": ("n_nationkey", "manager_name", "'New manager'", None, None),
    "dim_product": ("p_partkey", "product_group", "'NEW'", None, None),
    "dim_merchant": ("s_suppkey", "risk_category", "'MEDIUM'", None, None),
    "dim_store": ("s_suppkey", "store_type", "'KIOSK'", None, None),
    "dim_card": ("c_custkey", "status", "'LOST'", None, None),
    "dim_deposit": ("c_custkey", "status", "'CLOSED'", None, None),
    "dim_device": ("c_custkey", "is_trusted", "0", None, None),
    "dim_employee": ("s_suppkey", "status", "'LEFT'", None, None),
    "dim_loan": ("o_orderkey", "loan_status", "'CLOSED'", None, None),
    "dim_location": ("n_nationkey", "is_high_risk_area", "1", None, None),
}


def snapshot_sql(name: str, second: bool) -> str:
    """A snapshot: on the first day keys that leave a rest of 3 by 11 are not there yet, on the second those of 5 are gone."""
    base, columns = SNAPSHOTS[name]
    key, tracked, then, other, other_then = CHANGES[name]
    told = dict(columns)
    if second:
        told[tracked] = f"CASE WHEN {key} % 5 = 0 THEN {then} ELSE {told[tracked]} END"
        if other:
            told[other] = f"CASE WHEN {key} % 5 = 2 THEN {other_then} ELSE {told[other]} END"
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in told.items())} FROM {base} WHERE {key} % 11 <> {5 if second else 3}"


def snapshot(r: Roles, name: str, second: bool) -> DataFrame:
    base, _ = SNAPSHOTS[name]
    return r.spark.sql(snapshot_sql(name, second).replace(f" FROM {base} ", " FROM {base} "), base=r.table(base))


def initial(d: Dimension, source: DataFrame, day: dt.date) -> DataFrame:
    """A type 2 dimension after its first load."""
    empty = source.limit(0).select(F.lit("").alias(d.sk), *source.columns, F.lit(day).alias("effective_from"), F.lit(day).alias("effective_to"), F.lit(1).alias("is_current"))
    return apply_scd2(empty, source, [d.key], list(d.tracked), day, d.sk, d.close_missing)


def dimension(r: Roles, d: Dimension) -> DataFrame:
    """The dimension after the loads of both days."""
    first, second = snapshot(r, d.name, False), snapshot(r, d.name, True)
    if not d.tracked:
        return upsert(first, second, [d.key])
    return apply_scd2(initial(d, first, FIRST), second, [d.key], list(d.tracked), SECOND, d.sk, d.close_missing)


def _dimension_sql(d: Dimension) -> str:
    columns = list(SNAPSHOTS[d.name][1])
    days = f"WITH one AS ({snapshot_sql(d.name, False)}), two AS ({snapshot_sql(d.name, True)})"
    if not d.tracked:
        return f"{days} SELECT * FROM two UNION ALL SELECT * FROM one WHERE {d.key} NOT IN (SELECT {d.key} FROM two)"
    others = [c for c in columns if c != d.key and c not in d.tracked]
    differ = " OR ".join(f"one.{c} IS DISTINCT FROM two.{c}" for c in d.tracked)
    sk = lambda day: f"sha256(concat(CAST({d.key} AS STRING), '|{day}'))"
    kept = ", ".join(f"CASE WHEN kept AND k IS NOT NULL THEN new_{c} ELSE {c} END AS {c}" if c in others else c for c in columns)
    pairs = f"SELECT one.*, two.{d.key} AS k, NOT ({differ}) AS kept{''.join(f', two.{c} AS new_{c}' for c in others)} FROM one LEFT JOIN two ON one.{d.key} = two.{d.key}"
    return f"""{days}, pairs AS ({pairs})
    SELECT {sk(FIRST)} AS {d.sk}, {kept}, DATE '{FIRST}' AS effective_from, CASE WHEN k IS NULL OR NOT kept THEN DATE '{SECOND - dt.timedelta(days=1)}' ELSE DATE '{OPEN_END}' END AS effective_to, CASE WHEN k IS NULL OR NOT kept THEN 0 ELSE 1 END AS is_current FROM pairs
    UNION ALL
    SELECT {sk(SECOND)}, {', '.join(columns)}, DATE '{SECOND}', DATE '{OPEN_END}', 1 FROM two WHERE {d.key} NOT IN (SELECT {d.key} FROM pairs WHERE kept)"""


for _d in dimensions():
    query(f"m29_{_d.name}", _dimension_sql(_d))(lambda r, d=_d: dimension(r, d))


# Facts.


def with_keys(fact: DataFrame, lookups: list[tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """fact with columns of its dimensions, one lookup after the other; a key that a dimension lacks gives null, and the row stays."""
    for rows, on, columns in lookups:
        fact = fact.join(rows.select(on, *columns), on, "left")
    return fact


def stored(r: Roles, d: Dimension) -> DataFrame:
    """The dimension as its loads have left it in the shared folder; where they have not run in this session, they do so now."""
    path = f"{shared_folder(r.spark)}/dimensions-{hashlib.sha256(r.folder.encode()).hexdigest()[:16]}/{d.name}"
    place = r.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not place.getFileSystem(r.spark._jsc.hadoopConfiguration()).exists(place):
        dimension(r, d).write.mode("overwrite").parquet(path)
    return r.spark.read.parquet(path)


def _current(r: Roles, name: str) -> DataFrame:
    """The versions of a dimension that hold on DAY, from the stored dimension."""
    d = next(x for x in dimensions() if x.name == name)
    rows = stored(r, d)
    return as_of(rows, DAY) if d.tracked else rows


def _as_of_sql(name: str) -> str:
    d = next(x for x in dimensions() if x.name == name)
    body = _dimension_sql(d)
    return f"{d.name}_held AS (SELECT * FROM ({body}){f' WHERE DATE {chr(39)}{DAY}{chr(39)} BETWEEN effective_from AND effective_to' if d.tracked else ''})"


_IN_MONTH = "cob_dt BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'"
_CUSTOMER = _as_of_sql("dim_customer")


@query("m28_fact_txn_account", f"WITH {_CUSTOMER}, {_as_of_sql('dim_account')} SELECT t.txn_id, t.customer_id, customer_sk, t.customer_id * 10 + 1 AS account_id, account_sk, t.txn_ts, t.amount AS txn_amount, t.dc AS debit_credit, t.channel, t.cob_dt FROM account_txn t LEFT JOIN dim_customer_held c ON t.customer_id = c.customer_id LEFT JOIN dim_account_held a ON t.customer_id * 10 + 1 = a.account_id WHERE {_IN_MONTH}")
def fact_txn_account(r: Roles) -> DataFrame:
    rows = r.account_txn.where(_IN_MONTH).withColumn("account_id", F.col("customer_id") * 10 + 1)
    told = with_keys(rows, [(_current(r, "dim_customer"), "customer_id", ["customer_sk"]), (_current(r, "dim_account"), "account_id", ["account_sk"])])
    return told.select("txn_id", "customer_id", "customer_sk", "account_id", "account_sk", "txn_ts", F.col("amount").alias("txn_amount"), F.col("dc").alias("debit_credit"), "channel", "cob_dt")


@query("m28_fact_card_txn", f"WITH {_CUSTOMER} SELECT t.txn_id, t.card_id, t.customer_id, customer_sk, t.txn_ts, t.amount AS txn_amount, t.txn_type, t.pay_channel AS channel, t.status, t.cob_dt FROM card_txn t LEFT JOIN dim_customer_held c ON t.customer_id = c.customer_id WHERE {_IN_MONTH}")
def fact_card_txn(r: Roles) -> DataFrame:
    told = with_keys(r.card_txn.where(_IN_MONTH), [(_current(r, "dim_customer"), "customer_id", ["customer_sk"])])
    return told.select("txn_id", "card_id", "customer_id", "customer_sk", "txn_ts", F.col("amount").alias("txn_amount"), "txn_type", F.col("pay_channel").alias("channel"), "status", "cob_dt")


@query("m28_fact_online_transaction", f"WITH {_CUSTOMER} SELECT t.txn_id AS transaction_id, t.device_id, t.location_id, t.customer_id, customer_sk, t.channel, t.amount, t.is_fraud, t.fraud_reason, t.status, t.ts AS transaction_date, t.cob_dt FROM online t LEFT JOIN dim_customer_held c ON t.customer_id = c.customer_id WHERE {_IN_MONTH}")
def fact_online_transaction(r: Roles) -> DataFrame:
    told = with_keys(r.online.where(_IN_MONTH), [(_current(r, "dim_customer"), "customer_id", ["customer_sk"])])
    return told.select(F.col("txn_id").alias("transaction_id"), "device_id", "location_id", "customer_id", "customer_sk", "channel", "amount", "is_fraud", "fraud_reason", "status", F.col("ts").alias("transaction_date"), "cob_dt")


@query("m28_fact_loan_payment", f"WITH {_CUSTOMER}, {_as_of_sql('dim_loan')} SELECT p.payment_id, p.loan_id, l.product_code, l.branch_code, l.customer_id, customer_sk, p.due AS payment_date, p.scheduled AS scheduled_amount, p.paid AS amount_paid, p.penalty, p.days_late, p.payment_status FROM payment p LEFT JOIN dim_loan_held l ON p.loan_id = l.loan_id LEFT JOIN dim_customer_held c ON l.customer_id = c.customer_id")
def fact_loan_payment(r: Roles) -> DataFrame:
    """A chained lookup: loan, then the loan's customer; rows without either stay."""
    told = with_keys(r.payment, [(_current(r, "dim_loan"), "loan_id", ["product_code", "branch_code", "customer_id"]), (_current(r, "dim_customer"), "customer_id", ["customer_sk"])])
    return told.select("payment_id", "loan_id", "product_code", "branch_code", "customer_id", "customer_sk", F.col("due").alias("payment_date"), F.col("scheduled").alias("scheduled_amount"), F.col("paid").alias("amount_paid"), "penalty", "days_late", "payment_status")


@query("m28_fact_crm_interaction", f"WITH {_CUSTOMER} SELECT t.interaction_id, t.customer_id, customer_sk, t.ts AS interaction_date, t.cob_dt FROM interaction t LEFT JOIN dim_customer_held c ON t.customer_id = c.customer_id")
def fact_crm_interaction(r: Roles) -> DataFrame:
    told = with_keys(r.interaction, [(_current(r, "dim_customer"), "customer_id", ["customer_sk"])])
    return told.select("interaction_id", "customer_id", "customer_sk", F.col("ts").alias("interaction_date"), "cob_dt")


@query("m28_fact_support_ticket", f"WITH {_CUSTOMER} SELECT t.txn_id AS ticket_id, t.customer_id, customer_sk, coalesce(t.fraud_reason, 'FAILED_PAYMENT') AS issue_type, CASE WHEN t.amount > 50 THEN 'HIGH' ELSE 'LOW' END AS priority, t.ts AS date_opened, t.cob_dt FROM online t LEFT JOIN dim_customer_held c ON t.customer_id = c.customer_id WHERE t.status = 'FAILED'")
def fact_support_ticket(r: Roles) -> DataFrame:
    told = with_keys(r.online.where("status = 'FAILED'"), [(_current(r, "dim_customer"), "customer_id", ["customer_sk"])])
    return told.select(F.col("txn_id").alias("ticket_id"), "customer_id", "customer_sk", F.coalesce("fraud_reason", F.lit("FAILED_PAYMENT")).alias("issue_type"), F.when(F.col("amount") > 50, "HIGH").otherwise("LOW").alias("priority"), F.col("ts").alias("date_opened"), "cob_dt")


# Rules over the layer.


def _quarantine_sql() -> str:
    tables = {v.table for v in QUARANTINE if v.table != "fact_txn_account"}
    held = ", ".join(_as_of_sql(t) for t in sorted(tables))
    fact = "fact_txn_account_held AS (SELECT txn_id, amount * 1000 AS txn_amount, CASE WHEN txn_id % 13 = 0 THEN NULL ELSE channel END AS channel, dc AS txn_type, txn_ts AS txn_date FROM account_txn)"
    parts = [f"SELECT '{v.table}' AS source_table, '{v.name}' AS violation_type, '{v.severity}' AS severity, count(*) FILTER ({v.condition.format(today=f'DATE {chr(39)}{DAY}{chr(39)}', now=f'TIMESTAMP {chr(39)}2001-06-30 23:00:00{chr(39)}')}) AS violations FROM {v.table}_held" for v in QUARANTINE]
    return f"WITH {held}, {fact} " + " UNION ALL ".join(parts)


@query("dq18_all_violations", _quarantine_sql())
def all_violations(r: Roles) -> DataFrame:
    """The 18 rules of quarantine, all those of a table in one aggregation over it."""
    at = {"today": f"DATE '{DAY}'", "now": "TIMESTAMP_NTZ '2001-06-30 23:00:00'"}
    out = None
    for table in dict.fromkeys(v.table for v in QUARANTINE):
        rows = _current(r, table) if table != "fact_txn_account" else r.account_txn.select("txn_id", (F.col("amount") * 1000).alias("txn_amount"), F.when(F.col("txn_id") % 13 != 0, F.col("channel")).alias("channel"), F.col("dc").alias("txn_type"), F.col("txn_ts").alias("txn_date"))
        own = [v for v in QUARANTINE if v.table == table]
        counts = rows.agg(*[F.count_if(F.expr(v.condition.format(**at))).alias(v.name) for v in own])
        told = counts.select(F.explode(F.array(*[F.struct(F.lit(table).alias("source_table"), F.lit(v.name).alias("violation_type"), F.lit(v.severity).alias("severity"), F.col(v.name).alias("violations")) for v in own])).alias("v")).select("v.*")
        out = told if out is None else out.unionByName(told)
    return out


def _parents_sql() -> str:
    held, parts = {}, []
    for d in dimensions():
        for column, parent, parent_key in d.parents:
            held |= {d.name: _as_of_sql(d.name), parent: _as_of_sql(parent)}
            parts.append(f"SELECT '{d.name}' AS table_name, '{column}' AS column_name, '{parent}' AS parent, count(*) AS orphans FROM {d.name}_held WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_key} FROM {parent}_held)")
    return "WITH " + ", ".join(held.values()) + " " + " UNION ALL ".join(parts)


@query("dq8_references", _parents_sql())
def references(r: Roles) -> DataFrame:
    """Of every dimension and parent in the catalogue: rows whose key the parent lacks."""
    held = {d.name: _current(r, d.name) for d in dimensions()}
    out = None
    for d in dimensions():
        for column, parent, key in d.parents:
            known = held[parent].select(F.col(key).alias("_known")).distinct()
            lost = held[d.name].where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_known"), "left_anti")
            told = lost.agg(F.lit(d.name).alias("table_name"), F.lit(column).alias("column_name"), F.lit(parent).alias("parent"), F.count("*").alias("orphans"))
            out = told if out is None else out.unionByName(told)
    return out


#: Facts and marts that the catalogue's rules are held against, with the query of each; the dimensions are the stored ones.
_RULED = {
    "fact_txn_account": ("m28_fact_txn_account", fact_txn_account), "fact_card_txn": ("m28_fact_card_txn", fact_card_txn), "fact_crm_interaction": ("m28_fact_crm_interaction", fact_crm_interaction),
    "fact_online_transaction": ("m28_fact_online_transaction", fact_online_transaction), "fact_support_ticket": ("m28_fact_support_ticket", fact_support_ticket), "customer_balance_summary": ("m2_balance_summary", customer_marts.balance_summary),
    "customer_card_summary": ("m3_card_summary", customer_marts.card_summary), "customer_product_summary": ("m5_product_summary", customer_marts.product_summary), "mart_branch_monthly_summary": ("m16_branch_monthly", merchant_marts.branch_monthly),
    "cross_sell_segment": ("m10_cross_sell", customer_marts.cross_sell),
}
_HELD = {d.name for d in dimensions()}
_RULES = [c for c in (*SILVER_RULES, *GOLD_RULES) if c.table in _RULED or c.table in _HELD]
_SOURCES = {"core_customer": ("dim_customer", "customer_id"), "core_txn_account": ("account_txn", "txn_id")}


def _rules_sql() -> str:
    """Every rule of the catalogue as a row: what fails it and of how many."""
    held, parts = {}, []

    def of(name: str) -> str:
        held.setdefault(name, _as_of_sql(name) if name in _HELD else f"{name}_held AS ({ORACLES[_RULED[name][0]]})")
        return f"{name}_held"

    columns = {c.table: set(_columns_of(c.table)) for c in _RULES}
    for c in _RULES:
        table, told = of(c.table), []
        for check in c.checks:
            failed = {
                "row_count": "CASE WHEN count(*) < 1 THEN 1 ELSE 0 END", "not_null": f"count(*) FILTER ({check.column} IS NULL)", "range": f"count(*) FILTER ({check.column} < 0)",
                "unique": f"count(*) - count(DISTINCT {check.column}) - max(CASE WHEN {check.column} IS NULL THEN 1 ELSE 0 END)",
            }[check.kind]
            told.append((check.name, check.severity, failed if check.column is None or check.column in columns[c.table] else "NULL"))
        parts += [f"SELECT '{c.table}' AS table_name, '{n}' AS check_name, '{s}' AS severity, CAST({f} AS BIGINT) AS failed, count(*) AS total FROM {table}" for n, s, f in told]
        for x in c.references:
            parts.append(f"SELECT '{c.table}', '{x.name}', '{x.severity}', count(*) FILTER ({x.column} NOT IN (SELECT {x.parent_column} FROM {of(x.parent)})), count(*) FROM {table} WHERE {x.column} IS NOT NULL")
        for x in c.reconciliations:
            source, key = _SOURCES[x.source]
            keys = f"(SELECT count(DISTINCT {key}) FROM {source})"
            parts.append(f"SELECT '{c.table}', '{x.name}', '{x.severity}', CAST(CASE WHEN abs({keys} - count(DISTINCT {x.column})) * 100 > {keys} * {x.percent} THEN 1 ELSE 0 END AS BIGINT), count(DISTINCT {x.column}) FROM {table}")
    rows = " UNION ALL ".join(parts)
    return f"WITH {', '.join(held.values())} SELECT table_name, check_name, severity, CASE WHEN failed = 0 THEN 'PASS' WHEN severity = 'WARN' THEN 'WARN' ELSE 'FAIL' END AS status, failed, total FROM ({rows})"


def _columns_of(table: str) -> tuple[str, ...]:
    """Columns that a ruled table has, as far as rules name them."""
    lacks = {"fact_txn_account": ("txn_date",), "fact_card_txn": ("txn_date",), "fact_support_ticket": ("status",)}.get(table, ())
    d = next((x for x in dimensions() if x.name == table), None)
    named = {c.column for r in _RULES if r.table == table for c in r.checks if c.column}
    return tuple(c for c in named if c not in lacks and (d is None or c == d.key or c in d.columns))


@query("dq8_rule_catalogue", _rules_sql())
def rule_catalogue(r: Roles) -> DataFrame:
    """The rules of the layers' tables in one report; some facts lack a column that a rule names, which fails it."""

    @functools.cache
    def tables(name: str) -> DataFrame | None:
        if name in _SOURCES:
            return {"core_customer": r.customer, "core_txn_account": r.account_txn}[name]
        return _current(r, name) if name in _HELD else durable(_RULED[name][1](r)) if name in _RULED else None

    return contracts.enforce_all(_RULES, tables, DAY)
