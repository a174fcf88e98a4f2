"""Bank tables made from the given star schema, in Spark and, independently written, in DuckDB SQL.

Amounts are in thousands, and cast to decimal before any sum, so that results do not depend on row order. Order dates fall on midnight, so
hours are added to instants by key; business days are those of UTC+7.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions.columns import flag, money
from tierline.functions.time import business_date, business_hour

#: The business day that marts are made for.
DAY = dt.date(2001, 6, 30)


class Roles:
    """Role tables of one data folder, each read once it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.folder = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def branch(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("branch_id"), F.col("n_name").alias("branch_name"), F.col("r_name").alias("city"))

    @cached_property
    def customer_versions(self) -> DataFrame:
        """Type 2 dimension: every tenth customer has an older version in another segment, another tenth is closed."""
        base = self.table("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("branch_id"), money(F.col("c_acctbal")).alias("balance")
        )
        tenth = F.col("customer_id") % 10
        change = F.lit(dt.date(2001, 1, 1))
        now = base.select("*", F.when(tenth == 3, change).otherwise(F.lit(dt.date(1990, 1, 1))).alias("effective_from"), F.when(tenth == 7, F.lit(dt.date(2000, 12, 31))).otherwise(F.lit(dt.date(9999, 12, 31))).alias("effective_to"), flag(tenth != 7).alias("is_current"))
        old = base.where(tenth == 3).select("customer_id", "full_name", F.lit("OLD").alias("segment"), "branch_id", "balance", F.lit(dt.date(1990, 1, 1)).alias("effective_from"), F.lit(dt.date(2000, 12, 31)).alias("effective_to"), F.lit(0).alias("is_current"))
        return now.unionByName(old).withColumn("customer_sk", F.sha2(F.concat_ws("|", F.col("customer_id").cast("string"), F.col("effective_from").cast("string")), 256))

    @cached_property
    def customer(self) -> DataFrame:
        return self.customer_versions.where(F.lit(DAY).between(F.col("effective_from"), F.col("effective_to")))

    @cached_property
    def account_txn(self) -> DataFrame:
        """Orders as account transactions, one row a transaction and a business day."""
        ts = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
        rows = self.table("orders").select(
            F.col("o_orderkey").alias("txn_id"), F.col("o_custkey").alias("customer_id"), ts.alias("txn_ts"), money(F.col("o_totalprice")).alias("amount"), F.col("o_orderpriority").alias("channel"),
            F.when(F.col("o_orderstatus") == "F", "D").otherwise("C").alias("dc"), F.col("o_orderstatus").alias("status"),
        )
        return rows.withColumns({"cob_dt": business_date(F.col("txn_ts")), "hour": business_hour(F.col("txn_ts"))})

    @cached_property
    def card_txn(self) -> DataFrame:
        """Order lines as card transactions; a line's own key repeats in the data, so rows are told apart by all columns."""
        ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"))
        lines = self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"), F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("merchant_id"), F.col("l_partkey").alias("card_id"), ts.alias("txn_ts"), money(F.col("l_extendedprice")).alias("amount"),
            F.when(F.col("l_returnflag") == "R", "REFUND").when(F.col("l_returnflag") == "A", "CASH_ADVANCE").otherwise("PURCHASE").alias("txn_type"), F.when(F.col("l_linestatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
            F.when(F.col("l_linenumber") % 2 == 0, "QR").otherwise("POS").alias("pay_channel"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("int").alias("quantity"), F.col("l_discount").alias("discount"),
        )
        owners = self.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
        return lines.join(owners, "order_id").withColumns({"cob_dt": business_date(F.col("txn_ts")), "hour": business_hour(F.col("txn_ts"))})

    def _with_copies(self, rows: DataFrame) -> DataFrame:
        """As a store of daily snapshots has them: some rows come again on a later day, corrected, and some of these twice."""
        k = F.col("txn_id")
        again = lambda some, days: rows.where(some).withColumns({"amount": money(F.col("amount") + days), "cob_dt": F.date_add("cob_dt", days)})
        return rows.unionByName(again(k % 10 == 3, 1)).unionByName(again(k % 50 == 13, 2))

    @cached_property
    def account_copies(self) -> DataFrame:
        return self._with_copies(self.account_txn)

    @cached_property
    def card_copies(self) -> DataFrame:
        return self._with_copies(self.card_txn)

    @cached_property
    def merchant(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("merchant_id"), F.col("s_name").alias("merchant_name"), F.col("s_nationkey").alias("branch_id"), (F.col("s_nationkey") % 5).alias("mcc"))

    @cached_property
    def loan(self) -> DataFrame:
        """Orders as loans."""
        status = F.when(F.col("o_orderkey") % 11 == 0, "WRITTEN_OFF").when(F.col("o_orderstatus") == "F", "CLOSED").when(F.col("o_orderstatus") == "P", "OVERDUE").otherwise("ACTIVE")
        return self.table("orders").select(
            F.col("o_orderkey").alias("loan_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("product"), status.alias("loan_status"), money(F.col("o_totalprice")).alias("loan_amount"),
            money(money(F.col("o_totalprice")) * (F.col("o_orderkey") % 7).cast("int")).alias("outstanding"), F.col("o_orderdate").cast("date").alias("disbursed"),
        )

    @cached_property
    def loan_terms(self) -> DataFrame:
        """Loans with what a branch adds to them: its code (null or unknown for some), a rate and a term."""
        k = F.col("loan_id")
        return self.loan.withColumns({"branch_code": F.when(k % 13 != 0, k % 27), "interest_rate": ((k % 120) / F.lit(10)).cast("decimal(5,2)"), "term_months": (k % 10 * 6 + 6).cast("int")})

    @cached_property
    def payment(self) -> DataFrame:
        """Order lines as loan instalments."""
        days = (F.col("l_partkey") * 7 + F.col("l_suppkey") * 3 + F.col("l_linenumber")) % 400
        status = F.when(days >= 300, "MISSED").when(days % 5 == 0, "LATE").otherwise("PAID")
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"), F.col("l_orderkey").alias("loan_id"), F.col("l_shipdate").cast("date").alias("due"), days.cast("int").alias("days_late"), status.alias("payment_status"),
            money(F.col("l_extendedprice")).alias("scheduled"), money(money(F.col("l_extendedprice")) - money(F.round(F.col("l_discount") * 100))).alias("paid"), money(F.round(F.col("l_tax") * 100)).alias("penalty"), F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("teller_id"),
        )

    @cached_property
    def profile(self) -> DataFrame:
        """What the customer table lacks of a person, from the key."""
        k = F.col("c_custkey")
        day = lambda first, days: F.date_add(F.lit(first), days.cast("int"))
        return self.table("customer").select(
            k.alias("customer_id"), F.when(k % 2 == 0, "F").otherwise("M").alias("gender"), day(dt.date(1940, 1, 1), k * 37 % 20_000).alias("date_of_birth"), F.when(k % 4 == 0, "PENDING").otherwise("VERIFIED").alias("kyc_status"),
            day(dt.date(1990, 1, 1), k % 3000).alias("register_date"),
        )

    @cached_property
    def account(self) -> DataFrame:
        """A current account for each customer, and a deposit for every third, which may be large or overdrawn."""
        k, open_ = F.col("c_custkey"), lambda closed: F.when(closed, "CLOSED").otherwise("ACTIVE")
        rows = self.table("customer")
        current = rows.select((k * 10 + 1).alias("account_id"), k.alias("customer_id"), F.lit("CASA").alias("account_type"), open_(k % 8 == 5).alias("status"), money(F.col("c_acctbal")).alias("balance"))
        deposit = rows.where(k % 3 == 0).select((k * 10 + 2).alias("account_id"), k.alias("customer_id"), F.lit("TIME_DEPOSIT").alias("account_type"), open_(k % 5 == 1).alias("status"), money(money(F.col("c_acctbal")) * (k % 1000).cast("int")).alias("balance"))
        return current.unionByName(deposit)

    @cached_property
    def card(self) -> DataFrame:
        """Credit cards of most customers and debit cards of most, some of them blocked."""
        k, open_ = F.col("c_custkey"), lambda blocked: F.when(blocked, "BLOCKED").otherwise("ACTIVE")
        rows = self.table("customer")
        credit = rows.where(k % 4 != 0).select((k * 10 + 1).alias("card_id"), k.alias("customer_id"), F.lit("CREDIT").alias("card_type"), open_(k % 6 == 1).alias("status"), ((k % 50 + 1) * 1000).alias("credit_limit"))
        debit = rows.where(k % 5 != 0).select((k * 10 + 2).alias("card_id"), k.alias("customer_id"), F.lit("DEBIT").alias("card_type"), open_(k % 7 == 2).alias("status"), F.lit(None).cast("long").alias("credit_limit"))
        return credit.unionByName(debit)

    @cached_property
    def ledger(self) -> DataFrame:
        """Order lines as account transactions of the order's day: a customer has several, of different channels and amounts."""
        line = F.col("l_linenumber").cast("int")
        orders = self.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate"), F.when(F.col("o_orderstatus") == "F", "D").otherwise("C").alias("dc"))
        rows = self.table("lineitem").select(F.col("l_orderkey").alias("order_id"), line.alias("line"), F.col("l_partkey").alias("part_id"), money(money(F.col("l_extendedprice")) * line).alias("amount")).join(orders, "order_id")
        ts = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("order_id") % 24).cast("int"))
        rows = rows.select((F.col("order_id") * 10 + F.col("line")).alias("txn_id"), "customer_id", "part_id", ts.alias("txn_ts"), "amount", F.concat(F.lit("CH"), F.col("line").cast("string")).alias("channel"), "dc")
        return rows.withColumns({"cob_dt": business_date(F.col("txn_ts")), "hour": business_hour(F.col("txn_ts"))})

    @cached_property
    def interaction(self) -> DataFrame:
        """Pending orders as contacts with a customer."""
        rows = self.table("orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("interaction_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("ts"))
        return rows.withColumn("cob_dt", business_date(F.col("ts")))

    @cached_property
    def online(self) -> DataFrame:
        """Events as online payments in the month of DAY: they are moved back by a whole number of days."""
        k = F.col("event_id")
        rows = self.table("events").select(
            k.alias("txn_id"), F.col("user_id").alias("customer_id"), (F.col("ts") - F.make_dt_interval(F.lit(8249))).alias("ts"), money(F.col("value")).alias("amount"), F.col("event_type").alias("channel"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"), (F.col("user_id") * 3 + k % 3).alias("device_id"), (k % 25).cast("int").alias("location_id"), flag(k % 7 == 0).alias("is_fraud"),
            F.when(k % 7 == 0, F.when(k % 2 == 0, "STOLEN_CARD").otherwise("ODD_PLACE")).alias("fraud_reason"),
        )
        return rows.withColumn("cob_dt", business_date(F.col("ts")))

    @cached_property
    def merchant_txn(self) -> DataFrame:
        """Events as payments at merchants around DAY; some have no merchant, and some are neither by QR nor at a POS."""
        k, ts = F.col("event_id"), F.col("ts") - F.expr("INTERVAL 8249 DAY")
        channel = F.when(k % 19 == 0, "WEB").when(k % 3 == 0, "QR").otherwise("POS")
        rows = self.table("events").select(
            k.alias("transaction_id"), F.when(k % 17 != 0, F.col("user_id") % 20).alias("merchant_id"), ts.alias("transaction_date"), money(F.col("value")).alias("amount"), channel.alias("payment_channel"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"), flag(F.col("event_type") == "signup").alias("refund_flag"),
        )
        return rows.withColumn("cob_dt", business_date(F.col("transaction_date")))

    @cached_property
    def location(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("state"), flag(F.col("n_nationkey") % 7 == 0).alias("is_high_risk_area"))

    @cached_property
    def event(self) -> DataFrame:
        """Events as online payments: an amount, a merchant, a channel and an outcome from user, value and type."""
        return self.table("events").select(
            F.col("event_id"), F.col("ts"), F.col("user_id").alias("customer_id"), (F.col("user_id") % 20).alias("merchant_id"), money(F.col("value")).alias("amount"), F.col("event_type"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"), F.when(F.col("event_id") % 3 == 0, "QR").otherwise("POS").alias("pay_channel"), flag(F.col("event_type") == "signup").alias("refund_flag"), F.col("props"),
        )


def _copies_sql(rows: str) -> str:
    again = lambda some, days: f"SELECT * REPLACE (CAST(amount + {days} AS DECIMAL(18,2)) AS amount, CAST(cob_dt + {days} AS DATE) AS cob_dt) FROM {rows} WHERE {some}"
    return f"SELECT * FROM {rows} UNION ALL {again('txn_id % 10 = 3', 1)} UNION ALL {again('txn_id % 50 = 13', 2)}"


#: The same tables for DuckDB, by name; each may use those before it.
SQL: dict[str, str] = {
    "branch": "SELECT n_nationkey AS branch_id, n_name AS branch_name, r_name AS city FROM nation JOIN region ON n_regionkey = r_regionkey",
    "customer_versions": """
        SELECT *, sha256(customer_id || '|' || effective_from) AS customer_sk FROM (
          SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS segment, c_nationkey AS branch_id, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
                 CASE WHEN c_custkey % 10 = 3 THEN DATE '2001-01-01' ELSE DATE '1990-01-01' END AS effective_from,
                 CASE WHEN c_custkey % 10 = 7 THEN DATE '2000-12-31' ELSE DATE '9999-12-31' END AS effective_to,
                 CASE WHEN c_custkey % 10 = 7 THEN 0 ELSE 1 END AS is_current FROM customer
          UNION ALL
          SELECT c_custkey, c_name, 'OLD', c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)), DATE '1990-01-01', DATE '2000-12-31', 0 FROM customer WHERE c_custkey % 10 = 3)""",
    "dim_customer": "SELECT * FROM customer_versions WHERE DATE '2001-06-30' BETWEEN effective_from AND effective_to",
    "account_txn": """
        SELECT *, CAST(txn_ts + INTERVAL 7 HOUR AS DATE) AS cob_dt, CAST(hour(txn_ts + INTERVAL 7 HOUR) AS INTEGER) AS hour FROM (
          SELECT o_orderkey AS txn_id, o_custkey AS customer_id, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS txn_ts,
                 CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderpriority AS channel, CASE WHEN o_orderstatus = 'F' THEN 'D' ELSE 'C' END AS dc, o_orderstatus AS status FROM orders)""",
    "card_txn": """
        SELECT *, CAST(txn_ts + INTERVAL 7 HOUR AS DATE) AS cob_dt, CAST(hour(txn_ts + INTERVAL 7 HOUR) AS INTEGER) AS hour FROM (
          SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_orderkey AS order_id, l_suppkey AS merchant_id, l_partkey AS card_id, l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS txn_ts,
                 CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CASE l_returnflag WHEN 'R' THEN 'REFUND' WHEN 'A' THEN 'CASH_ADVANCE' ELSE 'PURCHASE' END AS txn_type,
                 CASE WHEN l_linestatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status, CASE WHEN l_linenumber % 2 = 0 THEN 'QR' ELSE 'POS' END AS pay_channel,
                 l_linenumber AS line, CAST(l_quantity AS INTEGER) AS quantity, l_discount AS discount, o_custkey AS customer_id
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
    "account_copies": _copies_sql("account_txn"),
    "card_copies": _copies_sql("card_txn"),
    "merchant": "SELECT s_suppkey AS merchant_id, s_name AS merchant_name, s_nationkey AS branch_id, s_nationkey % 5 AS mcc FROM supplier",
    "loan": """
        SELECT o_orderkey AS loan_id, o_custkey AS customer_id, o_orderpriority AS product,
               CASE WHEN o_orderkey % 11 = 0 THEN 'WRITTEN_OFF' WHEN o_orderstatus = 'F' THEN 'CLOSED' WHEN o_orderstatus = 'P' THEN 'OVERDUE' ELSE 'ACTIVE' END AS loan_status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS loan_amount, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(o_orderkey % 7 AS INTEGER) AS DECIMAL(18,2)) AS outstanding, CAST(o_orderdate AS DATE) AS disbursed FROM orders""",
    "loan_terms": """
        SELECT *, CASE WHEN loan_id % 13 <> 0 THEN loan_id % 27 END AS branch_code, CAST(CAST(loan_id % 120 AS DOUBLE) / 10 AS DECIMAL(5,2)) AS interest_rate,
               CAST(loan_id % 10 * 6 + 6 AS INTEGER) AS term_months FROM loan""",
    "payment": """
        SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS loan_id, CAST(l_shipdate AS DATE) AS due, CAST(d AS INTEGER) AS days_late,
               CASE WHEN d >= 300 THEN 'MISSED' WHEN d % 5 = 0 THEN 'LATE' ELSE 'PAID' END AS payment_status, CAST(l_extendedprice AS DECIMAL(18,2)) AS scheduled,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(round(l_discount * 100) AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS paid, CAST(round(l_tax * 100) AS DECIMAL(18,2)) AS penalty, l_partkey AS part_id, l_suppkey AS teller_id
        FROM (SELECT *, (l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 400 AS d FROM lineitem)""",
    "profile": """
        SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, DATE '1940-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS date_of_birth,
               CASE WHEN c_custkey % 4 = 0 THEN 'PENDING' ELSE 'VERIFIED' END AS kyc_status, DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS register_date FROM customer""",
    "dim_account": """
        SELECT c_custkey * 10 + 1 AS account_id, c_custkey AS customer_id, 'CASA' AS account_type, CASE WHEN c_custkey % 8 = 5 THEN 'CLOSED' ELSE 'ACTIVE' END AS status, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer
        UNION ALL SELECT c_custkey * 10 + 2, c_custkey, 'TIME_DEPOSIT', CASE WHEN c_custkey % 5 = 1 THEN 'CLOSED' ELSE 'ACTIVE' END, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * CAST(c_custkey % 1000 AS INTEGER) AS DECIMAL(18,2)) FROM customer WHERE c_custkey % 3 = 0""",
    "dim_card": """
        SELECT c_custkey * 10 + 1 AS card_id, c_custkey AS customer_id, 'CREDIT' AS card_type, CASE WHEN c_custkey % 6 = 1 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status, (c_custkey % 50 + 1) * 1000 AS credit_limit FROM customer WHERE c_custkey % 4 <> 0
        UNION ALL SELECT c_custkey * 10 + 2, c_custkey, 'DEBIT', CASE WHEN c_custkey % 7 = 2 THEN 'BLOCKED' ELSE 'ACTIVE' END, NULL FROM customer WHERE c_custkey % 5 <> 0""",
    "ledger": """
        SELECT *, CAST(txn_ts + INTERVAL 7 HOUR AS DATE) AS cob_dt, CAST(hour(txn_ts + INTERVAL 7 HOUR) AS INTEGER) AS hour FROM (
          SELECT l_orderkey * 10 + l_linenumber AS txn_id, o_custkey AS customer_id, l_partkey AS part_id, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS txn_ts,
                 CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_linenumber AS INTEGER) AS DECIMAL(18,2)) AS amount, 'CH' || l_linenumber AS channel, CASE WHEN o_orderstatus = 'F' THEN 'D' ELSE 'C' END AS dc
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
    "interaction": "SELECT o_orderkey AS interaction_id, o_custkey AS customer_id, o_orderdate AS ts, CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) AS cob_dt FROM orders WHERE o_orderstatus = 'P'",
    "online": """
        SELECT *, CAST(ts + INTERVAL 7 HOUR AS DATE) AS cob_dt FROM (
          SELECT event_id AS txn_id, user_id AS customer_id, ts - INTERVAL 8249 DAY AS ts, CAST(value AS DECIMAL(18,2)) AS amount, event_type AS channel, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                 user_id * 3 + event_id % 3 AS device_id, CAST(event_id % 25 AS INTEGER) AS location_id, CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS is_fraud,
                 CASE WHEN event_id % 7 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'STOLEN_CARD' ELSE 'ODD_PLACE' END END AS fraud_reason FROM events)""",
    "merchant_txn": """
        SELECT *, CAST(transaction_date + INTERVAL 7 HOUR AS DATE) AS cob_dt FROM (
          SELECT event_id AS transaction_id, CASE WHEN event_id % 17 <> 0 THEN user_id % 20 END AS merchant_id, ts - INTERVAL 8249 DAY AS transaction_date, CAST(value AS DECIMAL(18,2)) AS amount,
                 CASE WHEN event_id % 19 = 0 THEN 'WEB' WHEN event_id % 3 = 0 THEN 'QR' ELSE 'POS' END AS payment_channel, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                 CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS refund_flag FROM events)""",
    "location": "SELECT n_nationkey AS location_id, n_name AS state, CASE WHEN n_nationkey % 7 = 0 THEN 1 ELSE 0 END AS is_high_risk_area FROM nation",
    "event": """
        SELECT event_id, ts, user_id AS customer_id, user_id % 20 AS merchant_id, CAST(value AS DECIMAL(18,2)) AS amount, event_type, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN event_id % 3 = 0 THEN 'QR' ELSE 'POS' END AS pay_channel, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS refund_flag, props FROM events""",
}


def oracle(body: str) -> str:
    """body with the role tables that it names, and those that these name, before it."""
    need: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in SQL:
            if name not in need and f" {name}" in f" {text.replace(chr(10), ' ')}":
                need.add(name)
                todo.append(SQL[name])
    tables = ",\n".join(f"{n} AS ({SQL[n]})" for n in SQL if n in need)
    return f"WITH {tables}\n{body}" if tables and not body.lstrip().upper().startswith("WITH") else f"WITH {tables},\n{body.lstrip()[4:]}" if tables else body
