"""Marts of fraud, money laundering and credit risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import flag, ladder, money, ratio, score, zero
from tierline.functions.time import business_window
from tierline.plans.registry import query
from tierline.plans.roles import DAY, Roles
from tierline.sources.shared import durable

#: Role amounts are in thousands, the bounds below are not.
UNIT = 1000
#: An amount that is high for one transaction, and for the law; the range just below a report; counts of a day that are odd.
HIGH_AMOUNT, HIGH_VALUE, JUST_BELOW = 100_000_000, 200_000_000, (50_000_000, 99_999_999)
MANY_BELOW, MANY_TXNS, MANY_CHANNELS, MANY_STATES = 2, 4, 4, 3
#: Weights of night, amount, negative balance and anomaly; and of value, structuring, velocity, channels and places.
FRAUD_WEIGHTS, AML_WEIGHTS = (2, 3, 2, 3), (3, 4, 2, 1, 3)
_LEVEL_SQL = "CASE WHEN {0} >= 3 THEN 3 WHEN {0} >= 2 THEN 2 WHEN {0} >= 1 THEN 1 ELSE 0 END"
_FRAUD_SQL = """fraud AS (SELECT customer_id, cob_dt, max(is_fraud) AS is_fraud, max(CASE WHEN is_fraud = 1 THEN fraud_reason END) AS fraud_reason FROM online WHERE status = 'SUCCESS' AND cob_dt <= DATE '2001-06-30' GROUP BY customer_id, cob_dt)"""
_TXN_SQL = """txn AS (
        SELECT t.txn_id, t.part_id, t.customer_id, t.cob_dt, t.hour, t.amount, t.channel, t.dc, segment, CAST(balance + CASE WHEN dc = 'C' THEN t.amount ELSE -t.amount END AS DECIMAL(18,2)) AS balance_after
        FROM ledger t LEFT JOIN dim_customer c USING (customer_id) WHERE cob_dt <= DATE '2001-06-30')"""


def level(flags: Column) -> Column:
    return ladder(flags, [(3, 3), (2, 2), (1, 1)], 0)


def fraud_days(r: Roles) -> DataFrame:
    """Whether a customer's successful online payments of a business day hold a fraud, and why."""
    rows = r.online.where((F.col("status") == "SUCCESS") & (F.col("cob_dt") <= F.lit(DAY)))
    return rows.groupBy("customer_id", "cob_dt").agg(F.max("is_fraud").alias("is_fraud"), F.max(F.when(F.col("is_fraud") == 1, F.col("fraud_reason"))).alias("fraud_reason"))


def _txns(r: Roles) -> DataFrame:
    """Account transactions up to DAY, each with its customer's segment and the balance after it."""
    rows = r.ledger.where(F.col("cob_dt") <= F.lit(DAY)).join(r.customer.select("customer_id", "segment", "balance"), "customer_id", "left")
    after = money(F.col("balance") + F.when(F.col("dc") == "C", F.col("amount")).otherwise(-F.col("amount")))
    told = rows.select("txn_id", "part_id", "customer_id", "cob_dt", "hour", "amount", "channel", "dc", "segment", after.alias("balance_after"))
    return durable(told)  # each mart both aggregates it and joins the figures back


@query(
    "m12_fraud_risk",
    f"""
    WITH {_TXN_SQL}, {_FRAUD_SQL},
    g AS (SELECT customer_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS s, CAST(sum(amount * amount) AS DOUBLE) AS ss FROM txn GROUP BY customer_id),
    f AS (SELECT t.txn_id, t.part_id, t.customer_id, segment AS customer_segment, t.cob_dt, t.amount, t.dc AS debit_credit, t.channel, t.balance_after, CASE WHEN t.hour < 6 OR t.hour > 22 THEN 1 ELSE 0 END AS night_flag, CASE WHEN t.amount * 1000 > 100000000 THEN 1 ELSE 0 END AS high_amount_flag,
                 CASE WHEN balance_after < 0 THEN 1 ELSE 0 END AS neg_balance_flag, CASE WHEN s > 0 AND CAST(t.amount AS DOUBLE) > s / n + 3.0 * CASE WHEN n > 1 THEN sqrt(greatest(0, (ss - s * s / n) / (n - 1))) ELSE 0 END THEN 1 ELSE 0 END AS anomaly_flag
          FROM txn t LEFT JOIN g USING (customer_id))
    SELECT f.*, CAST(night_flag * 2 + high_amount_flag * 3 + neg_balance_flag * 2 + anomaly_flag * 3 AS INTEGER) AS risk_score, {_LEVEL_SQL.format("(night_flag + high_amount_flag + neg_balance_flag + anomaly_flag)")} AS risk_level, coalesce(is_fraud, 0) AS is_fraud
    FROM f LEFT JOIN fraud USING (customer_id, cob_dt)""",
)
def fraud_risk(r: Roles) -> DataFrame:
    txns = _txns(r)
    # Mean and deviation from exact sums, so that they do not depend on row order; a window would sort all transactions.
    stats = txns.groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("s"), F.sum(F.col("amount") * F.col("amount")).cast("double").alias("ss"))
    n, s, ss = (F.col(c) for c in ("n", "s", "ss"))
    spread = F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), F.try_divide(ss - s * s / n, n - 1)))).otherwise(0.0)
    joined = txns.join(stats, "customer_id", "left").join(fraud_days(r).drop("fraud_reason"), ["customer_id", "cob_dt"], "left")
    flags = {
        "night_flag": flag((F.col("hour") < 6) | (F.col("hour") > 22)), "high_amount_flag": flag(F.col("amount") * UNIT > HIGH_AMOUNT), "neg_balance_flag": flag(F.col("balance_after") < 0),
        "anomaly_flag": flag((s > 0) & (F.col("amount").cast("double") > s / n + 3.0 * spread)),
    }
    names = [F.col(c) for c in flags]
    return joined.withColumns(flags).select(
        "txn_id", "part_id", "customer_id", F.col("segment").alias("customer_segment"), "cob_dt", "amount", F.col("dc").alias("debit_credit"), "channel", "balance_after", *flags, score(list(zip(names, FRAUD_WEIGHTS, strict=True))).alias("risk_score"),
        level(names[0] + names[1] + names[2] + names[3]).alias("risk_level"), F.coalesce("is_fraud", F.lit(0)).alias("is_fraud"),
    )


@query(
    "m13_aml_monitoring",
    f"""
    WITH {_TXN_SQL}, {_FRAUD_SQL},
    d AS (SELECT customer_id, cob_dt, count(*) AS n, count(*) FILTER (amount * 1000 BETWEEN 50000000 AND 99999999) AS below, count(DISTINCT channel) AS channels FROM txn GROUP BY customer_id, cob_dt),
    g AS (SELECT customer_id, cob_dt, count(DISTINCT state) AS states, count(DISTINCT CASE WHEN is_high_risk_area = 1 THEN location_id END) AS risky FROM online JOIN location USING (location_id) WHERE status = 'SUCCESS' AND cob_dt <= DATE '2001-06-30' GROUP BY customer_id, cob_dt),
    f AS (SELECT t.txn_id, t.part_id, t.customer_id, segment AS customer_segment, t.cob_dt, t.amount, t.channel, coalesce(states, 0) AS distinct_states, coalesce(risky, 0) AS high_risk_locations, CASE WHEN t.amount * 1000 >= 200000000 THEN 1 ELSE 0 END AS high_value_flag, CASE WHEN below >= 2 THEN 1 ELSE 0 END AS structuring_flag,
                 CASE WHEN n >= 4 THEN 1 ELSE 0 END AS velocity_flag, CASE WHEN channels >= 4 THEN 1 ELSE 0 END AS multi_channel_flag, CASE WHEN states >= 3 THEN 1 ELSE 0 END AS geo_velocity_flag FROM txn t LEFT JOIN d USING (customer_id, cob_dt) LEFT JOIN g USING (customer_id, cob_dt)),
    k AS (SELECT *, high_value_flag + structuring_flag + velocity_flag + multi_channel_flag + geo_velocity_flag AS flags FROM f)
    SELECT k.* EXCLUDE (flags), CAST(high_value_flag * 3 + structuring_flag * 4 + velocity_flag * 2 + multi_channel_flag + geo_velocity_flag * 3 AS INTEGER) AS alert_score, {_LEVEL_SQL.format("flags")} AS risk_level, CASE WHEN flags >= 2 THEN 1 ELSE 0 END AS alert_generated,
           coalesce(is_fraud, 0) AS is_fraud, fraud_reason FROM k LEFT JOIN fraud USING (customer_id, cob_dt)""",
)
def aml_monitoring(r: Roles) -> DataFrame:
    """One row a transaction; figures of its customer's business day are aggregated first and joined on both keys."""
    keys, txns = ["customer_id", "cob_dt"], _txns(r)
    # Distinct channels and places by a first aggregation to their own grain; few rows reach the second.
    grain = txns.groupBy(*keys, "channel").agg(F.count("*").alias("n"), F.count_if((F.col("amount") * UNIT).between(*JUST_BELOW)).alias("below"))
    days = grain.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("below").alias("below"), F.count("channel").alias("channels"))
    paid = r.online.where((F.col("status") == "SUCCESS") & (F.col("cob_dt") <= F.lit(DAY))).select(*keys, "location_id").distinct().join(r.location, "location_id")
    places = paid.groupBy(*keys).agg(F.size(F.collect_set("state")).alias("states"), F.count_if(F.col("is_high_risk_area") == 1).alias("risky"))
    joined = txns.join(days, keys, "left").join(places, keys, "left").join(fraud_days(r), keys, "left")
    flags = {
        "high_value_flag": flag(F.col("amount") * UNIT >= HIGH_VALUE), "structuring_flag": flag(F.col("below") >= MANY_BELOW), "velocity_flag": flag(F.col("n") >= MANY_TXNS), "multi_channel_flag": flag(F.col("channels") >= MANY_CHANNELS),
        "geo_velocity_flag": flag(F.col("states") >= MANY_STATES),
    }
    names = [F.col(c) for c in flags]
    total = names[0] + names[1] + names[2] + names[3] + names[4]
    return joined.withColumns(flags).select(
        "txn_id", "part_id", "customer_id", F.col("segment").alias("customer_segment"), "cob_dt", "amount", "channel", F.coalesce("states", F.lit(0)).alias("distinct_states"), F.coalesce("risky", F.lit(0)).alias("high_risk_locations"), *flags,
        score(list(zip(names, AML_WEIGHTS, strict=True))).alias("alert_score"), level(total).alias("risk_level"), flag(total >= 2).alias("alert_generated"), F.coalesce("is_fraud", F.lit(0)).alias("is_fraud"), "fraud_reason",
    )


@query(
    "ml2_credit_features",
    """
    WITH l AS (SELECT customer_id, CAST(sum(outstanding) AS DOUBLE) AS debt, count(DISTINCT product) AS products FROM loan GROUP BY customer_id),
    t AS (SELECT customer_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS s FROM account_txn WHERE cob_dt BETWEEN DATE '2001-04-01' AND DATE '2001-06-30' GROUP BY customer_id),
    x AS (SELECT customer_id, coalesce(debt / nullif(CAST(balance AS DOUBLE), 0), 0) AS debt_to_asset, coalesce(CAST(n AS DOUBLE), 0) / 90.0 AS velocity, coalesce(s / nullif(CAST(n AS DOUBLE), 0), 0) AS avg_txn, coalesce(products, 0) AS diversity
          FROM dim_customer LEFT JOIN l USING (customer_id) LEFT JOIN t USING (customer_id))
    SELECT *, CASE WHEN debt_to_asset > 100 OR debt_to_asset < 0 THEN 1 ELSE 0 END AS label FROM x""",
)
def credit_features(r: Roles) -> DataFrame:
    loans = r.loan.groupBy("customer_id").agg(F.sum("outstanding").cast("double").alias("debt"), F.count_distinct("product").alias("products"))
    txns = business_window(r.account_txn, DAY, 90).groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("s"))
    joined = r.customer.join(loans, "customer_id", "left").join(txns, "customer_id", "left")
    zero_ = F.lit(0.0)
    rows = joined.select(
        "customer_id", F.coalesce(ratio(F.col("debt"), F.col("balance")), zero_).alias("debt_to_asset"), (F.coalesce(F.col("n").cast("double"), zero_) / 90.0).alias("velocity"), F.coalesce(ratio(F.col("s"), F.col("n")), zero_).alias("avg_txn"),
        F.coalesce("products", F.lit(0)).alias("diversity"),
    )
    return rows.withColumn("label", flag((F.col("debt_to_asset") > 100) | (F.col("debt_to_asset") < 0)))
