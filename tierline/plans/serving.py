"""Served slices of the marts for one day, and the tests that serving must pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import ratio
from tierline.plans import credit_marts, customer_marts, merchant_marts, risk_marts
from tierline.plans.registry import ORACLES, query
from tierline.plans.roles import DAY, Roles
from tierline.sources.tables import serve_slice

#: Served tables with the mart of each, and the query whose SQL says the same.
SERVED: dict[str, tuple[Callable[[Roles], DataFrame], str]] = {
    "mart_customer_360_current": (customer_marts.customer_360, "m1_customer_360"),
    "customer_balance_summary_current": (customer_marts.balance_summary, "m2_balance_summary"),
    "customer_card_summary_current": (customer_marts.card_summary, "m3_card_summary"),
    "customer_loan_summary_current": (customer_marts.loan_summary, "m4_loan_summary"),
    "customer_product_summary_current": (customer_marts.product_summary, "m5_product_summary"),
    "customer_transaction_summary_current": (customer_marts.transaction_summary, "m6_transaction_summary"),
    "merchant_360_current": (merchant_marts.merchant_360, "m7_merchant_360"),
    "rfm_segment_current": (customer_marts.rfm_segment, "m8_rfm_segment"),
    "churn_prediction_current": (customer_marts.churn_rules, "m9_churn_rules"),
    "cross_sell_segment_current": (customer_marts.cross_sell, "m10_cross_sell"),
    "campaign_target_current": (customer_marts.campaign_target, "m11_campaign_target"),
    "fraud_risk_txn_current": (risk_marts.fraud_risk, "m12_fraud_risk"),
    "aml_monitoring_current": (risk_marts.aml_monitoring, "m13_aml_monitoring"),
    "loan_delinquency_current": (credit_marts.loan_delinquency, "m14_loan_delinquency"),
    "loan_portfolio_risk_current": (credit_marts.loan_portfolio, "m15_loan_portfolio"),
    "loan_roll_rate_current": (credit_marts.roll_rate, "m20_roll_rate"),
    "loan_vintage_current": (credit_marts.loan_vintage, "m21_loan_vintage"),
    "merchant_ranking_current": (merchant_marts.merchant_ranking, "m18_merchant_ranking"),
    "region_monthly_summary_current": (merchant_marts.region_monthly, "m19_region_monthly"),
}


def served(r: Roles, table: str, day: dt.date = DAY) -> DataFrame:
    """The mart's snapshot of the day asked for, never of the newest; without rows of it, an error."""
    mart = SERVED[table][0](r)
    return serve_slice(mart.withColumn("cob_dt", F.lit(DAY)), day)


def _count_sql(table: str) -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS row_count, DATE '{DAY}' AS served_cob_dt FROM ({ORACLES[SERVED[table][1]]})"


@query("m22_served_tables", " UNION ALL ".join(map(_count_sql, SERVED)))
def served_tables(r: Roles) -> DataFrame:
    """Rows and day of every served table."""
    out = None
    for table in SERVED:
        told = served(r, table).agg(F.lit(table).alias("table_name"), F.count("*").alias("row_count"), F.max("cob_dt").alias("served_cob_dt"))
        out = told if out is None else out.unionByName(told)
    return out


def _customer_tests_sql() -> str:
    mart, rfm, loans = (ORACLES[n] for n in ("m1_customer_360", "m8_rfm_segment", "m15_loan_portfolio"))
    return f"""WITH m AS ({mart}), f AS ({rfm}), l AS ({loans})
    SELECT 'balances_non_negative' AS test_name, count(*) AS failures FROM m WHERE total_deposit_balance < 0 OR aum_total < 0 OR total_loan_outstanding < 0
    UNION ALL SELECT 'no_duplicate_customers', (SELECT count(*) FROM (SELECT customer_id FROM m GROUP BY customer_id HAVING count(*) > 1))
    UNION ALL SELECT 'customer_360_complete', CAST((SELECT CASE WHEN count(*) < 1000 OR count(*) FILTER (customer_segment = 'BUILDING') = 0 OR count(*) FILTER (customer_segment = 'VIP') = 0 OR count(*) FILTER (kyc_status = 'VERIFIED') = 0 THEN 1 ELSE 0 END FROM m) AS BIGINT)
    UNION ALL SELECT 'rfm_scores_valid', count(*) FROM f WHERE rfm_score < 1 OR rfm_score > 100 OR rfm_segment IS NULL
    UNION ALL SELECT 'loan_rates_bounded', count(*) FROM l WHERE late_payment_rate < 0 OR late_payment_rate > 1
    UNION ALL SELECT 'rfm_is_reachable', CAST((SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM f) AS BIGINT)
    UNION ALL SELECT 'snapshots_aligned', CAST((SELECT count(*) FILTER (cob_dt <> DATE '{DAY}') FROM m) + (SELECT count(*) FILTER (cob_dt <> DATE '{DAY}') FROM f) AS BIGINT)
    UNION ALL SELECT 'age_in_range', count(*) FROM m WHERE age < 0 OR age > 60
    UNION ALL SELECT 'txn_amount_positive', count(*) FROM m WHERE txn_amount_30d < 0"""


#: Fewer customers than this are no whole mart, and a score is in this range.
LEAST_CUSTOMERS, SCORES = 1000, (1, 100)


def out_of_range(column: str, low: object, high: object) -> Column:
    return F.count_if((F.col(column) < low) | (F.col(column) > high))


@query("dq21_serving_tests", _customer_tests_sql())
def serving_tests(r: Roles) -> DataFrame:
    """Failures of each test: one aggregation a table, which the tests of that table share."""
    day = F.col("cob_dt") != F.lit(DAY)
    none = lambda c: F.count_if(c) == 0
    failed = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    mart = served(r, "mart_customer_360_current").agg(
        F.count_if((F.col("total_deposit_balance") < 0) | (F.col("aum_total") < 0) | (F.col("total_loan_outstanding") < 0)).alias("balances_non_negative"),
        failed((F.count("*") < LEAST_CUSTOMERS) | none(F.col("customer_segment") == "BUILDING") | none(F.col("customer_segment") == "VIP") | none(F.col("kyc_status") == "VERIFIED")).alias("customer_360_complete"),
        F.count_if(day).alias("m_days"), out_of_range("age", 0, 60).alias("age_in_range"), F.count_if(F.col("txn_amount_30d") < 0).alias("txn_amount_positive"),
    )
    twice = served(r, "mart_customer_360_current").groupBy("customer_id").count().where("count > 1").agg(F.count("*").alias("no_duplicate_customers"))
    rfm = served(r, "rfm_segment_current").agg((out_of_range("rfm_score", *SCORES) + F.count_if(F.col("rfm_segment").isNull())).alias("rfm_scores_valid"), failed(F.count("*") == 0).alias("rfm_is_reachable"), F.count_if(day).alias("f_days"))
    loans = served(r, "loan_portfolio_risk_current").agg(out_of_range("late_payment_rate", 0, 1).alias("loan_rates_bounded"))
    row = mart.crossJoin(twice).crossJoin(rfm).crossJoin(loans).withColumn("snapshots_aligned", F.col("m_days") + F.col("f_days")).drop("m_days", "f_days")
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("test_name"), F.col(c).alias("failures")) for c in row.columns])).alias("t")).select("t.*")


# Distributions that dashboards show: counts of a mart by its labels.


def _share_sql(mart: str, label: str) -> str:
    return f"WITH m AS ({ORACLES[mart]}) SELECT {label}, count(*) AS customers, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share FROM m GROUP BY {label}"


def shares_by(df: DataFrame, label: str) -> DataFrame:
    """Rows of each label and their share of all: the total comes from the counts, not from the rows again."""
    counts = df.groupBy(label).agg(F.count("*").alias("customers"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("customers").alias("_all")))).select(label, "customers", (F.col("customers").cast("double") / F.col("_all")).alias("share"))


@query("m25_churn_distribution", _share_sql("m9_churn_rules", "churn_risk"))
def churn_distribution(r: Roles) -> DataFrame:
    return shares_by(customer_marts.churn_rules(r), "churn_risk")


@query("m25_aum_distribution", _share_sql("m2_balance_summary", "aum_bucket"))
def aum_distribution(r: Roles) -> DataFrame:
    return shares_by(customer_marts.balance_summary(r), "aum_bucket")


@query(
    "m25_rfm_distribution",
    f"WITH m AS ({ORACLES['m8_rfm_segment']}) SELECT rfm_segment, count(*) AS customers, CAST(sum(recency_days) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_recency, CAST(sum(frequency) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_frequency, CAST(sum(monetary) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_monetary FROM m GROUP BY rfm_segment",
)
def rfm_distribution(r: Roles) -> DataFrame:
    n = F.count("*")
    means = [ratio(F.sum(c), n).alias(f"mean_{name}") for c, name in (("recency_days", "recency"), ("frequency", "frequency"), ("monetary", "monetary"))]
    return customer_marts.rfm_segment(r).groupBy("rfm_segment").agg(n.alias("customers"), *means)


#: Campaigns in the order in which they are chosen.
CAMPAIGNS = ("Retention", "Cross_Sell_CC", "Cross_Sell", "Upsell", "Awareness")


@query(
    "m25_campaign_by_segment",
    f"WITH m AS ({ORACLES['m11_campaign_target']}) SELECT rfm_segment, {', '.join(f'count(*) FILTER (campaign_type = {chr(39)}{c}{chr(39)}) AS {c.lower()}' for c in CAMPAIGNS)}, count(*) AS customers FROM m GROUP BY rfm_segment",
)
def campaign_by_segment(r: Roles) -> DataFrame:
    counts = [F.count_if(F.col("campaign_type") == c).alias(c.lower()) for c in CAMPAIGNS]
    return customer_marts.campaign_target(r).groupBy("rfm_segment").agg(*counts, F.count("*").alias("customers"))


@query("m25_opportunities", _share_sql("m10_cross_sell", "primary_opportunity"))
def opportunities(r: Roles) -> DataFrame:
    return shares_by(customer_marts.cross_sell(r), "primary_opportunity")
