"""Marts at the grain of a customer. Facts are aggregated to that grain before they are joined."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import flag, ladder, money, ratio, zero
from tierline.functions.privacy import first_token
from tierline.functions.time import business_date, business_window
from tierline.operators.ranking import ntile
from tierline.operators.scd import latest_copy
from tierline.plans.registry import query
from tierline.plans.roles import DAY, Roles
from tierline.sources.shared import durable

NEVER = dt.date(1900, 1, 1)


def top_channel(txns: DataFrame, by: str, channel: str, name: str) -> DataFrame:
    """The most frequent channel of each group; of equal counts the first by name."""
    counts = txns.groupBy(by, channel).agg(F.count("*").alias("n"))
    first = F.min_by(channel, F.struct((-F.col("n")).alias("n"), F.col(channel)))
    return counts.groupBy(by).agg(first.alias(name))


#: Role amounts are in thousands, the bounds below are not.
UNIT = 1000
#: Least assets of each bucket, from the top; all others are MASS.
AUM_STEPS = [(5_000_000_000, "VIP"), (1_000_000_000, "PRIORITY"), (100_000_000, "AFFLUENT")]
#: Least totals of the three scores for each segment, from the top; all others are Lost.
RFM_STEPS = [(13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"), (5, "New Customers"), (3, "At Risk"), (2, "Hibernating")]
#: Idle days beyond which a customer is at each risk, from the top; all others are Active.
CHURN_STEPS = [(90, "High"), (60, "Medium"), (30, "Low")]
#: Transactions that are no spending.
GIVEN_BACK = ("REFUND", "REVERSAL")
NEVER_TS = "TIMESTAMP_NTZ'1900-01-01 00:00:00'"

_ACTIVITY_SQL = """activity AS (
        SELECT customer_id, count(*) FILTER (cob_dt >= DATE '2001-05-31') AS n30, coalesce(sum(spent) FILTER (cob_dt >= DATE '2001-05-31'), 0) AS s30, max(txn_ts) FILTER (cob_dt >= DATE '2001-05-31') AS last30,
               count(*) FILTER (cob_dt >= DATE '2001-04-01') AS n90, coalesce(sum(spent) FILTER (cob_dt >= DATE '2001-04-01'), 0) AS s90, max(txn_ts) FILTER (cob_dt >= DATE '2001-04-01') AS last90, max(txn_ts) AS last365
        FROM (SELECT customer_id, cob_dt, txn_ts, abs(amount) AS spent FROM account_txn
              UNION ALL SELECT customer_id, cob_dt, txn_ts, CASE WHEN txn_type NOT IN ('REFUND', 'REVERSAL') THEN amount END FROM card_txn WHERE status = 'SUCCESS')
        WHERE cob_dt BETWEEN DATE '2000-06-30' AND DATE '2001-06-30' GROUP BY customer_id)"""
_DAYS_SINCE_SQL = "CAST(DATE '2001-06-30' - CAST(coalesce({}, TIMESTAMP '1900-01-01 00:00:00') + INTERVAL 7 HOUR AS DATE) AS INTEGER)"
_RFM_SQL = f"""rfm_base AS (SELECT customer_id, {_DAYS_SINCE_SQL.format("last90")} AS recency_days, coalesce(n90, 0) AS frequency, CAST(coalesce(s90, 0) AS DECIMAL(18,2)) AS monetary FROM dim_customer LEFT JOIN activity USING (customer_id)),
    rfm_scores AS (SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score, CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score, CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score FROM rfm_base),
    rfm AS (SELECT *, r_score + f_score + m_score AS rfm_score, CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions' WHEN r_score + f_score + m_score >= 10 THEN 'Loyal Customers' WHEN r_score + f_score + m_score >= 7 THEN 'Potential Loyalists'
                   WHEN r_score + f_score + m_score >= 5 THEN 'New Customers' WHEN r_score + f_score + m_score >= 3 THEN 'At Risk' WHEN r_score + f_score + m_score >= 2 THEN 'Hibernating' ELSE 'Lost' END AS rfm_segment FROM rfm_scores)"""
_HOLDINGS_SQL = """held_accounts AS (SELECT customer_id, count(*) AS total_accounts, coalesce(sum(balance) FILTER (status = 'ACTIVE'), 0) AS deposits FROM dim_account GROUP BY customer_id),
    held_loans AS (SELECT customer_id, count(*) AS total_loans, sum(outstanding) AS owed FROM loan GROUP BY customer_id),
    holdings AS (SELECT customer_id, coalesce(total_accounts, 0) AS total_accounts, coalesce(total_loans, 0) AS total_loans, CAST(coalesce(deposits, 0) AS DECIMAL(18,2)) AS deposits, CAST(coalesce(owed, 0) AS DECIMAL(18,2)) AS owed,
                 CAST(coalesce(deposits, 0) + coalesce(owed, 0) AS DECIMAL(18,2)) AS aum_total,
                 CASE WHEN (coalesce(deposits, 0) + coalesce(owed, 0)) * 1000 >= 5000000000 THEN 'VIP' WHEN (coalesce(deposits, 0) + coalesce(owed, 0)) * 1000 >= 1000000000 THEN 'PRIORITY' WHEN (coalesce(deposits, 0) + coalesce(owed, 0)) * 1000 >= 100000000 THEN 'AFFLUENT' ELSE 'MASS' END AS aum_bucket
                 FROM dim_customer LEFT JOIN held_accounts USING (customer_id) LEFT JOIN held_loans USING (customer_id))"""


def activity(r: Roles, days: int = 365) -> DataFrame:
    """One row a customer with transactions in the last days: counts, spending and last instants of 30, 90 and all days."""
    account = business_window(r.account_txn, DAY, days).select("customer_id", "cob_dt", "txn_ts", F.abs("amount").alias("spent"))
    card = business_window(r.card_txn, DAY, days).where("status = 'SUCCESS'").select("customer_id", "cob_dt", "txn_ts", F.when(~F.col("txn_type").isin(*GIVEN_BACK), F.col("amount")).alias("spent"))
    since = lambda n: F.col("cob_dt") >= F.lit(DAY - dt.timedelta(days=n))
    figures = [x for n in (30, 90) for x in (F.count_if(since(n)).alias(f"n{n}"), F.sum(F.when(since(n), F.col("spent"))).alias(f"s{n}"), F.max(F.when(since(n), F.col("txn_ts"))).alias(f"last{n}"))]
    return account.unionByName(card).groupBy("customer_id").agg(*figures, F.max("txn_ts").alias("last365"))


def days_since(ts: str) -> Column:
    """Business days from an instant to DAY; without one, from the start of 1900."""
    return F.date_diff(F.lit(DAY), business_date(F.coalesce(F.col(ts), F.expr(NEVER_TS))))


def rfm_scores(r: Roles, facts: DataFrame) -> DataFrame:
    """customer_id, recency_days, frequency, monetary, the three scores (worst first, so that 5 is best; ties by customer), their sum and segment.

    The three ntiles run over slices of one durable table of a row a customer, one after the other and without joins.
    """
    base = r.customer.select("customer_id").join(facts, "customer_id", "left").select("customer_id", days_since("last90").alias("recency_days"), F.coalesce("n90", F.lit(0)).alias("frequency"), zero(F.col("s90")).alias("monetary"))
    out = base = durable(base)
    rows = base.count()
    for name, order in (("r_score", -F.col("recency_days")), ("f_score", F.col("frequency")), ("m_score", F.col("monetary"))):
        out = ntile(out, 5, [order, F.col("customer_id")], name, rows, of=base)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return out.withColumns({"rfm_score": total, "rfm_segment": ladder(total, RFM_STEPS, "Lost")})


def holdings(r: Roles) -> DataFrame:
    """One row a customer: numbers of accounts and loans, deposits, debt, assets and their bucket."""
    accounts = r.account.groupBy("customer_id").agg(F.count("*").alias("a"), F.sum(F.when(F.col("status") == "ACTIVE", F.col("balance"))).alias("d"))
    loans = r.loan.groupBy("customer_id").agg(F.count("*").alias("l"), F.sum("outstanding").alias("o"))
    rows = r.customer.select("customer_id").join(accounts, "customer_id", "left").join(loans, "customer_id", "left")
    rows = rows.select("customer_id", F.coalesce("a", F.lit(0)).alias("total_accounts"), F.coalesce("l", F.lit(0)).alias("total_loans"), zero(F.col("d")).alias("deposits"), zero(F.col("o")).alias("owed"))
    rows = rows.withColumn("aum_total", money(F.col("deposits") + F.col("owed")))
    return rows.withColumn("aum_bucket", ladder(F.col("aum_total") * UNIT, AUM_STEPS, "MASS"))


def card_holdings(r: Roles) -> DataFrame:
    """One row a customer that has cards."""
    active = lambda kind: F.count_if((F.col("card_type") == kind) & (F.col("status") == "ACTIVE"))
    return r.card.groupBy("customer_id").agg(F.count("*").alias("cards"), active("CREDIT").alias("credit"), active("DEBIT").alias("debit"), F.max(F.when(F.col("card_type") == "CREDIT", F.col("credit_limit"))).alias("max_credit_limit"))


@query(
    "m1_customer_360",
    f"""
    WITH {_ACTIVITY_SQL}, {_RFM_SQL}, {_HOLDINGS_SQL},
    ch AS (SELECT customer_id, channel FROM (SELECT customer_id, channel, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, channel) AS k FROM account_txn WHERE cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30' GROUP BY customer_id, channel) WHERE k = 1),
    cd AS (SELECT customer_id, count(*) AS cards, count(*) FILTER (card_type = 'CREDIT' AND status = 'ACTIVE') AS credit FROM dim_card GROUP BY customer_id),
    crm AS (SELECT customer_id, count(*) AS n, max(ts) AS last FROM interaction WHERE cob_dt BETWEEN DATE '2001-04-01' AND DATE '2001-06-30' GROUP BY customer_id),
    dg AS (SELECT customer_id, count(*) AS n, sum(amount) AS s, count(DISTINCT channel) AS channels, count(DISTINCT device_id) AS devices, max(ts) AS last FROM online WHERE status = 'SUCCESS' AND cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30' GROUP BY customer_id)
    SELECT d.customer_id, d.customer_sk, split_part(full_name, ' ', 1) || ' **' AS full_name_masked, CAST(floor((DATE '2001-06-30' - date_of_birth) / 365) AS INTEGER) AS age, gender, d.branch_id AS primary_branch_code, segment AS customer_segment, kyc_status, register_date,
           total_accounts, coalesce(cards, 0) AS total_cards, total_loans, CASE WHEN coalesce(credit, 0) > 0 THEN 1 ELSE 0 END AS has_credit_card, CASE WHEN deposits > 0 THEN 1 ELSE 0 END AS has_savings, CASE WHEN total_loans > 0 THEN 1 ELSE 0 END AS has_loan,
           deposits AS total_deposit_balance, owed AS total_loan_outstanding, aum_total, aum_bucket, coalesce(n30, 0) AS txn_count_30d, CAST(coalesce(s30, 0) AS DECIMAL(18,2)) AS txn_amount_30d, coalesce(last30, TIMESTAMP '1900-01-01 00:00:00') AS last_txn_date,
           {_DAYS_SINCE_SQL.format("last30")} AS days_since_last_txn, coalesce(ch.channel, 'UNKNOWN') AS primary_channel, coalesce(crm.n, 0) AS interaction_count_90d, crm.last AS last_interaction_date,
           coalesce(dg.n, 0) AS digital_txn_count_30d, CAST(coalesce(dg.s, 0) AS DECIMAL(18,2)) AS digital_txn_amount_30d, coalesce(channels, 0) AS digital_channel_count_30d, coalesce(devices, 0) AS digital_device_count_30d, dg.last AS last_digital_txn_date,
           CASE WHEN dg.n > 0 THEN 1 ELSE 0 END AS is_digital_active, r_score AS rfm_recency_score, f_score AS rfm_frequency_score, m_score AS rfm_monetary_score, rfm_segment, CASE WHEN {_DAYS_SINCE_SQL.format("last30")} > 90 THEN 1 ELSE 0 END AS churn_flag,
           CASE WHEN aum_total * 1000 >= 100000000 AND coalesce(credit, 0) = 0 THEN 1 ELSE 0 END AS cross_sell_credit_card_flag, DATE '2001-06-30' AS cob_dt
    FROM dim_customer d JOIN profile USING (customer_id) JOIN rfm USING (customer_id) JOIN holdings USING (customer_id) LEFT JOIN activity USING (customer_id) LEFT JOIN ch USING (customer_id) LEFT JOIN cd USING (customer_id) LEFT JOIN crm USING (customer_id) LEFT JOIN dg USING (customer_id)""",
)
def customer_360(r: Roles) -> DataFrame:
    facts = durable(activity(r, 90))  # the scores and the mart itself read it
    contacts = business_window(r.interaction, DAY, 90).groupBy("customer_id").agg(F.count("*").alias("contacts"), F.max("ts").alias("last_contact"))
    # Distinct channels and devices are counted at their own grain first; few rows reach the second aggregate.
    seen = business_window(r.online, DAY, 30).where("status = 'SUCCESS'").groupBy("customer_id", "channel", "device_id").agg(F.count("*").alias("n"), F.sum("amount").alias("s"), F.max("ts").alias("last"))
    digital = seen.groupBy("customer_id").agg(F.sum("n").alias("dn"), F.sum("s").alias("ds"), F.size(F.collect_set("channel")).alias("dc"), F.size(F.collect_set("device_id")).alias("dd"), F.max("last").alias("dl"))
    channel = top_channel(business_window(r.account_txn, DAY, 30), "customer_id", "channel", "top")
    joined = r.customer.join(r.profile, "customer_id")
    for part, how in ((rfm_scores(r, facts), "inner"), (holdings(r), "inner"), (facts, "left"), (channel, "left"), (card_holdings(r), "left"), (contacts, "left"), (digital, "left")):
        joined = joined.join(part, "customer_id", how)
    none = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    no_credit = F.coalesce("credit", F.lit(0)) == 0
    return joined.select(
        "customer_id", "customer_sk", first_token(F.col("full_name")).alias("full_name_masked"), F.floor(F.date_diff(F.lit(DAY), F.col("date_of_birth")) / 365).cast("int").alias("age"), "gender", F.col("branch_id").alias("primary_branch_code"),
        F.col("segment").alias("customer_segment"), "kyc_status", "register_date", "total_accounts", none("cards", "total_cards"), "total_loans", flag(~no_credit).alias("has_credit_card"), flag(F.col("deposits") > 0).alias("has_savings"),
        flag(F.col("total_loans") > 0).alias("has_loan"), F.col("deposits").alias("total_deposit_balance"), F.col("owed").alias("total_loan_outstanding"), "aum_total", "aum_bucket", none("n30", "txn_count_30d"), zero(F.col("s30")).alias("txn_amount_30d"),
        F.coalesce(F.col("last30"), F.expr(NEVER_TS)).alias("last_txn_date"), days_since("last30").alias("days_since_last_txn"), F.coalesce("top", F.lit("UNKNOWN")).alias("primary_channel"), none("contacts", "interaction_count_90d"),
        F.col("last_contact").alias("last_interaction_date"), none("dn", "digital_txn_count_30d"), zero(F.col("ds")).alias("digital_txn_amount_30d"), none("dc", "digital_channel_count_30d"), none("dd", "digital_device_count_30d"),
        F.col("dl").alias("last_digital_txn_date"), flag(F.col("dn") > 0).alias("is_digital_active"), F.col("r_score").alias("rfm_recency_score"), F.col("f_score").alias("rfm_frequency_score"), F.col("m_score").alias("rfm_monetary_score"), "rfm_segment",
        flag(days_since("last30") > 90).alias("churn_flag"), flag((F.col("aum_total") * UNIT >= AUM_STEPS[-1][0]) & no_credit).alias("cross_sell_credit_card_flag"), F.lit(DAY).alias("cob_dt"),
    )


@query("m2_balance_summary", f"WITH {_HOLDINGS_SQL} SELECT customer_id, total_accounts, total_loans, deposits AS total_deposit_balance, owed AS total_loan_outstanding, aum_total, aum_bucket, DATE '2001-06-30' AS cob_dt FROM holdings")
def balance_summary(r: Roles) -> DataFrame:
    return holdings(r).select("customer_id", "total_accounts", "total_loans", F.col("deposits").alias("total_deposit_balance"), F.col("owed").alias("total_loan_outstanding"), "aum_total", "aum_bucket", F.lit(DAY).alias("cob_dt"))


@query(
    "m3_card_summary",
    """
    WITH h AS (SELECT customer_id, count(*) AS cards, count(*) FILTER (card_type = 'CREDIT' AND status = 'ACTIVE') AS credit, count(*) FILTER (card_type = 'DEBIT' AND status = 'ACTIVE') AS debit, max(CASE WHEN card_type = 'CREDIT' THEN credit_limit END) AS max_credit_limit FROM dim_card GROUP BY customer_id),
    t AS (SELECT customer_id, count(*) AS n, sum(CASE WHEN txn_type NOT IN ('REFUND', 'REVERSAL') THEN amount END) AS s, count(*) FILTER (txn_type NOT IN ('REFUND', 'REVERSAL')) AS k, count(DISTINCT mcc) AS categories, max(txn_ts) AS last
          FROM card_txn LEFT JOIN merchant USING (merchant_id) WHERE status = 'SUCCESS' AND cob_dt BETWEEN DATE '2001-05-31' AND DATE '2001-06-30' GROUP BY customer_id)
    SELECT customer_id, customer_sk, coalesce(cards, 0) AS total_cards, coalesce(credit, 0) AS cnt_credit_active, coalesce(debit, 0) AS cnt_debit_active, max_credit_limit, coalesce(n, 0) AS total_card_txn_count_30d, CAST(coalesce(s, 0) AS DECIMAL(18,2)) AS total_card_txn_amount_30d,
           coalesce(CAST(s AS DOUBLE) / nullif(CAST(k AS DOUBLE), 0), 0) AS avg_card_txn_amount_30d, coalesce(categories, 0) AS distinct_merchant_categories, last AS last_card_txn_date, DATE '2001-06-30' AS cob_dt
    FROM dim_customer LEFT JOIN h USING (customer_id) LEFT JOIN t USING (customer_id)""",
)
def card_summary(r: Roles) -> DataFrame:
    good = business_window(r.card_txn, DAY, 30).where("status = 'SUCCESS'").join(r.merchant.select("merchant_id", "mcc"), "merchant_id", "left")
    spent = ~F.col("txn_type").isin(*GIVEN_BACK)
    seen = good.groupBy("customer_id", "mcc").agg(F.count("*").alias("n"), F.sum(F.when(spent, F.col("amount"))).alias("s"), F.count_if(spent).alias("k"), F.max("txn_ts").alias("last"))
    txns = seen.groupBy("customer_id").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("k").alias("k"), F.count("mcc").alias("categories"), F.max("last").alias("last"))
    joined = r.customer.join(card_holdings(r), "customer_id", "left").join(txns, "customer_id", "left")
    none = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    return joined.select(
        "customer_id", "customer_sk", none("cards", "total_cards"), none("credit", "cnt_credit_active"), none("debit", "cnt_debit_active"), "max_credit_limit", none("n", "total_card_txn_count_30d"), zero(F.col("s")).alias("total_card_txn_amount_30d"),
        F.coalesce(ratio(F.col("s"), F.col("k")), F.lit(0.0)).alias("avg_card_txn_amount_30d"), none("categories", "distinct_merchant_categories"), F.col("last").alias("last_card_txn_date"), F.lit(DAY).alias("cob_dt"),
    )


@query(
    "m4_loan_summary",
    """
    WITH l AS (
      SELECT customer_id, count(*) AS total_loans, count(*) FILTER (loan_status = 'ACTIVE') AS active_loans, count(*) FILTER (loan_status = 'OVERDUE') AS overdue_loans,
             count(*) FILTER (loan_status = 'WRITTEN_OFF') AS written_off_loans, CAST(sum(loan_amount) AS DECIMAL(18,2)) AS amount, CAST(sum(outstanding) AS DECIMAL(18,2)) AS outstanding,
             CAST(sum(interest_rate) AS DOUBLE) / count(interest_rate) AS rate, max(term_months) AS term
      FROM loan_terms GROUP BY customer_id),
    p AS (
      SELECT customer_id, count(*) AS n, count(*) FILTER (payment_status = 'LATE' OR days_late % 7 = 0) AS late, count(*) FILTER (payment_status = 'MISSED') AS missed,
             CAST(sum(paid) AS DECIMAL(18,2)) AS paid, CAST(sum(penalty) AS DECIMAL(18,2)) AS penalty
      FROM payment JOIN loan USING (loan_id) GROUP BY customer_id),
    d AS (SELECT customer_id, coalesce(sum(CASE WHEN status = 'ACTIVE' THEN balance END), 0) AS deposits FROM dim_account GROUP BY customer_id)
    SELECT customer_id, customer_sk, coalesce(total_loans, 0) AS total_loans, coalesce(active_loans, 0) AS active_loans, coalesce(overdue_loans, 0) AS overdue_loans, coalesce(written_off_loans, 0) AS written_off_loans,
           CAST(coalesce(amount, 0) AS DECIMAL(18,2)) AS total_loan_amount, CAST(coalesce(outstanding, 0) AS DECIMAL(18,2)) AS total_loan_outstanding, round(coalesce(rate, 0), 4) AS avg_loan_interest_rate,
           coalesce(term, 0) AS max_loan_term_months, coalesce(n, 0) AS payment_count, coalesce(late, 0) AS late_payment_count, coalesce(missed, 0) AS missed_payment_count,
           CAST(coalesce(paid, 0) AS DECIMAL(18,2)) AS total_amount_paid, CAST(coalesce(penalty, 0) AS DECIMAL(18,2)) AS total_penalty,
           CASE WHEN coalesce(n, 0) = 0 THEN 0.0::DOUBLE ELSE CAST(late AS DOUBLE) / n END AS late_payment_rate, CASE WHEN coalesce(n, 0) = 0 THEN 0.0::DOUBLE ELSE CAST(missed AS DOUBLE) / n END AS missed_payment_rate,
           CASE WHEN coalesce(deposits, 0) = 0 THEN NULL ELSE round(CAST(coalesce(outstanding, 0) AS DOUBLE) / CAST(deposits AS DOUBLE), 6) END AS loan_to_deposit_ratio, DATE '2001-06-30' AS cob_dt
    FROM dim_customer LEFT JOIN l USING (customer_id) LEFT JOIN p USING (customer_id) LEFT JOIN d USING (customer_id)""",
)
def loan_summary(r: Roles) -> DataFrame:
    """Loans, repayments and deposits of each customer, each summed to the customer before it is joined."""
    is_ = lambda s: F.count_if(F.col("loan_status") == s)
    late = (F.col("payment_status") == "LATE") | (F.col("days_late") % 7 == 0)  # the second is the source's own late flag
    paid = r.payment.groupBy("loan_id").agg(F.count("*").alias("n"), F.count_if(late).alias("late"), F.count_if(F.col("payment_status") == "MISSED").alias("missed"), F.sum("paid").alias("paid"), F.sum("penalty").alias("penalty"))
    loans = r.loan_terms.join(paid, "loan_id", "left").groupBy("customer_id").agg(
        F.count("*").alias("k"), is_("ACTIVE").alias("active"), is_("OVERDUE").alias("overdue"), is_("WRITTEN_OFF").alias("gone"), F.sum("loan_amount").alias("amount"), F.sum("outstanding").alias("outstanding"),
        ratio(F.sum("interest_rate"), F.count("interest_rate")).alias("rate"), F.max("term_months").alias("term"), *[F.sum(c).alias(c) for c in ("n", "late", "missed", "paid", "penalty")],
    )
    deposits = r.account.groupBy("customer_id").agg(F.sum(F.when(F.col("status") == "ACTIVE", F.col("balance"))).alias("deposits"))
    joined = r.customer.join(loans, "customer_id", "left").join(deposits, "customer_id", "left")
    none = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    rate = lambda c: F.coalesce(ratio(F.col(c), F.col("n")), F.lit(0.0))
    return joined.select(
        "customer_id", "customer_sk", none("k", "total_loans"), none("active", "active_loans"), none("overdue", "overdue_loans"), none("gone", "written_off_loans"), zero(F.col("amount")).alias("total_loan_amount"),
        zero(F.col("outstanding")).alias("total_loan_outstanding"), F.round(F.coalesce("rate", F.lit(0.0)), 4).alias("avg_loan_interest_rate"), none("term", "max_loan_term_months"), none("n", "payment_count"), none("late", "late_payment_count"),
        none("missed", "missed_payment_count"), zero(F.col("paid")).alias("total_amount_paid"), zero(F.col("penalty")).alias("total_penalty"), rate("late").alias("late_payment_rate"), rate("missed").alias("missed_payment_rate"),
        F.round(ratio(zero(F.col("outstanding")), F.col("deposits")), 6).alias("loan_to_deposit_ratio"), F.lit(DAY).alias("cob_dt"),
    )


@query(
    "m5_product_summary",
    """
    WITH a AS (SELECT customer_id, count(*) AS n, count(*) FILTER (account_type = 'CASA' AND status = 'ACTIVE') AS casa, count(*) FILTER (account_type = 'TIME_DEPOSIT' AND status = 'ACTIVE') AS td FROM dim_account GROUP BY customer_id),
    c AS (SELECT customer_id, count(*) AS n, count(*) FILTER (card_type = 'CREDIT' AND status = 'ACTIVE') AS credit, count(*) FILTER (card_type = 'DEBIT' AND status = 'ACTIVE') AS debit FROM dim_card GROUP BY customer_id),
    l AS (SELECT customer_id, count(*) AS n FROM loan GROUP BY customer_id)
    SELECT customer_id, customer_sk, coalesce(a.n, 0) AS total_accounts, coalesce(casa, 0) AS cnt_casa_active, coalesce(td, 0) AS cnt_td_active, coalesce(c.n, 0) AS total_cards, coalesce(credit, 0) AS cnt_credit_cards,
           coalesce(debit, 0) AS cnt_debit_cards, CASE WHEN credit > 0 THEN 1 ELSE 0 END AS has_credit_card, CASE WHEN a.n > 0 THEN 1 ELSE 0 END AS has_savings, CASE WHEN l.n > 0 THEN 1 ELSE 0 END AS has_loan, DATE '2001-06-30' AS cob_dt
    FROM dim_customer LEFT JOIN a USING (customer_id) LEFT JOIN c USING (customer_id) LEFT JOIN l USING (customer_id)""",
)
def product_summary(r: Roles) -> DataFrame:
    """Accounts, cards and loans that each customer holds."""
    active = lambda kind: F.count_if((F.col("account_type") == kind) & (F.col("status") == "ACTIVE"))
    accounts = r.account.groupBy("customer_id").agg(F.count("*").alias("accounts"), active("CASA").alias("casa"), active("TIME_DEPOSIT").alias("td"))
    joined = r.customer.join(accounts, "customer_id", "left").join(card_holdings(r), "customer_id", "left").join(r.loan.groupBy("customer_id").agg(F.count("*").alias("loans")), "customer_id", "left")
    none = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    return joined.select(
        "customer_id", "customer_sk", none("accounts", "total_accounts"), none("casa", "cnt_casa_active"), none("td", "cnt_td_active"), none("cards", "total_cards"), none("credit", "cnt_credit_cards"), none("debit", "cnt_debit_cards"),
        flag(F.col("credit") > 0).alias("has_credit_card"), flag(F.col("accounts") > 0).alias("has_savings"), flag(F.col("loans") > 0).alias("has_loan"), F.lit(DAY).alias("cob_dt"),
    )


_LAST_COPY_SQL = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY cob_dt DESC, txn_ts DESC, amount DESC, {1} DESC) AS rn FROM {0} WHERE cob_dt <= DATE '2001-06-30') WHERE rn = 1"


@query(
    "m6_transaction_summary",
    f"""
    WITH a AS (
      SELECT customer_id, count(*) AS n, sum(abs(amount)) AS s, count(*) FILTER (dc = 'C') AS credits, count(*) FILTER (dc = 'D') AS debits, max(txn_ts) AS last
      FROM ({_LAST_COPY_SQL.format("account_copies", "channel")}) WHERE CAST(txn_ts + INTERVAL 7 HOUR AS DATE) BETWEEN DATE '2001-05-31' AND DATE '2001-06-30' GROUP BY customer_id),
    c AS (
      SELECT customer_id, count(*) AS n, sum(CASE WHEN txn_type NOT IN ('REFUND', 'REVERSAL') THEN amount ELSE 0 END) AS s, max(txn_ts) AS last
      FROM ({_LAST_COPY_SQL.format("card_copies", "card_id")}) WHERE status = 'SUCCESS' AND CAST(txn_ts + INTERVAL 7 HOUR AS DATE) BETWEEN DATE '2001-05-31' AND DATE '2001-06-30' GROUP BY customer_id)
    SELECT customer_id, customer_sk, coalesce(a.n, 0) AS acct_txn_count_30d, CAST(coalesce(a.s, 0) AS DECIMAL(18,2)) AS acct_txn_amount_30d, coalesce(credits, 0) AS acct_credit_count_30d, coalesce(debits, 0) AS acct_debit_count_30d,
           coalesce(c.n, 0) AS card_txn_count_30d, CAST(coalesce(c.s, 0) AS DECIMAL(18,2)) AS card_txn_amount_30d, coalesce(a.n, 0) + coalesce(c.n, 0) AS total_txn_count_30d,
           CAST(coalesce(a.s, 0) + coalesce(c.s, 0) AS DECIMAL(18,2)) AS total_txn_amount_30d, greatest(coalesce(a.last, TIMESTAMP '1900-01-01 00:00:00'), coalesce(c.last, TIMESTAMP '1900-01-01 00:00:00')) AS last_txn_date, DATE '2001-06-30' AS cob_dt
    FROM dim_customer LEFT JOIN a USING (customer_id) LEFT JOIN c USING (customer_id)""",
)
def transaction_summary(r: Roles) -> DataFrame:
    """Account and card transactions of 30 business days, each in its newest copy as of DAY."""
    recent = F.col("day").between(F.lit(DAY - dt.timedelta(days=30)), F.lit(DAY))
    # A copy keeps its transaction's time, so older transactions need no resolution: the days are cut first.
    newest = lambda rows, tie: latest_copy(rows.withColumn("day", business_date(F.col("txn_ts"))).where(recent), ["txn_id"], "cob_dt", DAY, ["txn_ts", "amount", tie])
    accounts = newest(r.account_copies.select("txn_id", "customer_id", "txn_ts", "amount", "dc", "channel", "cob_dt"), "channel").groupBy("customer_id").agg(
        F.count("*").alias("an"), F.sum(F.abs("amount")).alias("as"), F.count_if(F.col("dc") == "C").alias("credits"), F.count_if(F.col("dc") == "D").alias("debits"), F.max("txn_ts").alias("al")
    )
    cards = newest(r.card_copies.select("txn_id", "customer_id", "txn_ts", "amount", "txn_type", "status", "card_id", "cob_dt"), "card_id").where("status = 'SUCCESS'").groupBy("customer_id").agg(
        F.count("*").alias("cn"), F.sum(F.when(~F.col("txn_type").isin(*GIVEN_BACK), F.col("amount"))).alias("cs"), F.max("txn_ts").alias("cl")
    )
    joined = r.customer.join(accounts, "customer_id", "left").join(cards, "customer_id", "left")
    none = lambda c: F.coalesce(c, F.lit(0))
    last = lambda c: F.coalesce(c, F.expr(NEVER_TS))
    return joined.select(
        "customer_id", "customer_sk", none("an").alias("acct_txn_count_30d"), zero(F.col("as")).alias("acct_txn_amount_30d"), none("credits").alias("acct_credit_count_30d"), none("debits").alias("acct_debit_count_30d"),
        none("cn").alias("card_txn_count_30d"), zero(F.col("cs")).alias("card_txn_amount_30d"), (none("an") + none("cn")).alias("total_txn_count_30d"), money(zero(F.col("as")) + zero(F.col("cs"))).alias("total_txn_amount_30d"),
        F.greatest(last("al"), last("cl")).alias("last_txn_date"), F.lit(DAY).alias("cob_dt"),
    )


@query("m8_rfm_segment", f"WITH {_ACTIVITY_SQL}, {_RFM_SQL} SELECT customer_id, customer_sk, recency_days, frequency, monetary, r_score, f_score, m_score, rfm_score, rfm_segment, DATE '2001-06-30' AS cob_dt FROM rfm JOIN dim_customer USING (customer_id)")
def rfm_segment(r: Roles, facts: DataFrame | None = None) -> DataFrame:
    scored = rfm_scores(r, activity(r, 90) if facts is None else facts).join(r.customer.select("customer_id", "customer_sk"), "customer_id")
    return scored.select("customer_id", "customer_sk", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score", "rfm_segment", F.lit(DAY).alias("cob_dt"))


_CHURN_SQL = f"""churn AS (
        SELECT *, CASE WHEN days_since_last_txn > 90 THEN 'High' WHEN days_since_last_txn > 60 THEN 'Medium' WHEN days_since_last_txn > 30 THEN 'Low' ELSE 'Active' END AS churn_risk, CASE WHEN days_since_last_txn > 90 THEN 1 ELSE 0 END AS is_churn_candidate FROM (
          SELECT customer_id, customer_sk, coalesce(n30, 0) AS txn_cnt_30d, coalesce(n90, 0) AS txn_cnt_90d, CAST(coalesce(s30, 0) AS DECIMAL(18,2)) AS txn_amt_30d, CAST(coalesce(s90, 0) AS DECIMAL(18,2)) AS txn_amt_90d, {_DAYS_SINCE_SQL.format("last365")} AS days_since_last_txn
          FROM dim_customer LEFT JOIN activity USING (customer_id)))"""


@query("m9_churn_rules", f"WITH {_ACTIVITY_SQL}, {_CHURN_SQL} SELECT *, DATE '2001-06-30' AS cob_dt FROM churn")
def churn_rules(r: Roles, facts: DataFrame | None = None) -> DataFrame:
    """By the later of account and card activity of the last year; a customer without any is far beyond each bound."""
    rows = r.customer.join(activity(r) if facts is None else facts, "customer_id", "left").select(
        "customer_id", "customer_sk", F.coalesce("n30", F.lit(0)).alias("txn_cnt_30d"), F.coalesce("n90", F.lit(0)).alias("txn_cnt_90d"), zero(F.col("s30")).alias("txn_amt_30d"), zero(F.col("s90")).alias("txn_amt_90d"),
        days_since("last365").alias("days_since_last_txn"),
    )
    idle = F.col("days_since_last_txn")
    return rows.withColumns({"churn_risk": ladder(idle, CHURN_STEPS, "Active", least=False), "is_churn_candidate": flag(idle > CHURN_STEPS[0][0]), "cob_dt": F.lit(DAY)})


_OFFERS_SQL = """offers AS (
        SELECT customer_id, customer_sk, segment AS customer_segment, CASE WHEN coalesce(credit, 0) = 0 THEN 1 ELSE 0 END AS no_credit_card, CASE WHEN coalesce(debit, 0) = 0 THEN 1 ELSE 0 END AS no_debit_card,
               CASE WHEN coalesce(credit, 0) = 0 THEN 'Credit Card' WHEN coalesce(debit, 0) = 0 THEN 'Debit Card' ELSE 'None' END AS primary_opportunity
        FROM dim_customer LEFT JOIN (SELECT customer_id, count(*) FILTER (card_type = 'CREDIT' AND status = 'ACTIVE') AS credit, count(*) FILTER (card_type = 'DEBIT' AND status = 'ACTIVE') AS debit FROM dim_card GROUP BY customer_id) USING (customer_id))"""


@query("m10_cross_sell", f"WITH {_OFFERS_SQL} SELECT *, DATE '2001-06-30' AS cob_dt FROM offers")
def cross_sell(r: Roles) -> DataFrame:
    lacks = lambda c: F.coalesce(c, F.lit(0)) == 0
    rows = r.customer.join(card_holdings(r), "customer_id", "left")
    offer = F.when(lacks("credit"), "Credit Card").when(lacks("debit"), "Debit Card").otherwise("None")
    return rows.select("customer_id", "customer_sk", F.col("segment").alias("customer_segment"), flag(lacks("credit")).alias("no_credit_card"), flag(lacks("debit")).alias("no_debit_card"), offer.alias("primary_opportunity"), F.lit(DAY).alias("cob_dt"))


_CAMPAIGN_SQL = f"""
    WITH {_ACTIVITY_SQL}, {_RFM_SQL}, {_CHURN_SQL}, {_OFFERS_SQL}, {_HOLDINGS_SQL}
    SELECT customer_id, o.customer_sk, rfm_segment, rfm_score, recency_days, frequency, monetary, churn_risk, is_churn_candidate, days_since_last_txn, customer_segment, aum_total, aum_bucket, branch_id AS primary_branch_code, primary_opportunity, no_credit_card,
           CASE WHEN is_churn_candidate = 1 AND rfm_segment IN ('At Risk', 'Hibernating') THEN 'Retention' WHEN no_credit_card = 1 AND aum_bucket IN ('AFFLUENT', 'PRIORITY', 'VIP') THEN 'Cross_Sell_CC' WHEN primary_opportunity <> 'None' THEN 'Cross_Sell'
                WHEN rfm_segment IN ('Champions', 'Loyal Customers') THEN 'Upsell' ELSE 'Awareness' END AS campaign_type, DATE '2001-06-30' AS cob_dt
    FROM rfm JOIN churn USING (customer_id) JOIN offers o USING (customer_id) JOIN holdings USING (customer_id) JOIN (SELECT customer_id, branch_id FROM dim_customer) USING (customer_id)"""


@query("m11_campaign_target", _CAMPAIGN_SQL)
def campaign_target(r: Roles) -> DataFrame:
    """Four marts of one day, joined on customer and day, so that no other day's rows can multiply them."""
    keys = ["customer_id", "cob_dt"]
    assets = holdings(r).join(r.customer.select("customer_id", F.col("branch_id").alias("primary_branch_code")), "customer_id").withColumn("cob_dt", F.lit(DAY))
    facts = durable(activity(r))  # a year's figures hold those of the shorter windows
    joined = rfm_segment(r, facts).join(churn_rules(r, facts).drop("customer_sk"), keys, "left").join(cross_sell(r).drop("customer_sk"), keys, "left").join(assets, keys, "left")
    rich = F.col("aum_bucket").isin("AFFLUENT", "PRIORITY", "VIP")
    campaign = (
        F.when((F.col("is_churn_candidate") == 1) & F.col("rfm_segment").isin("At Risk", "Hibernating"), "Retention").when((F.col("no_credit_card") == 1) & rich, "Cross_Sell_CC").when(F.col("primary_opportunity") != "None", "Cross_Sell")
        .when(F.col("rfm_segment").isin("Champions", "Loyal Customers"), "Upsell").otherwise("Awareness")
    )
    return joined.select(
        "customer_id", "customer_sk", "rfm_segment", "rfm_score", "recency_days", "frequency", "monetary", "churn_risk", "is_churn_candidate", "days_since_last_txn", "customer_segment", "aum_total", "aum_bucket", "primary_branch_code", "primary_opportunity",
        "no_credit_card", campaign.alias("campaign_type"), "cob_dt",
    )


#: Segments that are a risk, and those that may want another account; days idle that are a risk; the highest assets.
HIGHEST = ("PRIORITY", "VIP")
RISKY, SAVERS, IDLE = ("At Risk", "About to Sleep", "Hibernating", "Lost"), ("Loyal Customers", "Potential Loyalists"), 60


@query(
    "m23_risk_scores",
    f"""
    WITH t AS ({_CAMPAIGN_SQL})
    SELECT customer_id, churn_risk, is_churn_candidate, rfm_segment, rfm_score, days_since_last_txn,
           concat_ws('; ', CASE WHEN is_churn_candidate = 1 THEN 'Churn candidate — high risk of attrition' END, CASE WHEN days_since_last_txn > 60 THEN 'Inactive for ' || days_since_last_txn || ' days' END,
                     CASE WHEN rfm_segment IN ('At Risk', 'About to Sleep', 'Hibernating', 'Lost') THEN 'RFM segment: ' || rfm_segment END, CASE WHEN churn_risk = 'High' THEN 'High churn risk score' END) AS risk_factors, cob_dt
    FROM t""",
)
def risk_scores(r: Roles) -> DataFrame:
    """What a lookup says of the risk of one customer, for all of them at once."""
    idle = F.col("days_since_last_txn")
    factors = F.array(
        F.when(F.col("is_churn_candidate") == 1, "Churn candidate — high risk of attrition"), F.when(idle > IDLE, F.concat(F.lit("Inactive for "), idle.cast("string"), F.lit(" days"))),
        F.when(F.col("rfm_segment").isin(*RISKY), F.concat(F.lit("RFM segment: "), F.col("rfm_segment"))), F.when(F.col("churn_risk") == "High", "High churn risk score"),
    )
    return campaign_target(r).select("customer_id", "churn_risk", "is_churn_candidate", "rfm_segment", "rfm_score", "days_since_last_txn", F.array_join(factors, "; ").alias("risk_factors"), "cob_dt")


@query(
    "m23_recommendations",
    f"""
    WITH t AS ({_CAMPAIGN_SQL}), f AS (SELECT *, CASE WHEN no_credit_card = 1 AND aum_bucket <> 'MASS' THEN 1 ELSE 0 END AS flag FROM t)
    SELECT customer_id, flag AS cross_sell_credit_card_flag, primary_opportunity, rfm_segment, aum_bucket, campaign_type,
           concat_ws('; ', CASE WHEN flag = 1 THEN 'Credit Card' END, CASE WHEN primary_opportunity <> 'None' AND NOT (flag = 1 AND primary_opportunity = 'Credit Card') THEN primary_opportunity END,
                     CASE WHEN aum_bucket IN ('PRIORITY', 'VIP') THEN 'Priority Banking Package' END, CASE WHEN rfm_segment IN ('Loyal Customers', 'Potential Loyalists') THEN 'Savings Account Premium' END) AS recommended_products, cob_dt
    FROM f""",
)
def recommendations(r: Roles) -> DataFrame:
    """Products for every customer, in order of preference and each once."""
    rich = F.col("aum_bucket") != "MASS"
    flagged = flag((F.col("no_credit_card") == 1) & rich)
    products = F.array(
        F.when(flagged == 1, "Credit Card"), F.when(F.col("primary_opportunity") != "None", F.col("primary_opportunity")), F.when(F.col("aum_bucket").isin(*HIGHEST), "Priority Banking Package"), F.when(F.col("rfm_segment").isin(*SAVERS), "Savings Account Premium")
    )
    told = F.array_join(F.array_distinct(F.filter(products, lambda x: x.isNotNull())), "; ")
    return campaign_target(r).select("customer_id", flagged.alias("cross_sell_credit_card_flag"), "primary_opportunity", "rfm_segment", "aum_bucket", "campaign_type", told.alias("recommended_products"), "cob_dt")


@query(
    "m25_segment_distribution",
    """
    SELECT segment, count(*) AS customers, count(*) FILTER (balance < 0) AS negative, count(*) FILTER (balance >= 0 AND balance < 5000) AS low, count(*) FILTER (balance >= 5000) AS high, CAST(sum(balance) AS DECIMAL(18,2)) AS total_balance FROM dim_customer GROUP BY segment""",
)
def segment_distribution(r: Roles) -> DataFrame:
    bucket = ladder(F.col("balance"), [(5000, "high"), (0, "low")], "negative")
    crossed = r.customer.withColumn("bucket", bucket).groupBy("segment").pivot("bucket", ["negative", "low", "high"]).count().na.fill(0)
    totals = r.customer.groupBy("segment").agg(F.count("*").alias("customers"), zero(F.sum("balance")).alias("total_balance"))
    return totals.join(crossed, "segment").select("segment", "customers", "negative", "low", "high", "total_balance")
