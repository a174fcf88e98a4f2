"""Marts of merchants, branches and calendar months, and the streams' tables in batch form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.columns import flag, ladder, ratio, zero
from tierline.functions.privacy import first_token
from tierline.functions.time import business_date, business_hour, business_window
from tierline.plans.customer_marts import top_channel
from tierline.plans.registry import query
from tierline.plans.roles import DAY, Roles


#: Fixed value: days whose revenue varies by less than this share of their mean are a steady cash flow.
STEADY = 0.5


_MERCHANT_360_SQL = """
    WITH d AS (SELECT merchant_id, cob_dt, CAST(sum(CASE WHEN status = 'SUCCESS' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS revenue, count(*) FILTER (status = 'SUCCESS') AS n FROM card_txn WHERE cob_dt BETWEEN DATE '2001-04-01' AND DATE '2001-06-30' GROUP BY merchant_id, cob_dt),
    g AS (SELECT merchant_id, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue_90d, CAST(sum(n) AS BIGINT) AS txn_count_90d, count(*) AS days, CAST(sum(revenue) AS DOUBLE) AS s, CAST(sum(CAST(revenue AS DECIMAL(18,2)) * revenue) AS DOUBLE) AS ss,
                 CAST(coalesce(sum(CASE WHEN cob_dt > DATE '2001-05-31' THEN revenue END), 0) AS DECIMAL(18,2)) AS last30, CAST(coalesce(sum(CASE WHEN cob_dt > DATE '2001-05-01' AND cob_dt <= DATE '2001-05-31' THEN revenue END), 0) AS DECIMAL(18,2)) AS prev30 FROM d GROUP BY merchant_id),
    x AS (SELECT *, s / days AS mean, CASE WHEN days > 1 THEN sqrt(greatest(0, (ss - s * s / days) / (days - 1))) ELSE 0 END AS spread FROM g)
    SELECT merchant_id, split_part(merchant_name, ' ', 1) || ' **' AS merchant_name_masked, mcc AS mcc_code, city, CAST(coalesce(revenue_90d, 0) AS DECIMAL(18,2)) AS revenue_90d, coalesce(txn_count_90d, 0) AS txn_count_90d, coalesce(mean, 0) AS avg_daily_revenue, coalesce(days, 0) AS active_days_90d,
           CASE WHEN mean > 0 THEN spread / mean END AS cash_flow_cv, CAST(coalesce(last30, 0) AS DECIMAL(18,2)) AS revenue_last30, CAST(coalesce(prev30, 0) AS DECIMAL(18,2)) AS revenue_prev30, CAST(last30 - prev30 AS DOUBLE) / nullif(CAST(prev30 AS DOUBLE), 0) AS revenue_growth_30d,
           CASE WHEN last30 > 0 AND last30 > prev30 THEN 'WORKING_CAPITAL_LOAN' WHEN mean > 0 AND spread / mean < 0.5 AND revenue_90d > 0 THEN 'SAVINGS' ELSE 'EXTRA_POS' END AS advisory_product_hint, DATE '2001-06-30' AS cob_dt
    FROM merchant JOIN branch USING (branch_id) LEFT JOIN x USING (merchant_id)"""


@query("m7_merchant_360", _MERCHANT_360_SQL)
def merchant_360(r: Roles) -> DataFrame:
    """Successful payments are revenue; days on which all failed are active days without any."""
    good = F.col("status") == "SUCCESS"
    days = business_window(r.card_txn, DAY, 90).groupBy("merchant_id", "cob_dt").agg(zero(F.sum(F.when(good, F.col("amount")))).alias("revenue"), F.count_if(good).alias("n"))
    between = lambda a, b: F.when((F.col("cob_dt") > F.lit(DAY - dt.timedelta(days=a))) & (F.col("cob_dt") <= F.lit(DAY - dt.timedelta(days=b))), F.col("revenue"))
    sums = days.groupBy("merchant_id").agg(
        zero(F.sum("revenue")).alias("total"), F.sum("n").alias("n"), F.count("*").alias("days"), F.sum("revenue").cast("double").alias("s"), F.sum(F.col("revenue") * F.col("revenue")).cast("double").alias("ss"),
        zero(F.sum(between(30, 0))).alias("last30"), zero(F.sum(between(60, 30))).alias("prev30"),
    )
    k, s, ss = (F.col(c) for c in ("days", "s", "ss"))
    spread = F.when(k > 1, F.sqrt(F.greatest(F.lit(0.0), F.try_divide(ss - s * s / k, k - 1)))).otherwise(0.0)
    sums = sums.withColumns({"mean": s / k, "spread": spread})
    mean, cv = F.col("mean"), F.when(F.col("mean") > 0, F.col("spread") / F.nullif(F.col("mean"), F.lit(0.0)))
    hint = F.when((F.col("last30") > 0) & (F.col("last30") > F.col("prev30")), "WORKING_CAPITAL_LOAN").when((cv < STEADY) & (F.col("total") > 0), "SAVINGS").otherwise("EXTRA_POS")
    placed = r.merchant.join(r.branch, "branch_id").join(sums, "merchant_id", "left")
    return placed.select(
        "merchant_id", first_token(F.col("merchant_name")).alias("merchant_name_masked"), F.col("mcc").alias("mcc_code"), "city", zero(F.col("total")).alias("revenue_90d"), F.coalesce("n", F.lit(0)).alias("txn_count_90d"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_daily_revenue"), F.coalesce("days", F.lit(0)).alias("active_days_90d"), cv.alias("cash_flow_cv"), zero(F.col("last30")).alias("revenue_last30"), zero(F.col("prev30")).alias("revenue_prev30"),
        ratio(F.col("last30") - F.col("prev30"), F.col("prev30")).alias("revenue_growth_30d"), hint.alias("advisory_product_hint"), F.lit(DAY).alias("cob_dt"),
    )


@query(
    "m16_branch_monthly",
    """
    WITH t AS (SELECT branch_id, year(cob_dt) AS y, month(cob_dt) AS m, t.* FROM account_txn t JOIN dim_customer USING (customer_id) WHERE cob_dt <= DATE '2001-06-30'),
    k AS (SELECT branch_id, y, m, channel, row_number() OVER (PARTITION BY branch_id, y, m ORDER BY count(*) DESC, channel) AS rn FROM t GROUP BY branch_id, y, m, channel),
    g AS (
      SELECT branch_id, y, m, count(DISTINCT customer_id) AS active_customers, count(*) AS txn_count, sum(abs(amount)) AS total, sum(CASE WHEN dc = 'C' THEN amount ELSE 0 END) AS credit, sum(CASE WHEN dc = 'D' THEN amount ELSE 0 END) AS debit
      FROM t GROUP BY branch_id, y, m)
    SELECT branch_id AS branch_code, branch_name, city AS region, city, CAST(y AS INTEGER) AS txn_year, CAST(m AS INTEGER) AS txn_month, CAST((m + 2) // 3 AS INTEGER) AS txn_quarter, active_customers, txn_count,
           CAST(total AS DECIMAL(18,2)) AS total_txn_amount, CAST(total AS DOUBLE) / txn_count AS avg_txn_amount, CAST(credit AS DECIMAL(18,2)) AS total_credit_amount, CAST(debit AS DECIMAL(18,2)) AS total_debit_amount,
           channel AS top_channel, DATE '2001-06-30' AS cob_dt
    FROM g LEFT JOIN branch USING (branch_id) LEFT JOIN (SELECT * FROM k WHERE rn = 1) USING (branch_id, y, m)""",
)
def branch_monthly(r: Roles) -> DataFrame:
    """One row a branch and calendar month; one aggregation to a fine grain feeds sums, the top channel and distinct customers."""
    debit = F.col("dc") == "D"
    fine = r.account_txn.where(F.col("cob_dt") <= F.lit(DAY)).groupBy("customer_id", F.year("cob_dt").alias("txn_year"), F.month("cob_dt").alias("txn_month"), "channel").agg(
        F.count("*").alias("n"), F.sum(F.abs("amount")).alias("s"), F.sum(F.when(F.col("dc") == "C", F.col("amount"))).alias("c"), F.sum(F.when(debit, F.col("amount"))).alias("d")
    )
    place = ["branch_id", "txn_year", "txn_month"]
    rows = fine.join(r.customer.select("customer_id", "branch_id"), "customer_id")
    by_channel = rows.groupBy(*place, "channel").agg(*[F.sum(x).alias(x) for x in ("n", "s", "c", "d")])
    top = F.min_by("channel", F.struct((-F.col("n")).alias("n"), F.col("channel")))
    totals = by_channel.groupBy(*place).agg(F.sum("n").alias("txn_count"), zero(F.sum("s")).alias("total_txn_amount"), zero(F.sum("c")).alias("total_credit_amount"), zero(F.sum("d")).alias("total_debit_amount"), top.alias("top_channel"))
    people = rows.select(*place, "customer_id").distinct().groupBy(*place).agg(F.count("*").alias("active_customers"))
    named = totals.join(people, place).join(r.branch, "branch_id", "left")
    return named.select(
        F.col("branch_id").alias("branch_code"), "branch_name", F.col("city").alias("region"), "city", "txn_year", "txn_month", F.ceil(F.col("txn_month") / 3).cast("int").alias("txn_quarter"), "active_customers", "txn_count", "total_txn_amount",
        ratio(F.col("total_txn_amount"), F.col("txn_count")).alias("avg_txn_amount"), "total_credit_amount", "total_debit_amount", "top_channel", F.lit(DAY).alias("cob_dt"),
    )


@query(
    "m17_merchant_daily",
    """
    WITH t AS (SELECT *, CAST(hour(transaction_date + INTERVAL 7 HOUR) AS INTEGER) AS h FROM merchant_txn WHERE merchant_id IS NOT NULL AND payment_channel IN ('QR', 'POS') AND cob_dt BETWEEN DATE '2001-06-29' AND DATE '2001-06-30'),
    d AS (
      SELECT merchant_id, cob_dt AS txn_date, count(*) FILTER (status = 'SUCCESS') AS txn_count, CAST(sum(CASE WHEN status = 'SUCCESS' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS gross,
             count(*) FILTER (refund_flag = 1) AS refunds, count(*) FILTER (payment_channel = 'QR') AS qr_count, count(*) FILTER (payment_channel = 'POS') AS pos_count
      FROM t GROUP BY merchant_id, cob_dt),
    p AS (SELECT merchant_id, cob_dt AS txn_date, h, row_number() OVER (PARTITION BY merchant_id, cob_dt ORDER BY count(*) DESC, h) AS rn FROM t WHERE status = 'SUCCESS' GROUP BY merchant_id, cob_dt, h)
    SELECT d.merchant_id, split_part(merchant_name, ' ', 1) || ' **' AS merchant_name_masked, mcc AS mcc_code, city, d.txn_date, CAST(year(d.txn_date) AS INTEGER) AS txn_year, CAST(month(d.txn_date) AS INTEGER) AS txn_month, txn_count,
           gross AS gross_amount, coalesce(CAST(gross AS DOUBLE) / nullif(txn_count, 0), 0) AS avg_txn_amount, CASE WHEN txn_count > 0 THEN CAST(refunds AS DOUBLE) / txn_count ELSE 0 END AS refund_rate, qr_count, pos_count, p.h AS peak_hour, DATE '2001-06-30' AS cob_dt
    FROM d JOIN merchant USING (merchant_id) JOIN branch USING (branch_id) LEFT JOIN p ON d.merchant_id = p.merchant_id AND d.txn_date = p.txn_date AND p.rn = 1""",
)
def merchant_daily(r: Roles) -> DataFrame:
    """A merchant's payments by QR and at a POS on DAY and the day before. The peak hour is one of successes; refunds count
    whatever their status."""
    good = F.col("status") == "SUCCESS"
    rows = business_window(r.merchant_txn, DAY, 1).where(F.col("merchant_id").isNotNull() & F.col("payment_channel").isin("QR", "POS"))
    hours = rows.groupBy("merchant_id", F.col("cob_dt").alias("txn_date"), business_hour(F.col("transaction_date")).alias("h")).agg(
        F.count_if(good).alias("ok"), F.sum(F.when(good, F.col("amount"))).alias("s"), F.sum("refund_flag").alias("refunds"), F.count_if(F.col("payment_channel") == "QR").alias("qr"), F.count_if(F.col("payment_channel") == "POS").alias("pos")
    )
    peak = F.min_by(F.when(F.col("ok") > 0, F.col("h")), F.struct((-F.col("ok")).alias("n"), F.col("h")))
    days = hours.groupBy("merchant_id", "txn_date").agg(F.sum("ok").alias("txn_count"), zero(F.sum("s")).alias("gross_amount"), F.sum("refunds").alias("refunds"), F.sum("qr").alias("qr_count"), F.sum("pos").alias("pos_count"), peak.alias("peak_hour"))
    none = lambda c: F.coalesce(c, F.lit(0.0))
    return days.join(r.merchant.join(r.branch, "branch_id"), "merchant_id").select(
        "merchant_id", first_token(F.col("merchant_name")).alias("merchant_name_masked"), F.col("mcc").alias("mcc_code"), "city", "txn_date", F.year("txn_date").alias("txn_year"), F.month("txn_date").alias("txn_month"), "txn_count", "gross_amount",
        none(ratio(F.col("gross_amount"), F.col("txn_count"))).alias("avg_txn_amount"), none(ratio(F.col("refunds"), F.col("txn_count"))).alias("refund_rate"), "qr_count", "pos_count", "peak_hour", F.lit(DAY).alias("cob_dt"),
    )


_DAILY_SQL = """
    WITH t AS (SELECT *, CAST(ts + INTERVAL 7 HOUR AS DATE) AS day, CAST(hour(ts + INTERVAL 7 HOUR) AS INTEGER) AS h FROM event),
    p AS (SELECT merchant_id, day, h, row_number() OVER (PARTITION BY merchant_id, day ORDER BY count(*) DESC, h) AS k FROM t GROUP BY merchant_id, day, h)
    SELECT merchant_id, day, count(*) AS txns, count(*) FILTER (status = 'SUCCESS') AS successes, CAST(coalesce(sum(CASE WHEN status = 'SUCCESS' THEN amount END), 0) AS DECIMAL(18,2)) AS revenue, count(*) FILTER (pay_channel = 'QR') AS qr,
           CAST(sum(refund_flag) AS BIGINT) AS refunds, CAST(sum(refund_flag) AS DOUBLE) / nullif(CAST(count(*) FILTER (status = 'SUCCESS') AS DOUBLE), 0) AS refund_rate, any_value(p.h) AS peak_hour
    FROM t JOIN (SELECT merchant_id, day, h FROM p WHERE k = 1) p USING (merchant_id, day) GROUP BY merchant_id, day"""


def merchant_days(r: Roles) -> DataFrame:
    """Every merchant and business day there is. Refunds count whatever their status, while the rate is over successes (as the reconciliation does not)."""
    rows = r.event.withColumns({"day": business_date(F.col("ts")), "h": business_hour(F.col("ts"))})
    good = F.col("status") == "SUCCESS"
    hours = rows.groupBy("merchant_id", "day", "h").agg(F.count("*").alias("n"), F.count_if(good).alias("ok"), F.sum(F.when(good, F.col("amount"))).alias("s"), F.count_if(F.col("pay_channel") == "QR").alias("qr"), F.sum("refund_flag").alias("f"))
    peak = F.min_by("h", F.struct((-F.col("n")).alias("n"), F.col("h")))
    return hours.groupBy("merchant_id", "day").agg(
        F.sum("n").alias("txns"), F.sum("ok").alias("successes"), zero(F.sum("s")).alias("revenue"), F.sum("qr").alias("qr"), F.sum("f").alias("refunds"), ratio(F.sum("f"), F.sum("ok")).alias("refund_rate"), peak.alias("peak_hour")
    )


_MONTHS_SQL = """months AS (SELECT merchant_id, CAST(year(cob_dt) AS INTEGER) AS txn_year, CAST(month(cob_dt) AS INTEGER) AS txn_month, count(*) FILTER (status = 'SUCCESS') AS n, CAST(sum(CASE WHEN status = 'SUCCESS' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS s
                     FROM card_txn WHERE cob_dt <= DATE '2001-06-30' GROUP BY ALL)"""


def _months(r: Roles) -> DataFrame:
    """Successful payments of each merchant and month up to DAY; a month in which all failed has none, and is there."""
    good = F.col("status") == "SUCCESS"
    rows = r.card_txn.where(F.col("cob_dt") <= F.lit(DAY)).groupBy("merchant_id", F.year("cob_dt").alias("txn_year"), F.month("cob_dt").alias("txn_month"))
    return rows.agg(F.count_if(good).alias("n"), zero(F.sum(F.when(good, F.col("amount")))).alias("s"))


_RANKING_SQL = f"""
    WITH {_MONTHS_SQL}, g AS (SELECT *, lag(s) OVER (PARTITION BY merchant_id ORDER BY txn_year, txn_month) AS prev FROM months)
    SELECT merchant_id, split_part(merchant_name, ' ', 1) || ' **' AS merchant_name_masked, mcc AS mcc_code, city, txn_year, txn_month, n AS txn_count, s AS revenue, CAST(coalesce(prev, 0) AS DECIMAL(18,2)) AS prev_revenue, CAST(s - prev AS DOUBLE) / nullif(CAST(prev AS DOUBLE), 0) AS pop_growth_rate,
           CAST(rank() OVER (PARTITION BY mcc, txn_year, txn_month ORDER BY s DESC, merchant_id) AS INTEGER) AS rank_in_mcc, DATE '2001-06-30' AS cob_dt FROM g JOIN merchant USING (merchant_id) JOIN branch USING (branch_id)"""


@query("m18_merchant_ranking", _RANKING_SQL)
def merchant_ranking(r: Roles) -> DataFrame:
    """Growth over the month observed before, which need not be the calendar's."""
    before = F.lag("s").over(Window.partitionBy("merchant_id").orderBy("txn_year", "txn_month"))
    grown = _months(r).withColumn("prev", before).join(r.merchant.join(r.branch, "branch_id"), "merchant_id")
    place = F.rank().over(Window.partitionBy("mcc", "txn_year", "txn_month").orderBy(F.desc("s"), "merchant_id"))
    return grown.select(
        "merchant_id", first_token(F.col("merchant_name")).alias("merchant_name_masked"), F.col("mcc").alias("mcc_code"), "city", "txn_year", "txn_month", F.col("n").alias("txn_count"), F.col("s").alias("revenue"), zero(F.col("prev")).alias("prev_revenue"),
        ratio(F.col("s") - F.col("prev"), F.col("prev")).alias("pop_growth_rate"), place.alias("rank_in_mcc"), F.lit(DAY).alias("cob_dt"),
    )


@query(
    "m19_region_monthly",
    f"""
    WITH {_MONTHS_SQL}, c AS (SELECT city, txn_year, txn_month, count(*) AS active_merchants, CAST(sum(n) AS BIGINT) AS txn_count, CAST(sum(s) AS DECIMAL(18,2)) AS revenue FROM months JOIN merchant USING (merchant_id) JOIN branch USING (branch_id) WHERE city IS NOT NULL GROUP BY city, txn_year, txn_month),
    g AS (SELECT *, lag(revenue) OVER (PARTITION BY city ORDER BY txn_year, txn_month) AS prev FROM c)
    SELECT city, txn_year, txn_month, active_merchants, txn_count, revenue, CASE WHEN txn_count > 0 THEN CAST(revenue AS DOUBLE) / CAST(txn_count AS DOUBLE) ELSE 0 END AS avg_txn_amount, CAST(coalesce(prev, 0) AS DECIMAL(18,2)) AS prev_revenue,
           CAST(revenue - prev AS DOUBLE) / nullif(CAST(prev AS DOUBLE), 0) AS mom_growth_rate, CAST(rank() OVER (PARTITION BY txn_year, txn_month ORDER BY revenue DESC, city) AS INTEGER) AS rank_in_month, DATE '2001-06-30' AS cob_dt FROM g""",
)
def region_monthly(r: Roles) -> DataFrame:
    places = r.merchant.join(r.branch, "branch_id").where("city IS NOT NULL").select("merchant_id", "city")
    cities = _months(r).join(places, "merchant_id").groupBy("city", "txn_year", "txn_month").agg(F.count("*").alias("active_merchants"), F.sum("n").alias("txn_count"), zero(F.sum("s")).alias("revenue"))
    grown = cities.withColumn("prev", F.lag("revenue").over(Window.partitionBy("city").orderBy("txn_year", "txn_month")))
    place = F.rank().over(Window.partitionBy("txn_year", "txn_month").orderBy(F.desc("revenue"), "city"))
    return grown.select(
        "city", "txn_year", "txn_month", "active_merchants", "txn_count", "revenue", F.coalesce(ratio(F.col("revenue"), F.col("txn_count")), F.lit(0.0)).alias("avg_txn_amount"), zero(F.col("prev")).alias("prev_revenue"),
        ratio(F.col("revenue") - F.col("prev"), F.col("prev")).alias("mom_growth_rate"), place.alias("rank_in_month"), F.lit(DAY).alias("cob_dt"),
    )


@query("m24_daily_kpis", f"WITH daily AS ({_DAILY_SQL}) SELECT day, count(*) AS active_merchants, CAST(sum(successes) AS BIGINT) AS successful_transactions, CAST(sum(revenue) AS DECIMAL(18,2)) AS gross_amount, CASE WHEN sum(successes) > 0 THEN CAST(sum(refunds) AS DOUBLE) / CAST(sum(successes) AS DOUBLE) ELSE 0 END AS refund_rate FROM (SELECT * REPLACE (CASE WHEN successes > 0 THEN refunds ELSE 0 END AS refunds) FROM daily) GROUP BY day")
def daily_kpis(r: Roles) -> DataFrame:
    """The day's refund rate is the mean of the merchants' rates, weighted by their successes; merchants without any weigh nothing."""
    rate = weighted_mean(F.col("refunds"), F.col("successes"))
    return merchant_days(r).groupBy("day").agg(F.count("*").alias("active_merchants"), F.sum("successes").alias("successful_transactions"), zero(F.sum("revenue")).alias("gross_amount"), F.coalesce(rate, F.lit(0.0)).alias("refund_rate"))


def weighted_mean(over: Column, weight: Column) -> Column:
    """The mean of ratios over / weight, each weighted by its weight, from the numerators that they are made of: exact, where
    rate times weight would be rounded. Null where nothing weighs."""
    return ratio(F.sum(F.when(weight > 0, over)), F.sum(weight))


@query("ag9_weighted_ratio", f"WITH daily AS ({_DAILY_SQL}) SELECT merchant_id, CAST(sum(CASE WHEN successes > 0 THEN refunds ELSE 0 END) AS DOUBLE) / nullif(CAST(sum(successes) AS DOUBLE), 0) AS refund_rate FROM daily GROUP BY merchant_id")
def weighted_refunds(r: Roles) -> DataFrame:
    """A merchant's refund rate from its days' rates: each day weighs as much as it has successes."""
    rate = weighted_mean(F.col("refunds"), F.col("successes"))
    return merchant_days(r).groupBy("merchant_id").agg(rate.alias("refund_rate"))


@query("m24_finance_daily", f"WITH daily AS ({_DAILY_SQL}) SELECT day, CAST(sum(revenue) AS DECIMAL(18,2)) AS gross_amount, CAST(sum(successes) AS BIGINT) AS successful_transactions FROM daily GROUP BY day")
def finance_daily(r: Roles) -> DataFrame:
    return merchant_days(r).groupBy("day").agg(zero(F.sum("revenue")).alias("gross_amount"), F.sum("successes").alias("successful_transactions"))


@query("m24_advisory_distribution", f"WITH m AS ({_MERCHANT_360_SQL}) SELECT advisory_product_hint, count(*) AS merchants, CAST(sum(revenue_90d) AS DECIMAL(18,2)) AS revenue_90d FROM m GROUP BY advisory_product_hint")
def advisory_distribution(r: Roles) -> DataFrame:
    return merchant_360(r).groupBy("advisory_product_hint").agg(F.count("*").alias("merchants"), zero(F.sum("revenue_90d")).alias("revenue_90d"))


@query("m24_top_merchants", f"WITH m AS ({_RANKING_SQL}) SELECT merchant_id, merchant_name_masked, mcc_code, txn_year, txn_month, revenue, rank_in_mcc, pop_growth_rate FROM m ORDER BY revenue DESC, merchant_id, txn_year, txn_month LIMIT 20")
def top_merchants(r: Roles) -> DataFrame:
    """A top-k report."""
    return merchant_ranking(r).select("merchant_id", "merchant_name_masked", "mcc_code", "txn_year", "txn_month", "revenue", "rank_in_mcc", "pop_growth_rate").orderBy(F.desc("revenue"), "merchant_id", "txn_year", "txn_month").limit(20)


@query(
    "m24_refund_top50",
    "SELECT txn_id, merchant_id, amount, quantity, cob_dt FROM card_txn WHERE txn_type = 'REFUND' ORDER BY amount DESC, txn_id, quantity, cob_dt LIMIT 50",
)
def refund_top(r: Roles) -> DataFrame:
    """A top-k report: sorted heads of partitions meet, not the table."""
    return r.card_txn.where("txn_type = 'REFUND'").select("txn_id", "merchant_id", "amount", "quantity", "cob_dt").orderBy(F.desc("amount"), "txn_id", "quantity", "cob_dt").limit(50)


@query(
    "m24_hourly_transactions",
    "SELECT hour, count(*) AS txns, count(DISTINCT merchant_id) AS merchants, CAST(sum(CAST(quantity AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_quantity, CAST(sum(CAST(amount AS DECIMAL(18,2)) * quantity) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE) AS weighted_amount FROM card_txn GROUP BY hour",
)
def hourly_transactions(r: Roles) -> DataFrame:
    fine = r.card_txn.groupBy("hour", "merchant_id").agg(F.count("*").alias("n"), F.sum("quantity").alias("q"), F.sum(F.col("amount") * F.col("quantity")).alias("aq"))
    return fine.groupBy("hour").agg(F.sum("n").alias("txns"), F.count("*").alias("merchants"), ratio(F.sum("q"), F.sum("n")).alias("mean_quantity"), ratio(F.sum("aq"), F.sum("q")).alias("weighted_amount"))


@query(
    "st8_revenue_per_minute",
    """SELECT merchant_id, date_trunc('minute', ts) AS minute, count(*) FILTER (status = 'SUCCESS') AS successes, count(*) FILTER (status <> 'SUCCESS') AS failures, CAST(coalesce(sum(CASE WHEN status = 'SUCCESS' THEN amount END), 0) AS DECIMAL(18,2)) AS revenue,
       count(*) FILTER (pay_channel = 'QR') AS qr, count(*) FILTER (pay_channel = 'POS') AS pos FROM event GROUP BY ALL""",
)
def revenue_per_minute(r: Roles) -> DataFrame:
    good = F.col("status") == "SUCCESS"
    return r.event.groupBy("merchant_id", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute")).agg(
        F.count_if(good).alias("successes"), F.count_if(~good).alias("failures"), zero(F.sum(F.when(good, F.col("amount")))).alias("revenue"), F.count_if(F.col("pay_channel") == "QR").alias("qr"), F.count_if(F.col("pay_channel") == "POS").alias("pos")
    )


@query("st9_peak_hours", "SELECT merchant_id, CAST(hour(ts + INTERVAL 7 HOUR) AS INTEGER) AS business_hour, count(*) AS txns, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM event GROUP BY ALL")
def peak_hours(r: Roles) -> DataFrame:
    return r.event.groupBy("merchant_id", business_hour(F.col("ts")).alias("business_hour")).agg(F.count("*").alias("txns"), zero(F.sum("amount")).alias("amount"))


@query(
    "st10_latest_payment",
    "SELECT merchant_id, event_id, ts, amount, pay_channel FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY ts DESC, event_id DESC) AS k FROM event WHERE status = 'SUCCESS') WHERE k = 1",
)
def latest_payment(r: Roles) -> DataFrame:
    best = F.max_by(F.struct("event_id", "ts", "amount", "pay_channel"), F.struct("ts", "event_id"))
    return r.event.where("status = 'SUCCESS'").groupBy("merchant_id").agg(best.alias("e")).select("merchant_id", "e.*")


@query(
    "prj2_buckets",
    "SELECT CASE WHEN amount > 300000 THEN 'large' WHEN amount > 100000 THEN 'middle' ELSE 'small' END AS bucket, channel, count(*) AS txns, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM account_txn WHERE status IN ('F', 'O') AND channel NOT LIKE '5%' AND amount BETWEEN 1000 AND 900000 GROUP BY ALL",
)
def buckets(r: Roles) -> DataFrame:
    rows = r.account_txn.where(F.col("status").isin("F", "O") & ~F.col("channel").like("5%") & F.col("amount").between(1000, 900_000))
    return rows.groupBy(ladder(F.col("amount"), [(300_000, "large"), (100_000, "middle")], "small", least=False).alias("bucket"), "channel").agg(F.count("*").alias("txns"), zero(F.sum("amount")).alias("amount"))


@query(
    "wn2_primary_channel",
    "SELECT customer_id, channel AS primary_channel FROM (SELECT customer_id, channel, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, channel) AS k FROM account_txn GROUP BY customer_id, channel) WHERE k = 1",
)
def primary_channel(r: Roles) -> DataFrame:
    return top_channel(r.account_txn, "customer_id", "channel", "primary_channel")


@query(
    "jn3_as_of_event_time",
    "SELECT t.txn_id, t.customer_id, v.customer_sk, v.segment FROM account_txn t LEFT JOIN customer_versions v ON t.customer_id = v.customer_id AND t.cob_dt BETWEEN v.effective_from AND v.effective_to",
)
def as_of_event_time(r: Roles) -> DataFrame:
    """Each transaction with the version of its customer that held on its own day; without one, the key is null."""
    t, v = r.account_txn.alias("t"), r.customer_versions.alias("v")
    on = (F.col("t.customer_id") == F.col("v.customer_id")) & F.col("t.cob_dt").between(F.col("v.effective_from"), F.col("v.effective_to"))
    return t.join(v, on, "left").select("t.txn_id", "t.customer_id", "v.customer_sk", "v.segment")


@query(
    "ag11_failing_items",
    "SELECT customer_id, string_agg(channel, ',' ORDER BY channel) AS channels FROM (SELECT DISTINCT customer_id, channel FROM account_txn WHERE amount > 300000) GROUP BY customer_id",
)
def failing_items(r: Roles) -> DataFrame:
    big = F.when(F.col("amount") > 300_000, F.col("channel"))
    return r.account_txn.groupBy("customer_id").agg(F.array_join(F.sort_array(F.collect_set(big)), ",").alias("channels")).where("channels <> ''")


@query("ag12_distinct_days", "SELECT count(*) AS days, min(cob_dt) AS first_day, max(cob_dt) AS last_day FROM (SELECT DISTINCT cob_dt FROM account_txn)")
def distinct_days(r: Roles) -> DataFrame:
    return r.account_txn.select("cob_dt").distinct().agg(F.count("*").alias("days"), F.min("cob_dt").alias("first_day"), F.max("cob_dt").alias("last_day"))


@query("ag8_duplicate_keys", "SELECT txn_id, count(*) AS copies FROM card_txn GROUP BY txn_id HAVING count(*) > 1")
def duplicate_keys(r: Roles) -> DataFrame:
    return r.card_txn.groupBy("txn_id").agg(F.count("*").alias("copies")).where("copies > 1")


@query("jn5_never_active", "SELECT customer_id, full_name FROM dim_customer WHERE customer_id NOT IN (SELECT customer_id FROM account_txn)")
def never_active(r: Roles) -> DataFrame:
    return r.customer.select("customer_id", "full_name").join(r.account_txn, "customer_id", "left_anti")


@query("jn5_never_contacted", "SELECT customer_id, full_name FROM dim_customer WHERE customer_id NOT IN (SELECT customer_id FROM interaction WHERE cob_dt <= DATE '2001-06-30')")
def never_contacted(r: Roles) -> DataFrame:
    return r.customer.select("customer_id", "full_name").join(r.interaction.where(F.col("cob_dt") <= F.lit(DAY)), "customer_id", "left_anti")


@query("so1_source_alignment", "SELECT 'account' AS source, count(*) AS n, max(cob_dt) AS last_day FROM account_txn UNION ALL SELECT 'card', count(*), max(cob_dt) FROM card_txn UNION ALL SELECT 'online', count(*), max(CAST(ts + INTERVAL 7 HOUR AS DATE)) FROM event")
def source_alignment(r: Roles) -> DataFrame:
    parts = [("account", r.account_txn, F.col("cob_dt")), ("card", r.card_txn, F.col("cob_dt")), ("online", r.event, business_date(F.col("ts")))]
    rows = [df.agg(F.lit(n).alias("source"), F.count("*").alias("n"), F.max(c).alias("last_day")) for n, df, c in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("dq23_date_divergence", "SELECT strftime(cob_dt, '%Y') AS year, count(*) AS n, count(*) FILTER (cob_dt <> CAST(txn_ts AS DATE)) AS diverging FROM account_txn GROUP BY 1")
def date_divergence(r: Roles) -> DataFrame:
    """How often the business day is not the day of the instant."""
    apart = F.col("cob_dt") != F.col("txn_ts").cast("date")
    return r.account_txn.groupBy(F.date_format("cob_dt", "yyyy").alias("year")).agg(F.count("*").alias("n"), F.sum(flag(apart)).alias("diverging"))


@query("src3_business_window", "SELECT txn_id, customer_id, amount FROM account_txn WHERE txn_ts >= TIMESTAMP '2001-05-31 17:00:00' AND txn_ts < TIMESTAMP '2001-06-30 17:00:00'")
def window_scan(r: Roles) -> DataFrame:
    """An incremental scan with a backfill: the bounds are on the bare instant."""
    from tierline.functions.time import in_days

    return r.account_txn.where(in_days(F.col("txn_ts"), DAY, DAY.replace(day=1))).select("txn_id", "customer_id", "amount")
