"""Credit marts: delinquency by days past due, the portfolio, roll rates and vintages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.columns import flag, ladder, ratio, zero
from tierline.operators.metrics import Catalogue, Measure, Metric, Model
from tierline.operators.ranking import last_two
from tierline.plans.registry import query
from tierline.plans.roles import DAY, Roles

#: Days past due from which a debt is in groups 5 to 2, and in each bucket; from which it is non-performing, and the
#: bounds of what was ever overdue.
DEBT_STEPS = [(360, 5), (180, 4), (90, 3), (10, 2)]
BUCKETS = [(90, "90+"), (60, "60-89"), (30, "30-59"), (1, "1-29")]
NPL, EVER = 90, (30, 90)

_BUCKET_SQL = "CASE WHEN {0} = 0 THEN 'CURRENT' WHEN {0} < 30 THEN '1-29' WHEN {0} < 60 THEN '30-59' WHEN {0} < 90 THEN '60-89' ELSE '90+' END"
_DELINQUENCY_SQL = f"""delinquency AS (
    WITH due AS (SELECT loan_id, due, days_late, row_number() OVER (PARTITION BY loan_id ORDER BY due DESC, payment_id DESC, days_late DESC) AS rn FROM payment WHERE due <= DATE '2001-06-30'),
    agg AS (
      SELECT loan_id, max(CASE WHEN rn = 1 THEN days_late END) AS last_dpd, max(CASE WHEN rn = 1 THEN due END) AS last_due_date,
             max(CASE WHEN rn = 2 THEN days_late END) AS prev_dpd, max(days_late) AS max_dpd_ever FROM due GROUP BY loan_id),
    d AS (
      SELECT l.*, last_due_date, CASE WHEN loan_status = 'WRITTEN_OFF' THEN NULL ELSE coalesce(last_dpd, 0) END AS dpd, prev_dpd, coalesce(max_dpd_ever, 0) AS max_dpd_ever
      FROM loan_terms l LEFT JOIN agg USING (loan_id))
    SELECT loan_id, customer_id, branch_code, product AS product_code, loan_status, loan_amount, outstanding AS outstanding_balance, disbursed AS disbursement_date,
           strftime(disbursed, '%Y-%m') AS vintage_month, CAST((2001 - year(disbursed)) * 12 + 6 - month(disbursed) AS INTEGER) AS months_on_book, last_due_date, dpd,
           CASE WHEN loan_status = 'WRITTEN_OFF' THEN 'WRITTEN_OFF' ELSE {_BUCKET_SQL.format("dpd")} END AS dpd_bucket, prev_dpd,
           CASE WHEN prev_dpd IS NULL THEN NULL ELSE {_BUCKET_SQL.format("prev_dpd")} END AS prev_dpd_bucket,
           CASE WHEN dpd IS NULL THEN NULL WHEN dpd < 10 THEN 1 WHEN dpd < 90 THEN 2 WHEN dpd < 180 THEN 3 WHEN dpd < 360 THEN 4 ELSE 5 END AS debt_group,
           CASE WHEN dpd >= 90 THEN 1 ELSE 0 END AS is_npl, max_dpd_ever, CASE WHEN max_dpd_ever >= 30 THEN 1 ELSE 0 END AS ever_30_plus,
           CASE WHEN max_dpd_ever >= 90 THEN 1 ELSE 0 END AS ever_90_plus, DATE '2001-06-30' AS cob_dt
    FROM d)"""


def bucket(days: Column) -> Column:
    return ladder(days, BUCKETS, "CURRENT")


@query("m14_loan_delinquency", f"WITH {_DELINQUENCY_SQL} SELECT * FROM delinquency")
def loan_delinquency(r: Roles) -> DataFrame:
    """One row a loan: days past due of its last instalment up to DAY and of the one before, and the most it ever had.

    A loan that was written off is out of the balance sheet: it has no days past due, no debt group and is not non-performing.
    """
    due = r.payment.where(F.col("due") <= F.lit(DAY)).select("loan_id", F.unix_date("due").alias("day"), "payment_id", "days_late")
    last = last_two(due, "loan_id", [("day", 6), ("payment_id", 19), ("days_late", 9)], F.max("days_late").alias("ever"))
    gone = F.col("loan_status") == "WRITTEN_OFF"
    rows = r.loan_terms.join(last, "loan_id", "left").withColumns(
        {"dpd": F.when(~gone, F.coalesce("last.days_late", F.lit(0))).cast("int"), "prev_dpd": F.col("prior.days_late").cast("int"), "max_dpd_ever": F.coalesce("ever", F.lit(0)), "last_due_date": F.date_from_unix_date(F.col("last.day").cast("int"))}
    )
    return rows.select(
        "loan_id", "customer_id", "branch_code", F.col("product").alias("product_code"), "loan_status", "loan_amount", F.col("outstanding").alias("outstanding_balance"),
        F.col("disbursed").alias("disbursement_date"), F.date_format("disbursed", "yyyy-MM").alias("vintage_month"), F.floor(F.months_between(F.lit(DAY), "disbursed")).cast("int").alias("months_on_book"),
        "last_due_date", "dpd", F.when(gone, "WRITTEN_OFF").otherwise(bucket(F.col("dpd"))).alias("dpd_bucket"), "prev_dpd", F.when(F.col("prev_dpd").isNotNull(), bucket(F.col("prev_dpd"))).alias("prev_dpd_bucket"),
        F.when(F.col("dpd").isNotNull(), ladder(F.col("dpd"), DEBT_STEPS, 1)).alias("debt_group"), flag(F.col("dpd") >= NPL).alias("is_npl"), "max_dpd_ever",
        *[flag(F.col("max_dpd_ever") >= n).alias(f"ever_{n}_plus") for n in EVER], F.lit(DAY).alias("cob_dt"),
    )


@query(
    "m15_loan_portfolio",
    """
    WITH a AS (
      SELECT branch_code, product, count(*) AS total_loans, count(*) FILTER (loan_status = 'ACTIVE') AS active_loans, count(*) FILTER (loan_status = 'OVERDUE') AS overdue_loans,
             sum(loan_amount) AS total_amount, sum(outstanding) AS total_outstanding, coalesce(sum(CASE WHEN loan_status IN ('OVERDUE', 'WRITTEN_OFF') THEN outstanding END), 0) AS npl
      FROM loan_terms GROUP BY branch_code, product),
    p AS (
      SELECT branch_code, product, count(*) AS n, count(*) FILTER (payment_status = 'LATE') AS late, sum(penalty) AS penalty
      FROM loan_terms JOIN payment USING (loan_id) GROUP BY branch_code, product)
    SELECT a.branch_code, coalesce(branch_name, 'UNK') AS branch_name, a.product AS product_code, total_loans, active_loans, overdue_loans, CAST(total_amount AS DECIMAL(18,2)) AS total_amount,
           CAST(total_outstanding AS DECIMAL(18,2)) AS total_outstanding, round(CAST(overdue_loans AS DOUBLE) / total_loans, 4) AS overdue_rate, CAST(npl AS DECIMAL(18,2)) AS npl_proxy,
           coalesce(n, 0) AS payment_count, coalesce(late, 0) AS late_payment_count, round(CASE WHEN coalesce(n, 0) = 0 THEN 0 ELSE CAST(late AS DOUBLE) / n END, 4) AS late_payment_rate,
           CAST(coalesce(penalty, 0) AS DECIMAL(18,2)) AS total_penalty, DATE '2001-06-30' AS cob_dt
    FROM a LEFT JOIN branch b ON a.branch_code = b.branch_id LEFT JOIN p ON a.branch_code IS NOT DISTINCT FROM p.branch_code AND a.product = p.product""",
)
def loan_portfolio(r: Roles) -> DataFrame:
    """One row a branch and product. Payments are summed by loan before the join, so that no loan counts twice."""
    paid = r.payment.groupBy("loan_id").agg(F.count("*").alias("n"), F.count_if(F.col("payment_status") == "LATE").alias("late"), F.sum("penalty").alias("penalty"))
    bad, is_ = F.col("loan_status").isin("OVERDUE", "WRITTEN_OFF"), lambda s: F.count_if(F.col("loan_status") == s)
    sums = r.loan_terms.join(paid, "loan_id", "left").groupBy("branch_code", F.col("product").alias("product_code")).agg(
        F.count("*").alias("total_loans"), is_("ACTIVE").alias("active_loans"), is_("OVERDUE").alias("overdue_loans"), zero(F.sum("loan_amount")).alias("total_amount"), zero(F.sum("outstanding")).alias("total_outstanding"),
        zero(F.sum(F.when(bad, F.col("outstanding")))).alias("npl_proxy"), F.coalesce(F.sum("n"), F.lit(0)).alias("payment_count"), F.coalesce(F.sum("late"), F.lit(0)).alias("late_payment_count"), zero(F.sum("penalty")).alias("total_penalty"),
    )
    rate = lambda a, b: F.round(F.coalesce(ratio(F.col(a), F.col(b)), F.lit(0.0)), 4)
    named = sums.join(r.branch.select(F.col("branch_id").alias("branch_code"), "branch_name"), "branch_code", "left")
    return named.select(
        "branch_code", F.coalesce("branch_name", F.lit("UNK")).alias("branch_name"), "product_code", "total_loans", "active_loans", "overdue_loans", "total_amount", "total_outstanding", rate("overdue_loans", "total_loans").alias("overdue_rate"),
        "npl_proxy", "payment_count", "late_payment_count", rate("late_payment_count", "payment_count").alias("late_payment_rate"), "total_penalty", F.lit(DAY).alias("cob_dt"),
    )


@query(
    "m20_roll_rate",
    f"""
    WITH {_DELINQUENCY_SQL},
    pairs AS (SELECT prev_dpd_bucket AS from_bucket, dpd_bucket AS to_bucket, count(*) AS loans, sum(outstanding_balance) AS outstanding FROM delinquency WHERE prev_dpd_bucket IS NOT NULL GROUP BY 1, 2)
    SELECT from_bucket, to_bucket, loans, CAST(outstanding AS DECIMAL(18,2)) AS outstanding_balance, CAST(loans AS DOUBLE) / sum(loans) OVER (PARTITION BY from_bucket) AS roll_rate, DATE '2001-06-30' AS cob_dt FROM pairs""",
)
def roll_rate(r: Roles) -> DataFrame:
    """Loans with two instalments due by their buckets then and now; the rates of each bucket they come from sum to 1."""
    pairs = loan_delinquency(r).where("prev_dpd_bucket IS NOT NULL").groupBy(F.col("prev_dpd_bucket").alias("from_bucket"), F.col("dpd_bucket").alias("to_bucket"))
    sums = pairs.agg(F.count("*").alias("loans"), zero(F.sum("outstanding_balance")).alias("outstanding_balance"))
    total = F.sum("loans").over(Window.partitionBy("from_bucket"))  # 36 pairs at most
    return sums.select("from_bucket", "to_bucket", "loans", "outstanding_balance", (F.col("loans").cast("double") / total).alias("roll_rate"), F.lit(DAY).alias("cob_dt"))


@query(
    "m21_loan_vintage",
    f"""
    WITH {_DELINQUENCY_SQL}
    SELECT vintage_month, count(*) AS loans, CAST(sum(loan_amount) AS DECIMAL(18,2)) AS disbursed_amount, min(months_on_book) AS min_months_on_book, max(months_on_book) AS max_months_on_book,
           avg(CAST(ever_30_plus AS DOUBLE)) AS ever_30_plus_rate, avg(CAST(ever_90_plus AS DOUBLE)) AS ever_90_plus_rate, avg(CAST(is_npl AS DOUBLE)) AS npl_loan_rate, DATE '2001-06-30' AS cob_dt
    FROM delinquency WHERE loan_status <> 'WRITTEN_OFF' GROUP BY vintage_month""",
)
def loan_vintage(r: Roles) -> DataFrame:
    """By month of disbursement: the shares of loans that were ever 30 and 90 days late, and that are non-performing."""
    share = lambda c, name: ratio(F.sum(c), F.count("*")).alias(name)
    rows = loan_delinquency(r).where("loan_status <> 'WRITTEN_OFF'").groupBy("vintage_month")
    out = rows.agg(
        F.count("*").alias("loans"), zero(F.sum("loan_amount")).alias("disbursed_amount"), F.min("months_on_book").alias("min_months_on_book"), F.max("months_on_book").alias("max_months_on_book"),
        share("ever_30_plus", "ever_30_plus_rate"), share("ever_90_plus", "ever_90_plus_rate"), share("is_npl", "npl_loan_rate"),
    )
    return out.withColumn("cob_dt", F.lit(DAY))


@query(
    "ag7_latest_two_payments",
    """
    WITH p AS (SELECT loan_id, due, row_number() OVER (PARTITION BY loan_id ORDER BY due DESC, payment_id DESC, days_late DESC) AS k FROM payment)
    SELECT loan_id, max(CASE WHEN k = 1 THEN due END) AS last_due, max(CASE WHEN k = 2 THEN due END) AS prior_due FROM p GROUP BY loan_id""",
)
def latest_two_payments(r: Roles) -> DataFrame:
    last = last_two(r.payment.select("loan_id", F.unix_date("due").alias("day"), "payment_id"), "loan_id", [("day", 6), ("payment_id", 19)])
    date = lambda c: F.date_from_unix_date(F.col(c).cast("int"))
    return last.select("loan_id", date("last.day").alias("last_due"), date("prior.day").alias("prior_due"))


def catalogue(r: Roles) -> Catalogue:
    """The bank's metrics of credit; NPL is what is overdue by days, not by a loan's status."""
    loans = Model(
        "loan_delinquency", lambda: loan_delinquency(r), "loan", {"loan": "loan_id", "customer": "customer_id"},
        {c: c for c in ("cob_dt", "dpd_bucket", "prev_dpd_bucket", "debt_group", "loan_status", "vintage_month", "branch_code", "product_code")},
        {
            "loan_count": Measure("count", "loan_id"), "outstanding": Measure("sum", "outstanding_balance"), "on_book_outstanding": Measure("sum", "CASE WHEN debt_group IS NOT NULL THEN outstanding_balance ELSE 0 END"),
            "npl_outstanding": Measure("sum", "CASE WHEN is_npl = 1 THEN outstanding_balance ELSE 0 END"), "npl_loans": Measure("sum", "is_npl"), "ever_30_plus_loans": Measure("sum", "ever_30_plus"), "ever_90_plus_loans": Measure("sum", "ever_90_plus"),
        },
    )
    portfolio = Model(
        "loan_portfolio_risk", lambda: loan_portfolio(r), "branch_product", {"branch_product": "concat_ws('|', branch_code, product_code)"}, {c: c for c in ("cob_dt", "branch_code", "product_code")},
        {"payment_count": Measure("sum", "payment_count"), "late_payment_count": Measure("sum", "late_payment_count")},
    )
    customers = Model("customer", lambda: r.customer, "customer", {"customer": "customer_id"}, {"segment": "segment"})
    simple = {n: Metric(n) for n in ("loan_count", "on_book_outstanding", "npl_outstanding", "ever_30_plus_loans", "ever_90_plus_loans", "payment_count", "late_payment_count")}
    return Catalogue(
        [loans, portfolio, customers],
        simple | {
            "total_outstanding": Metric("outstanding"), "npl_loan_count": Metric("npl_loans"), "npl_ratio": Metric("npl_outstanding", "on_book_outstanding"), "ever_30_plus_rate": Metric("ever_30_plus_loans", "loan_count"),
            "ever_90_plus_rate": Metric("ever_90_plus_loans", "loan_count"), "late_payment_rate": Metric("late_payment_count", "payment_count"),
        },
    )


_SUMS_SQL = """count(loan_id) AS loan_count, CAST(sum(outstanding_balance) AS DOUBLE) AS outstanding, CAST(sum(CASE WHEN debt_group IS NOT NULL THEN outstanding_balance ELSE 0 END) AS DOUBLE) AS on_book,
             CAST(sum(CASE WHEN is_npl = 1 THEN outstanding_balance ELSE 0 END) AS DOUBLE) AS npl, CAST(sum(is_npl) AS DOUBLE) AS npl_loans, CAST(sum(ever_30_plus) AS DOUBLE) AS e30, CAST(sum(ever_90_plus) AS DOUBLE) AS e90"""


@query(
    "m26_semantic_metrics",
    f"""
    WITH {_DELINQUENCY_SQL},
    g AS (
      SELECT concat_ws(',', CASE WHEN grouping(loan_status) = 0 THEN 'loan_status' END, CASE WHEN grouping(product_code) = 0 THEN 'product_code' END, CASE WHEN grouping(segment) = 0 THEN 'customer__segment' END) AS grain,
             loan_status, product_code, segment AS customer__segment, {_SUMS_SQL}
      FROM delinquency LEFT JOIN dim_customer USING (customer_id) GROUP BY GROUPING SETS ((), (loan_status), (product_code), (segment), (product_code, segment)))
    SELECT metric, grain, loan_status, product_code, customer__segment, value FROM g, LATERAL (VALUES
      ('npl_ratio', npl / nullif(on_book, 0)), ('ever_30_plus_rate', e30 / nullif(loan_count, 0)), ('ever_90_plus_rate', e90 / nullif(loan_count, 0)), ('loan_count', CAST(loan_count AS DOUBLE)),
      ('npl_loan_count', npl_loans), ('total_outstanding', outstanding), ('npl_outstanding', npl), ('on_book_outstanding', on_book)) AS v(metric, value)""",
)
def semantic_metrics(r: Roles) -> DataFrame:
    """Eight metrics of loans by three dimensions, one of them of the customer, one by one, two together and in total: one scan of loans."""
    names = ["npl_ratio", "ever_30_plus_rate", "ever_90_plus_rate", "loan_count", "npl_loan_count", "total_outstanding", "npl_outstanding", "on_book_outstanding"]
    status, product, segment = by = ["loan_status", "product_code", "customer__segment"]
    return catalogue(r).query(names, by, [(), (status,), (product,), (segment,), (product, segment)])


@query(
    "m26_metrics_of_two_models",
    f"""
    WITH {_DELINQUENCY_SQL},
    l AS (SELECT CASE WHEN grouping(product_code) = 0 THEN 'product_code' ELSE '' END AS grain, product_code, {_SUMS_SQL} FROM delinquency GROUP BY GROUPING SETS ((), (product_code))),
    p AS (SELECT CASE WHEN grouping(product) = 0 THEN 'product_code' ELSE '' END AS grain, product AS product_code, CAST(count(payment_id) AS DOUBLE) AS n, CAST(count(*) FILTER (payment_status = 'LATE') AS DOUBLE) AS late
          FROM loan JOIN payment USING (loan_id) GROUP BY GROUPING SETS ((), (product)))
    SELECT metric, l.grain, l.product_code, value FROM l JOIN p ON l.grain = p.grain AND l.product_code IS NOT DISTINCT FROM p.product_code, LATERAL (VALUES
      ('npl_ratio', npl / nullif(on_book, 0)), ('late_payment_rate', late / nullif(n, 0)), ('payment_count', n)) AS v(metric, value)""",
)
def metrics_of_two_models(r: Roles) -> DataFrame:
    """Metrics of loans and of the portfolio side by side; a late rate is made from counts, not from rates of branches."""
    return catalogue(r).query(["npl_ratio", "late_payment_rate", "payment_count"], ["product_code"], [(), ("product_code",)])


#: (metric, warning, critical, which side is bad).
THRESHOLDS = [("npl_ratio", 0.50, 0.75, "above"), ("late_payment_rate", 0.10, 0.12, "above"), ("loan_count", 3_000.0, 2_950.0, "below")]
_LIMITS_SQL = ", ".join(f"('{m}', {w}::DOUBLE, {c}::DOUBLE, '{s}')" for m, w, c, s in THRESHOLDS)


@query(
    "m27_kpi_status",
    f"""
    WITH {_DELINQUENCY_SQL},
    l AS (SELECT product_code, {_SUMS_SQL} FROM delinquency GROUP BY 1),
    p AS (SELECT product AS product_code, CAST(count(payment_id) AS DOUBLE) AS n, CAST(count(*) FILTER (payment_status = 'LATE') AS DOUBLE) AS late FROM loan JOIN payment USING (loan_id) GROUP BY 1),
    m AS (SELECT metric, product_code, value FROM l JOIN p USING (product_code), LATERAL (VALUES ('npl_ratio', npl / nullif(on_book, 0)), ('late_payment_rate', late / nullif(n, 0)), ('loan_count', CAST(loan_count AS DOUBLE))) AS v(metric, value)),
    t AS (SELECT * FROM (VALUES {_LIMITS_SQL}) AS v(metric, warning, critical, side))
    SELECT metric, product_code, value, CASE WHEN (side = 'above' AND value > critical) OR (side = 'below' AND value < critical) THEN 'CRITICAL'
                                             WHEN (side = 'above' AND value > warning) OR (side = 'below' AND value < warning) THEN 'WARNING' ELSE 'OK' END AS status
    FROM m JOIN t USING (metric)""",
)
def kpi_status(r: Roles) -> DataFrame:
    """Each metric against its two limits, above or below which it is bad."""
    limits = r.spark.createDataFrame(THRESHOLDS, "metric string, warning double, critical double, side string")
    sign = F.when(F.col("side") == "above", 1.0).otherwise(-1.0)
    past = lambda c: F.col("value") * sign > F.col(c) * sign
    joined = catalogue(r).query([m for m, *_ in THRESHOLDS], ["product_code"]).join(F.broadcast(limits), "metric")
    return joined.select("metric", "product_code", "value", F.when(past("critical"), "CRITICAL").when(past("warning"), "WARNING").otherwise("OK").alias("status"))
