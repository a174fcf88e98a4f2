"""Queries of drift and models over the role tables."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators import drift, models
from tierline.operators.ranking import ranked
from tierline.plans.customer_marts import churn_rules
from tierline.plans.registry import query
from tierline.plans.risk_marts import credit_features
from tierline.plans.roles import Roles
from tierline.sources.shared import durable


def _halves(r: Roles) -> tuple[DataFrame, DataFrame]:
    half = F.lit(dt.date(1998, 1, 1))
    return r.account_txn.where(F.col("cob_dt") < half), r.account_txn.where(F.col("cob_dt") >= half)


@query(
    "ml4_ks",
    """WITH v AS (SELECT amount, count(*) FILTER (cob_dt < DATE '1998-01-01') AS a, count(*) FILTER (cob_dt >= DATE '1998-01-01') AS b FROM account_txn GROUP BY amount),
    c AS (SELECT CAST(sum(a) OVER (ORDER BY amount) AS DOUBLE) / CAST(sum(a) OVER () AS DOUBLE) AS x, CAST(sum(b) OVER (ORDER BY amount) AS DOUBLE) / CAST(sum(b) OVER () AS DOUBLE) AS y FROM v) SELECT max(abs(x - y)) AS ks FROM c""",
)
def ks(r: Roles) -> DataFrame:
    return drift.ks(*_halves(r), "amount")


@query("ml4_mean_shift", "WITH m AS (SELECT CAST(sum(amount) FILTER (cob_dt < DATE '1998-01-01') AS DOUBLE) / count(*) FILTER (cob_dt < DATE '1998-01-01') AS a, CAST(sum(amount) FILTER (cob_dt >= DATE '1998-01-01') AS DOUBLE) / count(*) FILTER (cob_dt >= DATE '1998-01-01') AS b FROM account_txn) SELECT abs(b - a) / abs(a) AS mean_shift FROM m")
def mean_shift(r: Roles) -> DataFrame:
    return drift.mean_shift(*_halves(r), "amount")


@query(
    "ml4_drift_bins",
    """WITH q AS (SELECT list_distinct(quantile_cont(CAST(amount AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS p FROM account_txn WHERE cob_dt < DATE '1998-01-01')
    SELECT CAST(len(list_filter(p, lambda x: CAST(amount AS DOUBLE) > x)) AS INTEGER) AS bin, count(*) AS n FROM account_txn, q WHERE cob_dt >= DATE '1998-01-01' GROUP BY 1""",
)
def drift_bins(r: Roles) -> DataFrame:
    base, now = _halves(r)
    return drift.bin_counts(now, "amount", drift.breakpoints(base, "amount"))


@query("wn5_global_rank", "SELECT txn_id, amount, row_number() OVER (ORDER BY amount, txn_id) AS rn FROM account_txn")
def global_rank(r: Roles) -> DataFrame:
    return ranked(r.account_txn.select("txn_id", "amount"), [F.col("amount"), F.col("txn_id")], "rn")


def _churn(r: Roles) -> DataFrame:
    """Rules label customers; the model may not see what the rules see."""
    labels = churn_rules(r).select("customer_id", F.col("is_churn_candidate").alias("label"))
    totals = r.account_txn.groupBy("customer_id").agg(F.count("*").cast("double").alias("txns"), F.sum("amount").cast("double").alias("amount"), F.avg(F.col("hour").cast("double")).alias("hour"))
    return r.customer.select("customer_id", "segment", F.col("balance").cast("double").alias("balance")).join(totals, "customer_id", "left").join(labels, "customer_id").na.fill(0.0)


def _churn_trees():
    return models.boosted_trees(["balance", "txns", "amount", "hour"], ["segment"], "label")


def _credit(r: Roles) -> tuple[DataFrame, PipelineModel]:
    """Held-out customers and the model of the others."""
    rows = credit_features(r).withColumn("diversity", F.col("diversity").cast("double"))
    train, test = models.split(rows, "customer_id", "label")
    return test, models.boosted_trees(["debt_to_asset", "velocity", "avg_txn", "diversity"], [], "label").fit(train)


@query("ml1_churn_model")
def churn_model(r: Roles) -> DataFrame:
    """All customers are scored."""
    rows = _churn(r)
    train, _ = models.split(rows, "customer_id", "label")
    return models.scores(_churn_trees().fit(train), rows, ["customer_id", "label"])


@query("ml1_churn_evaluation")
def churn_evaluation(r: Roles) -> DataFrame:
    """Rates of held-out customers, and the area under the ROC curve."""
    train, test = models.split(_churn(r), "customer_id", "label")
    scored = durable(models.scores(_churn_trees().fit(train), test, ["customer_id", "label"]))
    return models.evaluation(scored, "label").withColumn("auc", F.lit(models.auc(scored, "label")))


@query("ml3_credit_model")
def credit_model(r: Roles) -> DataFrame:
    """The confusion matrix of held-out customers."""
    test, model = _credit(r)
    return models.confusion(models.scores(model, test, ["customer_id", "label"]), "label")


@query("ml3_credit_evaluation")
def credit_evaluation(r: Roles) -> DataFrame:
    """Rates of held-out customers, and the area under the ROC curve."""
    test, model = _credit(r)
    scored = durable(models.scores(model, test, ["customer_id", "label"]))
    return models.evaluation(scored, "label").withColumn("auc", F.lit(models.auc(scored, "label")))


@query("ml3_credit_importances")
def credit_importances(r: Roles) -> DataFrame:
    _, model = _credit(r)
    return r.spark.createDataFrame(models.importances(model), "feature string, importance double")


@query(
    "ml4_psi",
    """WITH q AS (SELECT list_sort(list_distinct(quantile_cont(CAST(amount AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS p FROM account_txn WHERE cob_dt < DATE '1998-01-01'),
    b AS (SELECT len(list_filter(p, lambda x: CAST(amount AS DOUBLE) > x)) AS bin, count(*) FILTER (cob_dt < DATE '1998-01-01') AS a, count(*) FILTER (cob_dt >= DATE '1998-01-01') AS b FROM account_txn, q GROUP BY 1),
    s AS (SELECT a / sum(a) OVER () + 0.0001 AS p, b / sum(b) OVER () + 0.0001 AS q FROM b) SELECT round(sum((q - p) * ln(q / p)), 9) AS psi FROM s""",
)
def psi(r: Roles) -> DataFrame:
    return drift.psi(*_halves(r), "amount").select(F.round("psi", 9).alias("psi"))
