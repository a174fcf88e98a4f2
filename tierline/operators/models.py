"""Spark ML models of churn and credit risk: trained, scored and evaluated on executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split(df: DataFrame, key: str, label: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same in each run, and about share of either label."""
    part = F.pmod(F.xxhash64(key, label), F.lit(1000))
    return df.where(part < int(1000 * share)), df.where(part >= int(1000 * share))


def boosted_trees(numeric: Sequence[str], categories: Sequence[str], label: str, rounds: int = 20, depth: int = 4) -> Pipeline:
    """Missing numbers are 0's stand-in, the mean; categories are indexed, unknown ones too; then boosting."""
    numbers = [f"{c}_filled" for c in numeric]
    indexed = [f"{c}_index" for c in categories]
    stages = [Imputer(inputCols=list(numeric), outputCols=numbers)]
    stages += [StringIndexer(inputCol=c, outputCol=i, handleInvalid="keep") for c, i in zip(categories, indexed, strict=True)]
    stages += [VectorAssembler(inputCols=[*numbers, *indexed], outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features"), GBTClassifier(labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, maxBins=64, seed=1)]
    return Pipeline(stages=stages)


def scores(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("prediction"))


def confusion(scored: DataFrame, label: str) -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), "prediction").agg(F.count("*").alias("n"))


def evaluation(scored: DataFrame, label: str) -> DataFrame:
    """One row: rows, accuracy, precision, recall, f1; a rate over nothing is null."""
    y, p = F.col(label) == 1, F.col("prediction") == 1
    tp, fp, fn = F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)
    rate = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    return scored.agg(F.count("*").alias("rows"), rate(F.count_if(y == p), F.count("*")).alias("accuracy"), rate(tp, tp + fp).alias("precision"), rate(tp, tp + fn).alias("recall"), rate(2 * tp, 2 * tp + fp + fn).alias("f1"))


def auc(scored: DataFrame, label: str) -> float:
    """The area under the ROC curve, by Spark's evaluator; 0.5 says nothing."""
    return BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol=label, metricName="areaUnderROC", numBins=0).evaluate(scored.select("probability", F.col(label).cast("double").alias(label)))


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    """What each input adds to the trees; the sum is 1."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return [(c.removesuffix("_filled").removesuffix("_index"), float(x)) for c, x in zip(assembler.getInputCols(), model.stages[-1].featureImportances.toArray(), strict=True)]
