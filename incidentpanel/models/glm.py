"""Screening GLMs on categorical terms (Poisson counts, binomial shares)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentpanel.functions.labels import level_label


def dummy_terms(audit: DataFrame) -> list[tuple[str, str]]:
    """(variable, level) of every encoded dummy, in a fixed order.

    Level tables are as long as the category vocabulary, so this list is short.
    """
    rows = audit.filter(F.col("encoding_status") == "encoded_dummy").select("variable", "level_label")
    return [(r[0], r[1]) for r in rows.orderBy("variable", "level_label").collect()]


def design(frame: DataFrame, terms: Sequence[tuple[str, str]], months: Sequence[str] = ("month",)) -> DataFrame:
    """Dummy-coded feature vector; rows with a null category are dropped."""
    variables = sorted({v for v, _ in terms})
    kept = frame.dropna(subset=variables)
    names = [f"__x{i}" for i in range(len(terms))]
    dummies = {
        name: (level_label(v, two_digits=v in months) == level).cast("double") for name, (v, level) in zip(names, terms)
    }
    return VectorAssembler(inputCols=names, outputCol="features").transform(kept.withColumns(dummies)).drop(*names)


def fit_glm(
    data: DataFrame, family: str, label: str, weight: str | None = None, max_iter: int = 50
) -> GeneralizedLinearRegressionModel:
    link = {"poisson": "log", "binomial": "logit"}[family]
    glm = GeneralizedLinearRegression(
        family=family, link=link, labelCol=label, featuresCol="features", maxIter=max_iter, tol=1e-8
    )
    return (glm.setWeightCol(weight) if weight else glm).fit(data)


def coefficient_table(model: GeneralizedLinearRegressionModel, terms: Sequence[tuple[str, str]], spark) -> DataFrame:
    """Coefficient, p-value and |exp(b) - 1| per dummy level."""
    pvalues = list(model.summary.pValues)
    rows = [
        (variable, level, f"C({variable})[T.{level}]", float(b), float(p))
        for (variable, level), b, p in zip(terms, model.coefficients, pvalues)
    ]
    table = spark.createDataFrame(rows, "variable string, level_label string, term string, coefficient double, pvalue double")
    return table.withColumn("abs_pct_change_vs_reference", F.abs(F.exp("coefficient") - 1))


def expand_coefficients(audit: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Every audited level with its coefficient where it has one."""
    return audit.join(coefficients, ["variable", "level_label"], "left")
