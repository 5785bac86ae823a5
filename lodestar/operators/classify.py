"""Multi-class classification with Spark ML.

Every estimator is a ``Pipeline(VectorAssembler, estimator)`` fitted on the
training frame; scoring is ``model.transform`` (a per-row expression over the
fitted model, no shuffle).  Labels are used raw, as in the reference (7.4#12).
The assembled training frame (features and label) is persisted while the
estimator iterates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.partitioning import dealt_by_key


def feature_label_columns(df: DataFrame, label: str | None = None) -> tuple[list[str], str]:
    """Positional convention of the reference (P3): all columns but the last
    are features, the last is the label -- unless ``label`` names it."""
    cols = df.columns
    if label is None:
        return cols[:-1], cols[-1]
    return [c for c in cols if c != label], label


def make_estimator(kind: str, label: str, seed: int = 7, **params):
    """``logreg`` (M3/M4), ``tree`` (M5/M6), ``forest`` (M7/M8)."""
    from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                           RandomForestClassifier)
    if kind == "logreg":
        return LogisticRegression(featuresCol="features", labelCol=label, **params)
    if kind == "tree":
        return DecisionTreeClassifier(featuresCol="features", labelCol=label, seed=seed, **params)
    if kind == "forest":
        return RandomForestClassifier(featuresCol="features", labelCol=label, seed=seed, **params)
    raise ValueError(f"unknown classifier {kind!r}")


def fit_pipeline(train: DataFrame, features: Sequence[str], label: str, kind: str,
                 seed: int = 7, handle_invalid: str = "error", key_cols: Sequence[str] = (), **params):
    """Fit ``VectorAssembler -> estimator`` (M1, M2).  ``handle_invalid`` is
    the assembler's null policy (``error`` like the reference, or ``skip``).
    With ``key_cols`` the rows are dealt by key first, so that seeded samples
    do not depend on how the input is split."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=list(features), outputCol="features",
                                handleInvalid=handle_invalid)
    est = make_estimator(kind, label, seed, **params)
    if key_cols:
        train = dealt_by_key(train.select(*dict.fromkeys([*key_cols, *features, label])), list(key_cols), train.count())
    cached = assembler.transform(train.select(*features, label)).select("features", label).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel(stages=[assembler, *Pipeline(stages=[est]).fit(cached).stages])
    finally:
        cached.unpersist()


def score(model, df: DataFrame) -> DataFrame:
    """rawPrediction, probability and prediction per row (M9)."""
    return model.transform(df)


def training_accuracy(model) -> float:
    """Accuracy on the training set from the fitted summary."""
    return float(model.stages[-1].summary.accuracy)


def class_probabilities(scored: DataFrame, classes: Sequence[int], prefix: str = "p") -> DataFrame:
    """Per-class probability columns from the probability vector."""
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(F.col("probability"))
    return scored.select("*", *[arr[int(c)].alias(f"{prefix}{c}") for c in classes])


def export_predictions(scored: DataFrame, path: str, cols: Sequence[str],
                       single_file: bool = False) -> None:
    """Predictions to CSV (K1), error if the path exists.  Parallel part
    files by default; one file only on request."""
    out = scored.select(*cols)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("errorifexists").csv(path)
