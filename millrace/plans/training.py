"""Training table to model, run log, reference sample and baselines; test table to its error."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace import config
from millrace.ml import model as M
from millrace.ml.runs import load_latest_model, log_run
from millrace.operators import labels
from millrace.operators.baselines import compute_baselines
from millrace.sinks.tables import overwrite
from millrace.sources.files import read_test_csv, read_training_csv, read_truth


def run_baselines(spark: SparkSession, training_csv: str, out: str, metrics: Sequence[str] = config.METRICS) -> None:
    """Writes every unit's reference values, from which Silver fills its gaps."""
    overwrite(compute_baselines(read_training_csv(spark, training_csv, metrics), metrics), out)


def run_training(
    spark: SparkSession,
    training_csv: str,
    models_path: str,
    runs_path: str,
    reference_path: str,
    metrics: Sequence[str] = config.METRICS,
    params: config.BoostingParams = config.BoostingParams(),
) -> str:
    """Fits on the training side of the table, logs the run with the held-out error, saves the model and the
    sample that drift is measured against; returns the run's id."""
    rows = M.feature_rows(read_training_csv(spark, training_csv, metrics), metrics)
    model, measures, training = M.train(rows, metrics, params=params)
    model_path = f"{models_path.rstrip('/')}/{uuid.uuid4().hex}"
    model.write().save(model_path)
    M.export_reference(training, reference_path, metrics)
    return log_run(spark, runs_path, "training", vars(params), measures.first().asDict(), model_path)


def run_evaluation(
    spark: SparkSession, test_csv: str, truth_path: str, runs_path: str, metrics: Sequence[str] = config.METRICS
) -> tuple[DataFrame, DataFrame]:
    """(one row with n, RMSE and MAE, the first ten units) of the newest model on units it has not seen.

    A unit beyond the truth file counts in no measure and shows a null truth in the preview.
    """
    model = load_latest_model(spark, runs_path)
    measures, joined = M.evaluate_last_cycles(model, read_test_csv(spark, test_csv, metrics), read_truth(spark, truth_path), metrics)
    return measures, labels.preview(joined, "unit_number", M.PREDICTION, "rul")
