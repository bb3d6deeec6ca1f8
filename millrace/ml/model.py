"""Training, scoring and evaluating the remaining-useful-life regressor on executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import config
from millrace.functions.columns import unit_number_of
from millrace.operators import labels
from millrace.operators.cleaning import last_row
from millrace.operators.indexing import join_by_position
from millrace.operators.rolling import feature_names, rolling_features
from millrace.operators.schema_check import check_schema
from millrace.session import shared_dir

PREDICTION = "predicted_rul"
MODEL_CODE = "engine_model_code"


def feature_columns(metrics: Sequence[str], windows: Sequence[int] = config.ROLLING_WINDOWS) -> list[str]:
    """The 27 base columns and the rolling ones, in the order the model is fitted on."""
    return ["unit_number", "time_in_cycles", *metrics, "engine_model", *feature_names(metrics, windows)]


def feature_rows(
    wide: DataFrame,
    metrics: Sequence[str],
    order: Sequence[str] = ("time_in_cycles",),
    windows: Sequence[int] = config.ROLLING_WINDOWS,
    hot_rows: int | None = None,
    series: str = "unit_number",
) -> DataFrame:
    """Model rows, the same for training and for scoring. ``series`` tells the units apart: the sensor where
    there is one, as a sensor that is not called ``unit_<n>`` has no number."""
    return rolling_features(wide, series, order, metrics, windows, hot_rows)


def feature_schema(metrics: Sequence[str], df: DataFrame) -> T.StructType:
    return df.select(*feature_columns(metrics)).schema


def fitted_fill(rows: DataFrame, metrics: Sequence[str]) -> dict[str, float]:
    """What stands in for a missing value: the column's mean over the training rows, 0 for a column without values."""
    columns = [*metrics, *feature_names(metrics)]
    means = rows.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in columns]).first()
    return {c: means[c] or 0.0 for c in columns}


def build_pipeline(metrics: Sequence[str], label: str = "RUL",
                   params: config.BoostingParams = config.BoostingParams(), fill: dict[str, float] | None = None) -> Pipeline:
    """Fitted category codes, gaps filled with ``fill``, assembled features, boosted trees with squared error.

    Trees read a checkpoint of their row predictions every ten rounds, so a lost executor costs
    ten rounds and not all of them.
    """
    filled = {c: 0.0 for c in [*metrics, *feature_names(metrics)]} | (fill or {})
    values = ", ".join(f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {v!r}D) AS `_in_{c}`" for c, v in filled.items())
    numeric = [f"_in_{c}" if c in filled else c for c in feature_columns(metrics) if c != "engine_model"]
    return Pipeline(
        stages=[
            StringIndexer(inputCol="engine_model", outputCol=MODEL_CODE, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            SQLTransformer(statement=f"SELECT *, {values} FROM __THIS__"),
            VectorAssembler(inputCols=[*numeric, MODEL_CODE], outputCol="features", handleInvalid="keep"),
            GBTRegressor(
                featuresCol="features", labelCol=label, predictionCol=PREDICTION,
                maxIter=params.trees, maxDepth=params.max_depth, stepSize=params.learning_rate,
                subsamplingRate=params.row_sample, featureSubsetStrategy=str(params.column_sample),
                seed=params.seed, lossType="squared", checkpointInterval=10,
            ),
        ]
    )


def fit_on_vectors(pipeline: Pipeline, training: DataFrame) -> PipelineModel:
    """The fitted pipeline. Its last stage is fitted on written vectors: each of its many small jobs sends its whole
    lineage to the tasks, and the columns that vectors are made of would be part of that."""
    *before, regressor = pipeline.getStages()
    prepared = Pipeline(stages=before).fit(training)
    vectors = prepared.transform(training).select(regressor.getFeaturesCol(), regressor.getLabelCol()).checkpoint()
    return PipelineModel(stages=[*prepared.stages, regressor.fit(vectors)])


def train(
    rows: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("unit_number", "time_in_cycles"),
    params: config.BoostingParams = config.BoostingParams(),
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, one row with n / RMSE / MAE of the held-out part, training part).

    ``rows`` come from ``feature_rows`` and carry ``RUL``, which is capped here.
    """
    shared_dir(rows.sparkSession)
    prepared = labels.with_split(labels.cap_rul(rows), keys, seed=params.seed)
    # boosting passes over the rows once per tree level
    prepared = prepared.checkpoint()
    training = prepared.filter("is_train").drop("is_train")
    held_out = prepared.filter("NOT is_train").drop("is_train")
    model = fit_on_vectors(build_pipeline(metrics, params=params, fill=fitted_fill(training, metrics)), training)
    return model, labels.regression_metrics(model.transform(held_out), "RUL", PREDICTION), training


def score(model: PipelineModel, rows: DataFrame, metrics: Sequence[str],
          expected: T.StructType | None = None) -> DataFrame:
    """Adds ``predicted_rul`` to every row; with ``expected`` the feature schema is checked first."""
    if expected is not None:
        check_schema(rows.select(*feature_columns(metrics)).schema, expected)
    return model.transform(rows).select(*rows.columns, PREDICTION)


def evaluate_last_cycles(
    model: PipelineModel, test: DataFrame, truth: DataFrame, metrics: Sequence[str],
    order: Sequence[str] = ("time_in_cycles",),
) -> tuple[DataFrame, DataFrame]:
    """(metrics, predictions): features over all rows, then each unit's last row against the truth
    value at the unit's position."""
    rows = feature_rows(test, metrics, order)
    last = score(model, last_row(rows, "unit_number", order), metrics)
    joined = join_by_position(last.select("unit_number", PREDICTION), truth)
    return labels.regression_metrics(joined, "rul", PREDICTION), joined


def export_reference(training: DataFrame, path: str, metrics: Sequence[str]) -> None:
    """The training rows' features, which later drift tests compare with."""
    training.select(*feature_columns(metrics)).write.mode("overwrite").parquet(path)


def with_unit_number(silver: DataFrame) -> DataFrame:
    return silver.withColumn("unit_number", unit_number_of("sensor_id"))
