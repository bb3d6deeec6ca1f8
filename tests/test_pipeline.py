"""Bronze to Silver to Gold to drift, on simulated wear."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import config
from millrace.ml import model as ml
from millrace.ml.runs import RUN_SCHEMA, load_latest_model, log_run
from millrace.operators import baselines, labels
from millrace.plans import dashboard, gold, training
from millrace.plans.monitoring import drift_features, run_drift
from millrace.plans.silver import run_silver
from millrace.session import scratch_path
from millrace.sinks import tables
from millrace.sources import files
from millrace.streaming import bronze

METRICS = ["temp_a", "debit_refroidissement_b"]
PARAMS = config.BoostingParams(trees=8, max_depth=3, learning_rate=0.3)


def wide(spark, units, first_unit=1, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(first_unit, first_unit + units):
        life = int(rng.integers(40, 70))
        for c in range(1, life + 1):
            worn = c / life
            rows.append((u, c, float(500 + 80 * worn + rng.normal(0, 2)), float(40 - 9 * worn + rng.normal(0, 0.3)),
                         float(life - c), config.ENGINE_MODELS[u % 5]))
    return spark.createDataFrame(rows, f"unit_number int, time_in_cycles int, {METRICS[0]} double, {METRICS[1]} double,"
                                       " RUL double, engine_model string")


@pytest.fixture(scope="module")
def trained(spark):
    rows = ml.feature_rows(wide(spark, 12), METRICS)
    model, measures, sample = ml.train(rows, METRICS, params=PARAMS)
    return rows, model, measures.first(), sample


def test_training_beats_the_mean(trained):
    rows, _, measures, sample = trained
    spread = labels.cap_rul(rows).agg(F.stddev_pop("RUL")).first()[0]
    assert measures["rmse"] < 0.6 * spread
    total = rows.count()
    assert 0.7 < sample.count() / total < 0.9 and measures["n"] + sample.count() == total


def test_default_parameters(spark):
    trees = ml.build_pipeline(METRICS).getStages()[-1]
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize()) == (500, 6, 0.03)
    assert (trees.getSubsamplingRate(), trees.getFeatureSubsetStrategy(), trees.getSeed()) == (0.8, "0.6", 42)


def test_feature_count():
    assert len(ml.feature_columns(config.METRICS)) == 171
    assert len(gold.fact_features(config.METRICS)) == 168


def test_evaluation_on_unseen_units(spark, trained):
    _, model, _, _ = trained
    cut = wide(spark, 6, first_unit=100, seed=9).filter("RUL >= 5")
    truth_rows = sorted((r["unit_number"], r["m"]) for r in
                        cut.groupBy("unit_number").agg(F.min("RUL").alias("m")).collect())
    truth = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(truth_rows)], "row_index long, rul double")
    measures, joined = ml.evaluate_last_cycles(model, cut.drop("RUL"), truth, METRICS)
    assert measures.first()["n"] == 6 and joined.count() == 6 and measures.first()["mae"] < 25


def test_training_and_evaluation_flows(spark, path):
    """From CSV files to a logged model, its reference sample and its error on other units."""
    rows = wide(spark, 8)
    rows.write.csv(path("train"), sep=";", header=True)
    training.run_baselines(spark, path("train"), path("base"), METRICS)
    assert spark.read.parquet(path("base")).count() == 8
    training.run_training(spark, path("train"), path("models"), path("runs"), path("ref"), METRICS, PARAMS)
    assert 0.7 < spark.read.parquet(path("ref")).count() / rows.count() < 0.9
    cut = wide(spark, 5, first_unit=100, seed=9).filter("RUL >= 5").cache()
    cut.drop("RUL").write.csv(path("test"), sep=",", header=True)
    left = cut.groupBy("unit_number").agg(F.min("RUL").cast("string").alias("value")).orderBy("unit_number").drop("unit_number")
    left.coalesce(1).write.text(path("truth"))
    measures, preview = training.run_evaluation(spark, path("test"), path("truth"), path("runs"), METRICS)
    assert measures.first()["n"] == 5 and measures.first()["mae"] < 30 and preview.count() == 5


def test_the_whole_way(spark, trained, path):
    rows, model, measures, sample = trained
    # model, run log, reference sample, baselines
    model_path = scratch_path(spark, "model")
    model.write().save(model_path)
    log_run(spark, path("runs"), "training", vars(PARAMS), {"rmse": measures["rmse"]}, model_path)
    ml.export_reference(sample, path("reference"), METRICS)
    tables.overwrite(baselines.compute_baselines(wide(spark, 12), METRICS), path("baselines"))
    assert load_latest_model(spark, path("runs")).stages[0].labels == sorted(config.ENGINE_MODELS)

    # messages of one cycle per minute, some metrics missing, one sensor unnamed
    start = datetime(2024, 5, 1)
    messages = []
    for r in wide(spark, 4, seed=4).collect():
        for i, m in enumerate(METRICS):
            if (r["time_in_cycles"] + i) % 10:
                messages.append((f"unit_{r['unit_number']}", r["engine_model"], r["time_in_cycles"], m, r[m],
                                 (start + timedelta(minutes=30 * r["time_in_cycles"])).isoformat()))
    messages.append(("", "x", 1, "temp_a", 1.0, start.isoformat()))
    assert not run_silver(spark, path("bronze"), path("silver"))
    landed = files.from_rows(spark, messages, files.READING_SCHEMA)
    landed.repartitionByRange(3, "time_in_cycles").write.json(path("landing"))
    stream = bronze.stream_readings(spark, path("landing"))
    bronze.start_bronze(stream, path("bronze"), path("progress"), trigger={"availableNow": True}).awaitTermination()

    cycles = wide(spark, 4, seed=4).select("unit_number", "time_in_cycles").count()
    for _ in range(2):  # a second run changes nothing
        assert run_silver(spark, path("bronze"), path("silver"), path("baselines"), METRICS)
        silver = files.read_table(spark, path("silver"))
        assert silver.count() == cycles
        assert silver.filter("temp_a IS NULL OR debit_refroidissement_b IS NULL").count() == 0

    assert run_gold(spark, path)
    whole = sorted(map(str, spark.read.parquet(path("gold") + "/fact_engine_health").select("fact_id", "predicted_rul", "temp_a_mean_15").collect()))
    for part in (("2024-05-01", "2024-05-01"), ("2024-05-02", "2024-05-09")):  # no day twice
        assert gold.run_gold(spark, path("silver"), path("runs"), path("parts"), METRICS, dates=part)
    parts = spark.read.parquet(path("parts") + "/fact_engine_health")
    assert sorted(map(str, parts.select("fact_id", "predicted_rul", "temp_a_mean_15").collect())) == whole
    facts, engines, dates, statuses = (spark.read.parquet(path("gold") + "/" + t) for t in
                                       ("fact_engine_health", "dim_engine", "dim_date", "dim_status"))
    assert facts.count() == cycles == facts.select("fact_id").distinct().count()
    assert engines.count() == 4 and statuses.count() == 3
    star = dashboard.star_join(facts, engines, dates, statuses)
    assert star.count() == cycles
    # every unit runs to its end, where little life should be predicted
    assert dashboard.current_state(star).filter("status_id <= 2").count() == 4
    signs = dashboard.correlation_signs(dashboard.rul_correlation(facts, METRICS), dashboard.family_signs(METRICS))
    assert {r["sensor"]: r["as_expected"] for r in signs.collect()} == dict.fromkeys(METRICS, True)

    assert run_drift(spark, path("silver"), path("reference"), path("drift"), path("runs"), METRICS)
    fact = spark.read.parquet(path("drift")).first()
    assert 0 <= fact["share_of_drifted_columns"] <= 1 and len(str(fact["date_id"])) == 12
    logged = spark.read.schema(RUN_SCHEMA).parquet(path("runs")).filter(f"run_name = '{config.DRIFT_RUN_NAME}'").first()
    assert {f"drift_pvalue_{f}" for f in drift_features(METRICS)} <= set(logged["metrics"])
    # the monitoring run is newer, yet the model is found
    assert load_latest_model(spark, path("runs")) is not None


def run_gold(spark, path):
    return gold.run_gold(spark, path("silver"), path("runs"), path("gold"), METRICS)


def test_fact_keeps_missing_models_and_equals_the_joined_form(spark):
    rows = spark.createDataFrame(
        [("unit_1", 1, None, 3, "2024-01-01 00:00:00", 12.0), ("unit_2", 2, "B", 4, "2024-01-01 00:01:00", float("nan")),
         ("unit_2", 2, "B", 5, None, 50.0)],
        "sensor_id string, unit_number int, engine_model string, time_in_cycles int, window_start string, predicted_rul double")
    plain = gold.fact_engine_health(rows, [])
    joined = gold.fact_engine_health(rows, [], gold.dim_engine(rows), gold.dim_date(rows))
    assert sorted(map(str, plain.collect())) == sorted(map(str, joined.collect()))
    assert sorted((r["time_in_cycles"], r["status_id"]) for r in plain.collect()) == [(3, 1), (4, None)]
    assert "Join" not in plain._jdf.queryExecution().executedPlan().toString()


def test_training_queries_fit_the_full_size(spark):
    from millrace.catalog import learning

    assert learning.PARAMS == config.BoostingParams()
