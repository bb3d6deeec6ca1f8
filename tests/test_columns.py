from pyspark.sql import functions as F

from millrace.functions import columns as C


def one(spark, expr, schema="x double", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_health_band_edges(spark):
    cases = {15.0: 1, 15.01: 2, 45.0: 2, 45.01: 3, None: None, float("nan"): None, -3.0: 1}
    for rul, band in cases.items():
        assert one(spark, C.health_band("x"), value=rul) == band


def test_cap(spark):
    for rul, capped in {129.0: 129.0, 130.0: 130.0, 131.0: 130.0, None: None}.items():
        assert one(spark, C.capped_rul("x"), value=rul) == capped


def test_whole_number(spark):
    for value, want in {1.9: 1, -1.9: -1, None: 0, float("nan"): 0}.items():
        assert one(spark, C.whole_number("x"), value=value) == want


def test_event_time_forms(spark):
    for text, minute in {
        "2024-03-01T10:05:00": 202403011005, "2024-03-01T10:05:59.999999": 202403011005,
        "2024-03-01 10:05:01.5": 202403011005, "yesterday": None, "": None, None: None,
    }.items():
        assert one(spark, C.date_key(C.event_timestamp("x")), "x string", text) == minute
    assert one(spark, C.event_date("x"), "x string", "2024-03-01T23:59:59") == "2024-03-01"


def test_unit_ids(spark):
    assert one(spark, C.unit_number_of("x"), "x string", "unit_17") == 17
    assert one(spark, C.unit_number_of("x"), "x string", "pump") is None
    assert one(spark, C.sensor_id_of("x"), "x int", 17) == "unit_17"


def test_engine_models(spark):
    assert one(spark, C.engine_model_of("x"), "x int", 7) == "Turbofan-PW4000"
    assert one(spark, C.or_default_model("x"), "x string", None) == "Turbofan-CFM56"
    assert one(spark, C.engine_model_code("x"), "x string", "Turbofan-V2500") == 4
    assert one(spark, C.engine_model_code("x"), "x string", "other") == 5
    assert one(spark, C.engine_model_code("x"), "x string", None) == 5


def test_surrogate_keys_do_not_run_together(spark):
    rows = spark.createDataFrame(
        [("1", "23"), ("12", "3"), ("", "a"), (None, "a"), ("a", None), ("a", ""), ("a|b", "c"), ("a", "b|c")], "a string, b string"
    )
    keys = [r["k"] for r in rows.select(C.surrogate_key("a", "b").alias("k")).collect()]
    assert len(set(keys)) == len(keys) and all(0 <= k < 1 << 60 for k in keys)


def test_hash_percent_ignores_partitioning(spark):
    ids = spark.range(500).select("id", C.hash_percent(42, "id").alias("p"))
    a = {(r["id"], r["p"]) for r in ids.collect()}
    b = {(r["id"], r["p"]) for r in spark.range(500).repartition(7).select("id", C.hash_percent(42, "id").alias("p")).collect()}
    assert a == b and all(0 <= p < 100 for _, p in a)
    assert 0.7 < sum(p < 80 for _, p in a) / 500 < 0.9


def test_p_value_limits(spark):
    df = spark.createDataFrame([(0.0, 50, 50), (1.0, 1000, 1000), (0.3, 100, 100)], "d double, n int, m int")
    p = [r["p"] for r in df.select(C.ks_p_value(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    assert p[0] == 1.0 and 0 <= p[1] < 1e-12 and abs(p[2] - 0.00024) < 5e-5
