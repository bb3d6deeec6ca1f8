from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import baselines, cleaning, drift, indexing, labels, reshape, rolling
from millrace.operators.schema_check import SchemaMismatch, check_schema, schema_differences
from millrace.sources.files import READING_SCHEMA, parse_payloads, read_truth

READING = READING_SCHEMA.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")


def readings(spark, rows):
    return spark.createDataFrame(rows, READING)


def reading(sensor="unit_1", metric="m", value=1.0, time="2024-01-01T00:00:00", model="A", cycle=1):
    return (sensor, model, cycle, metric, value, time)


def test_valid_readings(spark):
    rows = readings(spark, [reading(None), reading(""), reading("unit_1")])
    assert [r["sensor_id"] for r in cleaning.valid_readings(rows).collect()] == ["unit_1"]


def test_unreadable_times_are_kept_apart(spark):
    good, bad = cleaning.split_by_time(readings(spark, [reading(), reading(time="soon"), reading(time=None)]))
    assert good.count() == 1 and bad.count() == 2


def test_replays_count_once(spark):
    rows = [reading(value=v, time=f"2024-01-01T00:00:{i:02d}") for i, v in enumerate([1.0, 3.0])]
    once = cleaning.dedupe_readings(readings(spark, rows * 5))
    assert sorted(r["value"] for r in once.collect()) == [1.0, 3.0]


def test_newest_per_key_ties_and_partitioning(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "o")], "k string, t int, v string"
    )
    picks = [
        sorted(map(tuple, cleaning.newest_per_key(rows.repartition(n), ["k"], ["t"]).collect())) for n in (1, 3, 7)
    ]
    assert picks[0] == picks[1] == picks[2]
    assert picks[0][0][:2] == ("a", 2) and picks[0][1] == ("b", 0, "o")


def test_newest_per_key_limits_before_the_shuffle(spark):
    copies = spark.range(0, 90_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id as t")
    newest = cleaning.newest_per_key(copies, ["k"], ["t"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them below the exchange
    assert newest.filter("k = 'hot'").first()["t"] == 89_997


def test_last_row_and_last_values(spark):
    rows = spark.createDataFrame([(1, 1, 5.0, None), (1, 2, None, 7.0), (2, 1, None, None)],
                                 "unit int, cycle int, a double, b double")
    assert sorted(cleaning.last_row(rows, "unit", ["cycle"]).select("unit", "cycle", "a").collect()) == [
        (1, 2, None), (2, 1, None)]
    assert sorted(map(tuple, cleaning.last_values(rows, "unit", ["cycle"], ["a", "b"]).collect())) == [
        (1, 5.0, 7.0), (2, None, None)]


def test_unpivot_skips_what_is_no_number(spark):
    wide = spark.createDataFrame([(1, "2.5", "off", 3), (2, None, "4", None)], "u int, a string, b string, c int")
    got = reshape.unpivot_readings(wide, ["u"], ["a", "b", "c"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", 2.5), (1, "c", 3.0), (2, "b", 4.0)]


def test_window_edges_and_unseen_metrics(spark):
    rows = readings(spark, [
        reading(value=1.0, time="2024-01-01T00:00:00"), reading(value=3.0, time="2024-01-01T00:00:59.999999"),
        reading(value=9.0, time="2024-01-01T00:01:00"),
    ])
    wide = reshape.with_window_keys(reshape.pivot_metrics(cleaning.timed(rows), ["m", "never"]))
    got = {r["window_start"]: (r["m"], r["never"], r["date"]) for r in wide.collect()}
    assert got == {"2024-01-01 00:00:00": (2.0, None, "2024-01-01"), "2024-01-01 00:01:00": (9.0, None, "2024-01-01")}
    narrow = reshape.with_window_keys(reshape.window_avg(cleaning.timed(rows)))
    assert sorted((r["window_start"], r["value"]) for r in narrow.collect()) == [
        ("2024-01-01 00:00:00", 2.0), ("2024-01-01 00:01:00", 9.0)]


def test_impute(spark):
    train = spark.createDataFrame([(1, 2.0, 1.0), (1, 4.0, None)], "unit_number int, a double, b double")
    base = baselines.compute_baselines(train, ["a", "b"])
    silver = spark.createDataFrame(
        [("unit_1", None, 7.0, None), ("unit_9", None, None, None)], "sensor_id string, a double, b double, c double"
    )
    got = {r["sensor_id"]: tuple(r)[1:] for r in baselines.impute(silver, base, ["a", "b", "c"]).collect()}
    assert got == {"unit_1": (3.0, 7.0, None), "unit_9": (None, None, None)}
    assert baselines.impute(silver, None, ["a"]) is silver


# --- rolling --------------------------------------------------------------------------------


def series(spark, lengths, seed=3, gaps=0.2):
    rng = np.random.default_rng(seed)
    rows = []
    for unit, n in enumerate(lengths):
        for cycle in range(n):
            value = None if rng.random() < gaps else float(rng.normal(1000, 3))
            rows.append((unit, cycle, value, float(rng.integers(0, 3))))
    return pd.DataFrame(rows, columns=["unit", "cycle", "a", "b"]).astype({"a": float}), ["a", "b"]


def brute_force(pdf, sensors, windows):
    out = pdf.sort_values(["unit", "cycle"]).reset_index(drop=True)
    for w in windows:
        for s in sensors:
            rolled = out.groupby("unit")[s].rolling(w, min_periods=1)
            out[f"{s}_mean_{w}"] = rolled.apply(np.nanmean, raw=True).reset_index(level=0, drop=True)
            out[f"{s}_std_{w}"] = rolled.apply(
                lambda x: np.nanstd(x, ddof=1) if np.isfinite(x).sum() > 1 else 0.0, raw=True
            ).reset_index(level=0, drop=True)
            # pandas gives no frame at all where every value is missing
            out[f"{s}_std_{w}"] = out[f"{s}_std_{w}"].fillna(0.0)
    return out


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("windows, hot_rows", [
    ((5, 10, 15), 10**6), ((5, 10, 15), 40), ((5, 10, 15), 7), ((3, 4), 10**6), ((3, 4), 25), ((7, 90), 10**6),
])
def test_rolling_equals_brute_force(spark, windows, hot_rows):
    pdf, sensors = series(spark, [1, 4, 30, 200])
    rows = spark.createDataFrame(pdf.sample(frac=1, random_state=1)).replace(float("nan"), None)
    got = rolling.rolling_features(rows, "unit", ["cycle"], sensors, windows, hot_rows)
    assert got.columns == ["unit", "cycle", "a", "b", *rolling.feature_names(sensors, windows)]
    got = got.toPandas().sort_values(["unit", "cycle"]).reset_index(drop=True)
    want = brute_force(pdf, sensors, windows)
    assert len(got) == len(want)
    for c in got.columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_first_row_and_constant_series(spark):
    rows = spark.createDataFrame([(1, c, 0.1) for c in range(30)], "unit int, cycle int, a double")
    got = rolling.rolling_features(rows, "unit", ["cycle"], ["a"]).orderBy("cycle").collect()
    assert got[0]["a_mean_5"] == 0.1 and got[0]["a_std_5"] == 0.0
    assert all(abs(r["a_std_15"]) < 1e-15 and abs(r["a_mean_15"] - 0.1) < 1e-15 for r in got)


def test_rolling_shuffles_once(spark):
    rows = spark.createDataFrame([(1, 1, 0.1)], "unit int, cycle int, a double").repartition(3)
    plan = rolling.rolling_features(rows, "unit", ["cycle"], ["a"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(unit") == 1 and plan.count("Sort [") == 1


def test_ties_give_the_same_frames_whatever_the_limit(spark):
    rows = spark.range(3000).selectExpr("if(id % 7 = 0, null, cast(id % 2 as int)) as unit", "cast(id % 5 as int) as cycle",
                                        "cast(id * 7 % 31 as double) as a", "id")
    got = [sorted(map(tuple, rolling.rolling_features(rows, "unit", ["cycle"], ["a"], hot_rows=n).select("id", F.round("a_mean_15", 9)).collect()))
           for n in (100, 700, 10**6)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 3000


def test_a_unit_with_a_third_of_the_rows_is_split(spark):
    rows = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 0, cast(1 + id % 200 as int)) as unit", "cast(id as int) as cycle", "cast(id * 7 % 31 as double) as a"
    )
    whole = rolling.rolling_features(rows, "unit", ["cycle"], ["a"])
    split = rolling.rolling_features(rows, "unit", ["cycle"], ["a"], hot_rows=300)
    assert split.count() == 6000
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(unit#" in plan and "_segment" in plan
    a, b = (df.toPandas().sort_values("cycle").reset_index(drop=True) for df in (whole, split))
    pd.testing.assert_frame_equal(a, b, rtol=1e-10)


# --- drift ----------------------------------------------------------------------------------


def numpy_d(x, y):
    grid = np.union1d(x, y)
    return np.abs(np.searchsorted(np.sort(x), grid, "right") / len(x)
                  - np.searchsorted(np.sort(y), grid, "right") / len(y)).max()


@pytest.mark.parametrize("hot_rows", [10**6, 50])
def test_ks_equals_numpy(spark, hot_rows):
    rng = np.random.default_rng(5)
    x = {"f": rng.normal(0, 1, 400), "g": rng.integers(0, 4, 400).astype(float), "h": np.full(400, 2.0)}
    y = {"f": rng.normal(0.3, 1, 300), "g": rng.integers(0, 5, 300).astype(float), "h": np.full(300, 2.0)}
    tests = drift.ks_two_sample(spark.createDataFrame(pd.DataFrame(x)), spark.createDataFrame(pd.DataFrame(y)),
                                ["f", "g", "h"], hot_rows)
    got = {r["feature"]: r for r in tests.collect()}
    for f in x:
        assert got[f]["d"] == pytest.approx(numpy_d(x[f], y[f]), abs=1e-12)
        assert (got[f]["n_ref"], got[f]["n_cur"]) == (400, 300)
    assert got["h"]["d"] == 0 and got["h"]["p_value"] == 1.0


def test_ks_edge_cases(spark):
    ref = spark.createDataFrame([(1.0, 1.0, None), (2.0, float("nan"), None)], "a double, b double, c double")
    cur = spark.createDataFrame([(3.0, 1.0, 1.0), (None, 1.0, 1.0)], "a double, b double, c double")
    got = {r["feature"]: (r["n_ref"], r["n_cur"], r["d"]) for r in drift.ks_two_sample(ref, cur, ["a", "b", "c", "z"]).collect()}
    assert got == {"a": (2, 1, 1.0), "b": (1, 2, 0.0)}
    assert drift.ks_two_sample(ref.limit(0), cur, ["a"]).count() == 0


def test_drift_share_at_the_limit(spark):
    tests = spark.createDataFrame([("a", 0.049), ("b", 0.05), ("c", 0.9)], "feature string, p_value double")
    row = drift.drift_summary(drift.drift_flags(tests), 5).first()
    assert (row["number_of_drifted_columns"], row["share_of_drifted_columns"], row["dataset_drift"]) == (1, 0.2, True)
    assert row["n_tested"] == 3
    assert not drift.drift_summary(drift.drift_flags(tests), 6).first()["dataset_drift"]


# --- positions, labels, schema --------------------------------------------------------------


def test_row_numbers_are_dense_and_ordered(spark):
    numbered = indexing.number_rows(spark.range(0, 5000, 1, 9).selectExpr("id * 7919 % 5003 as v"), ["v"])
    got = numbered.orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(5000))
    assert [r["v"] for r in got] == sorted(r["v"] for r in got)


def test_truth_meets_units_by_position(spark, tmp_path):
    (tmp_path / "truth.txt").write_text("112\n98 \n69\n")
    truth = read_truth(spark, str(tmp_path / "truth.txt"))
    units = spark.createDataFrame([(30, 1.0), (2, 2.0), (11, 3.0)], "unit_number int, p double")
    got = {r["unit_number"]: r["rul"] for r in indexing.join_by_position(units, truth).collect()}
    assert got == {2: 112.0, 11: 98.0, 30: 69.0}
    more = units.union(spark.createDataFrame([(40, 0.0)], units.schema))
    assert {r["unit_number"]: r["rul"] for r in indexing.join_by_position(more, truth).collect()}[40] is None


def test_errors_and_preview(spark):
    rows = spark.createDataFrame([(2, 10.0, 13.0), (1, 4.0, 0.04), (3, None, 1.0)], "u int, y double, p double")
    m = labels.regression_metrics(rows, "y", "p").first()
    assert m["n"] == 2 and m["mae"] == pytest.approx((3 + 3.96) / 2)
    assert [tuple(r) for r in labels.preview(rows, "u", "p", "y", 2).collect()] == [(1, 0.0, 4.0), (2, 13.0, 10.0)]


def test_rul_label(spark):
    rows = spark.createDataFrame([(1, 1), (1, 5), (2, 3)], "unit_number int, time_in_cycles int")
    assert sorted(r["RUL"] for r in labels.with_rul(rows).collect()) == [0, 0, 4]
    lost = spark.createDataFrame([(None, 1), (None, 3)], "unit_number int, time_in_cycles int")
    assert sorted(r["RUL"] for r in labels.with_rul(lost).collect()) == [0, 2]


def test_schema_check(spark):
    have = spark.createDataFrame([], "a int, b double, x string").schema
    want = spark.createDataFrame([], "b double, a bigint, c string").schema
    assert dict(schema_differences(have, want)) == {
        "a": "type int, expected bigint", "c": "missing", "x": "unexpected"}
    with pytest.raises(SchemaMismatch, match="c: missing"):
        check_schema(have, want)
    check_schema(have, have)
    assert schema_differences(spark.createDataFrame([], "b int, a int").schema,
                              spark.createDataFrame([], "a int, b int").schema)


def test_payload_quarantine(spark):
    lines = spark.createDataFrame(
        [('{"sensor_id":"unit_1","metric":"m","value":1.5,"event_time":"2024-01-01T00:00:00"}',), ("not json",),
         ('{"sensor_id": ',), (None,)], "value string")
    good, bad = parse_payloads(lines)
    assert [(r["sensor_id"], r["engine_model"], r["value"]) for r in good.collect()] == [("unit_1", None, 1.5)]
    assert bad.count() == 3


def test_latest_run_skips_monitoring(spark, path):
    from millrace import config
    from millrace.ml.runs import RUN_SCHEMA, latest_run, log_run

    log_run(spark, path("runs"), "training", {"trees": 5}, {"rmse": 2}, "/m1", datetime(2024, 1, 1))
    log_run(spark, path("runs"), "training", model_path="/m2", start_time=datetime(2024, 1, 2))
    log_run(spark, path("runs"), config.DRIFT_RUN_NAME, start_time=datetime(2024, 1, 3))
    runs = spark.read.schema(RUN_SCHEMA).parquet(path("runs"))
    assert runs.count() == 3 and latest_run(runs).first()["model_path"] == "/m2"


def test_many_segments_are_found_in_short_lists(spark):
    from bisect import bisect_right

    from millrace.operators import sizing

    rows = [("a", i * 7 % 9001) for i in range(9001)] + [(None, i) for i in range(600)] + [("b", 1), ("b", None), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    edges = sizing.segment_edges(df, "k", ["v"], 2)
    lists = {r["k"]: [x["v"] for x in r["_edges"]] for r in edges.collect()}
    longest = max(map(len, lists.values()))
    assert longest > 4096 and "b" not in lists
    sizes = [sizing._lists(edges, "k", w, longest).selectExpr("max(size(_list))").first()[0] for w in (1, 64, 4096)]
    assert max(sizes) == 63
    found = sizing.with_segment(df, "k", ["v"], edges).collect()
    assert len(found) == len(rows)
    for r in found:
        at, own = -1 if r["v"] is None else r["v"], lists.get(r["k"])
        want = bisect_right([-1 if x is None else x for x in own], at) if own else 0
        assert (r["_segment"], r["_cut"]) == (want, own is not None)


def test_edges_of_a_long_sample(spark):
    """Places in the sample times segments exceed 32 bits; the sample is every value here."""
    from millrace.operators import sizing

    n = 50_000
    df = spark.range(n).selectExpr("IF(id < 49000, 'a', NULL) AS k", "cast(id * 7919 % 50021 as double) AS v").unionAll(
        spark.sql("SELECT 'b', 1D UNION ALL SELECT 'c', CAST(NULL AS DOUBLE)"))
    values = {"a": sorted(i * 7919 % 50021 for i in range(49000)), None: sorted(i * 7919 % 50021 for i in range(49000, n))}
    for most in (1, 3):
        got = {r["k"]: [x["v"] for x in r["_edges"]] for r in sizing.segment_edges(df, "k", ["v"], most).collect()}
        want = {}
        for k, v in values.items():
            parts = -(-len(v) // most)
            want[k] = [v[p] for p in sorted({i * len(v) // parts for i in range(1, parts)})]
        assert got == want


def test_trees_fitted_on_vectors_are_the_pipelines(spark):
    from millrace import config
    from millrace.ml import model as ml

    wide = spark.range(300).selectExpr(
        "cast(id % 7 as int) AS unit_number", "cast(id div 7 as int) AS time_in_cycles", "concat('m', id % 3) AS engine_model",
        "IF(id % 5 = 0, NULL, sin(id)) AS a", "cast(id % 11 as double) AS b", "cast(id % 43 as double) AS RUL")
    rows = ml.feature_rows(wide, ["a", "b"]).coalesce(1).checkpoint()
    pipeline = ml.build_pipeline(["a", "b"], params=config.BoostingParams(trees=3))
    whole, parts = pipeline.fit(rows), ml.fit_on_vectors(pipeline, rows)
    # after the model's own name
    assert whole.stages[-1].toDebugString.split("\n")[1:] == parts.stages[-1].toDebugString.split("\n")[1:]
    assert len(parts.stages) == len(whole.stages) and "in {" in parts.stages[-1].toDebugString
