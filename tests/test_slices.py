"""Stored counts and moments against the rows themselves, exact splits, clustering, payloads, CSV folders."""

import json
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.operators import clustering, drift, splits
from millrace.operators.reshape import unpivot_readings
from millrace.plans import cube as Q
from millrace.plans import dashboard, monitoring
from millrace.sinks import tables
from millrace.sources import files, payloads

@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


FACT = "engine_id long, date_id long, status_id int, predicted_rul double, a double, b double, flat double, date string"


def facts(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        day, engine, rul = int(rng.integers(1, 9)), int(rng.integers(4)), float(rng.integers(100))
        a = None if rng.random() < 0.1 else 9046.0 + 1e-3 * rul + float(rng.normal(0, 0.01))  # large and nearly equal
        rows.append((engine, 202401000000 + day * 10000 + int(rng.integers(24)) * 100, 1 + int(rul > 15) + int(rul > 45),
                     None if rng.random() < 0.05 else rul, a, float(rng.normal()), 7.5, f"2024-01-0{day}"))
    return spark.createDataFrame(rows, FACT)


def engines(spark):
    return spark.createDataFrame([(i, f"unit_{i}") for i in range(4)], "engine_id long, sensor_id string")


# --- moments --------------------------------------------------------------------------------


@pytest.mark.parametrize("sliced", [{}, {"first_day": "2024-01-03", "last_day": "2024-01-06"}, {"statuses": [1, 3]},
                                    {"sensors": ["unit_1", "unit_3", "unit_9"]}, {"sensors": ["unit_2"], "first_day": "2024-01-08", "statuses": [2]}])
def test_cells_merge_to_what_the_facts_give(spark, sliced):
    rows, columns = facts(spark), ["a", "b", "flat"]
    offsets = Q.offsets_of(rows, columns)
    cells = Q.sliced_cells(Q.cube(rows, offsets), engines(spark), **sliced)
    chosen = rows.filter(F.col("date").between(sliced.get("first_day", "2024"), sliced.get("last_day", "2025")))
    if "statuses" in sliced:
        chosen = chosen.filter(F.col("status_id").isin(sliced["statuses"]))
    if "sensors" in sliced:
        chosen = chosen.filter(F.col("engine_id").isin([int(s[5:]) for s in sliced["sensors"]]))
    got = {r["sensor"]: r for r in Q.correlation_from_cells(cells, offsets, columns).collect()}
    want = {r["sensor"]: r for r in dashboard.rul_correlation(chosen, columns).collect()}
    for c in ("a", "b"):
        assert got[c]["n"] == chosen.filter(f"{c} IS NOT NULL AND predicted_rul IS NOT NULL").count()
        for part in ("correlation", "slope", "intercept"):
            assert got[c][part] == pytest.approx(want[c][part], rel=1e-8, abs=1e-9)
    assert got["flat"]["correlation"] is None and got["flat"]["slope"] is None
    stars = chosen.withColumn("timestamp", F.col("date").cast("timestamp"))
    for bucket in ("day", "month"):
        got = sorted(map(tuple, Q.trend_from_cells(cells, offsets, ["a", "predicted_rul"], bucket).select("bucket", "a", "predicted_rul").collect()))
        want = sorted(map(tuple, dashboard.metric_trend(stars, ["a", "predicted_rul"], bucket).collect()))
        assert [g[0] for g in got] == [w[0] for w in want]
        np.testing.assert_allclose([g[1:] for g in got], [w[1:] for w in want], rtol=1e-12)


def test_refreshing_days_replaces_their_cells(spark, path, whole_plans):
    rows = facts(spark)
    tables.write_partitioned(rows, path("fact"))
    for dates in (("2024-01-04", "2024-01-09"), ("2024-01-01", "2024-01-05")):
        assert Q.refresh_cube(spark, path("fact"), path("cube"), ["a", "b"], dates)
    offsets = Q.read_offsets(spark, path("cube"))
    got, want = files.read_table(spark, path("cube")), Q.cube(rows, offsets)
    size = lambda df: sorted(map(tuple, df.groupBy("level", "date", "column").agg(F.sum("n_all"), F.sum("n"), F.round(F.sum("sxy"), 6)).collect()))
    assert size(got.filter("column <> 'predicted_rul'")) == size(want.filter("column <> 'predicted_rul'"))
    plan = Q.sliced_cells(got, first_day="2024-01-03")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "level" in filters and "date" in filters and "2024-01-03" in filters
    assert not Q.refresh_cube(spark, path("none"), path("cube2"), ["a"])


# --- slices of the fact and clustering ------------------------------------------------------


def test_slicers_reach_the_files(spark, path, whole_plans):
    tables.write_partitioned(facts(spark), path("fact"))
    table = files.read_table(spark, path("fact"))
    chosen = dashboard.sliced_fact(table, engines(spark), ["unit_1", "unit_2"], "2024-01-03 05:00:00", "2024-01-04")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    partition = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-03" in partition and "2024-01-04" in partition
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "engine_id" in pushed and "date_id" in pushed and "202401030500" in pushed
    want = facts(spark).filter("engine_id IN (1, 2) AND date_id BETWEEN 202401030500 AND 202401040000")
    assert sorted(map(str, chosen.select("engine_id", "date_id", "a").collect())) == sorted(map(str, want.select("engine_id", "date_id", "a").collect()))
    star = dashboard.sliced(table.withColumn("timestamp_str", F.concat("date", F.lit(" 00:00:00"))), first="2024-01-02 01:00:00", last="2024-01-03 00:00:00")
    assert {r[0] for r in star.select("date").distinct().collect()} == {"2024-01-03"}
    assert "PartitionFilters: [isnotnull(date" in star._jdf.queryExecution().executedPlan().toString()


def test_many_engines_are_joined(spark, monkeypatch):
    monkeypatch.setattr(dashboard, "MAX_SLICED", 1)
    assert dashboard.sliced_fact(facts(spark), engines(spark), ["unit_1", "unit_2"]).filter("engine_id NOT IN (1, 2)").count() == 0


def touched_groups(folder, column, low, high):
    """Row groups whose statistics do not rule out a slice, and all of them."""
    touched = total = 0
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            file = pq.ParquetFile(os.path.join(folder, name))
            at = file.schema_arrow.get_field_index(column)
            for g in range(file.num_row_groups):
                stats = file.metadata.row_group(g).column(at).statistics
                total += 1
                touched += stats.min <= high and stats.max >= low
    return touched, total


def test_clustering_prunes_by_both_columns(spark, path):
    n = 40_000
    rows = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("engine"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)).alias("minute"), "id")
    clustering.clustered(rows, ["engine", "minute"], files=64).write.parquet(path("both"))
    rows.repartitionByRange(64, "engine").sortWithinPartitions("engine").write.parquet(path("one"))
    assert sorted(r["id"] for r in spark.read.parquet(path("both")).collect()) == list(range(n))
    slices = {"engine": (100, 119), "minute": (1000, 1099)}  # a fiftieth each; files hold an eighth of either column
    for column, (low, high) in slices.items():
        touched, total = touched_groups(path("both"), column, low, high)
        assert total >= 60 and touched <= 0.4 * total
    touched, total = touched_groups(path("one"), "minute", 1000, 1099)
    assert touched == total  # as it was: the second column prunes nothing


def test_clustering_of_skewed_and_missing_values(spark, path):
    rows = spark.createDataFrame([(7, i, "x") for i in range(300)] + [(None, None, None), (1, 5, None)], "a int, b int, c string")
    for df in (rows, rows.limit(0)):
        out = clustering.clustered(df, ["a", "b"], files=8)
        assert out.columns == ["a", "b", "c"] and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    parts = clustering.clustered(rows, ["a"], files=8).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 150  # the value of nearly all rows is in several files


def test_interleaved_bits(spark):
    pairs = [(a, b) for a in range(8) for b in range(8)]
    out = spark.createDataFrame(pairs, "a int, b int").select("a", "b", clustering.interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect()
    assert all(r["z"] == sum((r["a"] >> i & 1) << 2 * i + 1 | (r["b"] >> i & 1) << 2 * i for i in range(3)) for r in out)


# --- drift from counts ----------------------------------------------------------------------


def test_counts_of_days_give_the_direct_test(spark, path):
    rows = facts(spark).withColumn("b", F.round("b", 1)).withColumn("flat", F.when(F.col("b") > 1, F.lit(float("nan"))).otherwise(F.col("flat")))
    features = ["a", "b", "flat", "engine_id", "missing"]
    reference = facts(spark, 200, 2)
    tables.write_partitioned(drift.value_counts(rows, features, ["date"]), path("counts"))
    key = lambda df: sorted((r["feature"], r["n_ref"], r["n_cur"], round(r["d"], 12), round(r["p_value"], 12)) for r in df.collect())
    for dates in (("2024-01-01", "2024-01-09"), ("2024-01-03", "2024-01-04"), ("2024-01-08", "2024-01-08")):
        chosen = files.read_table(spark, path("counts"), dates)
        want = key(drift.ks_two_sample(reference, rows.filter(F.col("date").between(*dates)), features))
        assert len(want) == 4 and key(drift.ks_of_counts(drift.value_counts(reference, features), chosen)) == want
        assert key(drift.ks_of_counts(drift.value_counts(reference, features), chosen, hot_rows=20)) == want


def test_monitoring_from_counts_and_retries(spark, path):
    silver = spark.createDataFrame([(f"unit_{i % 5}", i, float(i % 17), f"2024-01-0{1 + i % 4}") for i in range(200)], "sensor_id string, time_in_cycles int, m double, date string")
    tables.write_partitioned(silver, path("silver"))
    spark.createDataFrame([(i % 5, i, float(i % 11)) for i in range(100)], "unit_number int, time_in_cycles int, m double").write.parquet(path("ref"))
    dates = ("2024-01-02", "2024-01-03")
    assert monitoring.refresh_value_counts(spark, path("silver"), path("counts"), ["m"])
    assert monitoring.refresh_value_counts(spark, path("silver"), path("counts"), ["m"], dates)  # again, for some days
    monitoring.store_reference_counts(spark, path("ref"), path("ref-counts"), ["m"])
    for _ in range(2):  # a retry replaces its fact
        assert monitoring.run_drift_from_counts(spark, path("counts"), path("ref-counts"), path("a"), path("runs"), ["m"], dates, run_id="r1")
        assert monitoring.run_drift(spark, path("silver"), path("ref"), path("b"), path("runs"), ["m"], dates, run_id="r1")
    assert monitoring.run_drift(spark, path("silver"), path("ref"), path("b"), path("runs"), ["m"], dates)
    a, b = spark.read.parquet(path("a")).collect(), spark.read.parquet(path("b")).collect()
    shown = lambda r: (r["dataset_drift"], r["share_of_drifted_columns"], r["number_of_drifted_columns"], r["n_tested"])
    assert len(a) == 1 and len(b) == 2 and {shown(r) for r in a + b} == {shown(a[0])}
    assert not monitoring.run_drift_from_counts(spark, path("none"), path("ref-counts"), path("a"), path("runs"), ["m"])


# --- exact split ----------------------------------------------------------------------------


@pytest.mark.parametrize("share", [0.2, 0.5, 0.0, 1.0, 0.333])
def test_exact_share_of_distinct_and_repeated_rows(spark, path, share):
    from fractions import Fraction
    from math import ceil

    rows = [(i, i % 3) for i in range(301)] + [(7, 1)] * 100 + [(8, j % 2) for j in range(60)] + [(None, None)] * 50
    spark.createDataFrame(rows, "k int, v int").write.parquet(path("t"))
    sides = []
    for parts in (1, 7):
        out = splits.with_exact_split(spark.read.parquet(path("t")).repartition(parts, "k", "v"), ["k"], share)
        assert out.columns == ["k", "v", "is_train"] and out.count() == len(rows)
        assert out.filter("NOT is_train").count() == ceil(len(rows) * Fraction(str(share)))
        sides.append(sorted(map(str, out.collect())))
    assert sides[0] == sides[1]


def test_smallest_by_histograms(spark):
    rng = np.random.default_rng(6)
    for values in (rng.integers(0, 1 << 60, 500), rng.integers(0, 5, 300), np.zeros(40, dtype=np.int64)):
        df, ordered = spark.createDataFrame([(int(v),) for v in values], "h long"), np.sort(values)
        for k in (1, 7, len(values) // 2, len(values)):
            value, rest = splits.smallest(df, "h", k)
            assert value == ordered[k - 1] and rest == k - int((values < value).sum())


def test_split_without_a_window(spark):
    plan = splits.with_exact_split(spark.range(1000).withColumn("k", F.col("id")), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Exchange" not in plan
    assert splits.with_exact_split(spark.range(0), ["id"]).count() == 0


# --- payloads and CSV folders ---------------------------------------------------------------


def test_payload_shapes(spark):
    head = {"sensor_id": "u1", "engine_model": "A", "time_in_cycles": 3, "event_time": "t"}
    lines = [
        json.dumps({**head, "metric": "m", "value": 1.5}), json.dumps({**head, "a": 1, "b": "2.5", "c": None, "d": True, "e": [1], "f": {"x": 1}, "g": "word"}),
        json.dumps({**head, "metrics": {"a": 1e400 if False else 7, "b": -2}}), json.dumps([{**head, "a": 4}, {"sensor_id": 17, "time_in_cycles": "12", "a": 5}, 9, "x"]),
        json.dumps(head), "{}", "[]", "", "no json", '{"a": 1', None, "12", json.dumps({"metric": "m", "value": {"v": 1}}), json.dumps({"x": 1, "metric": "only a name"})]
    good, bad = payloads.unpivot_payloads(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(map(tuple, good.collect()), key=str) == sorted([
        ("u1", "A", 3, "m", 1.5, "t"), ("u1", "A", 3, "a", 1.0, "t"), ("u1", "A", 3, "b", 2.5, "t"), ("u1", "A", 3, "a", 7.0, "t"),
        ("u1", "A", 3, "b", -2.0, "t"), ("u1", "A", 3, "a", 4.0, "t"), ("17", None, 12, "a", 5.0, None), (None, None, None, "x", 1.0, None)], key=str)
    counts = {(r["reason"], r["metric"]): r["n"] for r in bad.groupBy("reason", "metric").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {("no value", "c"): 1, ("no number", "d"): 1, ("no number", "e"): 1, ("no number", "f"): 1, ("no number", "g"): 1, ("no object", None): 3,
                      ("no readings", None): 2, ("no json", None): 5, ("no number", "m"): 1, ("no number", "metric"): 1}


def test_payloads_of_a_stream(spark, path):
    os.makedirs(path("in"))
    with open(path("in") + "/1.json", "w") as f:
        f.write('{"sensor_id": "u1", "a": 1, "b": 2}\nno json\n')
    good, bad = payloads.unpivot_payloads(spark.readStream.text(path("in")))
    for df, name in ((good, "good"), (bad, "bad")):
        (df.writeStream.format("parquet").option("path", path(name)).option("checkpointLocation", path(f"{name}-cp"))
         .trigger(availableNow=True).start().awaitTermination())
    assert sorted((r["metric"], r["value"]) for r in spark.read.parquet(path("good")).collect()) == [("a", 1.0), ("b", 2.0)]
    assert [r["reason"] for r in spark.read.parquet(path("bad")).collect()] == ["no json"]


def test_csv_folders_of_unlike_headers(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("unit_number;time_in_cycles;m;RUL;engine_model\n1;2;0.5;9;X\n1;3;;8;\n")
    (folder / "b.csv").write_text('more;time_in_cycles;unit_number;engine_model;RUL;m\nz;200;2;"Y;Z";7;1e-3\nz;x;2;Y;6;word\n')
    rows = files.read_training_csv(spark, str(folder), ["m"])
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [(1, 2, 0.5, 9.0, "X"), (1, 3, None, 8.0, None), (2, 200, 0.001, 7.0, "Y;Z"), (2, None, None, 6.0, "Y")], key=str)
    (folder / "c.csv").write_text("unit_number;time_in_cycles;RUL;engine_model\n1;2;9;X\n")
    with pytest.raises(Exception, match="c.csv has no column m|has no column m"):
        files.read_training_csv(spark, str(folder), ["m"]).collect()


def test_value_counts_ignore_unknown_columns(spark):
    rows = spark.createDataFrame([(1.0, "2"), (1.0, "x"), (None, None)], "a double, b string")
    assert sorted(map(tuple, drift.value_counts(rows, ["a", "b", "c"]).collect())) == [("a", 1.0, 2), ("b", 2.0, 1)]
    assert drift.value_counts(rows, ["c"]).count() == 0 and unpivot_readings(rows, [], []).count() == 0


def test_wide_rows_are_split_earlier():
    from millrace import config

    assert config.hot_rows(1) == config.HOT_ROWS and config.hot_rows(0) == config.HOT_ROWS
    assert 8 * 600 * config.hot_rows(600) <= config.HOT_BYTES < 8 * 600 * (config.hot_rows(600) + 1)
    assert config.hot_rows(10**9) == 10_000
