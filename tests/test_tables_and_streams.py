import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning
from millrace.plans.silver import touched_days
from millrace.session import shared_dir
from millrace.sinks import tables
from millrace.sources import files
from millrace.streaming import bronze

ALL = {"availableNow": True}
ROW = "k string, date string, v int, t int"


def content(spark, path):
    return sorted(tuple(r) for r in files.read_table(spark, path).select("k", "date", "v", "t").collect())


def test_missing_table(spark, path):
    assert files.read_table(spark, path("none")) is None


def test_upsert_inserts_updates_and_leaves_other_days(spark, path):
    p = path("t")
    first = spark.createDataFrame([("a", "2024-01-01", 1, 1), ("b", "2024-01-01", 1, 1), ("c", "2024-01-02", 1, 1)], ROW)
    tables.upsert(first, p, ["k"], ["t"])
    untouched = os.path.join(p, "date=2024-01-02")
    before = sorted(os.listdir(untouched))
    changes = spark.createDataFrame(
        [("b", "2024-01-01", 2, 2), ("d", "2024-01-01", 2, 2), ("a", "2024-01-01", 0, 0)], ROW)
    want = [("a", "2024-01-01", 1, 1), ("b", "2024-01-01", 2, 2), ("c", "2024-01-02", 1, 1), ("d", "2024-01-01", 2, 2)]
    for _ in range(2):
        tables.upsert(changes, p, ["k"], ["t"])
        assert content(spark, p) == want
    assert sorted(os.listdir(untouched)) == before


def test_upsert_tie_goes_to_the_later_order_column(spark, path):
    rows = spark.createDataFrame([("a", "2024-01-01", 1, 5), ("a", "2024-01-01", 2, 5)], ROW)
    tables.upsert(rows, path("t"), ["k"], ["t", "v"])
    assert content(spark, path("t")) == [("a", "2024-01-01", 2, 5)]


def test_upsert_keeps_rows_without_a_day_and_leaves_no_scratch(spark, path):
    tables.upsert(spark.createDataFrame([("a", None, 1, 1), ("b", "2024-01-01", 1, 1)], ROW), path("t"), ["k"], ["t"])
    before = set(os.listdir(shared_dir(spark)))
    tables.upsert(spark.createDataFrame([("c", None, 2, 2)], ROW), path("t"), ["k"], ["t"])
    assert content_any(spark, path("t")) == [("a", None), ("b", "2024-01-01"), ("c", None)]
    assert not [x for x in set(os.listdir(shared_dir(spark))) - before if x.startswith(("changes", "merged"))]


def content_any(spark, path):
    return sorted((r["k"], r["date"]) for r in files.read_table(spark, path).collect())


def test_merge_reads_only_touched_partitions(spark, path):
    tables.write_partitioned(spark.createDataFrame([(str(d), f"2024-01-{d:02d}", d, 0) for d in range(1, 11)], ROW), path("t"))
    changes = spark.createDataFrame([("3", "2024-01-03", 9, 9)], ROW)
    merged = tables.merge(files.read_table(spark, path("t")), changes, ["k"], ["t"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-03" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [tuple(r) for r in merged.select("k", "v").collect()] == [("3", 9)]


def test_date_range_prunes_partitions(spark, path):
    rows = spark.createDataFrame([(str(d), f"2024-01-{d:02d}", d, 0) for d in range(1, 11)], ROW)
    tables.write_partitioned(rows, path("t"))
    some = files.read_table(spark, path("t"), ("2024-01-03", "2024-01-05"))
    assert some.count() == 3 and len(some.inputFiles()) <= 10
    assert "PartitionFilters: [isnotnull" in some._jdf.queryExecution().executedPlan().toString()


def test_touched_days_take_whole_days(spark):
    rows = spark.createDataFrame([("a", "2024-01-01", 1, 1), ("b", "2024-01-01", 1, 2), ("c", "2024-01-02", 1, 3)], ROW)
    assert sorted(r["k"] for r in touched_days(rows.filter("k = 'b'"), rows).collect()) == ["a", "b"]


def test_jdbc_options():
    options = tables.jdbc_options("dim_engine", "engine_id")
    assert options == {"dbtable": "dim_engine", "createTableOptions": "ENGINE=MergeTree() ORDER BY engine_id"}


def test_star_table_is_sorted_within_files(spark, path):
    tables.write_star_table(spark.range(100).orderBy(F.rand(1)), path("s"), "id")
    for f in (x for x in os.listdir(path("s")) if x.endswith(".parquet")):
        ids = [r["id"] for r in spark.read.parquet(os.path.join(path("s"), f)).collect()]
        assert ids == sorted(ids)


def test_csv_readers(spark, tmp_path):
    (tmp_path / "train.csv").write_text("time_in_cycles;unit_number;b;a;engine_model;RUL;more\n2;1;;0.5;X;9;z\n")
    (tmp_path / "test.csv").write_text("unit_number,time_in_cycles,a,b,engine_model\n1,2,0.5,3,X\n")
    train = files.read_training_csv(spark, str(tmp_path / "train.csv"), ["a", "b"])
    assert tuple(train.first()) == (1, 2, 0.5, None, 9.0, "X")
    assert tuple(files.read_test_csv(spark, str(tmp_path / "test.csv"), ["a", "b"]).first()) == (1, 2, 0.5, 3.0, "X")
    with pytest.raises(ValueError, match="no column c"):
        files.read_test_csv(spark, str(tmp_path / "test.csv"), ["a", "c"])


# --- streams --------------------------------------------------------------------------------


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def message(i, sensor="unit_1", time=None):
    return {"sensor_id": sensor, "engine_model": "A", "time_in_cycles": i, "metric": "m", "value": float(i),
            "event_time": time or f"2024-01-01T00:{i:02d}:00"}


def bronze_rows(spark, path):
    return sorted((r["sensor_id"], r["time_in_cycles"], r["date"]) for r in files.read_table(spark, path).collect())


def run_bronze(spark, path, max_files=1, **source):
    rows = bronze.stream_readings(spark, path("in"), max_files=max_files, **source)
    query = bronze.start_bronze(rows, path("out"), path("progress"), trigger=ALL, quarantine=path("rejects"))
    query.awaitTermination()
    return query


def test_stream_batches_restart_and_filter(spark, path):
    land(path("in"), "1.json", [message(1), message(2, sensor="")])
    land(path("in"), "2.json", [message(3), message(4, time="never"), "not json"])
    query = run_bronze(spark, path)
    batches = [p["numInputRows"] for p in (json.loads(x.json) for x in query.recentProgress)]
    assert sum(n > 0 for n in batches) == 2  # one file each
    want = [("unit_1", 1, "2024-01-01"), ("unit_1", 3, "2024-01-01"), ("unit_1", 4, None)]
    assert sorted(bronze_rows(spark, path("out")), key=str) == sorted(want, key=str)
    rejects = spark.read.parquet(path("rejects")).collect()
    assert sorted((r["time_in_cycles"], r[files.CORRUPT]) for r in rejects if r["time_in_cycles"]) == [(2, None)]
    assert [r[files.CORRUPT] for r in rejects if not r["time_in_cycles"]] == ["not json"]
    land(path("in"), "3.json", [message(5)])
    run_bronze(spark, path)  # continues after the checkpoint
    assert len(bronze_rows(spark, path("out"))) == 4


def test_a_replayed_batch_lands_once(spark, path):
    rows = bronze.to_bronze(files.from_rows(spark, [tuple(message(i).values()) for i in range(5)], files.READING_SCHEMA))
    for _ in range(2):
        tables.replace_partitions(rows.withColumn("batch_id", F.lit("main-0")), path("out"), "date", ["batch_id"])
    assert len(bronze_rows(spark, path("out"))) == 5


def test_read_files_are_archived_not_lost(spark, path):
    for i in range(1, 4):
        land(path("in"), f"{i}.json", [message(i)])
        run_bronze(spark, path, archive=path("archive"))
    assert len(bronze_rows(spark, path("out"))) == 3
    archived = [f for _, _, fs in os.walk(path("archive")) for f in fs if f.endswith(".json")]
    kept = [f for f in os.listdir(path("in")) if f.endswith(".json")]
    assert sorted(set(archived) | set(kept)) == ["1.json", "2.json", "3.json"]


def test_stream_quarantine(spark, path):
    land(path("in"), "1.json", [message(1), "not json", message(2)])
    _, bad = bronze.stream_payloads(spark, path("in"))
    (bad.writeStream.format("parquet").option("path", path("bad")).option("checkpointLocation", path("cp"))
     .trigger(**ALL).start().awaitTermination())
    assert [r[0] for r in spark.read.parquet(path("bad")).collect()] == ["not json"]


@pytest.mark.parametrize("max_files", [1, 10])
def test_stream_windows_equal_batch_windows(spark, path, max_files):
    rows = [message(i) for i in range(40)]
    for start in range(0, 40, 10):
        # every file repeats the last message of the one before
        land(path("in"), f"{start:02d}.json", rows[max(start - 1, 0):start + 10])
    stream = bronze.stream_readings(spark, path("in"), max_files=max_files)
    wide = bronze.stream_features(stream, ["m"], "5 minutes", "10 minutes")
    (wide.writeStream.format("parquet").option("path", path("out")).option("checkpointLocation", path("cp"))
     .outputMode("append").trigger(**ALL).start().awaitTermination())
    got = sorted((r["time_in_cycles"], r["m"]) for r in spark.read.parquet(path("out")).collect())
    # the last message is at minute 39, so windows that end by minute 29 are final
    assert got == [(i, float(i)) for i in range(25)]


def test_null_days_and_valid_filter_do_not_lose_rows(spark):
    rows = files.from_rows(spark, [tuple(message(1, time="x").values())], files.READING_SCHEMA)
    assert cleaning.dated(rows).first()["date"] is None
