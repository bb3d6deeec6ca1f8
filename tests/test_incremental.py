"""Ledger, versions and look-back in streams; Silver and Gold that read only what changed."""

import json
import os
import shutil
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import cleaning
from millrace.operators.rolling import feature_names, rolling_features
from millrace.plans import gold, partials, silver
from millrace.sinks import tables
from millrace.sources import files
from millrace.streaming import bronze, rolling
from millrace.streaming.ledger import BatchLedger, land, ledger_of

ALL = {"availableNow": True}
START = datetime(2024, 1, 1)


def reading(sensor, minute, value, metric="m", model="A", cycle=1):
    return (sensor, model, cycle, metric, float(value), (START + timedelta(minutes=minute)).isoformat())


def land_json(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(dict(zip(files.READING_SCHEMA.names, r))) + "\n" for r in rows)


def stored(spark, path):
    return sorted((r["sensor_id"], r["event_time"], r["value"]) for r in files.read_table(spark, path).collect())


# --- ledger ---------------------------------------------------------------------------------


def test_many_batches_leave_folders_per_day(spark, path, monkeypatch):
    monkeypatch.setattr("millrace.streaming.ledger.FOLD_FILES", 7)
    out, book = path("t"), BatchLedger(spark, ledger_of(path("t")))
    rows = [files.from_rows(spark, [reading(f"u{i}", 1440 * (i % 3), i)], files.READING_SCHEMA) for i in range(20)]
    for i, batch in enumerate(rows):
        book.once("main", i, lambda replay, batch=batch, i=i: land(bronze.to_bronze(batch), out, f"main-{i}", replay))
    folders = [f for f in os.listdir(out) if "=" in f]
    assert sorted(folders) == [f"date=2024-01-0{d}" for d in (1, 2, 3)]
    assert len([f for f in os.listdir(ledger_of(out)) if f.endswith(".parquet")]) < 10
    assert len(stored(spark, out)) == 20
    fresh = BatchLedger(spark, ledger_of(out))
    landed = fresh.rows().filter("state = 'landed'").groupBy("day").agg(F.sum("n")).collect()
    assert sorted(map(tuple, landed)) == [("2024-01-01", 7), ("2024-01-02", 7), ("2024-01-03", 6)]
    assert fresh.state("main", 19) == "landed" and fresh.state("main", 3) == "landed" and fresh.state("main", 20) is None
    position, markers, days = fresh.batches_after(17)
    assert (position, markers, sorted(days)) == (20, ["main-17", "main-18", "main-19"], ["2024-01-01", "2024-01-02", "2024-01-03"])
    assert fresh.batches_after(17, 18)[1] == ["main-17"] and fresh.batches_after(20)[1] == []


@pytest.mark.parametrize("when", ["before", "half", "after"])
def test_a_replayed_batch_lands_once(spark, path, when):
    """A failure before, within or after the data is written."""
    out = path("t")
    first = bronze.to_bronze(files.from_rows(spark, [reading("u1", 0, 1), reading("u1", 2000, 2)], files.READING_SCHEMA))
    second = files.from_rows(spark, [reading("u2", 1, 3), reading("u2", 1441, 4), reading("u3", 5000, 5), ("u4", "A", 1, "m", 6.0, "never")], files.READING_SCHEMA)
    BatchLedger(spark, ledger_of(out)).once("main", 0, lambda replay: land(first, out, "main-0", replay))

    def fails(replay):
        if when == "half":  # one of its days only
            land(bronze.to_bronze(second).filter("sensor_id = 'u2'"), out, "main-1", replay)
        if when == "after":
            land(bronze.to_bronze(second), out, "main-1", replay)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        BatchLedger(spark, ledger_of(out)).once("main", 1, fails)
    for _ in range(2):  # the second time it has landed
        BatchLedger(spark, ledger_of(out)).once("main", 1, lambda replay: land(bronze.to_bronze(second), out, "main-1", replay))
    assert [v for _, _, v in stored(spark, out)] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    days = BatchLedger(spark, ledger_of(out)).days_since(None)
    assert sorted(days, key=str) == ["2024-01-01", "2024-01-02", "2024-01-04", None]


def test_stream_replays_its_last_batch(spark, path):
    """The checkpoint loses its commit, so the stream runs the batch again."""
    for i in range(3):
        land_json(path("in"), f"{i}.json", [reading("u", i, i), ("", "A", 1, "m", 0.0, "")])
    run = lambda: bronze.start_bronze(bronze.stream_readings(spark, path("in"), max_files=1), path("t"), path("cp"), trigger=ALL, quarantine=path("bad")).awaitTermination()
    run()
    for name in ("commits/2", "commits/.2.crc"):
        os.remove(path("cp") + "/" + name)
    run()
    assert [v for _, _, v in stored(spark, path("t"))] == [0.0, 1.0, 2.0]
    assert spark.read.parquet(path("bad")).count() == 3
    assert {f for f in os.listdir(path("bad")) if "=" in f} == {"batches=main-0"}


# --- versions -------------------------------------------------------------------------------

VERSIONED = T.StructType([*files.READING_SCHEMA.fields, T.StructField("processed_at", T.TimestampType())])


def test_newest_version_wins_and_state_drains(spark, path):
    rng = np.random.default_rng(1)
    versions = [(*reading(f"u{rng.integers(3)}", int(m), int(rng.integers(100)), model=str(rng.integers(3))), datetime(2024, 5, 1, 0, int(rng.integers(4))))
                for m in range(60) for _ in range(4)]
    versions += [("", "A", 1, "m", 1.0, START.isoformat(), datetime(2024, 5, 1)), ("u1", "A", 1, "m", 1.0, "never", datetime(2024, 5, 1))]
    rows = spark.createDataFrame(versions, VERSIONED)
    want = cleaning.dedupe_readings(cleaning.split_by_time(cleaning.valid_readings(rows))[0].drop("event_timestamp"))

    def run():
        stream = spark.readStream.schema(VERSIONED).option("maxFilesPerTrigger", 1).parquet(path("in"))
        query = (bronze.newest_in_stream(stream, "30 minutes").writeStream.format("parquet").option("path", path("out"))
                 .option("checkpointLocation", path("cp")).outputMode("append").trigger(**ALL).start())
        query.awaitTermination()
        return query

    # a version arrives up to 29 minutes after the reading's time
    delay = F.col("event_time").try_cast("timestamp") + F.make_dt_interval(mins=F.pmod(F.xxhash64(*rows.columns), F.lit(29)).cast("int"))
    late = rows.withColumn("slot", F.coalesce(F.least(F.lit(5), F.minute(delay) / 10 + 6 * F.hour(delay)).cast("int"), F.lit(0)))
    for i in range(6):
        late.filter(F.col("slot") == i).drop("slot").coalesce(1).write.mode("append").parquet(path("in"))
        if i == 2:
            run()
    beat = spark.createDataFrame([(None, None, None, None, None, "2024-02-01T00:00:00", None)], VERSIONED)
    beat.coalesce(1).write.mode("append").parquet(path("in"))
    query = run()
    key = lambda df: sorted(map(str, df.select(*files.READING_SCHEMA.names, "processed_at").collect()))
    assert key(spark.read.parquet(path("out"))) == key(want)
    assert [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress][-1] == 0


def test_arrival_decides_without_a_processing_time(spark, path):
    land_json(path("in"), "1.json", [reading("u", 0, 9)])
    stream = bronze.newest_in_stream(bronze.stream_readings(spark, path("in"), max_files=1))
    go = lambda: bronze.start_bronze(stream, path("t"), path("cp"), trigger=ALL).awaitTermination()
    go()
    land_json(path("in"), "2.json", [reading("u", 0, 5)])
    go()
    land_json(path("in"), "3.json", [reading("", 10_000, 0)])
    go()
    assert [v for _, _, v in stored(spark, path("t"))] == [5.0]


# --- look-back in streams -------------------------------------------------------------------

WIDE = "sensor_id string, cycle int, at timestamp, a double, b double"


def test_frame_statistics():
    rng = np.random.default_rng(2)
    values = rng.standard_normal((40, 3))
    values[rng.random((40, 3)) < 0.3] = np.nan
    for width in (1, 5, 15, 60):
        mean, deviation = rolling.frame_statistics(values, width, 25)
        for row in range(25):
            i = 15 + row
            for c in range(3):
                frame = values[max(0, i - width + 1): i + 1, c]
                frame = frame[~np.isnan(frame)]
                assert np.isnan(mean[row, c]) if not len(frame) else np.isclose(mean[row, c], frame.mean())
                assert np.isclose(deviation[row, c], frame.std(ddof=1) if len(frame) > 1 else 0.0)


def test_streamed_features_equal_batch_features(spark, path):
    rng = np.random.default_rng(3)
    rows = [(f"u{u}" if u else None, c, START + timedelta(minutes=c), None if rng.random() < 0.2 else float(rng.normal()), float(rng.normal()))
            for u in range(4) for c in range(int(rng.integers(10, 60)))]
    df = spark.createDataFrame(rows, WIDE)
    late = F.least(F.lit(3), ((F.col("cycle") + F.pmod(F.xxhash64("sensor_id", "cycle"), F.lit(14))) / 15).cast("int"))

    def run():
        stream = spark.readStream.schema(WIDE).option("maxFilesPerTrigger", 1).parquet(path("in"))
        features = rolling.rolling_in_stream(stream, "sensor_id", ["cycle"], ["a", "b"], "at", "15 minutes")
        (features.writeStream.format("parquet").option("path", path("out")).option("checkpointLocation", path("cp"))
         .outputMode("append").trigger(**ALL).start().awaitTermination())

    for i in range(4):
        df.filter(late == i).coalesce(1).write.mode("append").parquet(path("in"))
        if i == 1:
            run()
    spark.createDataFrame([(None, None, datetime(2024, 3, 1), None, None)], WIDE).write.mode("append").parquet(path("in"))
    run()
    columns = ["sensor_id", "cycle", "at", "a", "b", *feature_names(["a", "b"])]
    rounded = lambda x: x.select(*[F.round(c, 9).alias(c) if "_mean_" in c or "_std_" in c else c for c in columns])
    batch = rolling_features(df.filter("sensor_id IS NOT NULL"), "sensor_id", ["cycle"], ["a", "b"])
    got, want = rounded(spark.read.parquet(path("out"))), rounded(batch)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_frames_stay_in_their_series():
    values = np.array([[1.0], [2.0], [4.0], [10.0], [30.0]])
    mean, deviation = rolling.frame_statistics(values, 3, 3, np.array([0, 1, 2, 0, 1]))
    assert np.allclose(mean[:, 0], [7 / 3, 10.0, 20.0]) and np.allclose(deviation[:, 0], [np.std([1, 2, 4], ddof=1), 0.0, np.std([10, 30], ddof=1)])


def test_streamed_units_share_states(spark, path):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(f"u{u}", c, START + timedelta(minutes=c), float(rng.normal()), None if c % 3 else float(u)) for u in range(20) for c in range(18)], WIDE)
    held = []
    for low, high in ((0, 9), (9, 18)):
        df.filter(F.col("cycle").between(low, high - 1)).coalesce(1).write.mode("append").parquet(path("in"))
        if high == 18:
            spark.createDataFrame([(None, None, datetime(2024, 3, 1), None, None)], WIDE).write.mode("append").parquet(path("in"))
        stream = spark.readStream.schema(WIDE).parquet(path("in"))
        features = rolling.rolling_in_stream(stream, "sensor_id", ["cycle"], ["a", "b"], "at", "2 minutes", buckets=3)
        query = (features.writeStream.format("parquet").option("path", path("out")).option("checkpointLocation", path("cp"))
                 .outputMode("append").trigger(**ALL).start())
        query.awaitTermination()
        held += [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert 0 < max(held) <= 3  # not one for each of the 20 units
    rounded = lambda x: x.select("sensor_id", "cycle", *[F.round(c, 9).alias(c) for c in feature_names(["a", "b"])])
    got, want = rounded(spark.read.parquet(path("out"))), rounded(rolling_features(df, "sensor_id", ["cycle"], ["a", "b"]))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


# --- Silver ---------------------------------------------------------------------------------


def silver_rows(spark, path, *columns):
    return sorted(map(str, files.read_table(spark, path).select("sensor_id", "time_in_cycles", "window_start", *columns).collect()))


def test_partials_merge_to_one_run(spark, path):
    rng = np.random.default_rng(4)
    rows = [reading(f"u{rng.integers(4)}", int(rng.integers(3 * 1440)), rng.integers(100), metric=str(rng.choice(["m", "k", "other"])), cycle=int(rng.integers(2)))
            for _ in range(300)] + [("", "A", 1, "m", 1.0, START.isoformat()), ("u1", "A", 1, "m", 1.0, "never"), ("u1", None, 1, "m", None, START.isoformat())]
    cuts = [0, 120, 121, 250, len(rows)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        land_json(path("in"), f"{i}.json", rows[a:b])
        stream = bronze.stream_readings(spark, path("in"), max_files=1)
        bronze.start_bronze(stream, path("bronze"), path("cp"), trigger=ALL).awaitTermination()
        if i != 1:  # two batches at once, too
            assert partials.run_silver_incrementally(spark, path("bronze"), path("parts"), path("silver"), metrics=["m", "k"], window="1 hour")
    assert not partials.run_silver_incrementally(spark, path("bronze"), path("parts"), path("silver"), metrics=["m", "k"], window="1 hour")
    whole = partials.partial_means(files.read_table(spark, path("bronze")), ["m", "k"], "1 hour")
    parts = files.read_table(spark, path("parts")).select(*whole.columns)
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    want = partials.means_of(whole, ["m", "k"])
    newest = cleaning.newest_per_key(want, ["sensor_id", "window_start"], ["time_in_cycles", "engine_model"])
    assert silver_rows(spark, path("silver"), "m", "k") == sorted(map(str, newest.select("sensor_id", "time_in_cycles", "window_start", "m", "k").collect()))


def test_a_repeated_load_is_merged_once_per_day(spark, path):
    load = lambda *rows: partials.partial_means(files.from_rows(spark, rows, files.READING_SCHEMA), ["m"], "1 hour")
    total = lambda: sorted((r["date"], r["s"], r["n"]) for r in files.read_table(spark, path("t")).groupBy("date").agg(F.sum("sum_m").alias("s"), F.sum("n_m").alias("n")).collect())
    partials.apply_load(load(reading("u", 0, 1), reading("u", 1440, 10)), path("t"), 1, ["m"])
    second = load(reading("u", 5, 2), reading("u", 1445, 20), reading("u", 2881, 300))
    # as if the commit had reached one day only
    partials.apply_load(second.filter("date = '2024-01-02'"), path("t"), 2, ["m"])
    for _ in range(2):
        assert sorted(partials.apply_load(second, path("t"), 2, ["m"])) == ["2024-01-01", "2024-01-02", "2024-01-03"]
        assert total() == [("2024-01-01", 3.0, 2), ("2024-01-02", 30.0, 2), ("2024-01-03", 300.0, 1)]
    partials.apply_load(load(), path("t"), 3, ["m"])
    assert len(total()) == 3


def break_files(folder):
    """Zeros in place of the data; the schema at the end stays, as listing a table reads it."""
    for name in os.listdir(folder):
        place = os.path.join(folder, name)
        if name.endswith(".crc"):
            os.remove(place)
        elif name.endswith(".parquet"):
            with open(place, "rb") as f:
                data = f.read()
            end = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
            with open(place, "wb") as f:
                f.write(data[:4] + bytes(end - 4) + data[end:])


def test_days_that_did_not_change_are_not_read(spark, path):
    """Their data is gone, and the runs do not notice."""
    for i in range(4):
        land_json(path("in"), f"{i}.json", [reading("u", 1440 * i, i), reading("v", 1440 * i + 1, i)])
        bronze.start_bronze(bronze.stream_readings(spark, path("in")), path("bronze"), path("cp"), trigger=ALL).awaitTermination()
        partials.run_silver_incrementally(spark, path("bronze"), path("parts"), path("silver"), metrics=["m"])
    seen = BatchLedger(spark, ledger_of(path("bronze"))).rows().agg(F.max("at").cast("string")).first()[0]
    land_json(path("in"), "late.json", [reading("u", 1440.5, 41)])
    bronze.start_bronze(bronze.stream_readings(spark, path("in")), path("bronze"), path("cp"), trigger=ALL).awaitTermination()
    for table in ("bronze", "parts", "silver"):
        for day in (1, 3, 4):
            break_files(path(table) + f"/date=2024-01-0{day}")
            with pytest.raises(Exception, match="day|date|parquet"):
                spark.read.parquet(path(table) + f"/date=2024-01-0{day}").collect()
    read_day = lambda: spark.read.schema("sensor_id string, m double").parquet(path("silver") + "/date=2024-01-02").collect()
    partials.run_silver_incrementally(spark, path("bronze"), path("parts"), path("silver"), metrics=["m"])
    assert sorted(map(tuple, read_day())) == [("u", 21.0), ("v", 1.0)]
    assert silver.run_silver(spark, path("bronze"), path("silver"), metrics=["m"], since=seen)
    assert sorted(map(tuple, read_day())) == [("u", 21.0), ("v", 1.0)]


# --- Gold -----------------------------------------------------------------------------------


def gold_silver(spark, days=6, sensors=5, per_day=9):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(sensors):
        cycle = 0
        for d in range(days):
            for i in range(per_day if s else int(rng.integers(0, 3))):  # one sensor is seldom heard of
                cycle += 1
                at = START + timedelta(days=d, minutes=i)
                rows.append((f"unit_{s}", "A", cycle, float(rng.normal()), at.isoformat(sep=" "), at.date().isoformat()))
    return spark.createDataFrame(rows, "sensor_id string, engine_model string, time_in_cycles int, m double, window_start string, date string")


def test_tails_replace_the_history(spark, path):
    rows = gold_silver(spark)
    tails = path("tails")
    days = [f"2024-01-0{d}" for d in range(1, 7)]
    for day in days[:4]:
        chosen = gold.with_look_back(rows, (day, day), gold.read_tails(spark, tails))
        want = gold.with_look_back(rows, (day, day))
        assert sorted(map(str, chosen.collect())) == sorted(map(str, want.collect()))
        gold.store_tail(spark, chosen, day, tails)
    # days without a tail in between are read, older tails serve runs that go back
    for first, last in ((days[5], days[5]), (days[2], days[4]), (days[0], days[1])):
        chosen = gold.with_look_back(rows, (first, last), gold.read_tails(spark, tails))
        assert sorted(map(str, chosen.collect())) == sorted(map(str, gold.with_look_back(rows, (first, last)).collect()))
    gold.store_tail(spark, gold.with_look_back(rows, (days[1], days[1]), gold.read_tails(spark, tails)), days[1], tails)
    assert sorted(tables.partition_values(gold.read_tails(spark, tails), gold.AS_OF)) == days[:2]  # later ones rested on what is replaced


def test_look_back_reads_no_older_days(spark, path):
    rows = gold_silver(spark)
    tables.write_partitioned(rows, path("silver"))
    gold.store_tail(spark, rows.filter("date <= '2024-01-03'"), "2024-01-03", path("tails"))
    want = sorted(map(str, gold.with_look_back(rows, ("2024-01-05", "2024-01-06")).select("sensor_id", "window_start", "m").collect()))
    table = files.read_table(spark, path("silver"))
    for d in (1, 2, 3):
        shutil.rmtree(path("silver") + f"/date=2024-01-0{d}")
    chosen = gold.with_look_back(table, ("2024-01-05", "2024-01-06"), gold.read_tails(spark, path("tails")))
    assert sorted(map(str, chosen.select("sensor_id", "window_start", "m").collect())) == want
