"""Mixing against water filling by iteration and a walk through each source."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import curriculum

SCHEMA = "doc_id long, text string, source string, _size long, target string, _before long, _doc string, _copy int"


def fill(sizes, weights, repeats):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(repeats * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > repeats * sizes[s]]
        if not above:
            return {s: share.get(s, repeats * sizes[s]) for s in names}
        capped |= set(above)


def data(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(200):
        source = rng.choice(["a", "a", "a", "a", "b", "é", "", None, "z"])
        rows.append((i, " \n".join("wort" for _ in range(rng.randrange(0, 60))), source, 7, "clash", 3, "d", 1))
    more = [(300, None, "a"), (301, "", "new"), (None, "x y z", "b"), (3, rows[3][1], rows[3][2]), (302, "v " * 50_000, "z")]
    return rows + [(*r, 0, "", 0, "", 0) for r in more]


@pytest.mark.parametrize("seed, weights", [(1, (5, 2, 1)), (2, (5, 2, 1)), (3, (1, 50, 3))])
def test_targets_and_taken(spark, seed, weights):
    rows = data(seed)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + size(r[1])
    want = fill(sizes, weights, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    out = curriculum.mix(df.repartition(3), weights=weights).collect()
    again = curriculum.mix(df.repartition(5, "doc_id"), weights=weights).collect()
    key = lambda r: (str(r.doc_id), r._size, r._taken, str(r._positions))
    assert sorted(map(key, out)) == sorted(map(key, again)) and len(out) == len(rows)
    taken = {}
    for r in out:
        assert r._size == size(r.text) and 0 <= r._taken <= 3 * r._size and r._source_size == sizes[r.source]
        assert r._target == pytest.approx(want[r.source]) and r.target in ("clash", "")
        taken[r.source] = taken.get(r.source, 0) + r._taken
        assert (r._positions or []) == sorted(r._positions or []) and all(0 <= p <= 1 for p in r._positions or [])
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1


def test_positions_follow_the_schedule(spark):
    """The share of a source delivered by any time is the integral of its schedule."""
    rows = spark.range(1000).select((F.col("id") / 1000).alias("u"))
    for kind, schedule in enumerate(curriculum.SCHEDULES):
        for r in rows.select("u", curriculum.position_of(F.col("u"), F.lit(kind)).alias("t")).collect():
            done = sum(w / len(schedule) * min(1, max(0, r.t * len(schedule) - i)) for i, w in enumerate(schedule))
            assert done == pytest.approx(r.u, abs=1e-9)


def test_training_order(spark):
    rows = data(4)
    df = spark.createDataFrame(rows, SCHEMA)
    out = curriculum.training_order(df)
    assert out.columns == df.columns
    copies, mixed = {}, {}
    for r in out.collect():
        copies.setdefault((r.doc_id, r.source), []).append(len((r.text or "").split()))
    for r in curriculum.mix(df).collect():
        mixed[(r.doc_id, r.source)] = mixed.get((r.doc_id, r.source), 0) + r._taken
    assert {k: sum(v) for k, v in copies.items()} == {k: v for k, v in mixed.items() if v}
    first = [r._positions[0] for r in curriculum.mix(df).where("_taken > 0").orderBy(F.element_at("_positions", 1)).collect()]
    assert first == sorted(first)


def test_empty_table_and_order_of_the_hash(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert curriculum.mix(none).count() == 0 and curriculum.training_order(none).count() == 0
    zero = spark.createDataFrame([(1, None, "a", 0, "", 0, "", 0), (2, "", None, 0, "", 0, "", 0)], SCHEMA)
    assert [(r._taken, r._positions) for r in curriculum.mix(zero).collect()] == [(0, None)] * 2
    df = spark.createDataFrame([(i, "w", "a", 0, "", 0, "", 0) for i in range(50)], SCHEMA)
    order = [r.doc_id for r in curriculum.mix(df).orderBy(F.element_at("_positions", 1)).collect()]
    assert order == sorted(range(50), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


def test_order_does_not_depend_on_the_partitions(spark):
    """Null and equal ids, equal sizes, different texts: the same documents at the same positions."""
    rows = [(None, f"text {i} of three", "a") for i in range(9)] + [(7, f"other {i} text", "a") for i in range(9)] + [(i, "w " * (i % 5), "b") for i in range(40)]
    rows += [(None, "copied", "a")] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = []
    for parts in (1, 3, 7):
        mixed = sorted(map(str, curriculum.mix(df.repartition(parts)).collect()))
        runs.append((mixed, [tuple(r) for r in curriculum.training_order(df.repartition(parts)).collect()]))
    assert runs[0] == runs[1] == runs[2]


@pytest.mark.parametrize("limit", [10, 10**9])
def test_hot_keys_are_divided(spark, monkeypatch, limit):
    """A third of the rows share one key: their run is cut, and nothing changes."""
    monkeypatch.setattr(curriculum, "HOT_RUN_ROWS", limit)
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(1, 9), rng.choice("ab")) for i in range(600)] + [(None, f"x{i} " * rng.randrange(1, 5), "a") for i in range(300)]
    rows += [(17, f"y{i} z", "b") for i in range(100)] + [(None, "same", "a")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bins = []
    monkeypatch.setattr(curriculum, "stored", lambda d, label, f=curriculum.stored: bins.append((label, f(d, label))) or bins[-1][1])
    out = sorted(map(str, curriculum.mix(df).collect()))
    finer = [d for label, d in bins if label == "mix-finer-runs"]
    assert len(finer) == (limit == 10) and (not finer or finer[0].agg(F.max("n")).first()[0] <= 60)
    monkeypatch.setattr(curriculum, "HOT_RUN_ROWS", 10**9)
    assert out == sorted(map(str, curriculum.mix(df).collect()))


def test_whole_rows_move_once_for_the_sums(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(i, "a b c", "s") for i in range(50)], "doc_id long, text string, source string")
        plan = curriculum.mix(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) == 2 and "Window" in plan  # the rows, and the table of runs
