"""Mixing sources to target weights over training time: demand curves and the documents' positions on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.staging import MAX_TASKS, stored

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
PART_BYTES = 16 << 20  # text of a task of the training order
BUCKET_DIGITS = 3  # hex digits of the shuffling hash: 4096 runs of each source are summed separately
#: relative weight of the sources in each of the equal phases of training, by place in WEIGHTS; each row has mean 1
SCHEDULES = ((0.5, 0.75, 1.25, 1.5), (1.0, 1.0, 1.0, 1.0), (1.5, 1.25, 0.75, 0.5))
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, kind) from (source, source_size): one row for each source.

    Sources in code point order, null last, take the weights in turn and share the total size; a target stops at
    ``max_repeats`` times its source's size and the excess is shared by weight among the others, until none is above.
    In the order of cap by weight the capped sources come first, so running sums find them without iteration.
    The windows run over one row for each source. An empty source has target 0.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    kind = (rank - 1) % len(weights)
    rows = sizes.select("source", "source_size", kind.alias("kind"))
    rows = rows.withColumns({
        "w": F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("kind") + 1),
        "cap": F.col("source_size") * max_repeats, "total": F.sum("source_size").over(everything)})
    order = Window.orderBy(F.col("cap") / F.col("w"), "w", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0).cast("long")),
        "w_from": F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))})
    rows = rows.withColumn("capped", (F.col("total") - F.col("cap_before")) * F.col("w") > F.col("cap") * F.col("w_from"))
    rows = rows.withColumns({
        "left": F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0).cast("long")),
        "w_open": F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)})
    share = F.col("left").cast("double") * F.col("w") / F.col("w_open")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double")))
    return rows.select("source", "source_size", target.alias("target"), "kind")


def position_of(share: Column, kind: Column, schedules: tuple[tuple[float, ...], ...] = SCHEDULES) -> Column:
    """Training time in [0, 1] at which a source has delivered ``share`` of its target: the integral of its weight
    schedule, inverted piece by piece."""
    out = F.lit(None).cast("double")
    for k, schedule in enumerate(schedules):
        phases, mean = len(schedule), sum(schedule) / len(schedule)
        at, inverse = 0.0, F.lit(1.0)
        pieces = []
        for i, w in enumerate(schedule):
            step = w / mean / phases
            pieces.append((at + step, (F.lit(float(i)) + (share - F.lit(at)) / F.lit(step)) / F.lit(float(phases)) if step else F.lit(i / phases)))
            at += step
        for stop, value in reversed(pieces):
            inverse = F.when(share < F.lit(stop), value).otherwise(inverse)
        out = F.when(kind == k, inverse).otherwise(out)
    return out


HOT_RUN_ROWS, HOT_RUN_TIMES = 1000, 8  # a run of more rows than this, and so many times its source's mean run, is divided
HOT_DIGITS = 2


def _bin() -> Column:
    """One text for a source and a run of it."""
    return F.concat("_run", F.lit(":"), F.coalesce(F.concat(F.lit("s"), F.col("_source").cast("string")), F.lit("n")))


def _run_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_source", "_run").agg(F.sum("_size").alias("run_size"), F.count("*").alias("n")).withColumn("_bin", _bin())


ADDED = ("_size", "_source_size", "_target", "_taken", "_positions")


def _mixed(docs: DataFrame, size: Column | None, key: str, weights: tuple[int, ...], max_repeats: int,
           schedules: tuple[tuple[float, ...], ...]) -> DataFrame:
    """ADDED and _doc, the whole row of ``docs``, in which names cannot clash."""
    if len(schedules) != len(weights) or any(w < 0 for s in schedules for w in s):
        raise ValueError("one schedule of non-negative weights for each weight")
    hashed = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("source").alias("_source"),
        (word_count(F.col("text")) if size is None else size).alias("_size"), hashed.alias("_hash"))
    # rows with the same key and size go by all they hold, so the order does not depend on how they are stored
    rows = rows.withColumns({"_tie": F.xxhash64("_doc"), "_run": F.substring("_hash", 1, BUCKET_DIGITS)})
    runs = stored(_run_sums(rows), "mix-runs")
    each = F.avg("n").over(Window.partitionBy("_source"))
    hot = stored(runs.withColumn("_each", each).where((F.col("n") > HOT_RUN_ROWS) & (F.col("n") > F.col("_each") * HOT_RUN_TIMES)).select("_bin"), "mix-hot-runs")
    if not hot.isEmpty():
        # many rows of one key: their run is divided further down the same order
        hot = hot.select(F.col("_bin").alias("_hot"))
        finer = F.concat("_hash", F.lpad(F.col("_size").cast("string"), 19, "0"), F.lpad(F.hex("_tie"), 16, "0").substr(1, HOT_DIGITS))
        # the order of hex digits is that of unsigned numbers
        rows = rows.withColumn("_tie", F.lpad(F.hex("_tie"), 16, "0"))
        rows = rows.join(hot, _bin() == F.col("_hot"), "left").withColumn("_run", F.when(F.col("_hot").isNotNull(), finer).otherwise(F.col("_run"))).drop("_hot")
        runs = stored(_run_sums(rows), "mix-finer-runs")
    else:
        rows = rows.withColumn("_tie", F.lpad(F.hex("_tie"), 16, "0"))
    sizes = runs.groupBy(F.col("_source").alias("source")).agg(F.sum("run_size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeats)
    by_run = Window.partitionBy("_source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_source", "_bin", F.coalesce(F.sum("run_size").over(by_run), F.lit(0).cast("long")).alias("_before"))
    t, r = targets.alias("t"), runs.alias("r")
    runs = stored(
        r.join(t, F.col("r._source").eqNullSafe(F.col("t.source")))
        .select("_bin", "_before", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("kind").alias("_kind")), "mix-targets")
    # the running sums and the join need the same partitioning, so whole rows move once
    rows = rows.withColumn("_bin", _bin())
    inside = Window.partitionBy("_bin").orderBy("_hash", "_size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0).cast("long"))).join(runs, "_bin")
    first, budget = F.col("_before") + F.col("_inside"), F.floor("_target")
    taken, positions = F.lit(0).cast("long"), []
    for p in range(max_repeats):
        start = first + F.col("_source_size") * p
        piece = F.greatest(F.lit(0).cast("long"), F.least(F.col("_size"), budget - start))
        taken += piece
        positions.append(F.when(piece > 0, position_of(start / F.col("_target"), F.col("_kind"), schedules)))
    found = F.array_compact(F.array(*positions))
    return rows.select("_doc", "_size", "_source_size", "_target", taken.alias("_taken"),
                       F.nullif(found, F.array().cast("array<double>")).alias("_positions"))


def mix(docs: DataFrame, size: Column | None = None, key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS,
        max_repeats: int = MAX_REPEATS, schedules: tuple[tuple[float, ...], ...] = SCHEDULES) -> DataFrame:
    """``docs`` (``key``, source, text and any others) with the mix's columns, one row for each row.

    _size: words (or ``size``); _source_size, _target: of its source; _taken: words the mix takes, repeats
    counted; _positions: training times in [0, 1] at which its copies start, null if none is taken.

    A source's documents stand one after the other in the order of a hash of the key (ties: by size, then by a hash of
    the whole row), and are gone through again until the target is met, so the last copy may be cut; all that is taken of a source is its target
    without the fraction. Cumulative demand is the integral of the source's weight schedule, and a copy's position
    is where that demand reaches the words before it.

    Sums run over 4096 runs of each source, then over the runs, so a source with a third of all rows is never in one
    task; nor is a key with a third of them, null or not, whose run is divided by the ties' order. Null text has size 0 and is never taken; null sources are one source, the last; rows with a null or
    repeated key are documents of their own. Columns named like those added are replaced; no other name clashes.
    """
    rows = _mixed(docs, size, key, weights, max_repeats, schedules)
    return rows.select(*[F.col("_doc")[c].alias(c) for c in docs.columns if c not in ADDED], *ADDED)


def training_order(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them, sorted by training position over the partitions: one row for each copy.

    All columns stay. Of a copy that the target cuts, the text is its first words, joined by one space. Null and empty
    texts are never taken; equal positions go by a hash of the row, so rows that are equal in all columns may change
    places and others may not. The copies of training time are spread evenly, so a partition is a range of it and no
    sample is needed to divide them.
    """
    columns = docs.columns
    rows = _mixed(docs, None, "doc_id", WEIGHTS, MAX_REPEATS, SCHEDULES).where("_taken > 0")
    rows = rows.select("*", F.posexplode("_positions").alias("_copy", "_position"))
    text, words = F.col("_doc")["text"], F.least(F.col("_size"), F.col("_taken") - F.col("_copy") * F.col("_size"))
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, words.cast("int")), " ")
    whole = F.when(words < F.col("_size"), cut).otherwise(text)
    rows = rows.select(F.struct(*[(whole if c == "text" else F.col("_doc")[c]).alias(c) for c in columns]).alias("_doc"), "_position")
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = 1 + min(MAX_TASKS, total // PART_BYTES)
    at = F.least(F.floor(F.col("_position") * parts), F.lit(parts - 1)).cast("int")
    rows = rows.repartitionById(parts, at).sortWithinPartitions("_position", F.xxhash64("_doc"))
    return rows.select(*[F.col("_doc")[c].alias(c) for c in columns])
