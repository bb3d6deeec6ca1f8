"""SimHash near-duplicates: fingerprints, and their links found on a grid of segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.llm.staging import free_name, never_sent, stored
from millrace.llm.words import slices

SHINGLE = 4
SEED = 42
MAX_BITS = 4

# Fixed layout: 64 bits are 32 segments of two; a segment's bit count is written as a thermometer (0: 00, 1: 01,
# 2: 11), so that the Manhattan distance of two count vectors is the number of differing thermometer bits.
LOW_BITS = 0x5555555555555555
#: segments of the three grids; at 4 differing bits, one of them is within its radius 1, 1 or 0
GRIDS = ((0, 12, 1), (12, 12, 1), (24, 8, 0))


def _votes(hashes: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8)).reshape(-1, 64)
    whole = len(bits) // 250 * 250
    part = np.add.reduce(bits[:whole].reshape(-1, 250, 64), axis=1, dtype=np.uint8)
    return part.sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)


def fingerprint_of(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of one text; works through it piece by piece."""
    data = (text or "").encode("utf-8", "replace").lower()  # bytes: only A-Z change
    votes, n, kept = np.zeros(64, dtype=np.int64), 0, []
    digest = xxhash.xxh64_digest
    for _, piece in slices(data):
        words = kept + piece.split()  # bytes: ASCII white space only
        runs = [words[i:] for i in range(shingle)]
        hashes = b"".join([digest(b" ".join(x), seed) for x in zip(*runs)])
        if hashes:
            votes += _votes(hashes)
            n += len(hashes) // 8
        kept = words[-(shingle - 1):] if shingle > 1 else []
    if not n and kept:  # fewer words than a shingle
        votes, n = _votes(digest(b" ".join(kept), seed)), 1
    bits = np.packbits(2 * votes > n) if n else np.zeros(8, dtype=np.uint8)
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): one row for each document; null and empty texts get 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [fingerprint_of(t if isinstance(t, str) else None, shingle, seed) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": np.array(values, dtype=np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, fp long")


def thermometer(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, as thermometers in one long."""
    low = F.lit(LOW_BITS)
    other = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(other).bitwiseAND(low)
    both = fp.bitwiseAND(other).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(both, 1))


def _cells(reps: DataFrame, probe: bool) -> DataFrame:
    """Grid cells of each fingerprint: its own, and for a probe those one count higher in a segment.

    Of two cells at distance 1, one is one count above the other, so probing upwards only finds each pair once.
    """
    t = F.col("t")
    cells = []
    for grid, (first, n, radius) in enumerate(GRIDS):
        part = F.shiftrightunsigned(t, 2 * first).bitwiseAND(F.lit((1 << (2 * n)) - 1))
        tag = F.lit(grid << 32)
        cells.append(part.bitwiseOR(tag))
        if probe and radius:
            for i in range(n):
                low, high = 1 << (2 * i), 2 << (2 * i)
                up = F.when(part.bitwiseAND(F.lit(low)) == 0, part.bitwiseOR(F.lit(low))).when(
                    part.bitwiseAND(F.lit(high)) == 0, part.bitwiseOR(F.lit(high)))
                cells.append(up.bitwiseOR(tag))
    return reps.select("*", F.explode(F.array_compact(F.array(*cells))).alias("cell"))


def _near(max_bits: int) -> Column:
    """The Manhattan distance of the counts first, then the fingerprints themselves."""
    manhattan = F.bit_count(F.col("l.t").bitwiseXOR(F.col("r.t")))
    exact = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp")))
    return (F.col("l.fp") != F.col("r.fp")) & (manhattan <= max_bits) & (exact <= max_bits)


def _edges(left: DataFrame, right: DataFrame, max_bits: int, different: bool) -> DataFrame:
    """Links between rows of a cell; ``different``: only between labels that differ. See ``never_sent``."""
    on = (F.col("l.cell") == F.col("r.cell")) & _near(max_bits)
    if different:
        on &= F.col("l.label") != F.col("r.label")
    a, b = F.col("l.fp"), F.col("r.fp")
    return never_sent(left.alias("l")).join(never_sent(right.alias("r")), on).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _labelled(reps: DataFrame, edges: DataFrame) -> DataFrame:
    roots = connected_components(edges).withColumnRenamed("v", "fp")
    return stored(reps.select("fp", "t").join(roots, "fp", "left").select("fp", "t", F.coalesce("root", "fp").alias("label")), "simhash-labels")


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS, hub_rounds: int = 2) -> DataFrame:
    """(fp, root) for the distinct ``fps`` (fp): components under links of ``max_bits`` or fewer bits.

    Grid join: two fingerprints within 4 bits have count vectors within Manhattan distance 4, so in one of three
    groups of segments the vectors lie within distance 1, 1 or 0; cells of that group's grid meet by equal keys.

    A group of many near copies fills its cells. First every cell's rows are linked to one hub of the cell, a
    different one each round, which joins such a group by a number of links that grows with its rows; then only
    rows of different components are compared, and in each cell those of its largest component are on one
    side only. All links between different components are found, so the components are exact.
    """
    if max_bits > 4:
        raise ValueError("the three grids are laid out for at most 4 bits")
    reps = stored(fps.select("fp").distinct().withColumn("t", thermometer(F.col("fp"))), "simhash-reps")
    single = reps.withColumn("label", F.col("fp"))
    edges = None
    for seed in range(hub_rounds):
        home = _cells(single, probe=False)
        hub = home.groupBy("cell").agg(
            F.min_by(F.struct("fp", "t", "label"), F.xxhash64("fp", F.lit(seed))).alias("hub")).select("cell", "hub.*")
        found = _edges(hub, _cells(single, probe=True), max_bits, different=True)
        edges = found if edges is None else edges.unionAll(found)
    edges = stored(edges.distinct(), "simhash-hubs")
    labels = _labelled(reps, edges)
    home, probes = _cells(labels, probe=False), _cells(labels, probe=True)
    # cells whose rows all have one component need no comparison; in the others the largest is set apart
    seen = probes.groupBy("cell", "label").agg(F.count("*").alias("n"))
    mixed = stored(
        seen.groupBy("cell").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.count("*").alias("labels"))
        .where("labels > 1").select("cell", "most"), "simhash-cells")
    home, probes = (never_sent(x).join(mixed, "cell") for x in (home, probes))
    rest = _edges(home.where("label <> most"), probes, max_bits, different=True).unionAll(
        _edges(home.where("label = most"), probes.where("label <> most"), max_bits, different=True))
    return _labelled(reps, edges.unionAll(rest)).select("fp", F.col("label").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_copies) for every row of ``docs`` (doc_id, text).

    Rows with equal fingerprints are one class, so a group of exact copies costs one row in the join. Every row of
    the input gives one row, also repeated ones and those with a null doc_id; their component_id is the smallest
    doc_id reachable (null if the component has none). Null, empty and blank texts have fingerprint zero and are
    linked like any other. n_copies: rows with the same fingerprint. Columns besides doc_id and text are ignored.
    """
    rows = stored(fingerprints(docs, shingle), "simhash-fps")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_copies")), "simhash-classes")
    roots = fingerprint_components(classes, max_bits)
    smallest = classes.join(roots, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = classes.join(roots, "fp").join(smallest, "root").select("fp", "component_id", "n_copies")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_copies")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that with the smallest doc_id.

    Rows without doc_id are kept only if their component has no row with one, and then one of them; of rows that
    repeat the kept doc_id the one with the smallest text hash stays.
    """
    row = free_name(docs, "_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    marked = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), shingle, max_bits)
    ids = rows.select(F.col(row).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    best = (
        marked.join(ids, marked.doc_id == ids._row).groupBy("component_id")
        .agg(F.min_by("_row", F.struct(F.col("_id").isNull(), "_id", "_h", "_row")).alias("_row"))
    )
    return rows.join(best.select(F.col("_row").alias(row)), row, "left_semi").drop(row)
