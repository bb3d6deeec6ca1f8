"""Queries over the given tables, one for each operator, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    curriculum, decontaminate, digest, divergence, infill, licenses, oracles, separators, simhash, substring, training_order, warc, weak_labels,
    whitening,
)
from millrace.llm.staging import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", substring.digest(rows.kept).alias("kept_sha256"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.where("record_type <> 'gap'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op3_warc"] = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY ALL HAVING count(*) > 1)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stored(docs.select("doc_id", "source", curriculum.word_count(docs.text).alias("size")), "mix-sizes")
    rows = curriculum.mix(sized, size=sized["size"])
    return rows.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        F.col("_taken").alias("taken"), F.round(F.element_at("_positions", 1), 6).alias("position"))


ORACLES["op10_mixing"] = r"""
    WITH d AS (
        SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, 'null')) AS h,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS w,
            (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind,
            3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM s),
    o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
            sum(w) OVER (ORDER BY cap / w, w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_from FROM w),
    c AS (SELECT *, (total - cap_before) * w > cap * w_from AS capped FROM o),
    f AS (SELECT *, (total - coalesce(sum(cap) FILTER (capped) OVER (), 0))::BIGINT AS left_over, (sum(w) FILTER (NOT capped) OVER ())::BIGINT AS w_open FROM c),
    t AS (SELECT source, source_size, kind, CASE WHEN capped THEN cap::DOUBLE ELSE least(left_over::DOUBLE * w / w_open, cap::DOUBLE) END AS target FROM f),
    r AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.kind,
            coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    g AS (SELECT *, floor(target)::BIGINT AS budget, start / target AS u FROM r)
    SELECT doc_id, size, source_size, target,
        (greatest(0, least(size, budget - start)) + greatest(0, least(size, budget - start - source_size))
            + greatest(0, least(size, budget - start - 2 * source_size)))::BIGINT AS taken,
        CASE WHEN least(size, budget - start) > 0 THEN round(CASE kind
            WHEN 0 THEN CASE WHEN u < 0.125 THEN u / 0.125 / 4 WHEN u < 0.3125 THEN (1 + (u - 0.125) / 0.1875) / 4
                WHEN u < 0.625 THEN (2 + (u - 0.3125) / 0.3125) / 4 ELSE (3 + (u - 0.625) / 0.375) / 4 END
            WHEN 1 THEN u
            ELSE CASE WHEN u < 0.375 THEN u / 0.375 / 4 WHEN u < 0.6875 THEN (1 + (u - 0.375) / 0.3125) / 4
                WHEN u < 0.875 THEN (2 + (u - 0.6875) / 0.1875) / 4 ELSE (3 + (u - 0.875) / 0.125) / 4 END END, 6) END AS position
    FROM g
"""


@query
def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialised(table(spark, sf_dir, "documents"))


@query
def op5_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separators.token_counts(table(spark, sf_dir, "documents"))


@query
def op8_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judged(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query
def op9_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("mark")


ORACLES["op6_licenses"] = oracles.license_sql()
ORACLES["op8_divergence"] = oracles.divergence_sql()
ORACLES["op2_substring"] = oracles.substring_sql()
ORACLES["op7_decontamination"] = oracles.decontamination_sql()


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = whitening.fit(rows)
    explained = F.array(*[F.lit(e) for e in model.explained]).cast("array<double>")
    found = whitening.whiten(rows.select("vec_id", "embedding"), model)
    return found.select("vec_id", F.expr("try_cast(whitened_deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("i")).alias("explained"), F.lit(whitening.identity_error(rows, model)).alias("identity_error"))


@query
def op12_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.edit_comparison(table(spark, sf_dir, "documents"))


@query
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.fill_in_middle(table(spark, sf_dir, "documents"), outputs=False).drop("pieces")


ORACLES["op13_infill"] = oracles.infill_sql()
