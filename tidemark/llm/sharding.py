"""Sharding by proportional stratified interleaving; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import CRC_OF, CRC_STEPS, bucket_count, hash_buckets, order_hash, prefix_sums, source_key, text_of


def shard(docs: DataFrame, n_shards: int = 40, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Deal rows into shards whose row counts differ by one at most and whose mixture is the corpus's.

    Rows of a source are ranked in seeded-hash order; all rows are sorted by the fractional rank
    (rank + 1/2) / rows of the source, and the sorted sequence is cut into ``n_shards`` runs.
    Ranks and the global order come from two-level running counts, so neither a hot source nor
    the global sort meets in one task.

    Nulls: a null text has size 16 and the CRC of no bytes; null sources form a source of their
    own; null ids are ranked by one hash and may share it. Repeated rows each get a slot. Rows are
    dealt by id under this law, so equal texts of different ids may lie in different shards. An
    empty table gives no rows; with fewer rows than shards some shards stay empty. Other columns
    are not read.
    """
    rows = docs.count()
    text = text_of(text_col)
    base = docs.select(
        F.col(id_col).alias("doc_id"), source_key(source_col).alias("k"), order_hash(seed, id_col).alias("u"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit(1).alias("one"),
    )
    n = bucket_count(rows)
    base = base.withColumn("b", hash_buckets(F.col("u"), n))
    ranked = prefix_sums(base, ["k"], "b", ["u", "doc_id", "text_crc32", "size"], "one", "rank", "of_source")
    ranked = ranked.withColumn("f", (F.col("rank") + 0.5) / F.col("of_source"))
    ranked = ranked.drop("b").withColumn("b", F.least(F.floor(F.col("f") * n), F.lit(n - 1)))
    placed = prefix_sums(ranked, [], "b", ["f", "k", "u", "doc_id", "text_crc32", "size"], "one", "g", "of_all")
    cut = F.expr(f"(g * {n_shards}L) div {max(rows, 1)}L")
    placed = placed.withColumn("shard", cut.cast("int"))
    first = F.expr(f"(cast(shard as bigint) * {rows}L + {n_shards - 1}L) div {n_shards}L")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("g") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = f"""
WITH RECURSIVE {CRC_STEPS},
d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k, (coalesce(octet_length(encode(text)), 0) + 16)::BIGINT AS size, {CRC_OF.format("coalesce(text, '')")} AS text_crc32,
    substr(md5('17/' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS u FROM documents, crc),
r AS (SELECT *, (row_number() OVER (PARTITION BY k ORDER BY u, doc_id) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY k) AS f FROM d),
g AS (SELECT *, row_number() OVER (ORDER BY f, k, u, doc_id) - 1 AS g, count(*) OVER () AS n FROM r),
s AS (SELECT *, (g * 40) // n AS shard FROM g)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, (g - (shard * n + 39) // 40)::BIGINT AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""
