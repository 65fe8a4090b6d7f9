"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, bucket_count, hash_buckets, materialize, order_hash, prefix_sums, source_key, text_of

MOST, LEAST = 32 << 20, 1 << 16  #: words that a partition of mixed rows has at most, and at least if there are fewer than shuffle partitions
CHUNK = 12  #: slots are matched with sources by runs of 2**CHUNK grid points


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Targets of the sources: ``share`` of all sizes by weight, none above ``most`` times its own.

    ``sizes`` has k, source, source_size. Sharing an excess out again until none is above ends at
    the level L with sum(min(most * size, L * weight)) = share * total, the largest of the levels
    that follow from taking the first 0, 1, 2, ... sources (by most * size / weight) as full.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", most * F.col("source_size")).withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    order = Window.orderBy(F.col("cap") / F.col("w"), "k")
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    w = w.withColumn("level", (share * F.col("total") - full) / left)
    w = w.withColumn("level", F.max("level").over(Window.partitionBy()))
    return w.select("k", "source_size", F.greatest(F.least(F.col("cap"), F.col("level") * F.col("w")), F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = 256, seed: int = 8, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Plan a mix: returns (documents with targets and offsets, pieces of the schedule).

    A source's documents, in seeded-hash order, form a stream of words that repeats; it is cut
    into blocks of ``block`` words. Slot i of 2**b has the van der Corput point of i, which the
    cumulative block quotas of the sources map to a source (or to none, behind the last quota);
    the r-th slot of a source takes block r of its stream, the last cut where the target ends. In
    base 2 with 2**b slots every grid point occurs once, so each source gets its quota to the word.

    Pieces: slot, k, rank, doc_id, content, size, start (the document's offset in its source), epoch
    (how often the stream was repeated before), words (of the document before the piece), length
    (words). Sources are few: their targets are computed in one task.

    Null text: size 0; null sources form the last source; null ids are taken like others; ties and
    repeated rows have offsets of their own. Sizes of 0 in all rows or an empty table give targets
    of 0 and no pieces. Other columns are not read.
    """
    spark = docs.sparkSession
    size = F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")
    base = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), source_key(source_col).alias("k"), size.alias("size"), order_hash(seed, id_col).alias("u"), F.xxhash64(text_of(text_col)).alias("content")), "mix")
    quota = materialize(targets(base.groupBy("k").agg(F.first("source").alias("source"), F.sum("size").alias("source_size")), weights, share, most).withColumn("take", F.round("target").cast("long")).withColumn("blocks", F.ceil(F.col("take") / block)), "targets")
    rows, slots = base.count(), quota.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, (max(1, slots) - 1).bit_length())

    base = base.withColumn("b", hash_buckets(F.col("u"), bucket_count(rows)))
    placed = prefix_sums(base, ["k"], "b", ["u", "doc_id", "content", "size"], "size", "start", "of_source").drop("b", "u", "of_source")
    placed = placed.join(quota.select("k", "source_size", "target", "take"), "k")

    ends = quota.withColumn("hi", F.sum("blocks").over(Window.orderBy("k"))).withColumn("lo", F.col("hi") - F.col("blocks")).where("blocks > 0")
    ends = ends.select("k", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", 2 * CHUNK), F.shiftright(F.col("hi") - 1, 2 * CHUNK))).alias("run"))  # in two steps, so that no array is long
    first, last = F.greatest(F.shiftright("lo", CHUNK), F.shiftleft("run", CHUNK)), F.least(F.shiftright(F.col("hi") - 1, CHUNK), F.shiftleft("run", CHUNK) + F.lit((1 << CHUNK) - 1))
    ends = ends.select("k", "lo", "hi", F.explode(F.sequence(first, last)).alias("chunk"))
    grid = spark.range(1 << bits).select(F.col("id").alias("point"), F.shiftright("id", CHUNK).alias("chunk"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    plan = grid.join(ends, "chunk").where("point >= lo and point < hi").select("k", slot.alias("slot"), F.lit(1).alias("one"))
    plan = plan.withColumn("b", F.shiftright("slot", max(0, bits - bucket_count(1 << bits, 64).bit_length() + 1)))
    plan = prefix_sums(plan, ["k"], "b", ["slot"], "one", "rank", "of_source").select("k", "slot", "rank")

    at = placed.where("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(int(most + 0.999) - 1))).alias("epoch"))
    at = at.withColumn("from", F.col("start") + F.col("epoch") * F.col("source_size")).withColumn("to", F.least(F.col("from") + F.col("size"), F.col("take"))).where("from < to")
    at = at.select("k", "doc_id", "content", "size", "start", "epoch", "from", "to", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))).alias("rank"))
    begin = F.greatest(F.col("from"), F.col("rank") * block)
    length = F.least(F.col("to"), (F.col("rank") + 1) * block) - begin
    pieces = at.join(plan, ["k", "rank"]).select("slot", "k", "rank", "doc_id", "content", "size", "start", "epoch", (begin - F.col("from")).alias("words"), length.alias("length"))
    return placed, pieces


def taken(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """Documents with the words that the pieces take of each, repeats counted, the number of pieces and the first slot."""
    sums = pieces.where("length > 0").groupBy("k", "start", "doc_id").agg(F.sum("length").alias("taken"), F.count("*").alias("pieces"), F.min("slot").alias("first_slot")).select("k", "start", F.col("doc_id").alias("piece_id"), "taken", "pieces", "first_slot")
    p = placed.alias("p")
    out = p.join(sums.alias("s"), (F.col("p.k") == F.col("s.k")) & (F.col("p.start") == F.col("s.start")) & F.col("p.doc_id").eqNullSafe(F.col("s.piece_id")) & (F.col("p.size") > 0), "left")
    return out.select("p.doc_id", "p.size", "p.source_size", "p.target", *(F.coalesce(f"s.{c}", F.lit(0)).cast("long").alias(c) for c in ("taken", "pieces")), "s.first_slot")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **plan) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, in the order of the schedule.

    A document is there once or twice, each time at the slot of its first block and whole; the one
    at a source's end is cut after its last word taken. A document of which nothing is taken (an
    empty one too) is absent. Of rows that repeat id and text each has the copies of one place in
    the stream. The length column, where there is one, follows the text; other columns are kept.

    Partition i holds the slots i * S / n to (i + 1) * S / n in their order. Van der Corput slots
    spread each source evenly over these ranges, so partitions have like sizes and like mixtures.
    """
    spark = docs.sparkSession
    _, pieces = mix(docs, id_col=id_col, text_col=text_col, **plan)
    copies = pieces.groupBy("k", "start", "doc_id", "content", "size", "epoch").agg(F.sum("length").alias("words"), F.min("slot").alias("slot")).where("words > 0")
    places = copies.groupBy("k", "start", "doc_id", "content", "size").agg(F.sort_array(F.collect_list(F.struct("slot", "start", "words"))).alias("copies"), F.sum("words").alias("total"), F.max("slot").alias("top"))
    takes = places.groupBy("doc_id", "content", "size").agg(F.sort_array(F.collect_list(F.struct("k", "start", "copies"))).alias("places"), F.sum("total").alias("total"), F.max("top").alias("top"))
    takes = materialize(takes, "takes")
    got = takes.agg(F.sum("total").alias("total"), F.max("top").alias("top")).first()
    total, top = got["total"] or 0, got["top"] or 0
    n = max(1, -(-total // MOST), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // LEAST)))

    kinds = dict(docs.dtypes)
    own = [f"own_{i}" for i in range(len(docs.columns))]  # so that no name of the table's clashes
    of = dict(zip(docs.columns, own, strict=True))
    same = lambda i: (F.coalesce(i, F.lit(0).cast(kinds[id_col])).alias("i"), i.isNull().alias("no_id"))  # noqa: E731
    rows = docs.select(*(F.col(c).alias(x) for c, x in of.items()))
    rows = rows.select("*", *same(F.col(of[id_col])), F.xxhash64(text_of(of[text_col])).alias("content"))
    rows = rows.join(takes.select(*same(F.col("doc_id")), "content", "size", "places"), ["i", "no_id", "content"])
    number = F.row_number().over(Window.partitionBy("i", "no_id", "content").orderBy("size"))
    rows = rows.withColumn("number", number).where(F.col("number") <= F.size("places"))
    rows = rows.withColumn("copy", F.explode(F.element_at("places", F.col("number")).getField("copies"))).select(*own, "size", "copy.slot", "copy.start", "copy.words")
    cut = F.array_join(F.slice(F.regexp_extract_all(of[text_col], F.lit(WORD), F.lit(0)), F.lit(1), F.col("words").cast("int")), " ")
    rows = rows.withColumn(of[text_col], F.when(F.col("words") < F.col("size"), cut).otherwise(F.col(of[text_col])))
    if length_col in kinds:
        rows = rows.withColumn(of[length_col], F.length(of[text_col]).cast(kinds[length_col]))
    part = (F.col("slot").cast("double") * n / (top + 1)).cast("int")
    rows = rows.repartitionById(n, F.least(part, F.lit(n - 1))).sortWithinPartitions("slot", "start")
    return rows.select(*(F.col(x).alias(c) for c, x in of.items()))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(*mix(spark.read.parquet(f"{sf_dir}/documents.parquet")))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k, coalesce(len(regexp_extract_all(text, '[^ 	-]+')), 0) AS size,
    substr(md5('8/' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS u FROM documents),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY k ORDER BY u, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
w AS (
  SELECT k, sum(size)::BIGINT AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY any_value(source) NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w,
    2.0::DOUBLE * sum(size) AS cap, (sum(sum(size)) OVER ())::DOUBLE AS total FROM d GROUP BY k),
l AS (
  SELECT *, (1.5::DOUBLE * total - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT k, source_size, greatest(least(cap, (SELECT max(level) FROM l) * w), 0) AS target FROM l),
q AS (SELECT *, round(target)::BIGINT AS take, ceil(round(target) / 256)::BIGINT AS blocks FROM t),
e AS (SELECT k, blocks, sum(blocks) OVER (ORDER BY k) AS hi FROM q),
b AS (SELECT length(bin(greatest(1, sum(blocks))::BIGINT - 1)) AS bits FROM q),
s AS (SELECT point, ('0b' || reverse(lpad(bin(point), bits::INTEGER, '0')))::BIGINT AS slot FROM b, range((1::BIGINT << bits)::BIGINT) r(point)),
plan AS (SELECT k, slot, row_number() OVER (PARTITION BY k ORDER BY slot) - 1 AS rank FROM s JOIN e ON point >= hi - blocks AND point < hi),
a AS (
  SELECT p.k, doc_id, start, start + epoch * source_size AS f, least(start + epoch * source_size + size, take) AS t
  FROM p JOIN q USING (k), range(2) r(epoch) WHERE size > 0 AND start + epoch * source_size < take),
c AS (SELECT *, unnest(range(f // 256, (t - 1) // 256 + 1)) AS rank FROM a),
g AS (
  SELECT doc_id, sum(least(t, (rank + 1) * 256) - greatest(f, rank * 256))::BIGINT AS taken, count(*) AS pieces, min(slot) AS first_slot
  FROM c JOIN plan USING (k, rank) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, coalesce(pieces, 0) AS pieces, first_slot FROM p JOIN q USING (k) LEFT JOIN g USING (doc_id)
"""
