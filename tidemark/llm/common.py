"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: DuckDB SQL: a macro-like common table of the CRC-32 steps, and the CRC of the bytes of an expression.
CRC_STEPS = """crc_steps(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS steps FROM crc_steps WHERE k = 8)"""
CRC_OF = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda x: ('0x' || x)::BIGINT)), lambda a, x: xor(a >> 8, steps[(xor(a, x) & 255) + 1])), 4294967295)"""


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a folder of this machine only where the session names none and runs here alone."""
    got = spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        got = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    The files are deleted by ``discard`` or ``clear``, and at the latest when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    df.write.parquet(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(file)
    back = spark.read.schema(df.schema).parquet(path)
    back._tidemark_path = path
    return back


def clear(spark: SparkSession) -> None:
    """Delete everything that ``materialize`` has left in the session's shared folder, once its results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that nothing will read again."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._tidemark_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def join_classes(rows: DataFrame, classes: DataFrame, keys: list[str], size: str, total: int, spread: Column | None = None) -> DataFrame:
    """Left join of ``rows`` (with an ``id``) with their classes, one a key, when a class may hold a third of all rows.

    Classes of more than total / 100,000 rows (and more than 4096), of which there are fewer than
    100,000, are broadcast; their rows, and those that ``spread`` marks as without a class, go to
    partitions of their own ids for the other join.
    """
    others = [c for c in classes.columns if c not in keys]
    limit = max(4096, total // 100_000)
    large = F.broadcast(classes.where(F.col(size) > limit).select(*keys, *(F.col(c).alias(f"large_{c}") for c in others)))
    alone = F.col(f"large_{size}").isNotNull() | (F.lit(False) if spread is None else spread)
    rows = rows.join(large, keys, "left").withColumn("deal", F.when(alone, F.xxhash64("id", F.spark_partition_id())).otherwise(F.lit(0)))
    small = classes.where(F.col(size) <= limit).withColumn("deal", F.lit(0).cast("long"))
    out = rows.join(small, [*keys, "deal"], "left")
    return out.select(*keys, *(c for c in rows.columns if c not in keys and c != "deal" and not c.startswith("large_")), *(F.coalesce(f"large_{c}", c).alias(c) for c in others))


def _bytes(setting: str) -> int:
    """A number that may have one of Spark's size suffixes."""
    found = re.fullmatch(r"(-?\d+)([kmgt]?)b?", setting.lower())
    return int(found[1]) << 10 * " kmgt".index(found[2] or " ") if found else 0


def lean(df: DataFrame) -> DataFrame:
    """``df``, in whose session Arrow batches are small: a task that passes whole texts through Python then holds a few MB of them."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000), ("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)):
        now = _bytes(conf.get(key))
        if not 0 < now <= most:
            conf.set(key, str(most))
    return df


def text_of(column: str | Column) -> Column:
    """A text with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def source_key(column: str) -> Column:
    """A never-null key for a source, so that joins and windows on it share one partitioning."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column)), F.lit("n"))


def hash_buckets(u: Column, n: int) -> Column:
    """Bucket 0..n-1 by the leading bits of a 63-bit hash; order of buckets is order of hashes."""
    return F.shiftright(F.shiftrightunsigned(u, 16) * F.lit(n), 47)


def order_hash(seed: int, *columns: str) -> Column:
    """A seeded hash in [0, 2**63) for shuffled orders: the first 15 hexadecimal digits of an MD5, 60 bits, above 3 zeros."""
    text = F.concat_ws("/", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    return F.shiftleft(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), 3)


def bucket_count(rows: int, per_bucket: int = 256, most: int = 65536) -> int:
    """Enough buckets that one holds a small share of a hot source, few enough for a table of offsets."""
    return max(1, min(most, rows // per_bucket))


def prefix_sums(df: DataFrame, parts: list[str], bucket: str, order: list[str], weight: str, out: str, total: str) -> DataFrame:
    """Exclusive running sums of ``weight`` within ``parts`` in the order (bucket, order).

    Two levels, so that no task holds a whole part: sums of buckets (pre-aggregated, at most
    65,536 a part) give each bucket's start, a window inside one bucket gives the rest.
    Columns ``parts`` and ``bucket`` must not be null.
    """
    within = Window.partitionBy(*parts).orderBy(bucket)
    sums = df.groupBy(*parts, bucket).agg(F.sum(weight).alias("__sum"))
    starts = sums.select(
        *parts, bucket,
        F.coalesce(F.sum("__sum").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"),
        F.sum("__sum").over(Window.partitionBy(*parts)).alias(total),
    )
    inner = Window.partitionBy(*parts, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, [*parts, bucket])
        .withColumn(out, F.col("__start") + F.coalesce(F.sum(weight).over(inner), F.lit(0)))
        .drop("__start")
    )
