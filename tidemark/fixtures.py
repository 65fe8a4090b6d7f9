"""Inputs of the backfill queries, derived from the driver's tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

DAY = DateType()
CUT_EVENTS = "2024-01-20 23:59:59"
CUT_ORDERS = "1998-12-31 23:59:59"
CUT_ITEMS = "1998-06-30 23:59:59"
NOW = "2024-01-03 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder, gone when the driver ends, where all executors can write; of this machine only if the session runs here alone."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.gettempdir()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return path.toString()


def weekly_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """As ``events``, by week."""
    source, target = events(spark, sf_dir)
    return tuple(t.drop("event_date").withColumn("event_week", F.trunc("ts", "week")) for t in (source, target))


def _at_most(column: str, cut: str):
    return F.col(column) <= F.lit(cut).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source and target of the event history; a third of the history is in the target already."""
    source = table(spark, sf_dir, "events").withColumn("event_date", F.col("ts").cast("date"))
    return source, source.where(~_at_most("ts", CUT_EVENTS) | (F.col("event_id") % 3 == 0))


def text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a text checkpoint, some of it malformed or null."""
    text = F.when(F.col("event_id") % 97 == 0, "not-a-date").when(F.col("event_id") % 89 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return table(spark, sf_dir, "events").withColumn("ts_str", text)


def orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source and target of orders by month."""
    source = table(spark, sf_dir, "orders").withColumn("o_month", F.trunc("o_orderdate", "MM"))
    return source, source.where(~_at_most("o_orderdate", CUT_ORDERS) | (F.col("o_orderkey") % 3 == 0))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose partition date isn't aligned with the checkpoint, and is null for some."""
    day = F.when(F.col("l_orderkey") % 50 != 0, F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber")))
    return table(spark, sf_dir, "lineitem").withColumn("l_receipt", day)


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows from suppliers."""
    k = F.col("s_suppkey")
    status = F.element_at(F.array(*map(F.lit, ("PENDING", "IN_PROGRESS", "DELETED", "BACKFILLED", "SUCCESS", "FAILED", "SKIPPED"))), (k % 7 + 1).cast("int"))
    none = F.lit(None)
    return table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("business_unit"), F.col("s_name").alias("table_name"), F.concat(F.lit("r"), (k % 2).cast("string")).alias("run_id"), F.lit("b0").alias("batch_id"),
        F.lit("2024-01-01 00:00:00").alias("cut_off_date"), F.lit("ts").alias("checkpoint_col"), F.concat(F.lit("src."), "s_name").alias("source_fqn"), F.concat(F.lit("tgt."), "s_name").alias("target_fqn"),
        F.when(k % 6 != 0, F.concat(F.lit("p"), k.cast("string"))).alias("pipeline_name"), F.when(k % 6 != 0, F.concat(F.lit("i"), k.cast("string"))).alias("pipeline_id"),
        status.alias("status"), F.when(k % 4 != 0, (k % 3).cast("int")).alias("attempt"),
        F.when(k % 5 == 0, "run_A").when(k % 5 == 1, "run_B").alias("owner_run_id"),
        F.when(k % 5 == 0, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), k)).alias("lease_until"),
        F.when(status == "SKIPPED", "no access").alias("error_message"), none.cast("timestamp_ntz").alias("start_ts"), none.cast("timestamp_ntz").alias("end_ts"), none.cast("timestamp_ntz").alias("updated_ts"),
    )


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a later run registers: every other known table, and new ones."""
    k = F.col("s_suppkey")
    base = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    known = base.where(k % 2 == 0).select(k, F.col("n_name"), F.col("s_name"))
    new = base.where(k % 10 == 3).select(k, F.col("n_name"), F.concat(F.lit("new "), "s_name").alias("s_name"))
    return known.unionByName(new).select(
        F.col("n_name").alias("business_unit"), F.col("s_name").alias("table_name"), F.lit("r9").alias("run_id"), F.lit("b9").alias("batch_id"), F.lit("2024-02-01 00:00:00").alias("cut_off_date"),
        F.lit("ts2").alias("checkpoint_col"), F.concat(F.lit("src9."), "s_name").alias("source_fqn"), F.concat(F.lit("tgt9."), "s_name").alias("target_fqn"),
        F.when(k % 4 == 0, F.concat(F.lit("q"), k.cast("string"))).alias("pipeline_name"), F.when(k % 4 == 0, F.concat(F.lit("j"), k.cast("string"))).alias("pipeline_id"),
    )


def checks(spark: SparkSession) -> DataFrame:
    """Pre-flight inputs for every branch."""
    rows = [
        ("fine", True, True, "timestamp", "date", None), ("fine_text", True, True, "string", "timestamp_ntz", None), ("no_source", False, True, None, "date", None),
        ("no_target", True, False, "date", None, None), ("neither", False, False, None, None, None), ("no_source_column", True, True, None, "date", None),
        ("no_target_column", True, True, "date", None, None), ("odd_source", True, True, "bigint", "date", None), ("odd_target", True, True, "date", "double", None),
        ("bad_config", True, True, "date", "date", "backfill_days must be a positive integer"), ("bad_config_no_source", False, True, None, None, "backfill_days must be a positive integer"),
    ]
    return spark.createDataFrame(rows, "table_name string, source_exists boolean, target_exists boolean, source_type string, target_type string, config_error string")
