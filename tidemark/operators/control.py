"""Operators on the control table: each returns the whole table as it is afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.predicates import claimable
from tidemark.plans.specs import Status

KEYS = ("business_unit", "table_name")
#: The control table's columns (fixed by existing control tables).
SCHEMA = (
    StructType()
    .add("business_unit", "string")
    .add("table_name", "string")
    .add("run_id", "string")
    .add("batch_id", "string")
    .add("cut_off_date", "string")
    .add("checkpoint_col", "string")
    .add("source_fqn", "string")
    .add("target_fqn", "string")
    .add("pipeline_name", "string")
    .add("pipeline_id", "string")
    .add("status", "string")
    .add("attempt", "integer")
    .add("share_count", "long")
    .add("deleted_count", "long")
    .add("inserted_count", "long")
    .add("target_le_cutoff_count", "long")
    .add("live_gt_cutoff_before", "long")
    .add("live_gt_cutoff_after", "long")
    .add("partition_pruned", "boolean")
    .add("delete_predicate", "string")
    .add("backfill_newest_partition", "string")
    .add("backfill_oldest_partition", "string")
    .add("owner_run_id", "string")
    .add("lease_until", "timestamp")
    .add("error_message", "string")
    .add("start_ts", "timestamp")
    .add("end_ts", "timestamp")
    .add("updated_ts", "timestamp")
)
COLUMNS = SCHEMA.names
#: The run table's columns (fixed likewise).
RUNS = StructType().add("run_id", "string").add("business_unit", "string").add("status", "string").add("started_by", "string").add("start_ts", "timestamp").add("end_ts", "timestamp")
RENAMED = {"last_backfilled_partition": "backfill_oldest_partition"}  #: an older name of the watermark
REGISTERED = ("run_id", "batch_id", "cut_off_date", "checkpoint_col", "source_fqn", "target_fqn")


def update(control: DataFrame, where: Column, values: dict[str, Column], now: Column) -> DataFrame:
    """Set columns of the rows where the condition holds (null counts as false), and when."""
    hit = F.coalesce(where, F.lit(False))
    new = dict(values) | {"updated_ts": now}
    kinds = {f.name: f.dataType for f in control.schema.fields}
    return control.select(*(F.when(hit, new[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in control.columns))


def key_is(business_unit: str, table_name: str) -> Column:
    return (F.col("business_unit") == business_unit) & (F.col("table_name") == table_name)


def register(control: DataFrame, specs: DataFrame, now: Column) -> DataFrame:
    """Upsert: refresh rows that aren't SUCCESS, give pipeline fields to SUCCESS rows without, add new rows as PENDING.

    ``specs`` has KEYS, REGISTERED, pipeline_name and pipeline_id, one row a key. A pipeline that
    isn't known now doesn't wipe one that was.
    """
    t, s = control.alias("t"), specs.withColumn("__new", F.lit(True)).alias("s")
    old, new = (lambda c: F.col(f"t.{c}")), (lambda c: F.col(f"s.{c}"))
    joined = t.join(s, [old(k) == new(k) for k in KEYS], "full_outer")
    there, given = old("table_name").isNotNull(), F.coalesce(F.col("s.__new"), F.lit(False))
    refresh = there & given & F.coalesce(old("status") != Status.SUCCESS, F.lit(False))
    fill = there & given & ~refresh & old("pipeline_name").isNull() & new("pipeline_name").isNotNull()
    add = ~there & given
    kinds = {f.name: f.dataType for f in control.schema.fields}

    def column(c: str) -> Column:
        if c in KEYS:
            out = F.coalesce(old(c), new(c))
        elif c in REGISTERED:
            out = F.when(refresh | add, new(c)).otherwise(old(c))
        elif c in ("pipeline_name", "pipeline_id"):
            out = F.when(refresh, F.coalesce(new(c), old(c))).when(fill | add, new(c)).otherwise(old(c))
        elif c == "status":
            out = F.when(add, F.lit(Status.PENDING)).otherwise(old(c))
        elif c == "attempt":
            out = F.when(add, F.lit(0)).otherwise(old(c))
        elif c == "updated_ts":
            out = F.when(refresh | fill | add, now).otherwise(old(c))
        else:
            out = old(c)
        return out.cast(kinds[c]).alias(c)

    return joined.select(*map(column, control.columns))


def claim(control: DataFrame, key: Column, run: str, now: Column, minutes: int) -> DataFrame:
    return update(control, key & claimable(run, now), {"owner_run_id": F.lit(run), "lease_until": now + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))}, now)


def renew(control: DataFrame, key: Column, run: str, now: Column, minutes: int) -> DataFrame:
    return update(control, key & (F.col("owner_run_id") == run), {"lease_until": now + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))}, now)


def release(control: DataFrame, key: Column, run: str, now: Column) -> DataFrame:
    return update(control, key & (F.col("owner_run_id") == run), {"owner_run_id": F.lit(None), "lease_until": F.lit(None)}, now)


def mark_start(control: DataFrame, key: Column, now: Column) -> DataFrame:
    return update(control, key, {"status": F.lit(Status.IN_PROGRESS), "attempt": F.coalesce(F.col("attempt"), F.lit(0)) + 1, "start_ts": now, "error_message": F.lit(None)}, now)


def mark_end(control: DataFrame, key: Column, now: Column) -> DataFrame:
    return update(control, key, {"end_ts": now}, now)


def skip(control: DataFrame, key: Column, reason: str | Column, now: Column) -> DataFrame:
    """SKIPPED with a reason, unless the row is SUCCESS."""
    why = F.lit(reason) if isinstance(reason, str) else reason
    return update(control, key & (F.col("status") != Status.SUCCESS), {"status": F.lit(Status.SKIPPED), "error_message": why}, now)


def skip_listed(control: DataFrame, reasons: DataFrame, business_unit: str, now: Column) -> DataFrame:
    """``skip`` for the tables in ``reasons`` (table_name, skip_reason), one row a table."""
    marked = control.join(reasons, "table_name", "left")
    listed = (F.col("business_unit") == business_unit) & F.col("skip_reason").isNotNull()
    return skip(marked, listed, F.col("skip_reason"), now).select(*control.columns)


def end_run(runs: DataFrame, run: str, status: str, now: Column) -> DataFrame:
    """The run table with a run's status and end."""
    mine = F.col("run_id") == run
    return runs.withColumn("status", F.when(mine, F.lit(status)).otherwise(F.col("status"))).withColumn("end_ts", F.when(mine, now).otherwise(F.col("end_ts")))


def clear_skips(control: DataFrame, names: DataFrame, business_unit: str | None, now: Column) -> DataFrame:
    """SKIPPED rows of the named tables (a column table_name) become PENDING."""
    marked = control.join(names.select("table_name").distinct().withColumn("__named", F.lit(True)), "table_name", "left")
    where = F.col("__named") & (F.col("status") == Status.SKIPPED)
    if business_unit is not None:
        where &= F.col("business_unit") == business_unit
    return update(marked, where, {"status": F.lit(Status.PENDING), "error_message": F.lit(None)}, now).select(*control.columns)


def work_list(specs: DataFrame, control: DataFrame) -> DataFrame:
    """Specs whose control row isn't SUCCESS or SKIPPED."""
    return specs.join(control.where(F.col("status").isin(*Status.DONE)).select(*KEYS), list(KEYS), "left_anti")


def status_summary(control: DataFrame, run: str | None = None) -> DataFrame:
    rows = control if run is None else control.where(F.col("run_id") == run)
    return rows.groupBy("status").agg(F.count("*").alias("tables"))


def headline(control: DataFrame) -> DataFrame:
    """One row: tables, those that need attention, and k=v parts sorted by status."""
    per = status_summary(control)
    bad = F.coalesce(F.sum(F.when(F.col("status").isin(Status.FAILED, Status.SKIPPED), F.col("tables"))), F.lit(0))
    parts = F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.col("status"), F.col("tables").cast("string")))), ", ")
    return per.agg(F.coalesce(F.sum("tables"), F.lit(0)).alias("total"), bad.alias("attention"), parts.alias("parts"))


def run_gate(control: DataFrame, run: str) -> DataFrame:
    """One row: whether a run ends well, that is without FAILED or SKIPPED tables."""
    return control.where(F.col("run_id") == run).agg((F.count_if(F.col("status").isin(Status.FAILED, Status.SKIPPED)) == 0).alias("ok"))


def resolved(specs: DataFrame) -> DataFrame:
    """One row: how many of the specs have a pipeline's id, of how many."""
    return specs.agg(F.count_if(F.col("pipeline_id").isNotNull()).alias("resolved"), F.count("*").alias("tables"))


def report_detail(control: DataFrame, run: str) -> DataFrame:
    shown = ("status", "table_name", "business_unit", "attempt", "owner_run_id", "error_message")
    return control.where(F.col("run_id") == run).select(*shown).orderBy("status", "table_name")


def evolve(control: DataFrame, schema: StructType = SCHEMA) -> DataFrame:
    """A table of an older version with today's columns: renamed where it was renamed, else added as null; others go last."""
    for old, new in RENAMED.items():
        if old in control.columns and new not in control.columns:
            control = control.withColumnRenamed(old, new)
    known = [F.col(f.name).cast(f.dataType) if f.name in control.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return control.select(*known, *(c for c in control.columns if c not in schema.names))


def verdicts(checks: DataFrame) -> DataFrame:
    """The first failed pre-flight check of each table, a configuration error before all.

    ``checks``: table_name, source_exists, target_exists, source_type, target_type (null if the
    checkpoint column is missing), config_error.
    """
    accepted = ("date", "string", "timestamp", "timestamp_ntz")
    reason = (
        F.when(F.col("config_error").isNotNull(), F.col("config_error"))
        .when(~F.col("source_exists"), F.lit("source not readable"))
        .when(~F.col("target_exists"), F.lit("target not readable"))
        .when(F.col("source_type").isNull(), F.lit("checkpoint missing on source"))
        .when(F.col("target_type").isNull(), F.lit("checkpoint missing on target"))
        .when(~F.col("source_type").isin(*accepted) | ~F.col("target_type").isin(*accepted), F.lit("checkpoint type not comparable"))
        .otherwise(F.lit("ok"))
    )
    return checks.select("table_name", (reason == "ok").alias("ok"), reason.alias("reason"))


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
