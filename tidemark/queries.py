"""Queries of the backfill engine with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tidemark import fixtures as X
from tidemark.functions import predicates as P
from tidemark.operators import backfill as B
from tidemark.operators import control as K
from tidemark.registry import ORACLE, QUERIES, query  # noqa: F401

DAY = DateType()
_EVENT = f"TIMESTAMP '{X.CUT_EVENTS}'"
_ORDER = f"TIMESTAMP '{X.CUT_ORDERS}'"
_ITEM = f"TIMESTAMP '{X.CUT_ITEMS}'"
_F1 = f"WITH s AS (SELECT *, CAST(ts AS DATE) AS event_date FROM events), t AS (SELECT * FROM s WHERE ts > {_EVENT} OR event_id % 3 = 0) "
_F2 = "WITH e AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'not-a-date' WHEN event_id % 89 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_str FROM events) "
_F3 = f"WITH s AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS o_month FROM orders), t AS (SELECT * FROM s WHERE o_orderdate > {_ORDER} OR o_orderkey % 3 = 0) "
_F4 = "WITH l AS (SELECT *, CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER) END AS l_receipt FROM lineitem) "
_F5 = """WITH c AS (SELECT n_name AS business_unit, s_name AS table_name, 'r' || (s_suppkey % 2) AS run_id, 'b0' AS batch_id, '2024-01-01 00:00:00' AS cut_off_date, 'ts' AS checkpoint_col,
 'src.' || s_name AS source_fqn, 'tgt.' || s_name AS target_fqn, CASE WHEN s_suppkey % 6 <> 0 THEN 'p' || s_suppkey END AS pipeline_name, CASE WHEN s_suppkey % 6 <> 0 THEN 'i' || s_suppkey END AS pipeline_id,
 ['PENDING', 'IN_PROGRESS', 'DELETED', 'BACKFILLED', 'SUCCESS', 'FAILED', 'SKIPPED'][s_suppkey % 7 + 1] AS status, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey % 3 AS INTEGER) END AS attempt,
 CASE WHEN s_suppkey % 5 = 0 THEN 'run_A' WHEN s_suppkey % 5 = 1 THEN 'run_B' END AS owner_run_id,
 CASE WHEN s_suppkey % 5 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(s_suppkey AS INTEGER)) END AS lease_until,
 CASE WHEN s_suppkey % 7 = 6 THEN 'no access' END AS error_message FROM supplier JOIN nation ON s_nationkey = n_nationkey) """
_NOW = f"TIMESTAMP '{X.NOW}'"
_FREE = f"(status NOT IN ('SUCCESS', 'SKIPPED') AND (owner_run_id IS NULL OR owner_run_id = 'run_C' OR lease_until IS NULL OR lease_until < {_NOW}))"
_SPECS = """, n AS (SELECT s_suppkey AS k, n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 0
 UNION ALL SELECT s_suppkey, n_name, 'new ' || s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 10 = 3),
 x AS (SELECT n_name AS business_unit, s_name AS table_name, CASE WHEN k % 4 = 0 THEN 'q' || k END AS pipeline_name, CASE WHEN k % 4 = 0 THEN 'j' || k END AS pipeline_id FROM n) """


def _events(spark: SparkSession, sf_dir: str, days: int | None = None) -> tuple[DataFrame, DataFrame, B.Cut]:
    source, target = X.events(spark, sf_dir)
    return source, target, B.Cut.of(source, target, "ts", X.CUT_EVENTS, days)


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, B.Cut]:
    source, target = X.orders(spark, sf_dir)
    return source, target, B.Cut.of(source, target, "o_orderdate", X.CUT_ORDERS)


def _items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, B.Cut]:
    rows = X.items(spark, sf_dir)
    return rows, B.Cut.of(rows, rows, "l_shipdate", X.CUT_ITEMS)


def _now() -> Column:
    return F.lit(X.NOW).cast("timestamp_ntz")


@query(f"SELECT count(*) AS share_count FROM events WHERE ts <= {_EVENT}")
def share_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, _, cut = _events(spark, sf_dir)
    return B.source_count(source, cut)


@query(f"SELECT count(*) AS share_count FROM events WHERE ts <= {_EVENT} AND ts > {_EVENT} - INTERVAL 7 DAY")
def share_count_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, _, cut = _events(spark, sf_dir, 7)
    return B.source_count(source, cut)


@query(_F1 + f"SELECT count(*) FILTER (WHERE ts <= {_EVENT}) AS target_le_cutoff, count(*) FILTER (WHERE ts > {_EVENT}) AS live_gt_cutoff, count(*) FILTER (WHERE ts IS NULL) AS no_checkpoint FROM t")
def target_live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target, cut = _events(spark, sf_dir)
    return B.target_counts(target, cut)


@query(_F1 + f"SELECT event_id, ts, event_date FROM t WHERE NOT coalesce(ts <= {_EVENT}, false)")
def containment_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target, cut = _events(spark, sf_dir)
    return B.survivors(target, cut.history()).select("event_id", "ts", "event_date")


@query(_F2 + f"SELECT event_id, ts_str FROM e WHERE NOT coalesce(try_cast(ts_str AS TIMESTAMP) <= {_EVENT}, false)")
def containment_survivors_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.text_events(spark, sf_dir)
    return B.survivors(rows, B.Cut.of(rows, rows, "ts_str", X.CUT_EVENTS).history()).select("event_id", "ts_str")


@query(_F1 + f"SELECT count(*) AS deleted_count FROM t WHERE ts <= {_EVENT}")
def deleted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target, cut = _events(spark, sf_dir)
    return target.where(cut.history()).agg(F.count("*").alias("deleted_count"))


@query(_F1 + f"SELECT event_id, ts, user_id, event_type, value, props, event_date FROM s WHERE ts <= {_EVENT}")
def backfill_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target, cut = _events(spark, sf_dir)
    return B.backfill(source, target, cut.history())


_MIGRATED = "SELECT event_id, ts, user_id, event_type, value, event_date FROM t WHERE NOT coalesce(ts <= {0}, false) UNION ALL SELECT event_id, ts, user_id, event_type, value, event_date FROM s WHERE ts <= {0}"


@query(_F1 + _MIGRATED.format(_EVENT))
def migrated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.migrated(*_events(spark, sf_dir)).drop("props")


@query(_F1 + _MIGRATED.format(_EVENT) + f" AND ts > {_EVENT} - INTERVAL 7 DAY")
def migrated_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.migrated(*_events(spark, sf_dir, 7)).drop("props")


@query(_F1 + f"""SELECT (SELECT count(*) FROM s WHERE ts <= {_EVENT}) AS share_count, (SELECT count(*) FROM t WHERE ts > {_EVENT}) AS live_before,
 (SELECT count(*) FROM s WHERE ts <= {_EVENT}) AS target_le_cutoff, (SELECT count(*) FROM t WHERE ts > {_EVENT}) AS live_after, true AS ok""")
def verify_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target, cut = _events(spark, sf_dir)
    return B.parity(source, target, B.migrated(source, target, cut), cut)


@query(_F2 + f"SELECT count(*) FILTER (WHERE try_cast(ts_str AS TIMESTAMP) <= {_EVENT}) AS target_le_cutoff, count(*) FILTER (WHERE try_cast(ts_str AS TIMESTAMP) > {_EVENT}) AS live_gt_cutoff, count(*) FILTER (WHERE try_cast(ts_str AS TIMESTAMP) IS NULL) AS no_checkpoint FROM e")
def string_checkpoint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.text_events(spark, sf_dir)
    return B.target_counts(rows, B.Cut.of(rows, rows, "ts_str", X.CUT_EVENTS))


@query(_F1 + f"SELECT DISTINCT event_date AS value FROM (SELECT event_date FROM s UNION ALL SELECT event_date FROM t) WHERE event_date <= CAST({_EVENT} AS DATE) ORDER BY value DESC")
def partition_values_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target, cut = _events(spark, sf_dir)
    return B.partitions(source, target, "event_date", DAY, cut)


@query(_F3 + f"SELECT DISTINCT o_month AS value FROM (SELECT o_month FROM s UNION ALL SELECT o_month FROM t) WHERE o_month <= CAST({_ORDER} AS DATE) AND o_month < DATE '1997-06-01'")
def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target, cut = _orders(spark, sf_dir)
    return B.left_to_do(B.partitions(source, target, "o_month", DAY, cut), F.lit("1997-06-01").cast("date"))


@query(_F1 + f"SELECT event_id, ts, event_date FROM s WHERE event_date = DATE '2024-01-20' AND ts <= {_EVENT}")
def chunk_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target, cut = _events(spark, sf_dir)
    return B.backfill(source, target, B.slice_of("event_date", DAY, "2024-01-20", cut, windowed=True)).select("event_id", "ts", "event_date")


@query("SELECT CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right")
def chunked_equals_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slice replaced after the other, newest first as in the executor, against the single shot."""
    source, target, cut = _orders(spark, sf_dir)
    values = B.partitions(source, target, "o_month", DAY, cut).select(F.col("value").cast("string"))
    chunked = target
    for value in [r[0] for r in values.collect()]:  # one a partition
        chunked = B.replace_slice(source, chunked, "o_month", DAY, value, cut)
    return B.differences(chunked, B.migrated(source, target, cut))


@query(_F3 + f"SELECT count(*) AS misaligned FROM s WHERE o_orderdate <= {_ORDER} AND (o_month IS NULL OR o_month > CAST({_ORDER} AS DATE))")
def misalignment_count_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, _, cut = _orders(spark, sf_dir)
    return B.misalignment(source, "o_month", DAY, cut)


@query(_F4 + f"SELECT count(*) AS misaligned FROM l WHERE l_shipdate <= {_ITEM} AND (l_receipt IS NULL OR l_receipt > CAST({_ITEM} AS DATE))")
def misalignment_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cut = _items(spark, sf_dir)
    return B.misalignment(rows, "l_receipt", DAY, cut)


@query(_F4 + f"SELECT count(*) FILTER (WHERE l_receipt <= CAST({_ITEM} AS DATE) AND l_shipdate <= {_ITEM}) AS pruned, count(*) FILTER (WHERE l_shipdate <= {_ITEM}) AS whole FROM l")
def pruned_delete_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cut = _items(spark, sf_dir)
    return rows.agg(F.count_if(B.pruned_delete("l_receipt", DAY, cut)).alias("pruned"), F.count_if(cut.history()).alias("whole"))


@query(_F5 + _SPECS + """SELECT coalesce(c.business_unit, x.business_unit) AS business_unit, coalesce(c.table_name, x.table_name) AS table_name,
 CASE WHEN x.table_name IS NOT NULL AND (c.table_name IS NULL OR c.status <> 'SUCCESS') THEN 'r9' ELSE c.run_id END AS run_id,
 CASE WHEN x.table_name IS NOT NULL AND (c.table_name IS NULL OR c.status <> 'SUCCESS') THEN 'ts2' ELSE c.checkpoint_col END AS checkpoint_col,
 CASE WHEN x.table_name IS NOT NULL AND (c.table_name IS NULL OR c.status <> 'SUCCESS') THEN 'b9' ELSE c.batch_id END AS batch_id,
 CASE WHEN x.table_name IS NOT NULL AND (c.table_name IS NULL OR c.status <> 'SUCCESS') THEN '2024-02-01 00:00:00' ELSE c.cut_off_date END AS cut_off_date,
 CASE WHEN x.table_name IS NOT NULL AND (c.table_name IS NULL OR c.status <> 'SUCCESS') THEN 'src9.' || x.table_name ELSE c.source_fqn END AS source_fqn,
 CASE WHEN x.table_name IS NOT NULL AND (c.table_name IS NULL OR c.status <> 'SUCCESS') THEN 'tgt9.' || x.table_name ELSE c.target_fqn END AS target_fqn,
 CASE WHEN x.table_name IS NULL THEN c.pipeline_id WHEN c.table_name IS NULL THEN x.pipeline_id WHEN c.status <> 'SUCCESS' THEN coalesce(x.pipeline_id, c.pipeline_id)
  WHEN c.pipeline_name IS NULL AND x.pipeline_name IS NOT NULL THEN x.pipeline_id ELSE c.pipeline_id END AS pipeline_id,
 CASE WHEN x.table_name IS NULL THEN c.pipeline_name WHEN c.table_name IS NULL THEN x.pipeline_name WHEN c.status <> 'SUCCESS' THEN coalesce(x.pipeline_name, c.pipeline_name) ELSE coalesce(c.pipeline_name, x.pipeline_name) END AS pipeline_name,
 CASE WHEN c.table_name IS NULL THEN 'PENDING' ELSE c.status END AS status, CASE WHEN c.table_name IS NULL THEN 0 ELSE c.attempt END AS attempt,
 x.table_name IS NOT NULL AND (c.table_name IS NULL OR c.status <> 'SUCCESS' OR (c.pipeline_name IS NULL AND x.pipeline_name IS NOT NULL)) AS touched
 FROM c FULL JOIN x ON c.business_unit = x.business_unit AND c.table_name = x.table_name""")
def register_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = K.register(X.control(spark, sf_dir), X.specs(spark, sf_dir), _now())
    return out.select("business_unit", "table_name", "run_id", "checkpoint_col", "batch_id", "cut_off_date", "source_fqn", "target_fqn", "pipeline_id", "pipeline_name", "status", "attempt", F.col("updated_ts").isNotNull().alias("touched"))


@query(_F5 + "SELECT status, count(*) AS tables FROM c WHERE run_id = 'r0' GROUP BY status")
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.status_summary(X.control(spark, sf_dir), "r0")


@query(_F5 + ", g AS (SELECT status, count(*) AS n FROM c GROUP BY status) SELECT CAST(sum(n) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (WHERE status IN ('FAILED', 'SKIPPED')), 0) AS BIGINT) AS attention, string_agg(status || '=' || n, ', ' ORDER BY status) AS parts FROM g")
def summary_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.headline(X.control(spark, sf_dir))


@query(_F5 + f"SELECT table_name, CASE WHEN {_FREE} THEN 'run_C' ELSE owner_run_id END AS owner_run_id, CASE WHEN {_FREE} THEN {_NOW} + INTERVAL 120 MINUTE ELSE lease_until END AS lease_until FROM c")
def claim_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.claim(X.control(spark, sf_dir), F.lit(True), "run_C", _now(), 120).select("table_name", "owner_run_id", "lease_until")


@query(_F5 + f"SELECT table_name, CASE WHEN owner_run_id = 'run_B' THEN NULL ELSE owner_run_id END AS owner_run_id, CASE WHEN owner_run_id = 'run_A' THEN {_NOW} + INTERVAL 120 MINUTE WHEN owner_run_id = 'run_B' THEN NULL ELSE lease_until END AS lease_until FROM c")
def renew_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    renewed = K.renew(X.control(spark, sf_dir), F.lit(True), "run_A", _now(), 120)
    return K.release(renewed, F.lit(True), "run_B", _now()).select("table_name", "owner_run_id", "lease_until")


@query(_F5 + f"SELECT table_name, CASE WHEN run_id = 'r1' THEN 'IN_PROGRESS' ELSE status END AS status, CASE WHEN run_id = 'r1' THEN coalesce(attempt, 0) + 1 ELSE attempt END AS attempt, CASE WHEN run_id = 'r1' THEN NULL ELSE error_message END AS error_message, CASE WHEN run_id = 'r1' THEN {_NOW} END AS start_ts, CASE WHEN run_id = 'r1' THEN {_NOW} END AS end_ts FROM c")
def mark_start_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("run_id") == "r1"
    return K.mark_end(K.mark_start(X.control(spark, sf_dir), key, _now()), key, _now()).select("table_name", "status", "attempt", "error_message", "start_ts", "end_ts")


@query(_F5 + "SELECT table_name, CASE WHEN run_id = 'r1' AND status <> 'SUCCESS' THEN 'SKIPPED' ELSE status END AS status, CASE WHEN run_id = 'r1' AND status <> 'SUCCESS' THEN 'not ready' ELSE error_message END AS error_message FROM c")
def skip_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.skip(X.control(spark, sf_dir), F.col("run_id") == "r1", "not ready", _now()).select("table_name", "status", "error_message")


@query(_F5 + _SPECS + "SELECT table_name, CASE WHEN status = 'SKIPPED' AND table_name IN (SELECT table_name FROM x) THEN 'PENDING' ELSE status END AS status, CASE WHEN status = 'SKIPPED' AND table_name IN (SELECT table_name FROM x) THEN NULL ELSE error_message END AS error_message FROM c")
def clear_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.clear_skips(X.control(spark, sf_dir), X.specs(spark, sf_dir), None, _now()).select("table_name", "status", "error_message")


@query(_F5 + _SPECS + "SELECT business_unit, table_name FROM x WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.business_unit = x.business_unit AND c.table_name = x.table_name AND c.status IN ('SUCCESS', 'SKIPPED'))")
def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.work_list(X.specs(spark, sf_dir), X.control(spark, sf_dir)).select("business_unit", "table_name")


_CHECKS = """WITH v(table_name, s, t, a, b, e) AS (VALUES ('fine', true, true, 'timestamp', 'date', NULL), ('fine_text', true, true, 'string', 'timestamp_ntz', NULL), ('no_source', false, true, NULL, 'date', NULL),
 ('no_target', true, false, 'date', NULL, NULL), ('neither', false, false, NULL, NULL, NULL), ('no_source_column', true, true, NULL, 'date', NULL), ('no_target_column', true, true, 'date', NULL, NULL),
 ('odd_source', true, true, 'bigint', 'date', NULL), ('odd_target', true, true, 'date', 'double', NULL), ('bad_config', true, true, 'date', 'date', 'backfill_days must be a positive integer'),
 ('bad_config_no_source', false, true, NULL, NULL, 'backfill_days must be a positive integer')),
 r AS (SELECT table_name, CASE WHEN e IS NOT NULL THEN e WHEN NOT s THEN 'source not readable' WHEN NOT t THEN 'target not readable' WHEN a IS NULL THEN 'checkpoint missing on source'
 WHEN b IS NULL THEN 'checkpoint missing on target' WHEN a NOT IN ('date', 'string', 'timestamp', 'timestamp_ntz') OR b NOT IN ('date', 'string', 'timestamp', 'timestamp_ntz') THEN 'checkpoint type not comparable' ELSE 'ok' END AS reason FROM v)
 SELECT table_name, reason = 'ok' AS ok, reason FROM r"""


@query(_CHECKS)
def validation_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.verdicts(X.checks(spark))


@query(_F5 + "SELECT status, table_name, business_unit, attempt, owner_run_id, error_message FROM c WHERE run_id = 'r0' ORDER BY status, table_name")
def report_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.report_detail(X.control(spark, sf_dir), "r0")


@query(_F5 + "SELECT count(*) FILTER (WHERE status IN ('FAILED', 'SKIPPED')) = 0 AS ok FROM c WHERE run_id = 'r0'")
def run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.run_gate(X.control(spark, sf_dir), "r0")


@query(_F5 + "SELECT table_name, status, run_id AS backfill_oldest_partition, CAST(NULL AS VARCHAR) AS backfill_newest_partition, CAST(NULL AS BIGINT) AS share_count, CAST(28 AS BIGINT) AS n_columns FROM c")
def control_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = X.control(spark, sf_dir).withColumn("last_backfilled_partition", F.col("run_id")).drop("pipeline_name", "pipeline_id", "owner_run_id", "lease_until")
    new = K.evolve(old)
    return new.select("table_name", "status", "backfill_oldest_partition", "backfill_newest_partition", "share_count", F.lit(len(new.columns)).cast("long").alias("n_columns"))


from tidemark import job_queries  # noqa: E402, F401  registers the queries of whole jobs
