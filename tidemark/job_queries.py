"""Queries that run the engine itself: stores, control table, executor, runner, configuration; with the SQL that checks them."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as X
from tidemark.functions.predicates import partition_literal, quoted
from tidemark.functions.retry import retry
from tidemark.operators import backfill as B
from tidemark.operators import control as K
from tidemark.plans.executor import migrate
from tidemark.plans.runner import registration, run
from tidemark.plans.specs import History, Migration, Plan, Policy, Slicing
from tidemark.registry import query
from tidemark.sources import config as C
from tidemark.sources import metadata as M
from tidemark.sources.control_store import ControlStore
from tidemark.sources.owners import pipeline_owners
from tidemark.sources.store import SnapshotTable
from tidemark.sources.webhook import notify

_CUT = f"TIMESTAMP '{X.CUT_EVENTS}'"
_WEEKS = f"WITH s AS (SELECT *, CAST(date_trunc('week', ts) AS DATE) AS event_week FROM events), t AS (SELECT * FROM s WHERE ts > {_CUT} OR event_id % 3 = 0) "
_TEXT = "WITH e AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'not-a-date' WHEN event_id % 89 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_str FROM events) "
_RECORD = "share_count", "deleted_count", "inserted_count", "target_le_cutoff_count", "live_gt_cutoff_before", "live_gt_cutoff_after"


class _Job:
    """A target and a control table in a folder of their own, and one migration of them."""

    def __init__(self, spark: SparkSession, source: DataFrame, target: DataFrame, column: str, slicing: Slicing, partition: str | None, days: int | None = None) -> None:
        self.spark, self.source, folder = spark, source, X.scratch(spark)
        self.task = Migration("events", "shared.raw.events", "main.raw.events", History(column, X.CUT_EVENTS, days), slicing)
        self.target = SnapshotTable(spark, f"{folder}/target")
        self.target.create(target.schema, partition)
        self.target.append(target)
        self.control = ControlStore(spark, folder, "unit")
        self.control.ensure()
        self.control.register(registration(spark, Plan("unit", "c.s.t", (self.task,)), "r0", {}))

    def migrate(self, run: str, policy: Policy = Policy(), at_commit=lambda step: None) -> str:  # noqa: B008
        return migrate(self.spark, self.task, self.source, self.target, self.control, run, policy, at_commit)

    def record(self) -> DataFrame:
        row = F.col("owner_run_id").isNull() & F.col("lease_until").isNull() & F.col("end_ts").isNotNull()
        return self.control.rows().select("status", "attempt", *_RECORD, "partition_pruned", "backfill_newest_partition", "backfill_oldest_partition", "error_message", row.alias("ended"))


def _weekly(spark: SparkSession, sf_dir: str, mode: str = "on", days: int | None = None) -> _Job:
    return _Job(spark, *X.weekly_events(spark, sf_dir), "ts", Slicing(mode, "event_week" if mode == "on" else None), "event_week", days)


@query(_WEEKS + f"SELECT event_id, ts, event_week FROM t WHERE NOT coalesce(ts <= {_CUT}, false) UNION ALL SELECT event_id, ts, event_week FROM s WHERE ts <= {_CUT}")
def job_chunked_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after a migration with a commit for each week."""
    job = _weekly(spark, sf_dir)
    job.migrate("r1")
    return job.target.read().select("event_id", "ts", "event_week")


def _record_sql(share: str, history: str, live: str, pruned: str, newest: str = "CAST(NULL AS VARCHAR)", oldest: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""SELECT 'SUCCESS' AS status, 1 AS attempt, ({share}) AS share_count, ({history}) AS deleted_count, ({share}) AS inserted_count, ({share}) AS target_le_cutoff_count,
 ({live}) AS live_gt_cutoff_before, ({live}) AS live_gt_cutoff_after, {pruned} AS partition_pruned, {newest} AS backfill_newest_partition, {oldest} AS backfill_oldest_partition,
 CAST(NULL AS VARCHAR) AS error_message, true AS ended"""


_NEWEST, _OLDEST = (f"(SELECT CAST({f}(event_week) AS VARCHAR) FROM s WHERE event_week <= CAST({_CUT} AS DATE))" for f in ("max", "min"))
_SHARE, _HELD, _LIVE = f"SELECT count(*) FROM s WHERE ts <= {_CUT}", f"SELECT count(*) FROM t WHERE ts <= {_CUT}", f"SELECT count(*) FROM t WHERE ts > {_CUT}"


@query(_WEEKS + _record_sql(_SHARE, _HELD, _LIVE, "true", _NEWEST, _OLDEST))
def job_chunked_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control row after it."""
    job = _weekly(spark, sf_dir, "auto")
    job.migrate("r1")
    return job.record()


@query(_WEEKS + _record_sql(_SHARE + f" AND ts > {_CUT} - INTERVAL 7 DAY", _HELD, _LIVE, "false"))
def job_windowed_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At once, of the last seven days: all history goes, the window comes."""
    job = _weekly(spark, sf_dir, "off", 7)
    job.migrate("r1")
    return job.record()


_PARSED = "try_cast(ts_str AS TIMESTAMP)"


@query(_TEXT + _record_sql(f"SELECT count(*) FROM e WHERE {_PARSED} <= {_CUT}", f"SELECT count(*) FROM e WHERE {_PARSED} <= {_CUT} AND event_id % 3 = 0", f"SELECT count(*) FROM e WHERE {_PARSED} > {_CUT} AND event_id % 3 = 0", "false"))
def job_text_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text checkpoint, some of it malformed, in an unpartitioned table."""
    rows = X.text_events(spark, sf_dir)
    job = _Job(spark, rows, rows.where("event_id % 3 = 0"), "ts_str", Slicing(), None)
    job.migrate("r1")
    return job.record()


@query(_WEEKS + f"""SELECT 'FAILED' AS first_status, 'SUCCESS' AS second_status, {_NEWEST} AS first_slices,
 (SELECT string_agg(CAST(w AS VARCHAR), ',' ORDER BY w DESC) FROM (SELECT DISTINCT event_week AS w FROM s WHERE event_week <= CAST({_CUT} AS DATE))) AS second_slices,
 CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, 2 AS attempt""")
def job_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that crashes behind its first commit, and its rerun: that slice is done again, as it isn't marked, then all others."""
    job, first, second = _weekly(spark, sf_dir), [], []
    cut = B.Cut.of(job.source, job.target.read(), "ts", X.CUT_EVENTS)
    want = B.migrated(job.source, job.target.read(), cut)

    def crash(value: str) -> None:
        first.append(value)
        raise RuntimeError("crash")

    states = job.migrate("r1", at_commit=crash), job.migrate("r2", at_commit=second.append)
    out = B.differences(job.target.read(), want)
    return out.select(F.lit(states[0]).alias("first_status"), F.lit(states[1]).alias("second_status"), F.lit(",".join(first)).alias("first_slices"), F.lit(",".join(second)).alias("second_slices"), "only_left", "only_right", F.lit(job.control.row("events")["attempt"]).alias("attempt"))


@query("SELECT 'FAILED' AS outcome, 'other' AS owner, 'IN_PROGRESS' AS status, CAST(1 AS BIGINT) AS slices")
def job_lost_lease(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another run takes the table over behind the first slice: the heartbeat notices, no more is written, the other's row stays."""
    job, done = _weekly(spark, sf_dir), []

    def taken(value: str) -> None:
        done.append(value)
        job.control.change(lambda df: K.update(df, job.control.key("events"), {"owner_run_id": F.lit("other")}, job.control.now()))
        time.sleep(2)

    outcome = job.migrate("r1", Policy(renew_s=0.1), taken)
    return job.control.rows().select(F.lit(outcome).alias("outcome"), F.col("owner_run_id").alias("owner"), "status", F.lit(len(done)).cast("long").alias("slices"))


@query("""SELECT * FROM (VALUES ('bad', 'SKIPPED', 'backfill_days must be a positive integer, not ''-1''', 'i-bad'), ('good', 'SUCCESS', NULL, 'i-good'), ('lost', 'SKIPPED', 'source not readable', NULL)) v(table_name, status, error_message, pipeline_id),
 (SELECT 'FAILED' AS run_status, 'me' AS started_by, true AS ended, 'unit, run r1: 3 tables, 2 need attention (SKIPPED=2, SUCCESS=1)' AS report, CAST(2 AS BIGINT) AS resolved, 'good' AS work)""")
def job_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over a good table, one whose source is missing and one that is configured badly: control rows, run row, report."""
    source, target = X.weekly_events(spark, sf_dir)
    folder = X.scratch(spark)
    table = SnapshotTable(spark, f"{folder}/target")
    table.create(target.schema)
    table.append(target)
    places = {"shared_catalog": "a", "shared_schema": "b", "target_catalog": "c", "target_schema": "d", "control_catalog": "e", "control_schema": "f", "control_table": "g"}
    lines = ["table_name,cut_off_date,checkpoint_col,backfill_days", f"good,{X.CUT_EVENTS},ts,", f"lost,{X.CUT_EVENTS},ts,", f"bad,{X.CUT_EVENTS},ts,-1"]
    plan = C.resolve({"business_unit": "unit", "timezone": "UTC"}, C.parse_tables(lines), places)
    control, sent = ControlStore(spark, folder, "unit"), []
    find = lambda name: None if name.endswith("lost") else "i-" + name.rpartition(".")[2]
    out = run(spark, plan, control, {"a.b.good": source, "a.b.bad": source}.__getitem__, lambda name: table, "me", "r1", "http://hook", lambda url, body, seconds: sent.append(body) or 200, find)
    ended = control.runs.read().select(F.col("status").alias("run_status"), "started_by", F.col("end_ts").isNotNull().alias("ended"), F.col("run_id").alias("run"))
    rows = control.rows().join(ended, F.col("run_id") == F.col("run"))
    return rows.select("table_name", rows["status"], "error_message", "pipeline_id", "run_status", "started_by", "ended", F.lit(out.report if sent else "").alias("report"), F.lit(out.resolved).cast("long").alias("resolved"), F.lit(",".join(out.work)).alias("work"))


@query("""SELECT * FROM (VALUES ('a', 'sc.other.a', 'tc.own.a', 'ts', '2024-01-01', 30, 'auto', 'd', NULL), ('b', 'sc.other.b', 'tc.ts.b', 'at', '2024-01-02', NULL, 'off', NULL, 'backfill_days must be a positive integer, not ''0'''))
 v(name, source, target, checkpoint_col, cut_off, days, mode, partition_col, fault), (SELECT 'unit' AS business_unit, 'c.s.k' AS control, 'Asia/Kolkata' AS zone, 200 AS vacuum_hours)""")
def config_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table list over defaults and overrides, with padded and blank cells, as a plan."""
    lines = ["table_name, cut_off_date,checkpoint_col,target_schema,chunk_backfill,backfill_days,partition_col", " a ,2024-01-01,ts,own, Auto ,30,d", ",,,,,,", "b,2024-01-02,at,,,0,"]
    settings = {"business_unit": "unit", "control": {"catalog": "x", "schema": "s", "table": "k"}, "defaults": {"shared_catalog": "sc", "shared_schema": "ss", "target_catalog": "tc", "target_schema": "ts"}, "runtime": {"vacuum_after": True, "vacuum_retain_hours": 200}}
    plan = C.resolve(settings, C.parse_tables(lines), {"shared_schema": "other", "control_catalog": "c", "target_schema": " ", "timezone": None})
    rows = [(m.name, m.source, m.target, m.history.column, m.history.cut_off, m.history.days, m.slicing.mode, m.slicing.column, m.fault, plan.business_unit, plan.control, plan.zone, plan.policy.vacuum.hours) for m in plan.migrations]
    return spark.createDataFrame(rows, "name string, source string, target string, checkpoint_col string, cut_off string, days int, mode string, partition_col string, fault string, business_unit string, control string, zone string, vacuum_hours int")


@query("""SELECT * FROM (VALUES ('config', 'no rows', 'it has no rows'), ('config', 'empty', 'it is empty'), ('config', 'unknown', 'unknown columns zone'), ('config', 'surplus', 'line 2: more cells than columns'),
 ('config', 'twice', 'listed twice: a'), ('config', 'missing', 'a: checkpoint_col missing'), ('config', 'mode', 'chunk_backfill must be on, off or auto, not ''maybe'''), ('config', 'runtime', 'runtime: unknown keys vacuum'), ('config', 'unit', 'business_unit missing'),
 ('config', 'control', 'control: table missing'), ('mode', 'True', 'on'), ('mode', 'False', 'off'), ('mode', 'None', 'off'), ('mode', ' YES', 'on'), ('mode', 'Auto', 'auto'), ('mode', 'maybe', 'off'), ('days', 'None', 'None'), ('days', ' 7 ', '7')) v(kind, item, result)""")
def config_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read of odd settings, and the error of each bad configuration."""
    head, places = "table_name,cut_off_date,checkpoint_col", {"shared_catalog": "x", "shared_schema": "x", "target_catalog": "x", "target_schema": "x"}
    control = {"catalog": "c", "schema": "s", "table": "t"}
    bad = {
        "no rows": ([head], {}), "empty": ([], {}), "unknown": ([head + ",zone", "a,1,ts,b"], {}), "surplus": ([head, "a,1,ts,b"], {}), "twice": ([head, "a,1,ts", "a,1,ts"], {}),
        "missing": ([head, "a,1,"], {}), "mode": ([head + ",chunk_backfill", "a,1,ts,maybe"], {}), "runtime": ([head, "a,1,ts"], {"runtime": {"vacuum": True}}), "unit": ([head, "a,1,ts"], {"business_unit": ""}),
        "control": ([head, "a,1,ts"], {"control": {"catalog": "c", "schema": "s"}}),
    }
    rows = []
    for item, (lines, settings) in bad.items():
        try:
            C.resolve({"business_unit": "u", "control": control} | settings, C.parse_tables(lines), places)
        except C.ConfigError as e:
            rows.append(("config", item, str(e).removeprefix("the table list: ").removeprefix("the table list, ")))
    rows += [("mode", str(x), C.chunk_mode(x, strict=False)) for x in (True, False, None, " YES", "Auto", "maybe")]
    rows += [("days", str(x), str(C.window_days(x))) for x in (None, " 7 ")]
    return spark.createDataFrame(rows, "kind string, item string, result string")


_SPECS = """WITH n AS (SELECT s_suppkey AS k, n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 0
 UNION ALL SELECT s_suppkey, n_name, 'new ' || s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 10 = 3) """


@query(_SPECS + "SELECT count(*) FILTER (WHERE k % 4 = 0) AS resolved, count(*) AS tables FROM n")
def resolved_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.resolved(X.specs(spark, sf_dir))


@query("""SELECT * FROM (VALUES ('a', 'src.a', 'tgt.a', 'ts', '2024-01-01', 'p1', 'Pipe one'), ('b', 'src.b', 'tgt.b', 'ts', '2024-01-01', 'p1', 'Pipe one'), ('c', 'src.c', 'tgt.c', 'ts', '2024-01-01', 'p2', NULL), ('d', 'src.d', 'tgt.d', 'ts', '2024-01-01', NULL, NULL))
 v(table_name, source_fqn, target_fqn, checkpoint_col, cut_off_date, pipeline_id, pipeline_name), (SELECT CAST(2 AS BIGINT) AS name_lookups, 'unit' AS business_unit, 'r7' AS run_id)""")
def registered_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run registers, with pipelines looked up: an id's name is asked once, errors are no owner."""
    plan = Plan("unit", "c", tuple(Migration(n, f"src.{n}", f"tgt.{n}", History("ts", "2024-01-01")) for n in "abcd"))
    asked: list[str] = []

    def name_of(pipeline: str) -> str:
        asked.append(pipeline)
        if pipeline == "p2":
            raise OSError("no access")
        return "Pipe one"

    ids = {"tgt.a": "p1", "tgt.b": "p1", "tgt.c": "p2"}
    owners = pipeline_owners(spark, [(m.name, m.target) for m in plan.migrations], ids.__getitem__, name_of)
    out = registration(spark, plan, "r7", owners)
    return out.drop("batch_id").withColumn("name_lookups", F.lit(len(asked)).cast("long"))


@query("""SELECT n_name AS business_unit, s_name AS table_name, 'r' || (s_suppkey % 2) AS run_id FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_name = (SELECT min(s_name) FROM supplier)""")
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.control(spark, sf_dir)
    first = rows.orderBy("table_name").first()
    return rows.where(K.key_is(first["business_unit"], first["table_name"])).select("business_unit", "table_name", "run_id")


@query("""SELECT 'it''s' AS quote, 'back\\slash "x"' AS slash, 'naïve — 日本' AS unicode, '; DROP TABLE t --' AS statement, DATE '2024-01-31' AS day, true AS same, CAST(1 AS BIGINT) AS odd_name""")
def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of any kind as literals, never as SQL text; columns by whole names."""
    rows = spark.range(1).select(F.lit("it's").alias("quote"), F.lit('back\\slash "x"').alias("slash"), F.lit("naïve — 日本").alias("unicode"), F.lit("; DROP TABLE t --").alias("statement"), partition_literal("2024-01-31", X.DAY).alias("day"))
    odd = spark.range(2).withColumnRenamed("id", "a.b`c")
    n = odd.where(quoted("a.b`c") == 1).count()
    return rows.withColumn("same", F.col("quote") == F.lit("it's")).withColumn("odd_name", F.lit(n).cast("long"))


@query("SELECT kind, wait, CAST(seconds AS DOUBLE) AS seconds FROM (VALUES ('table', 1, 5.0), ('table', 2, 10.0), ('table', 3, 20.0), ('table', 4, 40.0), ('control', 1, 1.0), ('control', 2, 2.0), ('control', 3, 4.0), ('control', 4, 8.0), ('control', 5, 8.0), ('control', 6, 8.0), ('control', 7, 8.0)) v(kind, wait, seconds)")
def retry_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The waits of a step that conflicts each time: on tables, and on the control table."""
    rows = []
    for kind, attempts, first, cap in (("table", Policy().tries, Policy().first_wait_s, float("inf")), ("control", 8, 1.0, 8.0)):
        waits: list[float] = []
        try:
            retry(lambda: {}["never"], KeyError, attempts, first, cap, waits.append)
        except KeyError:
            rows += [(kind, i, float(w)) for i, w in enumerate(waits, 1)]
    return spark.createDataFrame(rows, "kind string, wait int, seconds double")


@query(_WEEKS + f"SELECT (SELECT count(*) FROM s WHERE ts > {_CUT}) AS left_rows, (SELECT count(*) FROM s) AS rows_before, CAST(1 AS BIGINT) AS folders_deleted, CAST(1 AS BIGINT) AS versions, 'vacuum of less than 168 hours needs an override' AS refusal")
def vacuum_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old files go, the newest version stays, and short retention needs an override."""
    source, _ = X.weekly_events(spark, sf_dir)
    table = SnapshotTable(spark, f"{X.scratch(spark)}/t")
    table.create(source.schema)
    before = table.append(source)
    n = table.read(before).count()
    table.delete(B.Cut.of(source, source, "ts", X.CUT_EVENTS).history())
    refusal = ""
    try:
        table.vacuum(1)
    except ValueError as e:
        refusal = str(e)
    gone = table.vacuum(0, override=True)
    left = table.read().agg(F.count("*").alias("left_rows"))
    return left.select("left_rows", F.lit(n).cast("long").alias("rows_before"), F.lit(gone).cast("long").alias("folders_deleted"), F.lit(len(table.versions())).cast("long").alias("versions"), F.lit(refusal).alias("refusal"))


@query(_WEEKS + "SELECT event_id, ts, event_week FROM t UNION ALL SELECT event_id + 1000000, ts, event_week FROM s WHERE event_id % 2 = 0")
def append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends by name under tokens: a batch that comes again isn't added again."""
    source, target = X.weekly_events(spark, sf_dir)
    table = SnapshotTable(spark, f"{X.scratch(spark)}/t")
    table.create(target.schema, "event_week")
    table.append(target, token="feed:0")
    more = source.where("event_id % 2 = 0").withColumn("event_id", F.col("event_id") + 1_000_000).select(*sorted(source.columns, reverse=True))
    for number in (1, 0, 1):
        table.append(more, token=f"feed:{number}")
    return table.read().select("event_id", "ts", "event_week")


@query(_WEEKS + f"""SELECT side, count(*) FILTER (WHERE ts <= {_CUT} AND ts > {_CUT} - INTERVAL 7 DAY) AS windowed, count(*) FILTER (WHERE ts <= {_CUT}) AS history, count(*) FILTER (WHERE ts > {_CUT}) AS live,
 count(*) FILTER (WHERE ts <= {_CUT} AND (event_week IS NULL OR event_week > CAST({_CUT} AS DATE))) AS misaligned, string_agg(DISTINCT CAST(event_week AS VARCHAR), ',' ORDER BY CAST(event_week AS VARCHAR)) FILTER (WHERE event_week <= CAST({_CUT} AS DATE)) AS partition_values
 FROM (SELECT 'source' AS side, * FROM s UNION ALL SELECT 'target', * FROM t) GROUP BY side""")
def table_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that a migration needs to know of a side, from one scan of it."""
    sides = dict(zip(("source", "target"), X.weekly_events(spark, sf_dir), strict=True))
    cut = B.Cut.of(*sides.values(), "ts", X.CUT_EVENTS, 7)
    one, two = (B.survey(t, cut, ("event_week", X.DAY)).withColumn("side", F.lit(s)).withColumn("partition_values", F.array_join("partition_values", ",")) for s, t in sides.items())
    return one.unionByName(two)


@query("""SELECT * FROM (VALUES ('partition', 'event_type', 'string'), ('partition', 'event_date', 'date'), ('column', 'event_id', 'long'), ('column', 'event_type', 'string'), ('column', 'event_date', 'date'),
 ('property', 'pipelines.pipelineId', 'p42'), ('property', 'absent', NULL), ('found', 'event_date', 'date'), ('configured', 'event_date', 'date'), ('configured', 'event_type', NULL), ('missing table', NULL, NULL), ('owner', 'p42', NULL)) v(kind, name, value)""")
def table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition columns, live schema, property, partition column and owner of a catalog table."""
    name = "meta_" + X.scratch(spark).rpartition("-")[2]
    spark.sql(f"CREATE TABLE {name} (event_id BIGINT, event_type STRING, event_date DATE) USING parquet PARTITIONED BY (event_type, event_date) TBLPROPERTIES ('pipelines.pipelineId' = 'p42')")
    try:
        schema, columns = spark.table(name).schema, M.partition_columns(spark, name)
        rows = [("partition", c, schema[c].dataType.typeName()) for c in columns]
        rows += [("column", *kv) for kv in M.live_schema(spark, name).items()]
        rows += [("property", k, M.table_property(spark, name, k)) for k in ("pipelines.pipelineId", "absent")]
        found = M.discover(columns, schema)
        rows.append(("found", found[0], found[1].simpleString()))
        for c in ("event_date", "event_type"):
            got = M.resolve(c, columns, schema)
            rows.append(("configured", c, got and got[1].simpleString()))
        rows.append(("missing table", None, str(x) if (x := M.live_schema(spark, name + "_absent")) else None))
        rows.append(("owner", pipeline_owners(spark, [("t", name)])["t"][1], None))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(rows, "kind string, name string, value string")


@query("SELECT 28 AS control_columns, 6 AS run_columns, 1 AS control_versions, CAST(0 AS BIGINT) AS control_rows")
def control_created_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = ControlStore(spark, X.scratch(spark), "unit")
    control.ensure()
    control.ensure()
    rows = control.rows().agg(F.count("*").alias("control_rows"))
    return rows.select(F.lit(len(control.table.schema())).alias("control_columns"), F.lit(len(control.runs.schema())).alias("run_columns"), F.lit(len(control.table.versions())).alias("control_versions"), "control_rows")


@query("SELECT * FROM (VALUES ('no address', false), ('refused', false), ('broken', false), ('sent', true)) v(item, sent)")
def webhook_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message is sent or not; nothing is raised."""

    def broken(*_: object) -> int:
        raise OSError("down")

    cases = (("no address", None, lambda *_: 200), ("refused", "http://hook", lambda *_: 500), ("broken", "http://hook", broken), ("sent", "http://hook", lambda *_: 204))
    return spark.createDataFrame([(item, bool(notify(url, "text", post=post))) for item, url, post in cases], "item string, sent boolean")
