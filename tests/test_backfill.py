"""Operators, store, executor and runner."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.retry import retry
from tidemark.operators import backfill as B
from tidemark.operators import control as K
from tidemark.plans.executor import Heartbeat, LeaseLost, migrate
from tidemark.plans.runner import RunActive, RunFailed, preflight, registration, run
from tidemark.plans.specs import History, Migration, Plan, Policy, Slicing, Status, Vacuum
from tidemark.sources import config as C
from tidemark.sources.control_store import ControlStore
from tidemark.sources.owners import pipeline_owners
from tidemark.sources.store import ConcurrentCommit, SnapshotTable
from tidemark.sources.webhook import notify
from tidemark.streaming.feed import feed

CUT = "2024-01-03 23:59:59"


@pytest.fixture(scope="module")
def source(spark):
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=8 * i)) for i in range(15)]
    return spark.createDataFrame(rows, "id long, ts timestamp").withColumn("day", F.col("ts").cast("date")).cache()


def TableSpec(name, cut_off, column, source, target, partition=None, chunk="off", days=None, fault=None):
    return Migration(name, source, target, History(column, cut_off, days), Slicing(chunk, partition), fault)


def old_rows(source):
    return source.where("id % 2 = 0 or id > 8").withColumn("id", F.col("id") + F.when(F.col("id") <= 8, 100).otherwise(0))


def make(spark, source, path, partition=None):
    t = SnapshotTable(spark, f"file://{path}/t")
    t.create(source.schema, partition)
    t.append(old_rows(source))
    return t


def controlled(spark, path, spec, unit="u"):
    c = ControlStore(spark, f"file://{path}/c", unit)
    c.ensure()
    c.register(registration(spark, Plan(unit, "c", (spec,)), "r", {}))
    return c


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


WANT = list(range(15))


@pytest.mark.parametrize(("chunk", "partition", "configured"), [("off", None, None), ("off", "day", "day"), ("on", "day", "day"), ("auto", "day", None), ("on", None, "day")])
def test_every_mode_gives_the_same_table(spark, source, tmp_path, chunk, partition, configured):
    spec = TableSpec("t", CUT, "ts", "s", "t", configured, chunk)
    t, c = make(spark, source, tmp_path, partition), controlled(spark, tmp_path, spec)
    assert migrate(spark, spec, source, t, c, "r") == Status.SUCCESS
    assert ids(t.read()) == WANT
    row = c.row("t")
    assert (row["share_count"], row["target_le_cutoff_count"], row["owner_run_id"], row["attempt"]) == (9, 9, None, 1)
    assert migrate(spark, spec, source, t, c, "r") == Status.SUCCESS
    assert c.row("t")["attempt"] == 1


def test_a_crash_after_any_commit_is_resumed(spark, source, tmp_path):
    for step in range(3):
        path = tmp_path / str(step)
        spec = TableSpec("t", CUT, "ts", "s", "t", "day", "on")
        t, c, seen = make(spark, source, path, "day"), controlled(spark, path, spec), []

        def crash(value, seen=seen, step=step):
            seen.append(value)
            if len(seen) == step + 1:
                raise RuntimeError("crash")

        assert migrate(spark, spec, source, t, c, "r1", at_commit=crash) == Status.FAILED
        again = []
        assert migrate(spark, spec, source, t, c, "r2", at_commit=again.append) == Status.SUCCESS
        assert ids(t.read()) == WANT
        assert seen == sorted(seen, reverse=True) and again[0] == seen[-1]


def test_a_new_cut_off_resets_the_watermark(spark, source, tmp_path):
    first = TableSpec("t", "2024-01-02 23:59:59", "ts", "s", "t", "day", "on")
    t, c = make(spark, source, tmp_path, "day"), controlled(spark, tmp_path, first)
    assert migrate(spark, first, source, t, c, "r1", at_commit=lambda v: 1 / 0) == Status.FAILED
    assert migrate(spark, TableSpec("t", CUT, "ts", "s", "t", "day", "on"), source, t, c, "r2") == Status.SUCCESS
    assert ids(t.read()) == WANT


def test_window_deletes_all_history_but_copies_the_last_days(spark, source, tmp_path):
    spec = TableSpec("t", CUT, "ts", "s", "t", days=1)
    t, c = make(spark, source, tmp_path), controlled(spark, tmp_path, spec)
    assert migrate(spark, spec, source, t, c, "r") == Status.SUCCESS
    assert ids(t.read()) == list(range(6, 15))


def test_null_and_malformed_checkpoints_stay_and_are_not_copied(spark, source, tmp_path):
    text = source.select("id", F.when(F.col("id") == 0, "bad").when(F.col("id") != 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"))
    t = SnapshotTable(spark, f"file://{tmp_path}/t")
    t.create(text.schema)
    t.append(text.where("id < 4"))
    spec = TableSpec("t", CUT, "ts", "s", "t")
    assert migrate(spark, spec, text, t, controlled(spark, tmp_path, spec), "r") == Status.SUCCESS
    assert ids(t.read()) == list(range(9))


def test_misaligned_partitions_are_not_trusted(spark, source, tmp_path):
    odd = source.withColumn("day", F.when(F.col("id") != 3, F.date_add("day", F.lit(2))))
    t = SnapshotTable(spark, f"file://{tmp_path}/t")
    t.create(odd.schema, "day")
    t.append(old_rows(odd))
    spec = TableSpec("t", CUT, "ts", "s", "t", "day", "auto")
    c = controlled(spark, tmp_path, spec)
    assert migrate(spark, spec, odd, t, c, "r") == Status.SUCCESS
    assert ids(t.read()) == WANT and c.row("t")["partition_pruned"] is False


def test_no_source_rows_change_nothing(spark, source, tmp_path):
    spec = TableSpec("t", "2020-01-01 00:00:00", "ts", "s", "t")
    t, c = make(spark, source, tmp_path), controlled(spark, tmp_path, spec)
    version = t.manifest().version
    assert migrate(spark, spec, source, t, c, "r") == Status.SUCCESS
    assert t.manifest().version == version


def test_a_missing_source_column_fails_the_table(spark, source, tmp_path):
    spec = TableSpec("t", CUT, "ts", "s", "t")
    t, c = make(spark, source, tmp_path), controlled(spark, tmp_path, spec)
    assert migrate(spark, spec, source.drop("day"), t, c, "r") == Status.FAILED
    assert "day" in c.row("t")["error_message"]


def test_one_of_two_claims_wins(spark, source, tmp_path):
    spec = TableSpec("t", CUT, "ts", "s", "t")
    c, won = controlled(spark, tmp_path, spec), []
    stores = [ControlStore(spark, f"file://{tmp_path}/c", "u") for _ in range(2)]
    threads = [threading.Thread(target=lambda s=s, n=n: won.append((n, s.claim("t", n, 10)))) for n, s in zip("ab", stores, strict=True)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert sorted(w for _, w in won) == [False, True]
    owner = next(n for n, w in won if w)
    assert c.row("t")["owner_run_id"] == owner
    assert not c.renew("t", "other", 10) and c.renew("t", owner, 10)
    c.set("t", "other", status="FAILED")
    assert c.row("t")["status"] == "PENDING"
    c.release("t", owner)
    assert c.claim("t", "later", 10)


def test_an_expired_lease_can_be_claimed(spark, tmp_path):
    at = [datetime(2024, 1, 1)]
    controlled(spark, tmp_path, TableSpec("t", CUT, "ts", "s", "t"))
    c = ControlStore(spark, f"file://{tmp_path}/c", "u", clock=lambda: at[0])
    assert c.claim("t", "a", 10) and not c.claim("t", "b", 10)
    at[0] += timedelta(minutes=11)
    assert c.claim("t", "b", 10)


def test_store_conflicts_appends_and_vacuum(spark, source, tmp_path):
    t = make(spark, source, tmp_path, "day")

    def meddle(df):
        SnapshotTable(spark, t.path).append(source.where("id = 0"))
        return df

    with pytest.raises(ConcurrentCommit):
        t.rewrite(meddle)
    n = t.read().count()
    t.rewrite(lambda df: (SnapshotTable(spark, t.path).append(source.where("id = 14")), df)[1], values=["2024-01-01"])
    assert t.read().count() == n + 1
    assert t.append(source, token="x").version == t.append(source, token="x").version
    t.delete(F.col("id") >= 0)
    assert t.read().count() == 0 and t.read(t.manifest(1)).count() > 0
    with pytest.raises(ValueError, match="override"):
        t.vacuum(1)
    assert t.vacuum(0, override=True) > 0 and t.read().count() == 0


def test_old_control_tables_evolve(spark, tmp_path):
    c = ControlStore(spark, f"file://{tmp_path}/c", "u")
    old = spark.createDataFrame([("u", "t", "SUCCESS", "2024-01-01")], "business_unit string, table_name string, status string, last_backfilled_partition string")
    c.table.create(old.schema)
    c.table.append(old)
    c.ensure()
    assert c.row("t")["backfill_oldest_partition"] == "2024-01-01" and set(K.COLUMNS) == set(c.rows().columns)
    version = c.table.manifest().version
    c.ensure()
    assert c.table.manifest().version == version


def test_run_over_tables_with_a_bad_one(spark, source, tmp_path):
    t = make(spark, source, tmp_path)
    tables = (TableSpec("t", CUT, "ts", "s", "t"), TableSpec("x", CUT, "ts", "nowhere", "t"), TableSpec("y", CUT, "ts", "s", "t", fault="bad days"))
    plan = Plan("u", "a.b.c", tables, zone="Asia/Kolkata", policy=Policy(threads=2))
    get = {"s": source}.__getitem__
    assert preflight(spark, tables, get, {"t": t}.get) == {"t": "ok", "x": "source not readable", "y": "bad days"}
    c, sent = ControlStore(spark, f"file://{tmp_path}/c", "u"), []
    out = run(spark, Plan("u", "a.b.c", tables, zone="UTC"), c, get, {"t": t}.get, webhook="http://x", post=lambda u, b, s: sent.append(b) or 200, find_pipeline=lambda n: "p1" if n == "t" else None)
    assert not out.ok and len(sent) == 1 and b"2 need attention (SKIPPED=2, SUCCESS=1)" in sent[0] and out.resolved == 3 and out.work == ["t"]
    with pytest.raises(RunFailed, match="SKIPPED=2"):
        out.gate()
    assert c.runs.read().first()["status"] == "FAILED" and ids(t.read()) == WANT
    good = run(spark, Plan("u", "a.b.c", tables[:1], zone="Asia/Kolkata"), c, get, {"t": t}.get)
    assert good.ok and good.gate() is None and spark.conf.get("spark.sql.session.timeZone") == "UTC" and plan.policy.threads == 2
    assert c.runs.read().where(F.col("run_id") == good.run_id).first()["status"] == "COMPLETED"


def test_an_error_of_a_table_or_of_the_run_is_recorded(spark, source, tmp_path):
    t, asked = make(spark, source, tmp_path), []

    def vanishing(name):
        asked.append(name)
        if name == "gone" and asked.count("gone") > 1:
            raise OSError("no such table")
        return source

    c = ControlStore(spark, f"file://{tmp_path}/c", "u")
    plan = Plan("u", "a.b.c", (TableSpec("t", CUT, "ts", "s", "t"), TableSpec("g", CUT, "ts", "gone", "t")), zone="UTC")
    out = run(spark, plan, c, vanishing, {"t": t}.get, run_id="r1")
    assert not out.ok and c.row("g")["status"] == "FAILED" and "no such table" in c.row("g")["error_message"] and c.row("t")["status"] == "SUCCESS"
    c.skip = lambda reasons: 1 / 0
    with pytest.raises(ZeroDivisionError):
        run(spark, plan, c, vanishing, {"t": t}.get, run_id="r2")
    assert {r["run_id"]: r["status"] for r in c.runs.read().collect()} == {"r1": "FAILED", "r2": "FAILED"}
    c.run_started("r3", "me")
    with pytest.raises(RunActive):
        run(spark, plan, c, vanishing, {"t": t}.get, alone=True)


def test_a_lost_lease_stops_a_migration(spark, source, tmp_path):
    spec = TableSpec("t", CUT, "ts", "s", "t", "day", "on")
    t, c, done = make(spark, source, tmp_path, "day"), controlled(spark, tmp_path, spec), []

    def taken_over(value):
        done.append(value)
        c.change(lambda df: K.update(df, c.key("t"), {"owner_run_id": F.lit("other")}, c.now()))
        time.sleep(1.5)

    assert migrate(spark, spec, source, t, c, "r", Policy(renew_s=0.1), at_commit=taken_over) == Status.FAILED
    row = c.row("t")
    assert len(done) == 1 and (row["owner_run_id"], row["status"]) == ("other", "IN_PROGRESS")  # the other run's row is left alone


def test_heartbeat_renews_and_outlives_errors():
    calls, answers = [], iter([True, OSError(), True, False])

    def renew():
        calls.append(1)
        x = next(answers)
        if isinstance(x, OSError):
            raise x
        return x

    with Heartbeat(renew, 0.02) as beat:
        beat.check()
        time.sleep(0.5)
        with pytest.raises(LeaseLost):
            beat.check()
    assert len(calls) == 4
    assert Policy().renewal() == 2400 and Policy(lease_minutes=0).renewal() == 15


def test_counts_are_those_written(spark, source, tmp_path):
    for k, (chunk, partition) in enumerate([("off", None), ("on", "day")]):
        path = tmp_path / str(k)
        spec = TableSpec("t", CUT, "ts", "s", "t", partition, chunk)
        t, c = make(spark, source, path, partition), controlled(spark, path, spec)
        gone = t.read().where(F.col("ts") <= F.lit(CUT).cast("timestamp")).count()
        assert migrate(spark, spec, source, t, c, "r") == Status.SUCCESS
        assert (c.row("t")["deleted_count"], c.row("t")["inserted_count"]) == (gone, 9)


@pytest.mark.parametrize("partition", [None, "day"])
def test_a_feed_that_commits_during_every_attempt(spark, source, tmp_path, partition):
    """Appends to what is being rewritten neither stop the rewrite nor get lost, and late history doesn't come back."""
    spec = TableSpec("t", CUT, "ts", "s", "t")
    t, c = make(spark, source, tmp_path, partition), controlled(spark, tmp_path, spec)
    feed_end, n, real = SnapshotTable(spark, t.path), [0], t._commit

    def commit(base, new):
        if n[0] < 12:  # before each of the first commits another one comes
            n[0] += 1
            rows = source.where("id in (0, 13)").withColumn("id", F.col("id") + 1000 + 100 * n[0])
            feed_end.append(rows, token=f"feed:{n[0]}")
        return real(base, new)

    t._commit = commit
    assert migrate(spark, spec, source, t, c, "r", Policy(tries=1)) == Status.SUCCESS
    assert ids(t.read()) == sorted(WANT + [1013 + 100 * k for k in range(1, 13)])
    assert t.manifest().tokens == ["feed:12"] and c.row("t")["inserted_count"] == 9
    assert t.append(source, token="feed:7").version == t.manifest().version  # replayed


def test_a_slice_with_many_rows_has_many_files(spark, tmp_path):
    rows = spark.range(400_000, numPartitions=8).select("id", F.lit("2024-01-01").cast("date").alias("day"))
    t = SnapshotTable(spark, f"file://{tmp_path}/t")
    t.create(rows.schema, "day")
    t.rewrite(lambda df: rows, values=["2024-01-01"])
    assert len(t.read().inputFiles()) == 8 and t.read().count() == 400_000
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        t.append(rows.withColumn("day", F.when(F.col("id") % 100 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-03")).cast("date")))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in t.read().inputFiles() if "2024-01-03" in f]
    assert len(files) > 1 and t.read().count() == 800_000


def test_changes_of_many_tables_are_committed_together(spark, tmp_path):
    c = ControlStore(spark, f"file://{tmp_path}/c", "u")
    c.ensure()
    tasks = tuple(TableSpec(f"t{i}", CUT, "ts", "s", "t") for i in range(60))
    c.register(registration(spark, Plan("u", "c", tasks), "r", {}))
    c.commits = 0

    def one(t):
        assert c.begin(t.name, "r", 10)["attempt"] == 1
        c.finish(t.name, "r", status=Status.SUCCESS)

    with ThreadPoolExecutor(20) as pool:
        list(pool.map(one, tasks))
    done = c.rows().where("status = 'SUCCESS' and owner_run_id is null and start_ts is not null and end_ts is not null").count()
    assert done == 60 and c.commits <= 30  # of 120 changes


def test_manifests_are_trimmed_and_small_appends_compacted(spark, source, tmp_path):
    t = make(spark, source, tmp_path, "day")
    n = t.read().count()
    for i in range(5):
        t.append(source.where("id = 0"), token=f"f:{i}")
    assert len(t.manifest().tokens) == 1
    t.compact(3)
    assert t.read().count() == n + 5 and sum(p["value"] == "2024-01-01" for p in t.manifest().parts) == 1
    assert len(t.versions()) == 8 and t.trim(2) == 0 and len(t.versions()) == 2  # the version before the compaction lists all
    assert t.trim(1) > 0 and len(t.versions()) == 1 and t.read().count() == n + 5
    t.rewrite(lambda df: df.where("id = 0"))
    t.vacuum(0, override=True)
    assert len(t.versions()) == 1 and t.read().count() > 0


def test_live_feed_beside_a_migration(spark, source, tmp_path):
    spec = TableSpec("t", CUT, "ts", "s", "t", "day", "on")
    t, c = make(spark, source, tmp_path, "day"), controlled(spark, tmp_path, spec)
    folder = f"{tmp_path}/in"
    source.where("id >= 12").withColumn("id", F.col("id") + 1000).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(source.schema).parquet(folder)
    query = feed(stream, t, f"{tmp_path}/ck").trigger(availableNow=True).start()
    assert migrate(spark, spec, source, t, c, "r", Policy(first_wait_s=0.1)) == Status.SUCCESS
    query.awaitTermination()
    assert ids(t.read()) == sorted([*WANT, 1012, 1013, 1014])


def test_differences_counts_both_ways(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert tuple(B.differences(a, b).first()) == (2, 1)


def test_retry_waits_double_and_give_up():
    waits, calls = [], []

    def bad():
        calls.append(1)
        raise KeyError

    with pytest.raises(KeyError):
        retry(bad, KeyError, sleep=waits.append)
    assert waits == [5, 10, 20, 40] and len(calls) == 5
    with pytest.raises(KeyError):
        retry(bad, ValueError, sleep=waits.append)
    assert len(calls) == 6


def test_webhook_never_raises():
    def broken(*_):
        raise OSError

    assert not notify("", "x") and not notify(None, "x") and not notify("u", "x", post=broken)
    assert notify("u", "x", post=lambda *_: 204) and not notify("u", "x", post=lambda *_: 500)


def test_owner_names_are_asked_once_and_errors_are_swallowed(spark):
    asked = []
    got = pipeline_owners(spark, [("a", "x"), ("b", "y"), ("c", "z")], find_id=lambda t: "p" if t != "z" else 1 / 0, find_name=lambda p: asked.append(p))
    assert got == {"a": (None, "p"), "b": (None, "p"), "c": (None, None)} and asked == ["p"]


def test_table_list(tmp_path):
    path = tmp_path / "tables.csv"

    def read(text):
        path.write_text(text)
        return C.read_tables(path)

    assert read("table_name, cut_off_date\n a , 2024 \n\n,\n") == [{"table_name": "a", "cut_off_date": "2024"}]
    for bad, what in (("", "empty"), ("table_name\n", "no rows"), ("table_name,zone\na,b\n", "unknown"), ("table_name\na,b\n", "more cells")):
        with pytest.raises(C.ConfigError, match=what):
            read(bad)


def test_configuration(tmp_path):
    head = "table_name,cut_off_date,checkpoint_col,target_schema,chunk_backfill,backfill_days,partition_col\n"
    (tmp_path / "t.csv").write_text(head + "a,2024-01-01,ts,own,auto,30,d\nb,2024-01-01,ts,,,-1,\n")
    yml = "business_unit: u\ntables_csv: t.csv\ncontrol: {catalog: c, schema: s, table: k}\nruntime: {%s}\ndefaults: {shared_catalog: sc, shared_schema: ss, target_catalog: tc, target_schema: ts}\n"
    (tmp_path / "c.yml").write_text(yml % "vacuum_after: true, vacuum_retain_hours: 200, vacuum_override_retention_check: false")
    got = C.load(tmp_path / "c.yml", {"shared_schema": "other", "timezone": " "})
    a, b = got.migrations
    assert a == Migration("a", "sc.other.a", "tc.own.a", History("ts", "2024-01-01", 30), Slicing("auto", "d"))
    assert b.target == "tc.ts.b" and "positive" in b.fault and b.slicing == Slicing()
    assert got.policy == Policy(vacuum=Vacuum(200, False)) and got.zone == "Asia/Kolkata" and got.control == "c.s.k"
    for runtime, what in (("vacuum: true", "unknown keys vacuum"), ("vacuum_after: true, vacuum_retain_hours: x", "number")):
        (tmp_path / "c.yml").write_text(yml % runtime)
        with pytest.raises(C.ConfigError, match=what):
            C.load(tmp_path / "c.yml")
    (tmp_path / "c.yml").write_text(yml % "vacuum_retain_hours: 24")
    assert C.load(tmp_path / "c.yml").policy.vacuum is None
    places = {"shared_catalog": "x", "shared_schema": "x", "target_catalog": "x", "target_schema": "x", "control_catalog": "c", "control_schema": "s", "control_table": "t"}
    assert C.from_parameters(tmp_path / "t.csv", "u", "UTC", places).zone == "UTC"
    with pytest.raises(C.ConfigError, match="table missing"):
        C.from_parameters(tmp_path / "t.csv", "u", "UTC", {k: v for k, v in places.items() if k != "control_table"})
    for text, what in ((head + "a,2024,ts,x,maybe,,\n", "chunk_backfill"), (head + "a,2024,ts,x,,,\na,2024,ts,x,,,\n", "twice"), (head + "a,,ts,x,,,\n", "missing")):
        (tmp_path / "t.csv").write_text(text)
        with pytest.raises(C.ConfigError, match=what):
            C.from_parameters(tmp_path / "t.csv", "u", "UTC", places)


def test_paths_may_lie_below_a_mount(tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("table_name\n")
    assert C.existing("/a/x.csv", (str(tmp_path),)) == tmp_path / "a" / "x.csv" and C.existing(tmp_path / "a") == tmp_path / "a"
    with pytest.raises(C.ConfigError, match="not found"):
        C.read_tables("/a/x.csv")


def test_normalisers():
    assert [C.chunk_mode(x) for x in (True, False, None, " YES", "Auto", "no")] == ["on", "off", "off", "on", "auto", "off"]
    assert C.chunk_mode("maybe", strict=False) == "off"
    assert [C.window_days(x) for x in (None, " ", 7, "7")] == [None, None, 7, 7]
    for bad in ("0", "-1", "x", True, "1.5"):
        with pytest.raises(C.ConfigError):
            C.window_days(bad)
