"""A run over all tables: register, check, migrate in parallel, report."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.predicates import type_of
from tidemark.operators import control as K
from tidemark.plans.executor import migrate
from tidemark.plans.specs import Migration, Plan, RunStatus
from tidemark.sources.control_store import ControlStore
from tidemark.sources.owners import pipeline_owners
from tidemark.sources.store import SnapshotTable
from tidemark.sources.webhook import notify

log = logging.getLogger(__name__)


class RunFailed(RuntimeError):
    """A run has FAILED or SKIPPED tables."""


class RunActive(RuntimeError):
    """Another run of the business unit hasn't ended."""


@dataclass
class Outcome:
    """What a run hands to those that follow it."""

    run_id: str
    ok: bool = False
    resolved: int = 0  #: tables whose pipeline is known
    work: list[str] = field(default_factory=list)  #: tables that were to be migrated
    report: str = ""

    def gate(self) -> None:
        """Raise unless all is well: the last step of a job, which so fails and alerts."""
        if not self.ok:
            raise RunFailed(self.report)


def preflight(spark: SparkSession, tasks: Iterable[Migration], source: Callable[[str], DataFrame | None], target: Callable[[str], SnapshotTable | None]) -> dict[str, str]:
    """The first failed check of each table, or ok; a table's schema is read once however often it is listed."""
    schemas: dict[str, object] = {}
    rows = []
    for t in tasks:
        for key, read in ((t.source, source), (t.target, lambda n: (x := target(n)) and x.read())):
            if key not in schemas:
                try:
                    schemas[key] = read(key).schema
                except Exception:  # noqa: BLE001  unreadable, for whatever reason
                    schemas[key] = None
        kinds = [k.typeName() if (s := schemas[x]) is not None and (k := type_of(s, t.history.column)) else None for x in (t.source, t.target)]
        rows.append((t.name, schemas[t.source] is not None, schemas[t.target] is not None, *kinds, t.fault))
    checks = spark.createDataFrame(rows, "table_name string, source_exists boolean, target_exists boolean, source_type string, target_type string, config_error string")
    return {r["table_name"]: r["reason"] for r in K.verdicts(checks).collect()}


def registration(spark: SparkSession, plan: Plan, run_id: str, owners: Mapping[str, tuple[str | None, str | None]]) -> DataFrame:
    """The rows that a run registers: its migrations with their pipelines (name, id)."""
    rows = [(plan.business_unit, t.name, run_id, run_id, t.history.cut_off, t.history.column, t.source, t.target, *owners.get(t.name, (None, None))) for t in plan.migrations]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*K.KEYS, *K.REGISTERED, "pipeline_name", "pipeline_id")))


def run(spark: SparkSession, plan: Plan, control: ControlStore, source: Callable[[str], DataFrame], target: Callable[[str], SnapshotTable], started_by: str = "", run_id: str | None = None, webhook: str | None = None, post: Callable | None = None, find_pipeline: Callable[[str], str | None] | None = None, alone: bool = False) -> Outcome:
    """Do all that is left of a plan. ``source`` and ``target`` give tables by name.

    Several runs may work side by side, as a table is claimed by one; with ``alone`` a run refuses
    to start beside another of its business unit. An error of one table fails that table. Whatever
    happens, the run's row is ended: COMPLETED, or FAILED if a table FAILED or was SKIPPED.
    Afterwards the session's time zone is what it was.
    """
    out = Outcome(run_id or uuid.uuid4().hex)
    control.ensure()
    if alone and not control.runs.read().where((F.col("business_unit") == plan.business_unit) & (F.col("status") == RunStatus.RUNNING)).isEmpty():
        raise RunActive(plan.business_unit)
    control.run_started(out.run_id, started_by)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", plan.zone)
    try:
        _work(spark, plan, control, source, target, out, find_pipeline)
        bad = K.headline(control.rows().where(F.col("run_id") == out.run_id)).first()
        out.ok = K.run_gate(control.rows(), out.run_id).first()["ok"]
        out.report = f"{plan.business_unit}, run {out.run_id}: {bad['total']} tables, {bad['attention']} need attention ({bad['parts']})"
        log.info(out.report)
        if bad["attention"]:
            notify(webhook, out.report, **({"post": post} if post else {}))
    finally:
        control.run_ended(out.run_id, RunStatus.COMPLETED if out.ok else RunStatus.FAILED)
        spark.conf.set("spark.sql.session.timeZone", zone)
    return out


def _work(spark: SparkSession, plan: Plan, control: ControlStore, source: Callable[[str], DataFrame], target: Callable[[str], SnapshotTable], out: Outcome, find_pipeline: Callable[[str], str | None] | None) -> None:
    owners = pipeline_owners(spark, [(t.name, t.target) for t in plan.migrations], find_pipeline)
    specs = registration(spark, plan, out.run_id, owners)
    out.resolved = K.resolved(specs).first()["resolved"]
    log.info("pipelines: %d of %d tables resolved", out.resolved, len(plan.migrations))
    control.register(specs)
    found = preflight(spark, plan.migrations, source, target)
    control.clear_skips([n for n, why in found.items() if why == "ok"])
    control.skip({n: why for n, why in found.items() if why != "ok"})
    todo = {r["table_name"] for r in K.work_list(specs, control.rows()).select("table_name").collect()}
    work = [t for t in plan.migrations if t.name in todo]
    out.work = [t.name for t in work]

    def one(t: Migration) -> None:
        try:
            migrate(spark, t, source(t.source), target(t.target), control, out.run_id, plan.policy)
        except Exception as e:  # such as a table that has gone since the checks
            log.exception("%s failed", t.name)
            control.fail(t.name, f"{type(e).__name__}: {e}")

    with ThreadPoolExecutor(max(1, plan.policy.threads)) as pool:
        list(pool.map(one, work))
