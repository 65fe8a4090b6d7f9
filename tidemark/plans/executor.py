"""The migration of one table: claim, replace the history, verify."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql.types import DataType

from tidemark.functions.retry import retry
from tidemark.operators import backfill as B
from tidemark.plans.specs import Migration, Policy, Status
from tidemark.sources.config import chunk_mode
from tidemark.sources.control_store import ControlStore
from tidemark.sources.metadata import discover, resolve
from tidemark.sources.store import ConcurrentCommit, SnapshotTable

log = logging.getLogger(__name__)


class LeaseLost(RuntimeError):
    pass


class Heartbeat:
    """Calls ``renew`` every so many seconds in the background; ``check`` raises once it has said that the lease is lost."""

    def __init__(self, renew: Callable[[], bool], every_s: float) -> None:
        self.renew, self.every, self.lost, self.done = renew, every_s, threading.Event(), threading.Event()
        self.thread = threading.Thread(target=self._run, daemon=True)

    def _run(self) -> None:
        while not self.done.wait(self.every):
            try:
                if not self.renew():
                    self.lost.set()
                    return
            except Exception:
                log.exception("a lease could not be renewed; it is tried again")

    def __enter__(self) -> Heartbeat:
        self.thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self.done.set()

    def check(self) -> None:
        if self.lost.is_set():
            raise LeaseLost("another run has taken the table over")


@dataclass(frozen=True)
class Mode:
    """How a table is replaced, and what one scan of each side has found."""

    chunked: bool
    partition: str | None
    kind: DataType | None
    source: Row
    target: Row

    def values(self) -> list[str]:
        """Partition values of either side up to the cut-off, newest first."""
        return sorted({*self.source["partition_values"], *self.target["partition_values"]}, reverse=True)


def choose(task: Migration, cut: B.Cut, columns: list[str], source: DataFrame, target: DataFrame) -> Mode:
    """Chunked or at once, and the partition column that deletes may be bounded by.

    A partition column, configured or found (in mode auto), counts only if no history of either
    side lies in a null partition or one beyond the cut-off. Both sides are scanned once.
    """
    mode = chunk_mode(task.slicing.mode, strict=False)
    found = resolve(task.slicing.column, columns, target.schema)
    if found is None and mode == "auto":
        found = discover(columns, target.schema)
    if found and found[0].lower() not in (c.lower() for c in source.columns):
        found = None
    of_source, of_target = (B.survey(side, cut, found).first() for side in (source, target))
    if found and of_source["misaligned"] + of_target["misaligned"]:
        log.warning("%s: %s is not aligned with %s; all is done at once", task.name, found[0], task.history.column)
        found = None
    if mode == "on" and found is None:
        log.warning("%s: no partition column to chunk by; all is done at once", task.name)
    return Mode(mode != "off" and found is not None, *(found or (None, None)), of_source, of_target)


def migrate(spark: SparkSession, task: Migration, source: DataFrame, target: SnapshotTable, control: ControlStore, run: str, policy: Policy = Policy(), at_commit: Callable[[str], object] = lambda step: None) -> str:  # noqa: B008
    """Migrate one registered table; its status at the end, or CLAIMED_ELSEWHERE.

    A replacement (of the table, its bounded partitions, or one slice) is one commit of the target,
    so a crash leaves either state and a rerun does the same again. Slices go from new to old; the
    oldest one done is the watermark that a rerun resumes below, unless cut-off or window changed.
    Appends that come meanwhile neither stop a replacement nor get lost. ``at_commit`` is called
    after each commit of the target (for tests).
    """
    before = control.row(task.name)
    if before is None or before["status"] in Status.DONE:
        return before["status"] if before else Status.SKIPPED
    row = control.begin(task.name, run, policy.lease_minutes)
    if row is None:
        return Status.CLAIMED_ELSEWHERE
    try:
        with Heartbeat(lambda: control.renew(task.name, run, policy.lease_minutes), policy.renewal()) as beat:
            end = _replace_and_verify(task, source, target, control, run, policy, row, beat, at_commit)
    except Exception as e:  # the table failed, not the run
        log.exception("%s failed", task.name)
        end = {"status": Status.FAILED, "error_message": f"{type(e).__name__}: {e}"[:2000]}
    control.finish(task.name, run, **end)
    return end["status"]


def _replace_and_verify(task: Migration, source: DataFrame, target: SnapshotTable, control: ControlStore, run: str, policy: Policy, row: Row, beat: Heartbeat, at_commit: Callable[[str], object]) -> dict[str, object]:
    """Does the work; the columns that the row shall have at the end."""
    save = lambda **values: control.set(task.name, run, **values)
    at = target.manifest()
    old = target.read(at)
    cut = B.Cut.of(source, old, task.history.column, task.history.cut_off, task.history.days)
    mode = choose(task, cut, [at.partition] if at.partition else [], source, old)
    share, live = mode.source["windowed"], mode.target["live"]
    counts = {"share_count": share, "live_gt_cutoff_before": live}
    if share == 0:
        return counts | {"status": Status.SUCCESS, "target_le_cutoff_count": mode.target["history"], "deleted_count": 0, "inserted_count": 0}

    deleted = inserted = 0

    def commit(change: Callable[..., DataFrame], doomed: Column, values: list[str] | None) -> None:
        """One replacement, counted while it is written."""
        nonlocal deleted, inserted

        def once() -> tuple[Observation, Observation]:
            removed, added = Observation(), Observation()
            target.rewrite(lambda df: change(df, removed, added), values=values, late=doomed)
            return removed, added

        beat.check()
        removed, added = retry(once, ConcurrentCommit, policy.tries, policy.first_wait_s)
        deleted, inserted = deleted + removed.get["removed"], inserted + added.get["added"]

    plan = f"{cut.column} <= {cut.cut_off!r}, days {cut.days}, by {mode.partition}"
    if mode.chunked:
        mark = row["backfill_oldest_partition"] if row["delete_predicate"] == plan else None
        newest = row["backfill_newest_partition"] if mark else None
        if mark:
            deleted, inserted = row["deleted_count"] or 0, row["inserted_count"] or 0
        save(**counts, partition_pruned=True, delete_predicate=plan, **({} if mark else {"backfill_newest_partition": None, "backfill_oldest_partition": None}))
        for value in [v for v in mode.values() if mark is None or v < mark]:
            doomed = B.slice_of(mode.partition, mode.kind, value, cut)
            commit(lambda df, removed, added, v=value: B.replace_slice(source, df, mode.partition, mode.kind, v, cut, removed, added), doomed, [value])
            at_commit(value)
            newest = newest or value
            save(backfill_newest_partition=newest, backfill_oldest_partition=value, deleted_count=deleted, inserted_count=inserted)
    else:
        save(**counts, partition_pruned=mode.partition is not None, delete_predicate=plan)
        commit(lambda df, removed, added: B.migrated(source, df, cut, removed, added), cut.history(), mode.values() if mode.partition else None)
        at_commit("all")
    save(status=Status.BACKFILLED, deleted_count=deleted, inserted_count=inserted)

    after = B.target_counts(target.read(), cut).first()
    out = {"target_le_cutoff_count": after["target_le_cutoff"], "live_gt_cutoff_after": after["live_gt_cutoff"]}
    if after["target_le_cutoff"] != share or after["live_gt_cutoff"] < live:
        why = f"verify: source {share}, target {after['target_le_cutoff']}; live {live} before, {after['live_gt_cutoff']} after"
        return out | {"status": Status.FAILED, "error_message": why, "backfill_newest_partition": None, "backfill_oldest_partition": None}
    if policy.vacuum:
        try:
            target.vacuum(policy.vacuum.hours, policy.vacuum.override)
        except Exception:
            log.exception("%s: vacuum failed; the migration stands", task.name)
    return out | {"status": Status.SUCCESS}
