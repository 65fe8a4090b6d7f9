"""The control and run tables on the snapshot store; every change is a compare-and-set commit."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.retry import retry
from tidemark.operators import control as K
from tidemark.plans.specs import RunStatus, Status
from tidemark.sources.store import ConcurrentCommit, SnapshotTable

KEPT = 64  #: versions of the control table that stay


@dataclass
class _Change:
    """A change that waits for its commit, and the row that its caller wants to see afterwards."""

    apply: Callable[[DataFrame], DataFrame]
    table_name: str | None = None
    done: bool = False
    row: Row | None = None
    error: BaseException | None = None


class ControlStore:
    """Changes that come while another is being committed wait and are committed together, by one job; rows asked for are read by one more."""

    def __init__(self, spark: SparkSession, path: str, business_unit: str, clock: Callable[[], datetime] | None = None) -> None:
        self.spark, self.unit, self.clock = spark, business_unit, clock
        self.table, self.runs = SnapshotTable(spark, f"{path}/control"), SnapshotTable(spark, f"{path}/runs")
        self.lock, self.waiting, self.commits = threading.Lock(), [], 0

    def now(self) -> Column:
        return F.current_timestamp() if self.clock is None else F.lit(self.clock()).cast("timestamp")

    def ensure(self) -> None:
        """Create the tables, or bring older ones up to date."""
        self.table.create(K.SCHEMA)
        self.runs.create(K.RUNS)
        if not {f.name for f in K.SCHEMA.fields} <= set(self.table.schema().names):
            retry(lambda: self.table.evolve(K.evolve), ConcurrentCommit, 8, 1.0, 8.0)

    def change(self, f: Callable[[DataFrame], DataFrame], table_name: str | None = None) -> Row | None:
        """Commit a change, alone or with others that wait; the row of ``table_name`` after it."""
        own = _Change(f, table_name)
        self.waiting.append(own)
        with self.lock:
            if not own.done:
                batch, self.waiting = self.waiting, []
                self._commit(batch)
        if own.error:
            raise own.error
        return own.row

    def _commit(self, batch: list[_Change]) -> None:
        def all_of(df: DataFrame) -> DataFrame:
            for c in batch:
                df = c.apply(df)
            return df.coalesce(1)

        try:
            at = retry(lambda: self.table.rewrite(all_of), ConcurrentCommit, 8, 0.2, 8.0)
            asked = {c.table_name for c in batch if c.table_name is not None}
            if asked:
                found = {r["table_name"]: r for r in self.table.read(at).where((F.col("business_unit") == self.unit) & F.col("table_name").isin(*asked)).collect()}
                for c in batch:
                    c.row = found.get(c.table_name)
            self.commits += 1
            if self.commits % KEPT == 0:
                self.table.trim(KEPT)
        except BaseException as e:
            for c in batch:
                c.error = e
        finally:
            for c in batch:
                c.done = True

    def key(self, table_name: str) -> Column:
        return K.key_is(self.unit, table_name)

    def rows(self) -> DataFrame:
        return self.table.read()

    def row(self, table_name: str) -> Row | None:
        return next(iter(self.rows().where(self.key(table_name)).take(1)), None)

    def register(self, specs: DataFrame) -> None:
        self.change(lambda df: K.register(df, specs, self.now()))

    def claim(self, table_name: str, run: str, minutes: int) -> bool:
        row = self.change(lambda df: K.claim(df, self.key(table_name), run, self.now(), minutes), table_name)
        return row is not None and row["owner_run_id"] == run and row["status"] not in Status.DONE

    def begin(self, table_name: str, run: str, minutes: int) -> Row | None:
        """Claim and mark the start, in one change; the row, if the claim has won."""
        key = self.key(table_name)

        def both(df: DataFrame) -> DataFrame:
            claimed = K.claim(df, key, run, self.now(), minutes)
            return K.mark_start(claimed, self._own(table_name, run) & ~F.col("status").isin(*Status.DONE), self.now())

        row = self.change(both, table_name)
        return row if row is not None and row["owner_run_id"] == run and row["status"] == Status.IN_PROGRESS else None

    def finish(self, table_name: str, run: str, **values: object) -> None:
        """Set columns, mark the end and release, in one change, unless another run owns the row by now."""
        own = self._own(table_name, run)

        def all_of(df: DataFrame) -> DataFrame:
            df = K.update(df, own, {k: F.lit(v) for k, v in values.items()}, self.now()) if values else df
            return K.release(K.mark_end(df, own, self.now()), self.key(table_name), run, self.now())

        self.change(all_of)

    def renew(self, table_name: str, run: str, minutes: int) -> bool:
        row = self.change(lambda df: K.renew(df, self.key(table_name), run, self.now(), minutes), table_name)
        return row is not None and row["owner_run_id"] == run

    def release(self, table_name: str, run: str) -> None:
        self.change(lambda df: K.release(df, self.key(table_name), run, self.now()))

    def set(self, table_name: str, run: str, **values: object) -> None:
        """Set columns of a row, unless another run owns it by now."""
        self.change(lambda df: K.update(df, self._own(table_name, run), {k: F.lit(v) for k, v in values.items()}, self.now()))

    def _own(self, table_name: str, run: str) -> Column:
        return self.key(table_name) & (F.col("owner_run_id") == run)

    def fail(self, table_name: str, why: str) -> None:
        """FAILED with a reason, for a table that nobody has claimed."""
        free = self.key(table_name) & F.col("owner_run_id").isNull() & ~F.col("status").isin(*Status.DONE)
        self.change(lambda df: K.update(df, free, {"status": F.lit(Status.FAILED), "error_message": F.lit(why[:2000])}, self.now()))

    def skip(self, reasons: dict[str, str]) -> None:
        """SKIPPED with a reason for each table, unless it is SUCCESS; one commit for all."""
        if reasons:
            listed = self.spark.createDataFrame(list(reasons.items()), "table_name string, skip_reason string")
            self.change(lambda df: K.skip_listed(df, listed, self.unit, self.now()))

    def clear_skips(self, names: list[str]) -> None:
        if names:
            listed = self.spark.createDataFrame([(n,) for n in names], "table_name string")
            self.change(lambda df: K.clear_skips(df, listed, self.unit, self.now()))

    def run_started(self, run: str, by: str) -> None:
        row = self.spark.range(1).select(F.lit(run).alias("run_id"), F.lit(self.unit).alias("business_unit"), F.lit(RunStatus.RUNNING).alias("status"), F.lit(by).alias("started_by"), self.now().alias("start_ts"), F.lit(None).cast("timestamp").alias("end_ts"))
        self.runs.append(row)

    def run_ended(self, run: str, status: str) -> None:
        change = lambda df: K.end_run(df, run, status, self.now()).coalesce(1)
        retry(lambda: self.runs.rewrite(change, late=F.lit(False)), ConcurrentCommit, 8, 0.2, 8.0)
