"""Predicates on checkpoints and partitions, as Columns; nothing is spliced into SQL text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructType, TimestampNTZType, TimestampType

CHECKPOINT_TYPES = (TimestampType, TimestampNTZType, DateType, StringType)
PARTITION_TYPES = (TimestampType, TimestampNTZType, DateType)


def quoted(name: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(schema: StructType, name: str) -> DataType | None:
    """The type of a column, matched without regard to case; None if it is absent."""
    return next((f.dataType for f in schema.fields if f.name.lower() == name.lower()), None)


def is_text(*types: DataType | None) -> bool:
    return any(isinstance(t, StringType) for t in types)


def checkpoint(name: str, text: bool = False) -> Column:
    """The checkpoint: the raw column, so that files can be skipped by it, or a tolerant parse of a text (bad ones are null)."""
    return quoted(name).try_cast("timestamp") if text else quoted(name)


def moment(cut_off: str, kind: DataType | None = None) -> Column:
    """A cut-off as a literal: wall clock for columns without zone, else in the session's zone."""
    return F.lit(cut_off).cast("timestamp_ntz" if isinstance(kind, TimestampNTZType) else "timestamp")


def history(name: str, cut_off: str, kind: DataType | None = None, text: bool = False, days: int | None = None) -> Column:
    """checkpoint <= cut-off, and with ``days`` also > cut-off minus that many days; null for a null checkpoint."""
    at, when = checkpoint(name, text), moment(cut_off, None if text else kind)
    out = at <= when
    return out if days is None else out & (at > when - F.make_dt_interval(F.lit(days)))


def live(name: str, cut_off: str, kind: DataType | None = None, text: bool = False) -> Column:
    """checkpoint > cut-off."""
    return checkpoint(name, text) > moment(cut_off, None if text else kind)


def bound(cut_off: str, kind: DataType) -> Column | None:
    """The cut-off in the type of a partition column; None if that isn't a date or timestamp."""
    if not isinstance(kind, PARTITION_TYPES):
        return None
    return F.lit(cut_off).cast("timestamp_ntz").cast("date") if isinstance(kind, DateType) else moment(cut_off, kind)


def partition_literal(value: object, kind: DataType) -> Column:
    """A partition's value as a literal of its type."""
    return F.lit(value).cast(kind)


def within(partition: str, kind: DataType, cut_off: str) -> Column:
    """Partitions that history can lie in."""
    return quoted(partition).isNotNull() & (quoted(partition) <= bound(cut_off, kind))


def misaligned(history_of: Column, partition: str, kind: DataType, cut_off: str) -> Column:
    """History in a null partition or one beyond the cut-off: there a pruned delete would miss rows."""
    return history_of & (quoted(partition).isNull() | (quoted(partition) > bound(cut_off, kind)))


def claimable(run: str, now: Column) -> Column:
    """Not done, and free: no owner, the same owner, or a lease that is missing or over. A null status isn't claimable."""
    from tidemark.plans.specs import Status

    free = F.col("owner_run_id").isNull() | (F.col("owner_run_id") == run) | F.col("lease_until").isNull() | (F.col("lease_until") < now)
    return F.coalesce(~F.col("status").isin(*Status.DONE) & free, F.lit(False))
