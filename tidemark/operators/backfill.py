"""Operators on source and target tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.functions import predicates as P


@dataclass(frozen=True)
class Cut:
    """What belongs to the history of a pair of tables."""

    column: str
    cut_off: str
    kind: DataType | None = None
    text: bool = False
    days: int | None = None

    @classmethod
    def of(cls, source: DataFrame, target: DataFrame, column: str, cut_off: str, days: int | None = None) -> Cut:
        """A text checkpoint on either side makes both compare as parsed texts."""
        a, b = P.type_of(source.schema, column), P.type_of(target.schema, column)
        return cls(column, cut_off, b, P.is_text(a, b), days)

    def history(self, windowed: bool = False) -> Column:
        return P.history(self.column, self.cut_off, self.kind, self.text, self.days if windowed else None)

    def live(self) -> Column:
        return P.live(self.column, self.cut_off, self.kind, self.text)


def survivors(target: DataFrame, doomed: Column) -> DataFrame:
    """What a delete leaves: rows for which the predicate is false or null."""
    return target.where(~F.coalesce(doomed, F.lit(False)))


def backfill(source: DataFrame, target: DataFrame, chosen: Column) -> DataFrame:
    """Chosen source rows with the target's columns in the target's order; a column that the source lacks is an error."""
    return source.where(chosen).select(*(P.quoted(c) for c in target.columns))


def migrated(source: DataFrame, target: DataFrame, cut: Cut, removed: Observation | None = None, added: Observation | None = None) -> DataFrame:
    """The target after its history was replaced by the source's (the window narrows the insert only).

    ``removed`` and ``added`` see the rows that go and come, while the result is written.
    """
    return _replaced(source, target, cut.history(), cut.history(windowed=True), removed, added)


def _replaced(source: DataFrame, target: DataFrame, doomed: Column, chosen: Column, removed: Observation | None, added: Observation | None) -> DataFrame:
    new = backfill(source, target, chosen)
    if added is not None:
        new = new.observe(added, F.count(F.lit(1)).alias("added"))
    return survivors(watched(target, doomed, removed), doomed).unionByName(new)


def source_count(source: DataFrame, cut: Cut) -> DataFrame:
    return source.where(cut.history(windowed=True)).agg(F.count("*").alias("share_count"))  # the filter reaches the scan


def target_counts(target: DataFrame, cut: Cut) -> DataFrame:
    """History, live rows and rows with no readable checkpoint, in one scan."""
    at = P.checkpoint(cut.column, cut.text)
    return target.agg(F.count_if(cut.history()).alias("target_le_cutoff"), F.count_if(cut.live()).alias("live_gt_cutoff"), F.count_if(at.isNull()).alias("no_checkpoint"))


def parity(source: DataFrame, before: DataFrame, after: DataFrame, cut: Cut) -> DataFrame:
    """One row: the counts that verify a migration and whether it holds."""
    a = before.where(cut.live()).agg(F.count("*").alias("live_before"))
    b = target_counts(after, cut).select("target_le_cutoff", F.col("live_gt_cutoff").alias("live_after"))
    one = F.lit(1).alias("one")  # three single rows
    out = source_count(source, cut).withColumn("one", one).join(a.withColumn("one", one), "one").join(b.withColumn("one", one), "one").drop("one")
    return out.withColumn("ok", (F.col("target_le_cutoff") == F.col("share_count")) & (F.col("live_after") >= F.col("live_before")))


def survey(frame: DataFrame, cut: Cut, partition: tuple[str, DataType] | None = None) -> DataFrame:
    """One row, from one scan of a side: windowed (history in the window), history, live, misaligned rows, and the texts of its partition values up to the cut-off."""
    if partition is None:
        misaligned, values = F.lit(0).cast("long"), F.array().cast("array<string>")
    else:
        misaligned = F.count_if(P.misaligned(cut.history(), *partition, cut.cut_off))
        values = F.array_sort(F.collect_set(F.when(P.within(*partition, cut.cut_off), P.quoted(partition[0]).cast("string"))))
    return frame.agg(F.count_if(cut.history(windowed=True)).alias("windowed"), F.count_if(cut.history()).alias("history"), F.count_if(cut.live()).alias("live"), misaligned.alias("misaligned"), values.alias("partition_values"))


def watched(frame: DataFrame, removed: Column, watch: Observation | None) -> DataFrame:
    """``frame``, counting on the way how many rows ``removed`` holds for (as removed)."""
    return frame if watch is None else frame.observe(watch, F.count_if(removed).alias("removed"))


def partitions(source: DataFrame, target: DataFrame, partition: str, kind: DataType, cut: Cut) -> DataFrame:
    """Distinct partition values of either side up to the cut-off, newest first."""
    own = [t.where(P.within(partition, kind, cut.cut_off)).select(P.quoted(partition).alias("value")) for t in (source, target)]
    return own[0].unionByName(own[1]).distinct().orderBy(F.desc("value"))


def left_to_do(values: DataFrame, watermark: Column | None) -> DataFrame:
    """Partitions older than the oldest one committed; all of them without a watermark."""
    return values if watermark is None else values.where(F.col("value") < watermark)


def slice_of(partition: str, kind: DataType, value: object, cut: Cut, windowed: bool = False) -> Column:
    return (P.quoted(partition) == P.partition_literal(value, kind)) & cut.history(windowed)


def replace_slice(source: DataFrame, target: DataFrame, partition: str, kind: DataType, value: object, cut: Cut, removed: Observation | None = None, added: Observation | None = None) -> DataFrame:
    """The target after one partition's history was replaced."""
    return _replaced(source, target, slice_of(partition, kind, value, cut), slice_of(partition, kind, value, cut, windowed=True), removed, added)


def misalignment(frame: DataFrame, partition: str, kind: DataType, cut: Cut) -> DataFrame:
    """How many rows of history the partition bound would miss."""
    return frame.where(P.misaligned(cut.history(), partition, kind, cut.cut_off)).agg(F.count("*").alias("misaligned"))


def aligned(partition: str, kind: DataType, cut: Cut, *frames: DataFrame) -> bool:
    """Whether no frame has misaligned history; stops at the first found."""
    return all(f.where(P.misaligned(cut.history(), partition, kind, cut.cut_off)).limit(1).isEmpty() for f in frames)


def pruned_delete(partition: str, kind: DataType, cut: Cut) -> Column:
    """The delete predicate with a partition bound that scans can prune by; the same rows where aligned."""
    return (P.quoted(partition) <= P.bound(cut.cut_off, kind)) & cut.history()


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of each side that the other lacks, as counts; both 0 for equal multisets."""
    signed = a.withColumn("__side", F.lit(1)).unionByName(b.withColumn("__side", F.lit(-1)))
    per = signed.groupBy(*(P.quoted(c) for c in a.columns)).agg(F.sum("__side").alias("__n"))
    return per.agg(F.coalesce(F.sum(F.greatest("__n", F.lit(0))), F.lit(0)).cast("long").alias("only_left"), F.coalesce(F.sum(F.greatest(-F.col("__n"), F.lit(0))), F.lit(0)).cast("long").alias("only_right"))
