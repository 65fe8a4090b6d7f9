"""Exact deduplication by Grace hashing."""

from __future__ import annotations

import hashlib
import os
import pickle
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, join_classes, lean, materialize, text_of

FAN_OUT = 16  #: spill files a level
LEVELS = 14  #: levels that the 64 bits of a hash serve, after the bits that dealt the bucket out

_HEADS = pa.schema([("h", pa.int64()), ("content", pa.binary()), ("n", pa.int64()), ("keep_id", pa.int64())])
_CLASSES = pa.schema([("sha", pa.binary()), ("n_bytes", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


class OpenTable:
    """Open addressing with linear probing; equal means equal content, the hash only finds the slot."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.counts: list[int] = []
        self.keeps: list[int | None] = []
        self.bytes = 0

    def _slot(self, h: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        i = (h ^ h >> 29) & mask
        while (at := self.slots[i]) >= 0 and not (self.hashes[at] == h and self.contents[at] == content):
            i = i + 1 & mask
        return i

    def add(self, h: int, content: bytes, n: int, keep: int | None) -> None:
        i = self._slot(h, content)
        at = self.slots[i]
        if at >= 0:
            self.counts[at] += n
            if keep is not None and (self.keeps[at] is None or keep > self.keeps[at]):
                self.keeps[at] = keep
            return
        self.slots[i] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.counts.append(n)
        self.keeps.append(keep)
        self.bytes += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self.slots = np.full(4 * len(self.slots), -1, np.int64)
            for k, (x, c) in enumerate(zip(self.hashes, self.contents, strict=True)):
                self.slots[self._slot(x, c)] = k

    def records(self) -> Iterator[tuple[int, bytes, int, int | None]]:
        return zip(self.hashes, self.contents, self.counts, self.keeps, strict=True)


class SpillFile:
    """Records of one sub-bucket in a file of the task's own temporary folder."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.file = open(path, "wb")  # noqa: SIM115

    def add(self, record: tuple) -> None:
        pickle.dump(record, self.file, 5)

    def read(self) -> Iterator[tuple]:
        self.file.close()
        with open(self.path, "rb") as f:
            while True:
                try:
                    yield pickle.load(f)
                except EOFError:
                    break
        os.unlink(self.path)


def grace(records: Iterator[tuple[int, bytes, int, int | None]], memory: int, level: int = 0) -> Iterator[OpenTable]:
    """Tables that together hold every distinct content of ``records`` once.

    Contents are counted together in a table until it takes more than ``memory`` bytes; then it and
    what is still to come are dealt to FAN_OUT spill files by the next bits of the hash, and each
    file is treated alike. Copies never force a split, as a table holds a content once. When the
    bits are used up (different contents of one 64-bit hash), the table is kept whatever its size.
    """
    table = OpenTable()
    for r in records:
        table.add(*r)
        if table.bytes > memory and level < LEVELS and len(table.contents) > 1:
            break
    else:
        if table.contents:
            yield table
        return
    folder = tempfile.mkdtemp(prefix="grace-")
    try:
        files = [SpillFile(f"{folder}/{i}") for i in range(FAN_OUT)]
        for part in (table.records(), records):
            for r in part:
                files[r[0] >> 4 * level & FAN_OUT - 1].add(r)
            table = None
        for f in files:
            yield from grace(f.read(), memory, level + 1)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def exact_dedup(docs: DataFrame, memory: int = 96 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Scan tasks count copies among each batch of their rows, so a text that fills a third of the
    table reaches its bucket once a batch; buckets of the content hash are then deduplicated by
    ``grace``. Rows find their class by SHA-256 and length, which a bucket checks to be unique
    among different contents.

    Of equal texts the largest id stays. Null text counts as empty, and all empty texts are equal.
    A null id stays only where the group has no other; then keep_id is null. Of rows that repeat
    both id and text exactly one is kept. Any length of text is compared whole. An empty table
    gives no rows; other columns are not read.
    """
    batches = lean(docs).select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def heads(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(table: OpenTable) -> Iterator[pa.RecordBatch]:
            rows = list(table.records())
            for i in range(0, len(rows), 256):
                h, content, n, keep = zip(*rows[i : i + 256], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(content, pa.binary()), pa.array(n, pa.int64()), pa.array(keep, pa.int64())], schema=_HEADS)

        table = OpenTable()
        for batch in it:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                table.add(xxhash.xxh3_64_intdigest(text) >> 1, text, 1, doc)
                if table.bytes > memory // 2:
                    yield from flush(table)
                    table = OpenTable()
        yield from flush(table)

    def classes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (r for b in it for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for table in grace(records, memory):
            found: dict[tuple[bytes, int], bytes] = {}
            several: list[tuple] = []
            for _, content, n, keep in table.records():
                key = (hashlib.sha256(content).digest(), len(content))
                if found.setdefault(key, content) is not content:
                    raise ValueError("two contents share a SHA-256 and a length")
                if n > 1:
                    several.append((*key, keep, n))
            for i in range(0, len(several), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*several[i : i + 4096], strict=True), _CLASSES, strict=True)], schema=_CLASSES)

    groups = batches.mapInArrow(heads, "h long, content binary, n long, keep_id long").repartition("h").mapInArrow(classes, "sha binary, n_bytes long, keep_id long, group_size long")
    rows = batches.select("id", F.unhex(F.sha2(F.col("text"), 256)).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")).groupBy("id", "sha", "n_bytes").agg(F.count("*").alias("times"))
    groups = materialize(groups, "groups")
    joined = join_classes(rows, groups, ["sha", "n_bytes"], "group_size", docs.count()).withColumn("group_size", F.coalesce("group_size", F.lit(1))).withColumn("keep_id", F.when(F.col("group_size") == 1, F.col("id")).otherwise(F.col("keep_id")))
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return each.select(F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns.

    A null text counts as empty; of rows that repeat both id and text one stays, whichever.
    """
    found = materialize(exact_dedup(docs, id_col=id_col, text_col=text_col).select("doc_id", "text_sha256", "kept"), "exact")
    each = found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("any"), F.count("*").alias("n"))
    own, sha, text = (fresh(docs, c) for c in ("gone_id", "gone_sha", "whole_text"))
    gone = each.where("not any").select(F.col("doc_id").alias(own), F.col("text_sha256").alias(sha))
    out = docs.join(gone, docs[id_col].cast("long").eqNullSafe(F.col(own)) & (F.sha2(text_of(text_col), 256) == F.col(sha)), "left_anti")
    if not each.where("any and n > 1").isEmpty():  # rows that repeat id and text
        out = out.withColumn(text, text_of(text_col)).dropDuplicates([id_col, text]).drop(text)
    return out


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
