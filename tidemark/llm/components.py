"""Connected components by alternating stars over DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialize


HUB = 4096  #: edges of a node that one task takes in any case


class UnionFind:
    """Sets of 0..n-1; a set's root is its least member."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], np.int64)


def contract(edges: DataFrame, batch: int = 1 << 18) -> DataFrame:
    """Edges (u, v) of each task, some 2**18 at a time, as stars around their components' least members."""

    def stars(us: list[np.ndarray], vs: list[np.ndarray]) -> pa.RecordBatch:
        ids, at = np.unique(np.concatenate([*us, *vs]), return_inverse=True)
        half, sets = len(at) // 2, UnionFind(len(ids))
        for a, b in zip(at[:half].tolist(), at[half:].tolist(), strict=True):
            sets.join(a, b)
        roots = sets.roots()
        leaf = roots != np.arange(len(ids))
        return pa.RecordBatch.from_arrays([pa.array(ids[leaf]), pa.array(ids[roots[leaf]])], names=["u", "v"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, n = [], [], 0
        for b in it:
            us.append(b.column(0).to_numpy())
            vs.append(b.column(1).to_numpy())
            n += len(b)
            if n >= batch:
                yield stars(us, vs)
                us, vs, n = [], [], 0
        if n:
            yield stars(us, vs)

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def _join_least(edges: DataFrame, least: DataFrame, rows: int) -> DataFrame:
    """Edges (u, v) with the m of their u. A hub's edges are dealt to parts, each with a copy of its m.

    A hub has more than rows / 1,000,000 edges (and more than HUB), so there are at most 1,000,000
    hubs: their names and numbers of parts, 12 bytes each, are broadcast.
    """
    limit = max(HUB, rows // 1_000_000)
    least = least.withColumn("parts", F.ceil(F.col("degree") / limit).cast("int")).drop("degree")
    hubs = F.broadcast(least.where("parts > 1").select("u", "parts"))
    dealt = edges.join(hubs, "u", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("v"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
    copies = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(F.col("parts"), F.lit(1)) - 1))).drop("parts")
    return dealt.join(copies, ["u", "part"]).drop("part")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of the nodes of ``edges`` (u, v: long), component being the least id reachable.

    Large and small stars alternate until nothing changes; each round is written to the shared
    folder. Minima are pre-aggregated, and a hub's edges are dealt to several tasks for the join
    with its minimum. Loops and repeated edges do no harm; edges with nulls are left out; no edges
    give no rows.
    """
    now = materialize(contract(edges.where("u is not null and v is not null and u <> v")), "stars")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not seen[0]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        mark, rows = seen, 2 * seen[0]
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")).withColumn("m", F.least("u", "m"))
        large = _join_least(both.where("v > u"), least, rows).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
        small = _join_least(down, low, rows).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        new = materialize(small, "stars")
        discard(now)
        now = new
