"""Near-duplicate documents by SetSketch: banded registers, joint estimates, exact verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discard, fresh, join_classes, lean, materialize, text_of
from tidemark.llm.components import components
from tidemark.llm.textkit import LOWER, Block, blocks, hash_spans, mix, spread

SHINGLE = 5
M = 128  #: registers
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 1  #: register = trunc(1 - log_BASE(least value)), values Exp(RATE)
ROWS = 4  #: registers of a band: at similarity 0.75 all 32 bands miss with probability 5e-6
BANDS = M // ROWS
NUMBER, OF = 75, 100  #: linked if OF * intersection >= NUMBER * union
SURE, DOUBT = 0.80, 0.57  #: estimates above are verified first; below (4.7 standard errors) never
TEXT = 1 << 20  #: bytes of text prepared at once
TOGETHER = 2048  #: documents compared with each other in one task

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 5-word shingles (or all words as one, if fewer) by text: two independent 64-bit hashes of each, n + 1 bounds.

    A shingle is both its hashes: two different ones agree in both with odds of 2**-128.
    """
    s, e, first = block.words()
    count = np.diff(first)
    n = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    start = np.repeat(first[:-1], n) + spread(n)
    size = np.repeat(np.minimum(count, SHINGLE), n)
    data = LOWER[block.data]

    def chain(seed: int) -> np.ndarray:
        h = mix(size.astype(np.uint64) * _GOLD + np.uint64(seed))
        padded = np.append(hash_spans(data, s, e, seed), np.zeros(SHINGLE, np.uint64))
        for j in range(SHINGLE):
            h = np.where(j < size, mix(h * np.uint64(0xD1342543DE82EF95) + padded[start + j]), h)
        return h

    one, two = chain(0), chain(1)
    doc = np.repeat(np.arange(block.n), n)
    order = np.lexsort((one, doc))
    if len(order) and ((doc[order][1:] == doc[order][:-1]) & (one[order][1:] == one[order][:-1]) & (two[order][1:] != two[order][:-1])).any():
        order = np.lexsort((two, one, doc))
    doc, one, two = doc[order], one[order], two[order]
    new = np.ones(len(one), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return one[new], two[new], np.searchsorted(doc[new], np.arange(block.n + 1))


def sketch(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SetSketches (uint16, a row a set) of sets of hashes.

    An element's values are a Poisson process of rate M with uniform registers, which gives every
    register independent exponential values. A set's registers are full long before an element's
    later points matter, so points are made only up to a time that fills all but surely; sets with
    an empty register are made again with twice the time.
    """
    n = np.diff(bounds)
    least = np.full(len(n) * M, np.inf)
    todo, times = np.flatnonzero(n > 0), np.log(M) + 12.0
    while len(todo):
        horizon = times / np.maximum(n, 1)
        doc = np.repeat(todo, n[todo])
        e = hashes[np.repeat(bounds[:-1][todo], n[todo]) + spread(n[todo])]
        x, end, step = np.zeros(len(e)), horizon[doc], 0
        while len(e):
            step = (step + int(_GOLD)) % 2**64
            h = mix(e + np.uint64(step))
            x = x - np.log(((h >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / M
            on = x < end
            e, x, end, doc, h = e[on], x[on], end[on], doc[on], h[on]
            np.minimum.at(least, doc * M + (h & np.uint64(M - 1)).astype(np.int64), x)
        empty = np.isinf(least.reshape(-1, M)).any(1)
        todo, times = todo[empty[todo]], 2 * times
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(k, 0, LIMIT).astype(np.uint16).reshape(-1, M)


def likely(one: np.ndarray, n_one: int, many: np.ndarray, n_many: np.ndarray, j: float) -> np.ndarray:
    """Whether the joint maximum-likelihood estimate of the similarity is at least ``j``.

    The likelihood of (greater, smaller, equal) registers given the sizes is concave in the
    similarity, so its derivative at ``j`` tells. Sizes too different for the threshold exclude.
    """
    up, down = (one > many).sum(1), (one < many).sum(1)
    same = M - up - down
    u = n_one / (n_one + n_many)
    v = 1 - u
    c = (BASE - 1) / BASE
    log_b = np.log(BASE)
    x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
    p, q = -np.log1p(-x * c) / log_b, -np.log1p(-y * c) / log_b
    dp, dq = -v * c / (log_b * (1 - x * c)), -u * c / (log_b * (1 - y * c))
    slope = up * dp / p + down * dq / q - same * (dp + dq) / np.maximum(1 - p - q, 1e-12)
    return (slope >= 0) & (OF * np.minimum(n_one, n_many) >= NUMBER * np.maximum(n_one, n_many))


def forest(label: np.ndarray, side: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that ``linked(i, others)`` confirms, over rows that are connected where labels agree.

    Pairs that are connected already are never compared. With two sides, only pairs across are.
    ``label`` is brought up to date.
    """
    out = []
    two = side.any() and not side.all()
    for i in range(len(label) - 1):
        rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if two:
            rest = rest[side[rest] != side[i]]
        for k in (linked(i, rest) if len(rest) else rest).tolist():
            if label[k] != label[i]:
                label[label == label[k]] = label[i]
                out.append((i, k))
    return out


def candidate_forest(n: np.ndarray, registers: np.ndarray, label: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that may be linked."""
    return forest(label, side, lambda i, rest: rest[likely(registers[i], n[i], registers[rest], n[rest], DOUBT)])


def verified_links(n: np.ndarray, registers: np.ndarray, sets: list[np.ndarray], label: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links, confirmed on full sets (2 x n hashes each); likely pairs first."""

    def confirmed(i: int, rest: np.ndarray, level: float) -> np.ndarray:
        rest = rest[likely(registers[i], n[i], registers[rest], n[rest], level)]
        if not len(rest):
            return rest
        size = n[rest]
        flat = np.concatenate([sets[k] for k in rest], 1)
        at = np.minimum(np.searchsorted(sets[i][0], flat[0]), n[i] - 1)
        both = np.add.reduceat((sets[i][:, at] == flat).all(0).astype(np.int64), np.cumsum(size) - size)
        return rest[OF * both >= NUMBER * (n[i] + size - both)]

    return [pair for level in (SURE, DOUBT) for pair in forest(label, side, lambda i, rest: confirmed(i, rest, level))]


def _linked(pairs: list[tuple[int, int]], ids: np.ndarray) -> pa.Table:
    a = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"u": pa.array(ids[a[:, 0]]), "v": pa.array(ids[a[:, 1]])})


def connect(groups: DataFrame, payload: Callable[[DataFrame], DataFrame], compare: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """(id, component): what ``compare`` connects inside each group of ``groups`` (key, c: rows of the key, id).

    ``payload(ids)`` gives id and what ``compare`` needs of it. Groups of at most TOGETHER rows are
    compared at once. Larger ones are dealt to blocks, by other hashes in each group. Then the least
    members of what is connected so far are compared, as long as that connects more; and only where
    a large group is still in several pieces, every two blocks of it, leaving out pairs connected
    already. So a large group of like documents costs one block a row, and no pair is lost.
    """

    def links(rows: DataFrame) -> DataFrame:
        each = rows.join(payload(rows.select("id").distinct()), "id")
        return each.groupBy("key", "lo", "hi").applyInArrow(compare, "u long, v long")

    def dealt(rows: DataFrame, count: str, salt: int) -> DataFrame:
        own = F.pmod(F.xxhash64(F.lit(salt), "key", "id"), F.ceil(F.col(count) / TOGETHER)).cast("int")
        return rows.select("key", "id", "label", own.alias("lo"), own.alias("hi"), F.lit(True).alias("side"))

    found = materialize(components(links(dealt(groups.withColumn("label", F.col("id")), "c", 3))), "connected")
    large = groups.where(F.col("c") > TOGETHER)
    if large.isEmpty():
        return found
    edges = lambda: found.select(F.col("id").alias("u"), F.col("component").alias("v")).where("u <> v")
    pieces = lambda: large.join(found, "id", "left").withColumn("label", F.coalesce("component", "id"))

    def several(rows: DataFrame) -> DataFrame:
        return rows.join(rows.groupBy("key").agg(F.count_distinct("label").alias("pieces")).where("pieces > 1"), "key")

    salt, before = 4, -1
    while True:
        heads = several(pieces().groupBy("key", "label").agg(F.min("id").alias("id")))
        left = heads.agg(F.count("*")).first()[0]
        if left in (0, before):
            break
        found = materialize(components(links(dealt(heads, "pieces", salt)).unionByName(edges())), "connected")
        salt, before = salt + 1, left
    if left:
        parts = F.ceil(F.col("c") / TOGETHER).cast("int")
        rows = several(pieces()).withColumn("own", F.pmod(F.xxhash64(F.lit(salt), "key", "id"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        rows = rows.select("key", "id", "label", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") <= F.col("other")).alias("side"))
        found = materialize(components(links(rows).unionByName(edges())), "connected")
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the component's least id) of each row.

    Rows with the same set form a class, represented by its least id. Representatives are sketched
    and banded; buckets that hold the same documents are taken once. In each bucket a spanning
    forest of the pairs with a likely estimate is emitted, never all pairs; its components are the
    only places where links can be. There pairs are verified on full sets, except between documents
    that are connected already, and again only a forest of links leaves the task (``connect``). A
    full set is the two independent 64-bit hashes of every shingle: links and classes are wrong only
    if different shingles agree in both (2**-128 a pair).

    Null and empty texts have no shingles and are linked with nothing. A null id has no component
    and is kept. Ids are taken to be unique; rows that share one count as linked. An empty table
    gives no rows; other columns are not read.
    """
    base = lean(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def prepare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for block in blocks(batch.column(1), TEXT):
                h, g, bounds = shingles(block)
                n = np.diff(bounds)
                s1, s2 = (np.concatenate([[0], np.cumsum(mix(x + _GOLD), dtype=np.uint64)]).astype(np.uint64) for x in (h, g))
                s1, s2 = (s[bounds[1:]] - s[bounds[:-1]] for s in (s1, s2))
                _, first, again = np.unique(np.stack([s1, s2], 1), axis=0, return_index=True, return_inverse=True)
                own = np.sort(first)
                sizes = n[own]
                flat = h[np.repeat(bounds[:-1][own], sizes) + spread(sizes)]
                made = sketch(flat, np.concatenate([[0], np.cumsum(sizes)]))
                rows = np.searchsorted(own, first[again.reshape(-1)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[block.first : block.first + block.n], pa.array(n.astype(np.int64)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array([made[r].tobytes() for r in rows], pa.binary())],
                    names=["doc_id", "n", "s1", "s2", "registers"],
                )

    rows = materialize(base.mapInArrow(prepare, "doc_id long, n long, s1 long, s2 long, registers binary"), "sketches")
    classes = rows.where("n > 0 and doc_id is not null").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    ids = classes.select(F.col("rep").alias("id"))
    nodes = materialize(rows.where("n > 0").select(F.col("doc_id").alias("id"), "n", "registers").join(ids, "id", "left_semi").dropDuplicates(["id"]), "nodes")

    def band(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            r = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + _GOLD), r.shape[:2])
            for j in range(ROWS):
                key = mix(key * np.uint64(0xD1342543DE82EF95) + r[:, :, j])
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["key", "id"])

    bands = nodes.select("id", "registers").mapInArrow(band, "key long, id long")
    shared = bands.groupBy("key").agg(F.count("*").alias("c"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s")).where("c > 1")
    shared = shared.groupBy("c", "s").agg(F.min("key").alias("key"))
    buckets = materialize(bands.join(shared.select("key", "c"), "key"), "buckets")

    def parse(t: pa.Table) -> tuple[np.ndarray, ...]:
        registers = np.frombuffer(b"".join(t["registers"].to_pylist()), np.uint16).reshape(-1, M)
        return t["id"].to_numpy(), t["n"].to_numpy(), registers, np.unique(t["label"].to_numpy(), return_inverse=True)[1], t["side"].to_numpy()

    def guess(t: pa.Table) -> pa.Table:
        own, n, registers, label, side = parse(t)
        return _linked(candidate_forest(n, registers, label, side), own)

    maybe = connect(buckets, lambda _: nodes, guess)
    places = materialize(maybe.join(maybe.groupBy("component").agg(F.count("*").alias("c")), "component").withColumnRenamed("component", "key"), "places")

    def full(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for block in blocks(batch.column(1), TEXT):
                h, g, bounds = shingles(block)
                members = [h[a:b].tobytes() + g[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.first : block.first + block.n], pa.array(members, pa.binary())], names=["id", "members"])

    def with_sets(ids: DataFrame) -> DataFrame:
        sets = base.join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").mapInArrow(full, "id long, members binary").dropDuplicates(["id"])
        return nodes.join(sets, "id")

    def verify(t: pa.Table) -> pa.Table:
        own, n, registers, label, side = parse(t)
        return _linked(verified_links(n, registers, [np.frombuffer(m, np.uint64).reshape(2, -1) for m in t["members"].to_pylist()], label, side), own)

    found = connect(places, with_sets, verify)
    discard(nodes, places, buckets)

    groups = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("s1", "s2", "n", "copies", F.coalesce("component", "rep").alias("component_id"))
    own = rows.select(F.col("doc_id").alias("id"), "s1", "s2", "n")
    out = join_classes(own, groups, ["s1", "s2", "n"], "copies", rows.count(), F.col("n") == 0)
    component = F.when(F.col("n") == 0, F.col("id")).when(F.col("id").isNotNull(), F.col("component_id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps: the least id of each component, and all that are linked with nothing."""
    own = fresh(docs, "gone_id")
    gone = materialize(near_duplicates(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias(own)), "near")
    return docs.join(gone, docs[id_col].cast("long") == F.col(own), "left_anti")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All pairs that share a shingle, counted; components by transitive closure.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON r.doc_id = e.x),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
