"""Hierarchical packing of documents into context windows of several lengths."""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import lean, text_of
from tidemark.llm.textkit import MAY_SPACE, SPACES, Block, blocks, distinct, spread, trim

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long, ids binary"
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.int64()), ("ids", pa.binary())])

TEXT = 2 << 20  #: bytes of text encoded at once
REMEMBERED = 256  #: bytes of the longest chunk that is remembered between blocks
_ENCODERS: dict[str, ChunkEncoder] = {}


class ChunkEncoder:
    """Byte-level BPE of whole texts with a bounded memory of chunks.

    The split pattern of this vocabulary never joins the last of some white-space characters with
    what precedes it, so a text can be cut there into chunks that are encoded alone; each distinct
    chunk of a block is encoded once; blocks and the memory tell chunks apart by their bytes. The rank file holds
    the same vocabulary as the tokenizer file and is much the faster; texts with the tokenizer's
    special strings go through the tokenizer itself.
    """

    def __init__(self, name: str, most: int = 150_000) -> None:
        path = public_tokenizers.path
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path(f"{name}.tiktoken"), "rb"))}
        self.encode = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.bytes_of[i] = len(token)
        self.file, self.full = path(f"{name}.json"), None
        with open(self.file, encoding="utf-8") as f:
            self.special = [t["content"].encode() for t in json.load(f)["added_tokens"]]
        trim()
        self.most = most
        self.known: dict[bytes, bytes] = {}

    def remember(self, chunk: bytes, ids: bytes) -> None:
        if len(chunk) <= REMEMBERED:
            self.known[chunk] = ids

    def block(self, block: Block) -> Iterator[np.ndarray]:
        """The ids of each text of a block."""
        data, known = block.data, self.known
        cut = SPACES[data]
        cut[:-1] &= ~MAY_SPACE[data[1:]]
        cut[block.bounds[1:][np.diff(block.bounds) > 0] - 1] = False  # what follows the last byte is another text
        s, e, first = block.chunks(cut)
        at, which = distinct(data, s, e)
        raw = data.tobytes()
        names = [raw[a:b] for a, b in zip(s[at].tolist(), e[at].tolist(), strict=True)]
        ids = [known.get(k) for k in names]
        if len(known) + len(ids) > self.most:
            known.clear()
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            a = s[at[new]]
            alone = ~cut[a]  # a text's first chunk can't follow another
            for i in np.flatnonzero(alone).tolist():
                x = new[i]
                ids[x] = array("I", self.encode(names[x].decode())).tobytes()
                self.remember(names[x], ids[x])
            new = [x for x, first in zip(new, alone.tolist(), strict=True) if not first]
            spans = list(zip(s[at[new]].tolist(), e[at[new]].tolist(), strict=True))
            got = np.array(self.encode(b"".join([raw[a:b] for a, b in spans]).decode()), "<u4")
            upto = np.cumsum([0, *(b - a for a, b in spans)])
            split = np.searchsorted(np.concatenate([[0], np.cumsum(self.bytes_of[got])]), upto).tolist() if len(got) else [0] * len(upto)
            flat = got.tobytes()
            for k, x in enumerate(new):
                ids[x] = flat[4 * split[k] : 4 * split[k + 1]]
                self.remember(names[x], ids[x])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        table, base = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        count = sizes[which]
        out = table[np.repeat(base[which], count) + spread(count)]
        ends = np.concatenate([[0], np.cumsum(count)])[first]
        special = any(x in raw for x in self.special)
        for i in range(block.n):
            text = raw[block.bounds[i] : block.bounds[i + 1]] if special else b""
            if special and any(x in text for x in self.special):
                self.full = self.full or Tokenizer.from_file(self.file)  # seldom needed, and large
                yield np.array(self.full.encode(text.decode(), add_special_tokens=False).ids, "<u4")
            else:
                yield out[ends[i] : ends[i + 1]]


def encoder(name: str) -> ChunkEncoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = ChunkEncoder(name)
    return _ENCODERS[name]


class TierPacker:
    """Packs the documents of one task.

    A document is cut into windows of the longest tier; its rest is routed to the shortest tier
    that holds it. A bounded pool of rests waits; when it overflows, each tier in turn packs a
    window as long as its own rests can fill one: the longest opens it, the longest that fit follow,
    first of the tier itself, then of shorter ones, and the last gap is filled with a cut from the
    shortest tier, whose remainder is routed anew. When no tier can fill a window alone, the one
    with most tokens waiting opens it. So every tier has windows, short rests that are left over fill
    long ones, and no window has a gap but for the last of a task. Windows of a tier form step
    groups of ``step_tokens`` each, so that all steps have equally many tokens.
    """

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, base: int, pool: int = 512) -> None:
        self.tiers, self.step, self.pool = sorted(tiers), step_tokens, pool
        self.next = self.made = base
        self.waiting: dict[int, list[tuple[int, int, tuple]]] = {t: [] for t in self.tiers}
        self.tokens = dict.fromkeys(self.tiers, 0)
        self.order = 0
        self.groups: dict[int, list] = {t: [0, 0] for t in self.tiers}
        self.held = 0
        self.turn = 0

    def add(self, doc: int | None, ids: bytes) -> Iterator[tuple]:
        n, top = len(ids) // 4, self.tiers[-1]
        whole = n - n % top
        for at in range(0, whole, top):
            yield from self.close(top, [(doc, at, ids[4 * at : 4 * (at + top)], n)])
        if n > whole:
            self.route((doc, whole, ids[4 * whole :], n))
        if self.held > self.pool:
            yield from self.drain(self.pool // 2)

    def route(self, piece: tuple) -> None:
        n = len(piece[2]) // 4
        tier = next(t for t in self.tiers if n <= t)
        self.order += 1
        self.tokens[tier] += n
        heapq.heappush(self.waiting[tier], (-n, self.order, piece))
        self.held += 1

    def take(self, tier: int) -> tuple:
        self.held -= 1
        n, _, piece = heapq.heappop(self.waiting[tier])
        self.tokens[tier] += n
        return piece

    def drain(self, leave: int) -> Iterator[tuple]:
        """Close windows, tier after tier, until ``leave`` rests wait."""
        while self.held > leave:
            turns = self.tiers[self.turn :] + self.tiers[: self.turn]
            tier = next((t for t in turns if self.tokens[t] >= t), None) or max(self.tiers, key=self.tokens.__getitem__)
            self.turn = (self.tiers.index(tier) + 1) % len(self.tiers)
            window = [self.take(tier)]
            room = tier - len(window[0][2]) // 4
            while room and self.held:
                fits = next((t for t in reversed(self.tiers) if self.waiting[t] and -self.waiting[t][0][0] <= room), None)
                if fits:
                    window.append(self.take(fits))
                    room -= len(window[-1][2]) // 4
                    continue
                short = next(t for t in self.tiers if self.waiting[t])
                doc, at, ids, n = self.take(short)
                window.append((doc, at, ids[: 4 * room], n))
                self.route((doc, at + room, ids[4 * room :], n))
                room = 0
            yield from self.close(tier, window)

    def close(self, tier: int, window: list[tuple]) -> Iterator[tuple]:
        used = sum(len(p[2]) // 4 for p in window)
        while tier // 2 >= used:  # the last windows of a task may be shorter than every tier
            tier //= 2
        group = self.groups.setdefault(tier, [0, 0])
        if group[1] == 0 or group[1] + tier > self.step:
            self.made += 1
            group[:] = [self.made, 0]
        group[1] += tier
        offset = 0
        for doc, at, ids, n in window:
            yield doc, at, len(ids) // 4, zlib.crc32(ids), n, self.next, offset, tier, group[0], ids
            offset += len(ids) // 4
        self.next += 1


def pack(docs: DataFrame, tiers: tuple[int, ...] = (256, 512, 1024, 2048), step_tokens: int = 16384, name: str = "byte_bpe_50k", end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack documents into windows of the lengths ``tiers`` (powers of two); one row per piece.

    A document is its ids and ``end_id``. Rows have the piece's place in document and window, its
    window's tier (to which it is padded) and step group, and its ids. Every scan task packs its
    own rows, so nothing is shuffled; only a task's last windows can have gaps.

    Null or empty text: the end id alone. Texts of any length are cut. Null ids stay null; repeated
    rows are packed each. An empty table gives no rows; other columns are not read.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(name), np.array([end_id], "<u4").tobytes()
        packer = TierPacker(tiers, step_tokens, TaskContext.get().partitionId() << 40)

        def rows() -> Iterator[tuple]:
            for batch in it:
                docs = batch.column(0).to_pylist()
                for block in blocks(batch.column(1), TEXT):
                    for i, ids in enumerate(encode.block(block), block.first):
                        yield from packer.add(docs[i], ids.tobytes() + end)
            yield from packer.drain(0)

        held: list[tuple] = []
        for row in rows():
            held.append(row)
            if len(held) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _PIECES, strict=True)], schema=_PIECES)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return lean(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, PIECES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("ids")
