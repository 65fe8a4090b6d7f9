"""Token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import lean, text_of
from tidemark.llm.textkit import Block, blocks, distinct

MARK = "▁"  #: how the vocabulary writes a space
REMEMBERED = 256  #: bytes of the longest chunk that is remembered between blocks

_COUNTERS: dict[str, MergeCounter] = {}
_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


class MergeCounter:
    """Counts the tokens of a byte-pair vocabulary with scores, byte fallback and no normalisation.

    Symbols are a doubly linked list, candidate merges a heap by rank, then place. A count is the
    number of initial symbols (a character, or each byte of one that the vocabulary lacks) less
    that of merges; no identifiers are made. As no piece has a space behind another character, and
    some characters are in no longer piece at all, a text is cut there and each distinct chunk of a
    block is counted once; blocks and the memory tell chunks apart by their bytes.
    """

    def __init__(self, path: str, most: int = 600_000) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(model.vocab_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in usable}
        long = [p for p in self.rank if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in long):
            raise ValueError("a piece has a space behind another character: texts can't be cut at spaces")
        inside = {c for p in long for c in p}
        self.solo = np.zeros(256, bool)
        self.solo[[b for b in range(128) if chr(b) not in inside and b != 0x20]] = True
        self.most = most
        self.known: dict[bytes, int] = {}

    def count(self, text: str) -> int:
        rank = self.rank
        symbols: list[str] = list(text)
        n = len(symbols)
        total = n if all(map(rank.__contains__, symbols)) else sum(1 if c in rank else len(c.encode()) for c in symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != len(pair) or symbols[i] + symbols[j] != pair:
                continue  # one side has been merged meanwhile
            symbols[i], symbols[j] = pair, ""
            total -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                right = pair + symbols[k]
                if right in rank:
                    heapq.heappush(heap, (rank[right], i, right))
            k = before[i]
            if k >= 0:
                left = symbols[k] + pair
                if left in rank:
                    heapq.heappush(heap, (rank[left], k, left))
        return total

    def block(self, block: Block) -> np.ndarray:
        """Tokens of each text of a block; spaces are still \\x20, and a text's leading one isn't there yet."""
        data, known = block.data, self.known
        cut = data == 0x20
        cut[1:] &= data[:-1] != 0x20
        solo = self.solo[data]
        cut |= solo
        cut[1:] |= solo[:-1]
        s, e, first = block.chunks(cut)
        at, which = distinct(data, s, e)
        raw = data.tobytes()
        if len(known) + len(at) + block.n > self.most:
            known.clear()

        def count(chunk: bytes, mark: str) -> int:
            key = mark.encode() + b"\xff" + chunk  # no text has this byte
            got = known.get(key)
            if got is None:
                got = self.count(mark + chunk.decode().replace(" ", MARK))
                if len(chunk) <= REMEMBERED:
                    known[key] = got
            return got

        counts = np.array([count(raw[a:b], "") for a, b in zip(s[at].tolist(), e[at].tolist(), strict=True)], np.int64)[which]
        for i in first[:-1][first[1:] > first[:-1]].tolist():  # a text's first chunk has a space more
            counts[i] = count(raw[s[i] : e[i]], MARK)
        upto = np.concatenate([[0], np.cumsum(counts)])
        return upto[first[1:]] - upto[first[:-1]]


def counter(name: str) -> MergeCounter:
    if name not in _COUNTERS:
        _COUNTERS[name] = MergeCounter(public_tokenizers.path(name))
    return _COUNTERS[name]


def count_tokens(docs: DataFrame, name: str = "piece_bpe_32k.model", limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row.

    Null and empty texts have no tokens. Texts of any length are counted whole; memory grows with
    the longest text, not with the table. Null ids and repeated rows each give a row. An empty
    table gives none; other columns are not read.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = counter(name)
        for batch in it:
            texts = batch.column(1)
            plain = pc.replace_substring(texts, MARK, " ") if len(texts) else texts
            found = [merges.block(b) for b in blocks(plain)]
            n = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)], schema=_COUNTS)

    return lean(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
