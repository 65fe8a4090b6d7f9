"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discard, lean, materialize, order_hash, text_of
from tidemark.llm.textkit import LOWER, Block, blocks, hash_spans

#: Lexicon voters: general insults, one voter a word.
LEXICON = (
    "idiot moron stupid dumb loser trash garbage scum worthless pathetic disgusting clown fool jerk imbecile "
    "filthy vermin creep liar coward freak pig rat parasite degenerate disgrace ugly hate kill shut "
    "idiota imbécil estúpido basura asqueroso patético idiote débile stupide ordure minable dégoûtant "
    "dumm dummkopf abschaum müll erbärmlich widerlich trottel versager"
).split()
#: Pattern voters, and what fires them.
PATTERNS = ("three words of capitals", "two exclamation marks", "a letter four times", "a digit or sign inside a word", "four letters spelt out", "a starred word", "you are a")
#: Word sequences of the last pattern.
ADDRESS = ("you are a", "you are an", "tu es un", "tu es une", "du bist ein", "du bist eine", "eres un", "eres una")
SIGNIFICANT = 6.0  #: least log likelihood ratio of a mined feature, far beyond chance among the words of a corpus
TEXT = 1 << 20  #: bytes of text scored at once
PREFIXES = (3, 4, 5, 6, 7, 8)  #: bytes of a word's beginning that are features, beside whole words
LEAST_GAIN = 4.0  #: log likelihood that a dependence between voters must explain to be a part of the label model


@dataclass
class LabelModel:
    """p(class) and, for each voter, p(fires | class, its parent fires or not); a root's parent is itself, never firing.

    ``rates[y, v, i]`` is the probability that voter i fires in class y when its parent's vote is v:
    accuracies are its differences between classes, correlations those between v = 0 and 1.
    """

    prior: float
    parent: np.ndarray
    rates: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)  #: calibration of the log odds on the labels

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Log odds of class 1 by rows of votes (rows x voters), before calibration."""
        if not len(self.parent):
            return np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        fires = np.log(self.rates[1] / self.rates[0])
        silent = np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        up = votes[:, self.parent] & (self.parent != np.arange(len(self.parent)))
        v = votes.astype(float)
        base = np.log(self.prior / (1 - self.prior)) + silent[0].sum()
        # terms of (vote, parent's vote): (0,0) in base, the others as what they add to it
        return base + v @ (fires[0] - silent[0]) + up @ (silent[1] - silent[0]) + (v * up) @ (fires[1] - silent[1] - fires[0] + silent[0])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.log_odds(votes) + b, -30, 30)))


@dataclass
class Model:
    features: np.ndarray  #: sorted feature hashes
    weights: np.ndarray
    bias: float
    labels: LabelModel | None = field(default=None, compare=False)  #: what made the training labels


def held_out(id_col: str, folds: int = 5) -> Column:
    """Whether a row is left out of learning: crc32 of its id as text is divisible by ``folds``; a null id's is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(True))


@cache
def _letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether bytes below 0x80, and code points of the first three planes, are letters (or marks on them)."""
    points = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x30000)])
    return np.append(points[:0x80], np.zeros(0x80, bool)), points


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to letters; punctuation, spaces, digits and symbols of any script don't."""
    ascii_letter, points = _letter_tables()
    out = ascii_letter[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        n = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        point = data[lead].astype(np.int64) & np.array([0x1F, 0x0F, 0x07])[n - 2]
        for k in range(1, 4):
            more = n > k
            point[more] = point[more] << 6 | data[np.minimum(lead[more] + k, len(data) - 1)] & 0x3F
        is_letter = points[np.minimum(point, len(points) - 1)]
        for k in range(4):
            on = lead[is_letter & (n > k)] + k
            out[on[on < len(out)]] = True
    return out


def _words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters of a block; start and end of each run of letters; runs before each text."""
    data = LOWER[block.data]
    accented = np.zeros(len(data), bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data[accented] += 0x20  # capitals of Latin-1
    inside = letters(data)
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = block.bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    s = np.flatnonzero(starts)
    return data, s, np.flatnonzero(ends) + 1, np.searchsorted(s, block.bounds)


def _kinds(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which words have a feature of a kind, and its hash: whole words, then beginnings of longer words."""
    yield np.arange(len(s)), hash_spans(data, s, e)
    for k in PREFIXES:
        longer = np.flatnonzero(e - s > k)
        yield longer, hash_spans(data, s[longer], s[longer] + k, k)


def features_of(block: Block, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature hashes of a block; distinct (text, index of feature) pairs with counts.

    With ``wanted`` (sorted hashes) these are the features, and all others are passed over.
    Features are told apart by 64-bit hashes.
    """
    data, s, e, first = _words(block)
    _, at, which = np.unique(hash_spans(data, s, e), return_index=True, return_inverse=True)
    doc = np.repeat(np.arange(block.n), np.diff(first))
    pair, n = np.unique(doc * max(1, len(at)) + which, return_counts=True)
    doc, which = np.divmod(pair, max(1, len(at)))
    kinds = list(_kinds(data, s[at], e[at]))
    names = np.unique(np.concatenate([h for _, h in kinds])) if wanted is None else wanted
    keys, counts = [], []
    for rows, h in kinds:
        place = np.minimum(np.searchsorted(names, h), max(0, len(names) - 1))
        good = names[place] == h if len(names) else np.zeros(len(h), bool)
        feature = np.full(len(at), -1)
        feature[rows[good]] = place[good]
        f = feature[which]
        keys.append(doc[f >= 0] * max(1, len(names)) + f[f >= 0])
        counts.append(n[f >= 0])
    key, i = np.unique(np.concatenate(keys), return_inverse=True)
    doc, f = np.divmod(key, max(1, len(names)))
    return names, doc, f, np.bincount(i, np.concatenate(counts), len(key)).astype(np.int64)


@cache
def _hashes(words: tuple[str, ...]) -> np.ndarray:
    raw = [w.encode() for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8)
    n = np.array([len(w) for w in raw])
    return hash_spans(data, np.cumsum(n) - n, np.cumsum(n))


def lexicon_hashes() -> np.ndarray:
    return _hashes(tuple(LEXICON))


def patterns_of(block: Block) -> np.ndarray:
    """Which PATTERNS each text of a block has (texts x patterns)."""
    low, s, e, first = _words(block)
    raw, out = block.data, np.zeros((block.n, len(PATTERNS)), bool)
    small = (low >= 0x61) & (low <= 0x7A)
    word_doc = np.repeat(np.arange(block.n), np.diff(first))
    upto = np.concatenate([[0], np.cumsum((raw >= 0x41) & (raw <= 0x5A))])
    capitals = (upto[e] - upto[s] == e - s) & (e - s >= 3)
    letter = np.zeros(len(s), bool)
    letter[:-1] = (e[:-1] - s[:-1] == 1) & (s[1:] == e[:-1] + 1) & (raw[e[:-1]] == 0x20) & (word_doc[1:] == word_doc[:-1])
    word = hash_spans(low, s, e)

    def bytes_hit(k: int, hit: np.ndarray, wide: int) -> None:
        at = np.flatnonzero(hit)
        a = np.searchsorted(block.bounds, at, "right") - 1
        same = at + wide <= block.bounds[a + 1]
        out[a[same], k] = True

    def words_hit(k: int, hits: list[np.ndarray]) -> None:
        """Sequences of words, the j-th of which is hit in hits[j]."""
        n = len(s) - len(hits) + 1
        if n > 0:
            on = np.logical_and.reduce([h[j : j + n] for j, h in enumerate(hits)]) & (word_doc[:n] == word_doc[len(hits) - 1 :])
            out[word_doc[:n][on], k] = True

    def near(*tests: np.ndarray) -> np.ndarray:
        n = len(raw) - len(tests) + 1
        return np.logical_and.reduce([x[j : j + n] for j, x in enumerate(tests)]) if n > 0 else np.zeros(0, bool)

    words_hit(0, [capitals] * 3)
    bytes_hit(1, near(raw == 0x21, raw == 0x21), 2)
    bytes_hit(2, _fours(low, small), 4)
    sign = ((raw >= 0x30) & (raw <= 0x39)) | (raw == 0x40) | (raw == 0x24)
    bytes_hit(3, near(small, sign, small), 3)
    words_hit(4, [letter] * 3)
    bytes_hit(5, near(small, raw == 0x2A, raw == 0x2A), 3)
    for phrase in ADDRESS:
        words_hit(6, [word == h for h in _hashes(tuple(phrase.split()))])
    return out


def _fours(low: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Where the same letter stands four times."""
    n = len(low) - 3
    return small[:n] & (low[1 : n + 1] == low[:n]) & (low[2 : n + 2] == low[:n]) & (low[3 : n + 3] == low[:n]) if n > 0 else np.zeros(0, bool)


def dependences(mass: np.ndarray, fires: np.ndarray, both: np.ndarray) -> np.ndarray:
    """The parent of each voter in the tree of dependences given the class that explains most (Chow and Liu).

    mass: weight of the classes; fires[y, i], both[y, i, j]: weights of rows in which voters fire.
    A voter whose dependences explain less than LEAST_GAIN is its own parent.
    """
    m = fires.shape[1]
    gain = np.zeros((m, m))
    for y in (0, 1):
        n = mass[y] + 2.0
        p = (fires[y] + 1.0) / n
        p11 = np.clip((both[y] + 0.25) / n, 1e-12, None)
        p10, p01 = np.clip(p[:, None] - p11, 1e-12, None), np.clip(p[None, :] - p11, 1e-12, None)
        p00 = np.clip(1 - p11 - p10 - p01, 1e-12, None)
        for cell, a, b in ((p11, p, p), (p10, p, 1 - p), (p01, 1 - p, p), (p00, 1 - p, 1 - p)):
            gain += n * cell * np.log(cell / np.clip(np.outer(a, b), 1e-12, None))
    np.fill_diagonal(gain, -np.inf)
    parent = np.arange(m)
    left = np.ones(m, bool)
    while left.any():  # a tree from each voter that nothing is linked with
        start = int(np.flatnonzero(left)[0])
        left[start] = False
        best, link = gain[start].copy(), np.full(m, start)
        while left.any():
            i = int(np.argmax(np.where(left, best, -np.inf)))
            if best[i] < LEAST_GAIN:
                break
            parent[i], left[i] = link[i], False
            better = gain[i] > best
            best[better], link[better] = gain[i][better], i
    return parent


def estimate(mass: np.ndarray, fires: np.ndarray, both: np.ndarray, parent: np.ndarray, prior: float | None = None) -> LabelModel:
    """Rates from weights; with few rows they shrink towards the voter's rate over both classes."""
    own = np.arange(len(parent))
    root = parent == own
    with_up = np.where(root, 0.0, fires[:, parent])
    joint = np.where(root, 0.0, both[:, own, parent])
    rates = np.empty((2, 2, len(parent)))
    share = (fires.sum(0) + 0.02) / (mass.sum() + 1.0)
    for y in (0, 1):
        alone = (fires[y] + share) / (mass[y] + 1.0)
        rates[y, 1] = (joint[y] + 2 * alone) / (with_up[y] + 2)
        rates[y, 0] = (np.maximum(fires[y] - joint[y], 0) + alone) / (np.maximum(mass[y] - with_up[y], 0) + 1)
    return LabelModel(float(np.clip(mass[1] / mass.sum(), 1e-4, 0.5)) if prior is None else prior, parent, np.clip(rates, 1e-6, 1 - 1e-6))


def linear_classifier(x: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None, steps: int = 300, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adam over the whole sample; a class weighs as the root of its size."""
    x = x.astype(np.float32)
    t = target.astype(np.float32)
    w = np.ones(len(t), np.float32) if weight is None else weight.astype(np.float32)
    weigh = w * (t / max((w * t).sum(), 1.0) ** 0.5 + (1 - t) / max((w * (1 - t)).sum(), 1.0) ** 0.5)
    weigh = (weigh / weigh.sum()).astype(np.float32)
    w, b = np.zeros(x.shape[1] + 1, np.float32), np.zeros((2, x.shape[1] + 1), np.float32)
    for i in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        d = weigh * (p - t)
        g = np.append(x.T @ d + ridge * w[:-1], d.sum()).astype(np.float32)
        b[0] = 0.9 * b[0] + 0.1 * g
        b[1] = 0.99 * b[1] + 0.01 * g * g
        w -= 0.1 * (b[0] / (1 - 0.9**i)) / (np.sqrt(b[1] / (1 - 0.99**i)) + 1e-8)
    return w[:-1].astype(float), float(w[-1])


def mine(rows: DataFrame, most: int) -> tuple[np.ndarray, int, int]:
    """The features of texts (y, text) that set toxic ones apart, best first, and the numbers of rows with y = 1 and 0.

    Counted over all rows: only the ``most`` best by log likelihood ratio come to the driver.
    """

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            y = batch.column(0).to_numpy().astype(np.int64)
            for block in blocks(batch.column(1), 2 * TEXT):
                names, doc, f, _ = features_of(block)
                own = y[block.first : block.first + block.n]
                n = np.bincount(f, minlength=len(names))
                n1 = np.bincount(f, own[doc], len(names)).astype(np.int64)
                # the row without a feature counts the texts
                names, n1, n0 = np.append(names.view(np.int64), 0), np.append(n1, own.sum()), np.append(n - n1, block.n - own.sum())
                yield pa.RecordBatch.from_arrays([pa.array(names, mask=np.arange(len(names)) == len(names) - 1), pa.array(n1), pa.array(n0)], names=["f", "n1", "n0"])

    counted = materialize(rows.mapInArrow(count, "f long, n1 long, n0 long").groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where("n1 >= 2 or f is null"), "features")
    totals = counted.where("f is null").first()
    all1, all0 = (totals["n1"], totals["n0"]) if totals else (0, 0)
    if not all1:
        return np.empty(0, np.uint64), 0, all0
    n1, n0, a1, a0 = F.col("n1") + 0.25, F.col("n0") + 0.25, float(all1 + 0.5), float(all0 + 0.5)
    gain = n1 * F.log(n1 / a1 / ((n1 + n0) / (a1 + a0))) + (a1 - n1) * F.log(F.greatest((a1 - n1) / a1, F.lit(1e-9)) / F.greatest((a1 + a0 - n1 - n0) / (a1 + a0), F.lit(1e-9)))
    best = counted.where("f is not null").where(n1 / a1 > 4 * n0 / a0).withColumn("gain", gain).where(F.col("gain") > SIGNIFICANT).orderBy(F.desc("gain"), "f").limit(most).select("f").collect()
    discard(counted)
    return np.array([r["f"] for r in best], np.int64).view(np.uint64), all1, all0


def votes_of(block: Block, voting: np.ndarray) -> np.ndarray:
    """Votes on the texts of a block (texts x voters): of features (sorted hashes), then of the patterns."""
    out = np.zeros((block.n, len(voting)), bool)
    _, doc, f, _ = features_of(block, voting)
    out[doc, f] = True
    return np.concatenate([out, patterns_of(block)], 1)


def ballots(rows: DataFrame, y: DataFrame, voting: np.ndarray) -> DataFrame:
    """Distinct sets of votes on all ``rows`` (id, text): the voters, how many rows (n), and how many are labelled 1 and 0."""

    def vote(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for block in blocks(batch.column(1), TEXT):
                v = votes_of(block, voting)
                row, voter = np.nonzero(v)
                ends = np.searchsorted(row, np.arange(block.n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[block.first : block.first + block.n], pa.ListArray.from_arrays(pa.array(ends), pa.array(voter.astype(np.int16)))], names=["id", "voters"])

    cast = rows.mapInArrow(vote, f"id {dict(rows.dtypes)['id']}, voters array<smallint>")
    return materialize(cast.join(y, "id", "left").groupBy("voters").agg(F.count("*").alias("n"), F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") == 0).alias("n0")), "ballots")


def _sums(found: DataFrame, m: int, weigh: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """mass, fires and both by class over all ballots, summed on the executors; ``weigh(votes, n, n1, n0)`` gives a row's weights in classes 0 and 1."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, (m + 1) * (m + 1)))  # voter m fires always
        for batch in it:
            v = np.zeros((batch.num_rows, m + 1))
            v[_filled(batch.column(0))] = 1
            v[:, m] = 1
            n, n1, n0 = (batch.column(i).to_numpy().astype(float) for i in (1, 2, 3))
            for y, w in enumerate(weigh(v[:, :m].astype(bool), n, n1, n0)):
                total[y] += ((v * w[:, None]).T @ v).reshape(-1)
        at = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], names=["at", "w0", "w1"])

    got = found.select("voters", "n", "n1", "n0").mapInArrow(run, "at long, w0 double, w1 double").groupBy("at").agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1")).toArrow()
    out = np.zeros((2, (m + 1) * (m + 1)))
    out[:, got["at"].to_numpy()] = got["w0"].to_numpy(), got["w1"].to_numpy()
    out = out.reshape(2, m + 1, m + 1)
    return out[:, m, m], out[:, m, :m], out[:, :m, :m]


def _filled(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows and values of a column of lists."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def label_model(found: DataFrame, m: int, seeds: np.ndarray, rounds: int = 6) -> LabelModel:
    """The generative model of ``m`` voters, fitted by expectation maximisation on all ballots.

    Labels give the first estimate (without any, the ``seeds``, trusted voters, do). Then rows without
    a label count for the classes as their votes say; labelled rows keep their class, so that a voter
    that mostly fires alone isn't taken for noise. Labels so fix accuracies and correlations but never
    a row's posterior, which is that of its votes. Dependences are found anew in the second round. At
    the end labels calibrate the log odds.
    """
    mass, fires, both = _sums(found, m, lambda v, n, n1, n0: (n0, n1))
    if mass.min() < 1:

        def trusted(v: np.ndarray, n: np.ndarray, n1: np.ndarray, n0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            q = np.where(v[:, seeds].any(1), 0.9, 0.02)
            return n * (1 - q), n * q

        mass, fires, both = _sums(found, m, trusted)
    if mass.sum() == 0:
        return LabelModel(0.1, np.arange(0), np.empty((2, 2, 0)))
    parent = dependences(mass, fires, both)
    model = estimate(mass, fires, both, parent)
    for i in range(rounds):

        def expected(v: np.ndarray, n: np.ndarray, n1: np.ndarray, n0: np.ndarray, now: LabelModel = model) -> tuple[np.ndarray, np.ndarray]:
            q, free = now.posterior(v), n - n1 - n0
            return n0 + free * (1 - q), n1 + free * q

        mass, fires, both = _sums(found, m, expected)
        if i == 1:
            parent = dependences(mass, fires, both)
        model = estimate(mass, fires, both, parent)
    model.scale = calibrate(found, m, model)
    return model


def calibrate(found: DataFrame, m: int, model: LabelModel) -> tuple[float, float]:
    """Slope and intercept that fit the log odds to the labels, from their counts by log odds (in steps of 1/8)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            v = np.zeros((batch.num_rows, m), bool)
            v[_filled(batch.column(0))] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(8 * np.clip(model.log_odds(v), -40, 40)).astype(np.int64)), batch.column(1), batch.column(2)], names=["s", "n1", "n0"])

    got = found.where("n1 + n0 > 0").select("voters", "n1", "n0").mapInArrow(run, "s long, n1 long, n0 long").groupBy("s").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).orderBy("s").toArrow()
    s, n1, n0 = (got[c].to_numpy().astype(float) for c in ("s", "n1", "n0"))
    if not len(s) or min(n1.sum(), n0.sum()) < 1:
        return 1.0, 0.0
    x, theta = np.stack([s / 8, np.ones(len(s))]), np.array([1.0, 0.0])
    for _ in range(50):  # Newton's steps, with a prior that keeps the slope near 1
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        g = x @ (n1 - (n1 + n0) * p) - np.array([1.0, 0.01]) * (theta - np.array([1.0, 0.0]))
        h = (x * (n1 + n0) * p * (1 - p)) @ x.T + np.diag([1.0, 0.01])
        step = np.linalg.solve(h, g)
        theta = theta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(theta[0], 0.05)), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, toxic: int = 4000, clean: int = 8000, mined: int = 1024, voters: int = 160, seed: int = 4, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the rows of ``docs`` that are not held out.

    Words and word beginnings that set toxic rows apart are mined by counts over all labelled rows;
    the ``voters`` best, the lexicon and the patterns vote on all rows, labelled or not. The label
    model is fitted on all these votes. Its posteriors are the labels by which a linear classifier
    on the mined and lexicon features is trained; for this step alone a sample of at most ``toxic``
    + ``clean`` labelled rows, weighed by their classes' sizes, comes to the driver.

    Null texts are empty. Labels that are null, held out or of no document teach nothing; of several
    labels of an id the largest counts. Without toxic labels only lexicon and patterns vote; without
    labelled rows every score is the prior's.
    """
    y = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("y")).where(~held_out("id"))
    rows = lean(docs).select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).where(~held_out("id"))
    best, all1, all0 = mine(rows.join(y.hint("shuffle_hash"), "id").select("y", "text"), mined)
    features = np.unique(np.concatenate([best, lexicon_hashes()]))
    voting = np.unique(np.concatenate([best[:voters], lexicon_hashes()]))
    m = len(voting) + len(PATTERNS)
    found = ballots(rows, y, voting)
    seeds = np.append(np.searchsorted(voting, lexicon_hashes()), np.arange(len(voting), m))
    model = label_model(found, m, seeds)
    discard(found)

    parts = [y.where(f"y = {v}").orderBy(order_hash(seed, "id"), "id").limit(n) for v, n in ((1, toxic), (0, clean))]
    sample = rows.join(F.broadcast(parts[0].unionByName(parts[1])), "id")  # at most toxic + clean ids of 8 bytes

    def hits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for block in blocks(batch.column(2), TEXT):
                _, doc, f, n = features_of(block, features)
                cut = np.searchsorted(doc, np.arange(block.n + 1)).astype(np.int32)
                part = slice(block.first, block.first + block.n)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in (f, n)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], batch.column(1)[part], *lists, pa.array(model.posterior(votes_of(block, voting)))], names=["id", "y", "f", "n", "posterior"])

    got = sample.select("id", "y", "text").mapInArrow(hits, f"id {dict(rows.dtypes)['id']}, y int, f array<long>, n array<long>, posterior double").toPandas()
    got = got.sort_values("id", kind="stable").reset_index(drop=True)
    if not len(got):
        return Model(features, np.zeros(len(features)), -2.0, model)
    x = np.zeros((len(got), len(features)), np.float32)
    for i, (f, n) in enumerate(zip(got["f"], got["n"], strict=True)):
        x[i, f] = np.log1p(np.asarray(n, float))
    gold = got["y"].to_numpy(int)
    sampled = np.bincount(gold, minlength=2)
    weight = (np.array([all0, all1]) / np.maximum(sampled, 1))[gold]
    weights, bias = linear_classifier(x, got["posterior"].to_numpy(), weight)
    return Model(features, weights, bias, model)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of each row, over whole texts.

    Null and empty texts have the score of a text without features. Null ids and repeated rows each
    give a row; an empty table none; other columns are not read.
    """
    return _scored(docs, model, id_col, text_col, ())


def _scored(docs: DataFrame, model: Model, id_col: str, text_col: str, carry: tuple[str, ...]) -> DataFrame:
    """As ``score``, and if there are columns to ``carry`` with the text and these as carry_0, carry_1, ..., so that no names clash."""
    features, weights, bias = model.features, model.weights, model.bias
    base = lean(docs).select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"), *(F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)))
    kinds = dict(base.dtypes)

    def scores(block: Block) -> np.ndarray:
        _, doc, f, n = features_of(block, features)
        total = bias + np.bincount(doc, np.log1p(n) * weights[f], block.n)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for block in blocks(pc.fill_null(batch.column(2), ""), TEXT):
                out, part = scores(block), batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(out), pa.array((out >= 0.5).astype(np.int32)), *part.columns[3:]], names=["doc_id", "held_out", "text", "score", "predicted", *names])

    names = [f"carry_{i}" for i in range(len(carry))]
    schema = f"doc_id {kinds['doc_id']}, held_out boolean, text string, score double, predicted int"
    if carry:
        return base.mapInArrow(run, ", ".join([schema, *(f"{c} {kinds[c]}" for c in names)]))

    def narrow(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (b.drop_columns(["text"]) for b in run(it))

    return base.mapInArrow(narrow, schema.replace(" text string,", ""))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below 1/2, with all their columns; null texts count as empty and stay as they are."""
    others = tuple(c for c in docs.columns if c != "text")
    kept = _scored(docs, fit(docs, labels), "doc_id", "text", others).where("predicted = 0")
    names = {c: f"carry_{i}" for i, c in enumerate(others)}
    return kept.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
