import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import language_model as L
from tidemark.llm import toxicity as T
from tidemark.llm.textkit import blocks


def held(i, folds):
    return i is None or zlib.crc32(str(i).encode()) % folds == 0


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\0"]


def test_base_scores_and_counts(odd, none, plain):
    c = Counter(x for i, t in plain if not held(i, 10) for x in tokens(t))
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in plain:
        w = tokens(t)
        want.append((str(i), held(i, 10), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)))
    got = L.lm_scores(odd).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == sorted(want)
    assert all(r["score"] < 0 for r in got)
    assert L.lm_scores(none).count() == 0


def test_held_out_text_is_likelier_than_by_frequency(spark):
    rng = random.Random(1)
    tongues = [[f"{a}{x}o" for x in "bcdfg"] for a in "ae"] + [[f"{a}{x}en" for x in "klmnp"] for a in "iu"]
    rows = [(i, " ".join(rng.choices(tongues[i % 2 * 2] + tongues[i % 2 * 2 + 1], k=60))) for i in range(400)]
    a = L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    out = [r for r in a if r["held_out"]]
    assert len(out) > 20 and sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + 10
    b = L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r["doc_id"]: round(r["score"], 4) for r in a} == {r["doc_id"]: round(r["score"], 4) for r in b}  # however rows are dealt


def test_contexts_are_words_not_classes_of_words(spark):
    """Words that end alike have followers of their own, which classes of endings can't tell apart."""
    rng = random.Random(2)
    stems = [f"{a}{b}" for a in "bcdfghklmn" for b in "aeiou"]
    heads = [f"{x}en" for x in stems]
    rows = [(i, " ".join(f"{h} {h[:-2]}us" for h in rng.choices(heads, k=40))) for i in range(400)]
    got = [r for r in L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect() if r["held_out"]]
    # a head is one of 50, its follower is certain: about 0.85 a token
    assert len(got) > 20 and sum(r["score"] for r in got) / sum(r["n_tokens"] for r in got) > -1.0


def fixed(own, state, params, v, customers):
    """A chain whose last sweep left this state."""
    tables = (np.bincount(own.leaf, state[0].t, L.LEAVES).astype(float), np.bincount(own.mid, state[1].t, L.PARENTS).astype(float), float(state[2].t.sum()))
    return L.Chain(v=v, customers=customers, tables=[tables], params=[params])


def test_states_are_seatings_and_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    words = np.array([11, 22, 33, 44], np.uint64)
    w, leaf = np.repeat(words, L.LEAVES), np.tile(np.arange(L.LEAVES), 4)
    n = rng.integers(0, 400, len(w)) * (rng.random(len(w)) < 0.4)
    own = L.Dishes(w, leaf, n)
    params = ((0.6, 2.0), (0.5, 0.7), (0.4, 5.0))
    state = own.start()
    for _ in range(5):
        chain = fixed(own, state, params, 4, np.bincount(leaf, n, L.LEAVES).astype(float))
        for c, seats in zip(own.customers(state), state, strict=True):
            cell = np.repeat(np.arange(len(c)), seats.t)
            assert (np.bincount(cell, seats.sizes, len(c)) == c).all() and ((seats.t > 0) == (c > 0)).all() and (seats.sizes > 0).all()
        p2, p1, p0 = own.predict(chain, 0, state)
        new = (5.0 + 0.4 * chain.tables[0][2]) / (chain.v + 1) / (5.0 + chain.tables[0][1].sum())  # the class of unknown words
        assert p0.sum() + new == pytest.approx(1)
        for k in range(L.PARENTS):
            new1 = (0.7 + 0.5 * chain.tables[0][1][k]) * new / (0.7 + np.bincount(L.PARENT, chain.tables[0][0], L.PARENTS)[k])
            assert p1[own.mid == k].sum() + new1 == pytest.approx(1)
            for x in np.flatnonzero(L.PARENT == k)[:2]:
                new2 = (2.0 + 0.6 * chain.tables[0][0][x]) * new1 / (2.0 + chain.customers[x])
                assert p2[own.leaf == x].sum() + new2 == pytest.approx(1)
        again = L.Dishes.load(own.dump(state))
        assert all((a.t == b.t).all() and (a.sizes == b.sizes).all() for a, b in zip(again[1], state, strict=True)) and (again[0].total == own.total).all() and (again[0].key2 == own.key2).all()
        state = own.sweep(chain, 1, state)
    assert sum(s.t.sum() for s in state) > sum((c > 0).sum() for c in own.customers(state))


@pytest.mark.parametrize("scan", [128, 2])
def test_sweeps_have_the_exact_distribution(monkeypatch, scan):
    """Tables of a cell after many sweeps, against generalised Stirling numbers: p(t) ~ pull**t * S(c, t)."""
    monkeypatch.setattr(L, "SCAN", scan)
    for c, pull, d in ((2, 0.5, 0.3), (5, 0.5, 0.3), (9, 2.0, 0.6)):
        s = {(0, 0): 1.0}
        for n in range(1, c + 1):
            for t in range(n + 1):
                s[n, t] = s.get((n - 1, t - 1), 0) + (n - 1 - d * t) * s.get((n - 1, t), 0)
        want = np.array([pull**t * s[c, t] for t in range(1, c + 1)])
        want /= want.sum()
        m = 20_000
        key, seats = np.arange(m, dtype=np.uint64), L.Seats.single(np.full(m, c))
        for sweep in range(25):
            seats = seats.reseated(np.full(m, c), np.full(m, pull), d, key, sweep)
        assert np.abs(np.bincount(seats.t, minlength=c + 1)[1:] / m - want).max() < 0.015


def test_customers_that_come_and_go():
    """Cells that grow and shrink between sweeps have the distribution of their new size."""
    m, d, pull = 20_000, 0.5, 1.0
    key, seats = np.arange(m, dtype=np.uint64), L.Seats.single(np.full(m, 3))
    for k, c in enumerate([7, 0, 4, 1, 6, *[5] * 12]):
        seats = seats.reseated(np.full(m, c), np.full(m, pull), d, key, k)
        assert (np.bincount(np.repeat(np.arange(m), seats.t), seats.sizes, m) == c).all()
    same = L.Seats.single(np.full(m, 5))
    for k in range(20):
        same = same.reseated(np.full(m, 5), np.full(m, pull), d, key, 100 + k)
    assert seats.t.mean() == pytest.approx(same.t.mean(), rel=0.02)


def test_discounts_and_strengths_are_drawn_from_their_distribution():
    assert np.allclose(L.gammaln(np.array([0.05, 0.5, 3.0, 700.0])), [math.lgamma(x) for x in (0.05, 0.5, 3.0, 700.0)])
    rng = random.Random(6)
    for d, a in ((0.3, 10.0), (0.8, 1.0)):
        tables, customers, sizes = [], [], []
        for _ in range(20):  # restaurants of the plain process
            own = []
            for i in range(800):
                x = rng.random() * (i + a) - (a + d * len(own))
                if x < 0:
                    own.append(1)
                    continue
                for k, size in enumerate(own):
                    x -= size - d
                    if x < 0:
                        break
                own[k] += 1
            tables.append(len(own))
            customers.append(sum(own))
            sizes += own
        of_sizes = sum(np.array([math.lgamma(s - g) - math.lgamma(1 - g) for g in L.GRID_D]) for s in sizes)
        drawn = [L.draw_parameters(np.array(tables), np.array(customers), of_sizes, salt) for salt in range(300)]
        assert abs(np.mean([x for x, _ in drawn]) - d) < 0.06 and abs(np.mean(np.log10([y for _, y in drawn])) - math.log10(a)) < 0.5


def plain_model(rows, sweeps, first, seed):
    """Scores of a plain hierarchical Pitman-Yor model: customers, one by one, in dictionaries of lists of tables."""
    rng = random.Random(seed)

    def class_of(word):
        if word is None:
            return (None,), (None,)
        raw = word.encode()
        kind = lambda b: int(L._CLASS[b])
        one = kind(raw[-1])
        return (one, kind(raw[-2]) if len(raw) > 1 else 0), (one,)

    pairs, after, total = Counter(), defaultdict(set), Counter()
    for i, text in rows:
        if not held(i, 10):
            before = None
            for w in tokens(text):
                pairs[before, w] += 1
                after[before].add(w)
                total[before] += 1
                before = w
    n1, n2 = (sum(c == k for c in pairs.values()) for k in (1, 2))
    leaf_d = min(0.95, max(0.05, (n1 + 1) / (n1 + 2 * n2 + 2)))
    v = len({w for _, w in pairs})
    c2 = Counter()
    for before, w in pairs:
        leaf, mid = class_of(before)
        c2[(leaf, mid), w] += 1
    seats2 = {k: [c] for k, c in c2.items()}

    def customers(seats, up):
        out = Counter()
        for (place, w), own in seats.items():
            out[up(place), w] += len(own)
        return out

    seats1 = {k: [c] for k, c in customers(seats2, lambda p: p[1]).items()}
    seats0 = {k: [c] for k, c in customers(seats1, lambda p: ()).items()}
    grid = [(float(d), float(a)) for d in L.GRID_D for a in L.GRID_A]

    def draw(seats):
        tables, people = Counter(), Counter()
        sizes = Counter()
        for (place, _), own in seats.items():
            tables[place] += len(own)
            people[place] += sum(own)
            sizes.update(own)
        by_d = {float(d): sum(n * (math.lgamma(s - d) - math.lgamma(1 - d)) for s, n in sizes.items()) for d in L.GRID_D}
        log_p = [by_d[d] + sum((t - 1) * math.log(d) + math.lgamma(a / d + t) - math.lgamma(a / d + 1) - math.lgamma(a + people[r]) + math.lgamma(a + 1) for r, t in tables.items()) for d, a in grid]
        top = max(log_p)
        return rng.choices(grid, [math.exp(x - top) for x in log_p])[0]

    def few(seats):
        ones, twos = (sum(sum(own) == k for own in seats.values()) for k in (1, 2))
        return min(0.95, max(0.05, (ones + 1) / (ones + 2 * twos + 2))), 1.0

    params = few(seats2), few(seats1), few(seats0)

    def sums(seats):
        t, c = Counter(), Counter()
        for (place, _), own in seats.items():
            t[place] += len(own)
            c[place] += sum(own)
        return t, c

    def predictor():
        (d2, a2), (d1, a1), (d0, a0) = params
        (t2, c2s), (t1, c1s), (t0, c0s) = (sums(s) for s in (seats2, seats1, seats0))

        def p0(w):
            own = seats0.get(((), w), [])
            return (sum(own) - d0 * len(own) + (a0 + d0 * t0[()]) / (v + 1)) / (a0 + c0s[()])

        def p1(mid, w):
            own = seats1.get((mid, w), [])
            return (sum(own) - d1 * len(own) + (a1 + d1 * t1[mid]) * p0(w)) / (a1 + c1s[mid])

        def p2(place, w):
            own = seats2.get((place, w), [])
            return (sum(own) - d2 * len(own) + (a2 + d2 * t2[place]) * p1(place[1], w)) / (a2 + c2s[place])

        return p0, p1, p2

    def sweep(seats, d, a, parent, tables):
        for (place, w), own in seats.items():
            q = (a + d * tables[place]) * parent(place, w)
            for _ in range(sum(own)):
                k = rng.choices(range(len(own)), own)[0]
                own[k] -= 1
                if not own[k]:
                    del own[k]
                k = rng.choices(range(len(own) + 1), [*(s - d for s in own), q])[0]
                if k == len(own):
                    own.append(1)
                else:
                    own[k] += 1

    def resize(seats, want, d, a, parent, tables):
        for key, n in want.items():
            own = seats.setdefault(key, [])
            while sum(own) > n:
                k = rng.choices(range(len(own)), own)[0]
                own[k] -= 1
                if not own[k]:
                    del own[k]
            while sum(own) < n:
                q = (a + d * tables[key[0]]) * parent(*key)
                k = rng.choices(range(len(own) + 1), [*(s - d for s in own), q])[0]
                if k == len(own):
                    own.append(1)
                else:
                    own[k] += 1

    states = []
    for s in range(1, sweeps):
        p0, p1, _ = predictor()
        t2, t1, t0 = sums(seats2)[0], sums(seats1)[0], sums(seats0)[0]
        (d2, a2), (d1, a1), (d0, a0) = params
        above2, above1, above0 = (lambda place, w: p1(place[1], w)), (lambda place, w: p0(w)), (lambda place, w: 1 / (v + 1))
        sweep(seats2, d2, a2, above2, t2)
        resize(seats1, customers(seats2, lambda p: p[1]), d1, a1, above1, t1)
        sweep(seats1, d1, a1, above1, t1)
        resize(seats0, customers(seats1, lambda p: ()), d0, a0, above0, t0)
        sweep(seats0, d0, a0, above0, t0)
        params = draw(seats2), draw(seats1), draw(seats0)
        if s >= first:
            p2 = predictor()[2]
            asked = {}
            for _, text in rows:
                before = None
                for w in tokens(text):
                    key = (class_of(before), w)
                    if key not in asked:
                        asked[key] = p2(*key)
                    before = w
            states.append(asked)
    out = {}
    for i, text in rows:
        before, score = None, 0.0
        for w in tokens(text):
            p = sum(s[class_of(before), w] for s in states) / len(states)
            score += math.log10((max(pairs[before, w] - leaf_d, 0) + (1 + leaf_d * len(after[before])) * p) / (1 + total[before]))
            before = w
        out[i] = score
    return out


def test_scores_agree_with_a_plain_model(spark):
    rng = random.Random(14)
    words = [f"{a}{b}{c}" for a in "bdkl" for b in "aei" for c in ("n", "s", "", "lo")]
    follow = {w: rng.choices(words, k=6) for w in words}
    rows = []
    for i in range(150):
        w, text = rng.choice(words), []
        for _ in range(30):
            text.append(w)
            w = rng.choice(follow[w]) if rng.random() < 0.8 else rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(150, None), (151, ""), (152, "unseen words here")]
    got = {r["doc_id"]: r["score"] for r in L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), burn_in=4, samples=12).collect()}
    plain = [plain_model(rows, 16, 4, seed) for seed in (1, 2, 3)]
    mean = {i: sum(p[i] for p in plain) / 3 for i, _ in rows}
    # as near as independent chains are to each other, and all in all within half a percent
    assert all(abs(got[i] - mean[i]) < 0.25 + 0.02 * abs(mean[i]) for i, _ in rows)
    assert abs(sum(got.values()) / sum(mean.values()) - 1) < 0.005


def full_model(rows, sweeps, first, seed):
    """Scores of a plain hierarchical Pitman-Yor model that seats the customers of words' restaurants too; seats change at once on all levels."""
    rng = random.Random(seed)

    def up(k, place):
        if k == 0:
            raw = b"" if place is None else place.encode()
            return (int(L._CLASS[raw[-1]]), int(L._CLASS[raw[-2]]) if len(raw) > 1 else 0) if raw else (None,)
        return place[:1] if k == 1 else ()

    learnt = [(before, w) for i, text in rows if not held(i, 10) for t in [tokens(text)] for before, w in zip([None, *t], t, strict=False)]
    v = len({w for _, w in learnt})
    seats, people, tables = [defaultdict(list) for _ in range(4)], [Counter() for _ in range(4)], [Counter() for _ in range(4)]
    params = [(0.5, 1.0)] * 4

    def p(k, place, w):
        if k == 4:
            return 1 / (v + 1)
        (d, a), own = params[k], seats[k].get((place, w), ())
        return (sum(own) - d * len(own) + (a + d * tables[k][place]) * p(k + 1, up(k, place), w)) / (a + people[k][place])

    def come(k, place, w):
        if k < 4:
            (d, a), own = params[k], seats[k][place, w]
            at = rng.choices(range(len(own) + 1), [*(n - d for n in own), (a + d * tables[k][place]) * p(k + 1, up(k, place), w)])[0]
            people[k][place] += 1
            if at < len(own):
                own[at] += 1
            else:
                own.append(1)
                tables[k][place] += 1
                come(k + 1, up(k, place), w)

    def go(k, place, w):
        if k < 4:
            own = seats[k][place, w]
            at = rng.choices(range(len(own)), own)[0]
            people[k][place] -= 1
            own[at] -= 1
            if not own[at]:
                del own[at]
                tables[k][place] -= 1
                go(k + 1, up(k, place), w)

    for x in learnt:
        come(0, *x)
    grid, total = [(float(d), float(a)) for d in L.GRID_D for a in L.GRID_A], Counter()
    for s in range(sweeps):
        for k in range(4):
            for place, w in learnt if k == 0 else [x for x, own in seats[k].items() for _ in range(sum(own))]:
                go(k, place, w)
                come(k, place, w)
        for k in range(4):
            sizes = Counter(n for own in seats[k].values() for n in own)
            by_d = {float(d): sum(n * (math.lgamma(x - d) - math.lgamma(1 - d)) for x, n in sizes.items()) for d in L.GRID_D}
            log_p = [by_d[d] + sum((t - 1) * math.log(d) + math.lgamma(a / d + t) - math.lgamma(a / d + 1) - math.lgamma(a + people[k][r]) + math.lgamma(a + 1) for r, t in tables[k].items() if t) for d, a in grid]
            params[k] = rng.choices(grid, [math.exp(x - max(log_p)) for x in log_p])[0]
        if s >= first:
            for x in {(before, w) for _, text in rows for t in [tokens(text)] for before, w in zip([None, *t], t, strict=False)}:
                total[x] += p(0, *x) / (sweeps - first)
    return {i: sum(math.log10(total[x]) for t in [tokens(text)] for x in zip([None, *t], t, strict=False)) for i, text in rows}


def test_op3_seats_the_customers_of_words_restaurants(spark, tmp_path):
    """The query against a plain model of all levels, which differs from one table a dish."""
    rng = random.Random(14)
    words = [f"{a}{b}{c}" for a in "bdkl" for b in "aei" for c in ("n", "s", "", "lo")]
    rows = []
    for i in range(300):  # every text draws from few words, so that pairs recur and their tables matter
        own = rng.choices(words, k=4)
        rows.append((i, " ".join(rng.choices(own, k=20))))
    rows += [(300, None), (301, "unseen words here"), (302, " ".join(["ban bas"] * 200))]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, score = spark.read.parquet(f"{tmp_path}/documents.parquet"), lambda df: {r["doc_id"]: r["score"] for r in df.collect()}
    plain = [full_model(rows, 30, 10, seed) for seed in (1, 2)]
    mean = {i: sum(p[i] for p in plain) / 2 for i, _ in rows}
    off = lambda got: sum(abs(got[i] - mean[i]) for i, _ in rows)
    one_table = score(L.lm_scores(docs))
    assert abs(sum(one_table.values()) / sum(mean.values()) - 1) > 0.02
    assert off(score(L.op3_lm_scoring(spark, str(tmp_path)))) < 0.7 * off(one_table)  # after a few sweeps
    got = score(L.lm_scores(docs, seat_words=True, burn_in=6, samples=10))
    assert all(abs(got[i] - mean[i]) < 0.25 + 0.02 * abs(mean[i]) for i, _ in rows)
    assert abs(sum(got.values()) / sum(mean.values()) - 1) < 0.005


@pytest.mark.parametrize("c", [9, 40])
def test_scans_that_hold_tables_only_have_the_exact_distribution(c):
    m, pull, d = 4000, 2.0, 0.6
    s = {(0, 0): 1.0}
    for n in range(1, c + 1):
        for t in range(n + 1):
            s[n, t] = s.get((n - 1, t - 1), 0) + (n - 1 - d * t) * s.get((n - 1, t), 0)
    want = np.array([pull**t * s[c, t] for t in range(1, c + 1)])
    key, seats = np.arange(m, dtype=np.uint64), L.Seats.single(np.full(m, c))
    for sweep in range(8):
        seats = seats.scanned(np.full(m, c), np.full(m, pull), d, key, sweep)
        assert (np.bincount(np.repeat(np.arange(m), seats.t), seats.sizes, m) == c).all()
    assert np.abs(np.bincount(seats.t, minlength=c + 1)[1:] / m - want / want.sum()).max() < 0.03


@pytest.fixture(scope="module")
def toxic(spark):
    """Insults in one language, word beginnings in another, junk; labels of some rows, twice for one, null for one."""
    rng = random.Random(4)
    words = [f"{a}{b}{c}" for a in ("ba", "de", "ki", "lo") for b in ("ra", "te", "no") for c in ("n", "s", "ll")]
    rows, labels = [], []
    for i in range(900):
        t = rng.choices(words, k=rng.randint(5, 80))
        y = int(i % 6 == 0)
        if y:
            for _ in range(rng.randint(1, 4)):
                t[rng.randrange(len(t))] = rng.choice(["idiot", "moron"]) if i % 4 == 0 else "zuqu" + rng.choice(words)
        rows.append((i, " ".join(t).capitalize(), "clash"))
        if i % 3 != 1:
            labels.append((i, 1, y))
    labels += [labels[0], (5000, 1, 1), (1, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_rows_are_found_and_clean_ones_left(toxic):
    docs, labels = toxic
    got = T.score(docs, T.fit(docs, labels)).collect()
    y = {i: int(i % 6 == 0) for i in range(900)}
    out = [r for r in got if r["held_out"]]
    assert len(got) == 900 and all(r["held_out"] == held(r["doc_id"], 5) and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert sum(r["predicted"] == y[r["doc_id"]] for r in out) >= 0.97 * len(out)
    assert sum(r["predicted"] for r in got if not y[r["doc_id"]]) <= 3
    kept = T.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in got)


def test_held_out_labels_teach_nothing(toxic):
    from pyspark.sql import functions as F

    docs, labels = toxic
    other = labels.withColumn("toxic", F.when(T.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.fit(docs, labels), T.fit(docs, other)
    assert (a.features == b.features).all() and np.allclose(a.weights, b.weights)


def words_of(text):
    """Plain reading of the words: runs of letters, capitals made small."""
    out, word = [], ""
    for c in text + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c.lower() if c < "\x80" or "À" <= c <= "Þ" else c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_features(text):
    out = Counter()
    for w in words_of(text):
        raw = w.encode()
        out[(0, raw)] += 1
        for k in T.PREFIXES:
            if len(raw) > k:
                out[(k, raw[:k])] += 1
    return out


def named(feature):
    k, raw = feature
    data = np.frombuffer(raw, np.uint8)
    return int(T.hash_spans(data, np.array([0]), np.array([len(raw)]), k)[0])


ODD_WORDS = ["“idiot”", "idiot…", "idiot—really", "¿Idiota?", "l’idiote", "MÜLL!", "日本語。文", "naïve‐x", "ab!!c", "ÀÉÞ", "a_b", "x9y", "😀idiot😀", "e\u0301t", "Straße", "ｗｉｄｅ"]


def test_words_end_at_punctuation_of_any_script():
    rng = random.Random(8)
    texts = ["", *ODD_WORDS, *(" ".join(rng.choices(ODD_WORDS, k=12)) for _ in range(50))]
    (block,) = blocks(pa.array(texts))
    names, doc, f, n = T.features_of(block)
    got = [Counter() for _ in texts]
    for d, k, c in zip(doc.tolist(), f.tolist(), n.tolist(), strict=True):
        got[d][int(names[k])] += c
    assert got == [Counter({named(k): c for k, c in plain_features(t).items()}) for t in texts]
    lexicon = set(T.lexicon_hashes().tolist())
    assert all(lexicon & set(g) for t, g in zip(texts, got, strict=True) if "diot" in t or "MÜLL" in t)


def test_patterns_equal_regular_expressions():
    rng = random.Random(12)
    parts = ["ABC", "DEFG", "AB", "you", "are", "a", "an", "You", "ARE", "tu", "es", "une", "!!", "!", "aaaa", "aaa", "zzzzz", "b4d", "b@d", "4x", "f**k", "f*k", "i d i o t", "x y z", "d", "ÉÉÉ", "du bist ein", "eres", "un", "-", "\n", "é"]
    texts = ["", "a", "!!", *("".join(x + rng.choice([" ", " ", "", ", "]) for x in rng.choices(parts, k=rng.randint(1, 14))) for _ in range(800))]
    (block,) = blocks(pa.array(texts))
    letter = "[^\\W\\d_]"

    def plain(t):
        w = [(m[0], m.start(), m.end()) for m in re.finditer(rf"{letter}+", t)]
        runs = lambda ok, k: any(all(ok[i : i + k]) for i in range(len(ok) - k + 1))
        alone = [len(x.encode()) == 1 and j + 1 < len(w) and t[e : w[j + 1][1]] == " " for j, (x, _, e) in enumerate(w)]
        low = [x.lower() for x, _, _ in w]
        return (runs([bool(re.fullmatch("[A-Z]{3,}", x)) for x, _, _ in w], 3), "!!" in t, bool(re.search(r"([A-Za-z])\1{3}", t.lower() if t.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), t))),
                bool(re.search(r"[A-Za-z][0-9@$][A-Za-z]", t)), runs(alone, 3), bool(re.search(r"[A-Za-z]\*\*", t)), any(low[i : i + len(p.split())] == p.split() for p in T.ADDRESS for i in range(len(low))))

    assert [tuple(x) for x in T.patterns_of(block).tolist()] == [plain(t) for t in texts]


def test_mined_counts_ballots_and_scores_equal_plain_ones(toxic):
    docs, labels = toxic
    y = {}
    for r in labels.collect():
        if r["toxic"] is not None and not held(r["doc_id"], 5):
            y[r["doc_id"]] = max(y.get(r["doc_id"], 0), r["toxic"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    n1, n0 = Counter(), Counter()
    for i, t in texts.items():
        if i in y:
            (n1 if y[i] else n0).update(set(plain_features(t)))
    all1, all0 = sum(y[i] for i in y if i in texts), sum(1 - y[i] for i in y if i in texts)

    def gain(f):
        a, b, p, q = n1[f] + 0.25, n0[f] + 0.25, all1 + 0.5, all0 + 0.5
        if n1[f] < 2 or a / p <= 4 * b / q:
            return 0
        return a * math.log(a / p / ((a + b) / (p + q))) + (p - a) * math.log(max((p - a) / p, 1e-9) / max((p + q - a - b) / (p + q), 1e-9))

    best = {named(f): gain(f) for f in n1 if gain(f) > T.SIGNIFICANT}
    y_rows = labels.where("toxic is not null").groupBy(T.F.col("doc_id").alias("id")).agg(T.F.max("toxic").alias("y")).where(~T.held_out("id"))
    rows = docs.select(T.F.col("doc_id").alias("id"), "text")
    got, g1, g0 = T.mine(rows.join(y_rows, "id").select("y", "text"), 1000)
    assert (g1, g0) == (all1, all0) and set(got.tolist()) == set(best)
    voting = np.unique(np.concatenate([got[:20], T.lexicon_hashes()]))
    place = {int(h): i for i, h in enumerate(voting)}
    want = Counter()
    for i, t in texts.items():
        (block,) = blocks(pa.array([t]))
        extra = [len(voting) + k for k in np.flatnonzero(T.patterns_of(block)[0])]
        want[tuple(sorted(place[named(f)] for f in plain_features(t) if named(f) in place) + extra), y.get(i)] += 1
    cast = {tuple(r["voters"]): (r["n"], r["n1"], r["n0"]) for r in T.ballots(rows, y_rows, voting).collect()}
    assert cast == {v: (sum(want[v, k] for k in (None, 0, 1)), want[v, 1], want[v, 0]) for v, _ in want}
    model = T.fit(docs, labels)
    weight = dict(zip(model.features.tolist(), model.weights, strict=True))
    for r in T.score(docs, model).collect():
        s = model.bias + sum(math.log1p(c) * weight.get(named(f), 0) for f, c in plain_features(texts[r["doc_id"]]).items())
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, s)))))


def plain_em(rows, model, parent, rounds):
    """The label model's expectation maximisation row by row."""
    m = len(parent)
    for _ in range(rounds):
        mass, fires, both = np.zeros(2), np.zeros((2, m)), np.zeros((2, m, m))
        for v in rows:
            odds = math.log(model.prior / (1 - model.prior))
            for i in range(m):
                up = int(v[parent[i]]) if parent[i] != i else 0
                r1, r0 = model.rates[1, up, i], model.rates[0, up, i]
                odds += math.log(r1 / r0) if v[i] else math.log((1 - r1) / (1 - r0))
            q = 1 / (1 + math.exp(-max(-30, min(30, odds))))
            for y, w in ((0, 1 - q), (1, q)):
                mass[y] += w
                fires[y] += w * v
                both[y] += w * np.outer(v, v)
        model = T.estimate(mass, fires, both, parent)
    return model


def test_label_model_learns_accuracies_and_correlations_without_labels(spark):
    """Voters of known accuracies, one of them three times over; labels start the search and don't decide."""
    rng = np.random.default_rng(5)
    n, hit, false = 6000, np.array([0.8, 0.5, 0.3, 0.6]), np.array([0.02, 0.05, 0.01, 0.1])
    y = rng.random(n) < 0.15
    v = rng.random((n, 4)) < np.where(y[:, None], hit, false)
    v = np.concatenate([v, v[:, 3:4], v[:, 3:4]], 1)  # the weakest voter in copies
    gold = np.where(rng.random(n) < 0.05, y.astype(int), -1)
    table = spark.createDataFrame([([int(i) for i in np.flatnonzero(r)], 1, int(g == 1), int(g == 0)) for r, g in zip(v, gold, strict=True)], "voters array<smallint>, n long, n1 long, n0 long").repartition(3)
    model = T.label_model(table, 6, np.arange(1), rounds=20)
    p = model.posterior(v)
    best = hit**v[:, :4] * (1 - hit) ** (1 - v[:, :4].astype(int))
    other = false**v[:, :4] * (1 - false) ** (1 - v[:, :4].astype(int))
    ideal = 0.15 * best.prod(1) / (0.15 * best.prod(1) + 0.85 * other.prod(1))
    assert abs(model.prior - 0.15) < 0.03 and ((p > 0.5) == (ideal > 0.5)).mean() > 0.97 and ((p > 0.5) == y).mean() > 0.93
    assert len(set(model.parent[3:].tolist())) == 1  # the copies hang together
    assert p[(v == [0, 0, 0, 1, 1, 1]).all(1)].max() < 0.6  # and count once
    start = T.LabelModel(model.prior, model.parent, model.rates)
    plain = plain_em(v[:500], start, model.parent, 3)
    few = spark.createDataFrame([([int(i) for i in np.flatnonzero(r)], 1, 0, 0) for r in v[:500]], "voters array<smallint>, n long, n1 long, n0 long").groupBy("voters").agg(*(T.F.sum(c).alias(c) for c in ("n", "n1", "n0")))
    now = start
    for _ in range(3):
        now = T.estimate(*T._sums(few, 6, lambda x, n, a, b, now=now: (n * (1 - now.posterior(x)), n * now.posterior(x))), model.parent)
    assert now.prior == pytest.approx(plain.prior) and np.allclose(now.rates, plain.rates)


def test_odd_rows_are_scored(odd, none, plain, toxic):
    _, labels = toxic
    model = T.fit(odd, labels)
    got = T.score(odd, model).collect()
    assert len(got) == len(plain) and all(0 <= r["score"] <= 1 for r in got)
    assert T.score(none, model).count() == 0 and T.fit(none, labels.limit(0)).bias < 0
    assert T.score(odd, T.fit(odd, labels.where("toxic = 0"))).count() == len(plain)


def test_scores_of_one_text_do_not_depend_on_its_neighbours(toxic, spark):
    docs, labels = toxic
    model = T.fit(docs, labels)
    a = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    b = {r["doc_id"]: r["score"] for r in T.score(docs.where("doc_id % 50 = 0").repartition(7), model).collect()}
    assert all(a[i] == pytest.approx(s) for i, s in b.items())
