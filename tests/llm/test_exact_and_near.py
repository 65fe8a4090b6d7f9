import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import near_dedup as N
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import OpenTable, exact_dedup, grace, without_copies
from tidemark.llm.near_dedup import near_duplicates, without_near_copies


def test_exact_groups(odd, plain):
    got = exact_dedup(odd).collect()
    groups = defaultdict(list)
    for i, t in plain:
        groups[t or ""].append(i)
    assert len(got) == len(plain)
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = sha[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(known) if known else None)
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(dict.fromkeys(sha, 1))


def test_exact_stage_and_empty(odd, none, plain):
    assert exact_dedup(none).count() == 0 and without_copies(none).count() == 0
    out = without_copies(odd)
    assert out.columns == odd.columns
    assert Counter(r["text"] or "" for r in out.collect()) == Counter({t or "" for _, t in plain})


def test_grace_splits_and_compares_contents():
    rng = random.Random(1)
    texts = [str(rng.randrange(3000)).encode() * 20 for _ in range(20000)]
    records = [(hash(t) >> 2 & 2**62 - 1, t, 1, i) for i, t in enumerate(texts)]
    want = {t: (n, max(i for i, x in enumerate(texts) if x == t) if n < 3 else None) for t, n in Counter(texts).items()}
    got, tables = {}, 0
    for table in grace(iter(records), 20_000):
        tables += 1
        for _, t, n, keep in table.records():
            assert t not in got
            got[t] = (n, keep if n < 3 else None)
    assert tables > 1 and got == want


def test_one_hash_for_different_contents():
    table = OpenTable()
    for i in range(3000):
        table.add(7, str(i % 1500).encode(), 1, i)
    assert sorted(table.counts) == [2] * 1500
    (only,) = grace(iter([(7, str(i).encode(), 1, i) for i in range(100)]), 10)
    assert len(only.contents) == 100


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()
    return out


def brute(sets):
    ids = sorted(sets)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = root(ids[x]), root(ids[y])
                up[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def near_rows(n=260, seed=3):
    """Texts with copies of every degree, a chain, and a passage that many share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    shared = rng.choices(words, k=40)
    rows = []
    for i in range(n):
        if i % 3 and rows:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
        else:
            text = rng.choices(words, k=rng.randint(3, 150)) + (shared if i % 2 else [])
        rows.append((i * 7 % 1009, " ".join(text)))
    return rows


@pytest.mark.parametrize("together", [2048, 40])
def test_near_components_equal_brute_force(spark, monkeypatch, together):
    monkeypatch.setattr(N, "TOGETHER", together)
    rows = near_rows()
    sets = sets_of(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(sets)
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_tells_texts_apart_that_simple_hashes_confuse(spark):
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    rows = [(10 * k + i, "".join((a, b)[x ^ i] for x in bits[:n])) for k, (a, b, n) in enumerate([("a", "b", 1024), ("e", "q", 1024), ("0", "x", 2048)]) for i in (0, 1)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6 and all(r["component_id"] == r["doc_id"] for r in got)


def test_a_large_group_of_near_copies(spark):
    """20,000 near copies of a text, and others that share a passage with them, in far less than a comparison of all pairs."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    shared = rng.choices(words, k=60)
    rows = [(i, " ".join([*shared, f"n{i}", *rng.choices(words, k=2)])) for i in range(20_000)]
    rows += [(i, " ".join([*shared[:20], *rng.choices(words, k=60)])) for i in range(20_000, 21_000)]
    began = time.perf_counter()
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert all(got[i] == (0 if i < 20_000 else i) for i in got) and len(got) == 21_000
    assert time.perf_counter() - began < 120


def test_near_odd_rows(odd, none, plain):
    assert near_duplicates(none).count() == 0
    got = near_duplicates(odd).collect()
    assert len(got) == len(plain)
    sets = sets_of([r for r in plain if r[0] is not None])
    want = brute(sets)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"]) == (want[r["doc_id"]], len(sets[r["doc_id"]]))
    assert without_near_copies(odd).columns == odd.columns and without_near_copies(none).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 3000).astype(np.uint64)
    left, right, union = a[:2000], a[500:], a
    s = N.sketch(np.concatenate([left, right, union]), np.cumsum([0, 2000, 2500, 3000]))
    assert (np.maximum(s[0], s[1]) == s[2]).all()  # a register is a maximum, so sketches of parts give the whole's
    real = 1500 / 3000
    assert N.likely(s[0], 2000, s[1:2], np.array([2500]), real - 0.2)[0] and not N.likely(s[0], 2000, s[1:2], np.array([2500]), real + 0.2)[0]
    one = N.sketch(a[:1], np.array([0, 1, 1]))
    assert (one[0] > 0).all() and (one[1] == 0).all()


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 60)] + [(1, 1), (None, 3), (900, 800), (800, 900)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in range(5, 60)} | {800: 800, 900: 800}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
