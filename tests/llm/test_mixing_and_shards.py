import re
import zlib
from collections import Counter, defaultdict

from tidemark.llm.mixing import mix, mixed, taken
from tidemark.llm.sharding import shard


def fill(sizes, weights, share, most):
    """Targets by sharing the excess out again and again."""
    total, target, full = share * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set()
    while True:
        left = total - sum(target[s] for s in full)
        free = sum(weights[s] for s in sizes if s not in full)
        if not free:
            return target
        for s in sizes:
            if s not in full:
                target[s] = left * weights[s] / free
        over = [s for s in sizes if s not in full and target[s] > most * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = most * sizes[s]
            full.add(s)


def test_mix(spark, odd, none):
    plan = mix(odd, block=16)
    rows = taken(*plan).collect()
    source = {}
    for r in odd.select("doc_id", "source", "text").collect():
        source.setdefault(r["doc_id"], r["source"])
    sizes = Counter()
    for r in rows:
        sizes[source[r["doc_id"]]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = fill(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2.0)
    got = Counter()
    assert len(rows) == odd.count()
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        got[s] += r["taken"]
    assert all(abs(got[s] - want[s]) <= 0.5 for s in sizes)
    pieces = plan[1].collect()
    assert len({p["slot"] for p in pieces}) == len({(p["k"], p["rank"]) for p in pieces})
    per_slot = Counter()
    for p in pieces:
        per_slot[p["slot"]] += p["length"]
    assert sum(n != 16 for n in per_slot.values()) <= len(sizes)  # equal blocks, but a source's last
    assert taken(*mix(none)).count() == 0
    assert sorted(map(str, rows)) == sorted(map(str, taken(*mix(odd, block=16)).collect()))


def test_a_schedule_visits_sources_evenly(spark):
    docs = spark.createDataFrame([(i, "w " * 50, f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    _, pieces = mix(docs, block=32)
    slots = sorted({(p["slot"], p["k"]) for p in pieces.collect()})
    counts = Counter(k for _, k in slots)
    for part in range(1, 8):  # prefixes of the schedule have the mix's shares
        prefix = Counter(k for s, k in slots if s < (slots[-1][0] + 1) * part / 8)
        assert all(abs(prefix[k] - counts[k] * part / 8) <= 8 for k in counts)


def test_mixed_documents(odd, none):
    per = defaultdict(int)
    for r in taken(*mix(odd)).collect():
        per[r["doc_id"]] += r["taken"]
    out = mixed(odd)
    assert out.columns == odd.columns and dict(out.dtypes) == dict(odd.dtypes)
    got = Counter()
    for r in out.select("doc_id", "text", "n_chars").collect():
        got[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert got == +Counter(per)
    assert mixed(none).count() == 0


def test_rows_that_repeat_lose_no_words(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "x")] * 3 + [(2, "f g", "x"), (None, "h i", "x"), (None, "h i", "x")], "doc_id long, text string, source string")
    plan = dict(share=1.3, block=4)
    want = sum(r["taken"] for r in taken(*mix(docs, **plan)).collect())
    assert sum(len(r["text"].split()) for r in mixed(docs, **plan).collect()) == want == round(1.3 * 21)


def test_mixed_rows_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "w " * (30 + i % 50), f"s{i % 3}", i, 0) for i in range(900)], "doc_id long, text string, source string, slot long, gone_id int").repartition(5)
    _, pieces = mix(docs, block=32)
    first = {}
    for p in pieces.collect():
        key = (p["doc_id"], p["epoch"])
        first[key] = min(first.get(key, 1 << 60), p["slot"])
    out = mixed(docs, block=32)
    assert out.columns == docs.columns
    seen, slots = Counter(), []
    for r in out.collect():
        slots.append({first[r["doc_id"], e] for e in (0, 1) if (r["doc_id"], e) in first})
        seen[r["doc_id"]] += 1
    assert seen == Counter(i for i, _ in first)
    at = 0
    for some in slots:  # each row has a slot not before its predecessor's
        at = min(s for s in some if s >= at)
    rows = [r["source"] for r in out.collect()]
    words = Counter()
    for r in docs.select("source", "doc_id").collect():
        words[r["source"]] += sum((r["doc_id"], e) in first for e in (0, 1))
    for part in range(1, 8):  # any prefix has the mixture
        prefix = Counter(rows[: len(rows) * part // 8])
        assert all(abs(prefix[s] / words[s] - part / 8) < 0.06 for s in words)


def test_shards(odd, none, plain):
    rows = shard(odd, 7).collect()
    assert len(rows) == len(plain) and {r["law"] for r in rows} == {"rows"} and all(r["grown_shard"] is None for r in rows)
    shards = defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values()) and {len(s) for s in shards.values()} <= {len(rows) // 7, len(rows) // 7 + 1}
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in plain)
    assert shard(none).count() == 0 and shard(odd.limit(3), 40).count() == 3


def test_every_shard_has_the_mixture(spark):
    docs = spark.createDataFrame([(i, "x", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2100)], "doc_id long, text string, source string")
    joined = shard(docs, 20).join(docs.select("doc_id", "source"), "doc_id").groupBy("shard", "source").count().collect()
    per = defaultdict(dict)
    for r in joined:
        per[r["source"]][r["shard"]] = r["count"]
    assert all(len(p) == 20 and max(p.values()) - min(p.values()) <= 2 for p in per.values())
