import re
from collections import Counter

import numpy as np
import public_tokenizers
from test_exact_and_near import brute, sets_of
from tokenizers import Tokenizer

from tidemark.llm import mixing, pipeline, toxicity
from tidemark.llm.common import materialize

SF = "/root/testdata/sf0.001"


def test_stages_are_the_operators_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bad = {r["doc_id"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 1").collect()}
    ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == names
        texts = {r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}
        if name == "toxicity":
            assert ids(docs) == Counter(i for i in texts if i not in bad)
        elif name == "exact_dedup":
            last = {t: i for i, t in sorted(texts.items())}
            assert ids(docs) == Counter(last.values())
        elif name == "near_dedup":
            assert ids(docs) == Counter(set(brute(sets_of(sorted(texts.items()))).values()))
        else:
            words = lambda x: re.findall(r"[^\x20\x09-\x0D]+", x or "")
            plan = {r["doc_id"]: r["taken"] for r in mixing.taken(*mixing.mix(before)).collect() if r["taken"]}
            assert ids(docs) == Counter({i: -(-n // len(words(texts[i]))) for i, n in plan.items()})
            got = Counter()
            for r in docs.select("doc_id", "text").collect():
                got[r["doc_id"]] += len(words(r["text"]))
                assert words(texts[r["doc_id"]])[: len(words(r["text"]))] == words(r["text"])
            assert got == Counter(plan)
    pieces, full = pipeline.STAGES[-1][1](spark, docs, SF).collect(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, packed = Counter(), Counter()
    for r in docs.select("doc_id", "text").collect():
        want.update((r["doc_id"], i) for i in [*full.encode(r["text"], add_special_tokens=False).ids, 1])
    for p in pieces:
        packed.update((p["doc_id"], i) for i in np.frombuffer(p["ids"], "<u4").tolist())
    assert packed == want
    fill = Counter()
    for p in pieces:
        fill[p["sequence_id"], p["tier"]] += p["length"]
    assert sum(n < tier for (_, tier), n in fill.items()) <= docs.rdd.getNumPartitions()


def test_empty_tables_pass_all_stages(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
