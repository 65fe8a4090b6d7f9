import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import textkit
from tidemark.llm.packing import ChunkEncoder, TierPacker, encoder, pack
from tidemark.llm.textkit import blocks, pack as squeeze, unpack
from tidemark.llm.token_counts import count_tokens, counter

AL = [*"ab  \n\t▁éßthe er in of　😀ﬁ<s></>0x10,.'\x00\x1c\x85", "the", "ing", "  ", "   ", "<0x0A>", "'s", "<|endoftext|>", "\xa0"]


def twins(a, b, n):
    """Two texts that polynomial hashes modulo 2**64 confuse: the Thue-Morse sequence over a and b, and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


def samples(n=1500):
    rng = random.Random(2)
    return ["".join(rng.choices(AL, k=rng.randint(0, 30))) for _ in range(n)] + ["a" * 3000, " " * 300, "", "ab" * 1000]


def test_counts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = samples()
    c = counter("piece_bpe_32k.model")
    got = np.concatenate([c.block(b) for b in blocks(pa.array([t.replace("▁", " ") for t in texts]), 4000)])
    assert got.tolist() == [len(x) for x in model.encode(texts)]


def test_count_rows(odd, none, plain):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(odd).collect())
    n = [(i, t or "", len(model.encode(t or ""))) for i, t in plain]
    assert got == sorted((str(i), len(t.encode()), k, k > 4096) for i, t, k in n)
    assert count_tokens(none).count() == 0


def test_ids_equal_the_tokenizer():
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = samples()
    e = encoder("byte_bpe_50k")
    for _ in range(2):  # the second time from memory
        got = [x.tolist() for b in blocks(pa.array(texts), 4000) for x in e.block(b)]
        assert got == [x.ids for x in full.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("n", [512, 1024, 2048])
def test_texts_that_simple_hashes_confuse_are_told_apart(n):
    texts = [x for a, b in ("ab", "th", "in", "eq", "0x") for x in twins(a, b, n)]
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    e, c = ChunkEncoder("byte_bpe_50k"), counter("piece_bpe_32k.model")
    assert [x.tolist() for b in blocks(pa.array(texts)) for x in e.block(b)] == [x.ids for x in full.encode_batch(texts, add_special_tokens=False)]
    assert np.concatenate([c.block(b) for b in blocks(pa.array(texts))]).tolist() == [len(x) for x in model.encode(texts)]


def test_contents_decide_where_hashes_meet(monkeypatch):
    rng = random.Random(7)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 90))) for _ in range(300)]
    data, ends = np.frombuffer("".join(words).encode(), np.uint8), np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    assert len(set(textkit.hash_spans(data, starts, ends).tolist())) == len(set(words))
    for poor in (None, lambda d, s, e, seed=0: (e - s).astype(np.uint64) % np.uint64(3)):
        if poor:
            monkeypatch.setattr(textkit, "hash_spans", poor)
        at, which = textkit.distinct(data, starts, ends)
        assert [words[at[k]] for k in which] == words and len(at) == len(set(words))


def test_white_space_at_the_end_of_a_text_stays_with_it():
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ends = ["", "\n", "\n\n", "\n\n\n", " ", "  ", "\t", "\r\n", " \n"]
    texts = [t for a in ends for t in (f"foo bar{a}", "letters first", a, "baz", f"one two{a}", "", f"foo bar{a}{a}", " qux")]
    e = ChunkEncoder("byte_bpe_50k")
    for some in (texts, texts, texts[::-1]):  # again from memory, and with other neighbours
        got = [x.tolist() for b in blocks(pa.array(some)) for x in e.block(b)]
        assert got == [x.ids for x in full.encode_batch(some, add_special_tokens=False)]


def test_pieces_cover_documents_and_windows(odd, none, plain):
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = pack(odd).collect()
    docs, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0
        docs[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for i, t in plain:
        want[i].append([*full.encode(t or "", add_special_tokens=False).ids, 1])
    for i, own in docs.items():
        ids = sorted((r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in own)
        if len(want[i]) == 1:
            assert [x for _, piece in ids for x in piece] == want[i][0]
            assert all(r["doc_tokens"] == len(want[i][0]) for r in own)
        else:
            assert sum(len(p) for _, p in ids) == sum(map(len, want[i]))
    assert set(docs) == set(want)
    for own in windows.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= own[0]["tier"] <= 2048 and len({(r["tier"], r["step_group"]) for r in own}) == 1
    assert pack(none).count() == 0


def test_windows_have_no_gaps_but_the_last_and_groups_are_even():
    rng = random.Random(1)
    packer = TierPacker((256, 512, 1024, 2048), 4096, 0, pool=64)
    rows = [x for i in range(3000) for x in packer.add(i, bytes(4 * rng.choice([3, 40, 100, 200, 200, 300, 300, 400, 700, 1500, 5000])))]
    rows += packer.drain(0)
    used, tier, group = defaultdict(int), {}, {}
    for r in rows:
        used[r[5]] += r[2]
        tier[r[5]], group[r[5]] = r[7], r[8]
    assert sum(tier[s] - n for s, n in used.items()) < 2048 and sum(used[s] < tier[s] for s in used) <= 1
    counts = Counter(tier.values())
    assert all(counts[t] > 20 for t in (256, 512, 1024, 2048))
    own = Counter()
    for r in rows:
        own[r[7], next(t for t in (256, 512, 1024, 2048) if r[2] <= t)] += 1
    assert own[2048, 256] and own[2048, 512]  # long windows have rests of shorter tiers
    sums = defaultdict(int)
    for s, g in group.items():
        sums[g] += tier[s]
    assert sum(n < 4096 for n in sums.values()) <= 5 and max(sums.values()) == 4096


def test_arrays_pack_and_unpack():
    for a in (np.arange(1000, dtype=np.uint64) << np.uint64(40), np.array([], np.uint32), np.array([1.5, -2], np.float32)):
        assert (unpack(squeeze(a), a.dtype) == a).all()
