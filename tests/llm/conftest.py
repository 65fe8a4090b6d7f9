import random

import pytest

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names the operators use inside."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["é", "naïve,", "ÜBER", "x y", "日本語", "<s>", "<|endoftext|>", "▁"]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    base = [prose(rng.randint(1, 120)) for _ in range(30)]
    texts = [*base, None, None, "", "", " ", "\n\t ", "one", "one two three four", "a b c d e", prose(20000), "z" * 30000, base[3], base[3], base[4], base[5] + " tail words", base[6].replace(" ", "\n")]
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None, "clash", i, 1, 1, 1, "k", 0) for i, t in enumerate(texts)]
    rows += [(None, "a null id", None, None, None, None, None, None, None, None, None, None), rows[4], rows[4]]
    return spark.createDataFrame(rows, KINDS + ", size string, b long, n long, c long, rank long, k string, shard int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="session")
def plain(odd):
    """The rows of ``odd`` as (doc_id, text)."""
    return [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
