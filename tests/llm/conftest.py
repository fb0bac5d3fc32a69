from __future__ import annotations

import random

import pytest


SCHEMA = "text string, doc_id long, n_words string, source string, lang string, n_chars long"


def odd_texts() -> list[str | None]:
    """Null, empty, blank, very short and very long texts, odd spaces and scripts, repeated rows."""
    rnd = random.Random(5)
    words = ["the", "The", "a", "naïve", "x1", "don't", "東京都", "🎉🎉", "1234567", "..!?", "'s", "é", "ÅΣ", "<|endoftext|>"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", "  ", "  ", "\x1c", "\x0b", "\r\n", "　\n "]
    texts = [None, "", " ", "\n \n", "a", " a", "a ", " ", "   x", "no  gaps\n\nhere \n", "z" * 3000, "ab" * 2000 + " end", "1 " * 500]
    texts += ["".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.choice([3, 30, 300]))) for _ in range(60)]
    texts.append("".join(rnd.choice(words) + " " for _ in range(60_000)))
    return texts + texts[:14]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows in an order of their own, with columns that clash with the operators' and nulls in all but doc_id."""
    rows = [(t, 1000 - k, "x" if k % 3 else None, f"s{k % 4}" if k % 5 else None, "en" if k % 2 else None, None) for k, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def texts(odd):
    return {r.doc_id: r.text or "" for r in odd.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
