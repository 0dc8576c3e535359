from __future__ import annotations

import random

import pytest

#: Texts that try an operator: nothing, white space, signs, several scripts, special tokens, repeats, one long line.
ODD = [None, "", " ", "\n", "\n\n  \t", "a", "Žluťoučký kůň", "中文 字符", "😀 emoji 😀", "x<|endoftext|>y", "it's we'll 123,456.7  　!", "tab\there\r\nline", "word " * 50, "a" * 3000, "The end. " * 400, "nul\0byte"]


@pytest.fixture
def odd_documents(spark):
    rows = [(k, t, "en", None if k % 3 == 0 else f"s{k % 3}", len(t or "")) for k, t in enumerate(ODD)]
    rows += [(3, "repeated id", "en", "s0", 11), (4, "\n\n  \t", "en", "s1", 5), (4, "\n\n  \t", "en", "s1", 5), (None, "no id", "en", "s0", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def made_up(seed: int, n: int, words: int = 60) -> list[str]:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(300)]
    return ["".join(r.choice(vocabulary) + r.choice([" ", " ", " ", ". ", "\n"]) for _ in range(r.randint(1, words))) for _ in range(n)]
