"""Inputs that the tests of the operators share."""

import random
import re

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: texts that every operator must take
ODD = [None, "", " ", "\n\n", "a", "ß é 日本", "x " * 5000, "word", "word", "    a\u0085b", "'s it's <|endoftext|> </s>",
       "a\tb\x0bc\x0cd\re", "0123456789abcdef" * 40, "\x00\x01 control", "é combining"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, repeated rows, a repeated and a null id, columns with clashing names."""
    rows = [(i, t, "en" if i % 3 else None, "s", None) for i, t in enumerate(ODD)]
    rows += [rows[6], rows[6], (2, "another text for an id that is there", "en", None, 1), (None, "no id here", "en", "s", 2)]
    extra = "n long, node long, label string, score string, size string, shard string, piece string, spans string, row string, text_ string"
    return spark.createDataFrame([(*r, 1, 2, "l", "s", "z", "h", "p", "q", "r", "t") for r in rows], f"{DOCS}, {extra}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    """n words of a made-up vocabulary, rare words rarer."""
    return " ".join(f"w{int(rng.paretovariate(0.6)) % words}x{rng.randrange(30)}" for _ in range(n))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
