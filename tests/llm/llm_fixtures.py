from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng: random.Random, words: int, stems: str = "ab cde fgh ij klm nop qr stu vw xyz") -> str:
    parts = stems.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([r if isinstance(r, tuple) and len(r) == 5 else row(*r) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and blank texts, repeated rows, a shared id, a very long text."""
    rng = random.Random(3)
    same = prose(rng, 40)
    return make_docs([
        (1, None), (None, None), (None, same), (2, ""), (3, " \n\t "), (4, same), (4, same), (5, same), (5, prose(rng, 30)),
        (6, prose(rng, 30_000)), (7, "a"), (8, "é 漢 😀 'll don't"), (9, same, None, None), (10, "x" * 5000),
    ])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
