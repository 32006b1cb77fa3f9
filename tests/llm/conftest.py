from __future__ import annotations

import random

import pytest


@pytest.fixture
def docs(table):
    """Documents given as (doc_id, text); extra columns carry names that operators use themselves."""

    def make(rows):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string, n bigint"
        return table(
            schema,
            [
                {"doc_id": i, "text": t, "lang": (more or [None])[0], "source": f"s{(i or 0) % 3}", "key": "k", "row": "r", "n": 1}
                for i, t, *more in rows
            ],
        )

    return make


@pytest.fixture(scope="session")
def prose():
    """Seeded word salad: prose(seed, words)."""
    vocabulary = [a + b for a in "ka lo mi ne ro sa tu ve".split() for b in "ba di fo gu ha je ki lu".split()]

    def make(seed: int, words: int) -> str:
        rng = random.Random(seed)
        return " ".join(rng.choice(vocabulary) for _ in range(words))

    return make
