from __future__ import annotations

import datetime as dt
import random

import pytest

SYLLABLES = "an ti re on en th er st al in or ed".split()


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(600)]


@pytest.fixture(scope="session")
def table(spark):
    """Documents, with further columns whose names the operators use for themselves."""

    def made(rows):
        clash = (7, "x", 1.5, True, dt.date(2024, 1, 1))
        return spark.createDataFrame(
            [(*row, *clash) for row in rows],
            "doc_id long, text string, id long, line string, rate double, query boolean, n date",
        )

    return made


@pytest.fixture(scope="session")
def odd(words):
    """Texts that must not break anything: null, empty, blank, short, long, repeated, odd characters."""
    rng = random.Random(9)
    long = " ".join(rng.choices(words, k=60_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "é 🙂 中文\nline two"), (6, long), (7, long),
        (8, "x" * 50_000), (9, "12 34 !!"), (9, "12 34 !!"), (None, "no id here at all"), (10, "a\x00b   c"),
    ]
