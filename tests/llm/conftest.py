"""Messy tables for the operators on training data."""

import random

import pytest

EXTRA = "row string, copies long, target double, h long, keys string, lost_id long, size long, n long, score double"


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """doc_id -> text: exact and near copies, shared lines, short, empty, null and very long texts."""
    base = " ".join(words(1, 120))
    near = base.replace(base.split()[60], "changed", 1)
    far = " ".join(words(2, 120))
    return {
        1: base, 2: base.upper(), 3: near, 4: far, 5: "", 6: None, 7: " \t\n ", 8: "one", 9: "One two",
        10: "one", 11: " ".join(words(3, 60_000, 5000)), 12: "x" * 200_000, 13: base + "\n" + far,
        14: "a line that stands in two documents, word for word\n" + " ".join(words(4, 40)),
        15: " ".join(words(5, 40)) + "\na line that stands in two documents, word for word\n\n",
        16: "é ü 字 😀 " + " ".join(words(6, 30)),
    }


@pytest.fixture(scope="session")
def messy(spark, texts):
    """The texts with null ids, repeated rows, null sources and languages, and extra columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, "b" if i % 3 else None, len(t or "")) for i, t in texts.items()]
    rows += [rows[0], rows[3], (None, "no id here", "en", "b", 10), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
    return spark.createDataFrame([(*r, *["x", 1, 1.0, 1, "k", 1, 1, 1, 0.5]) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
