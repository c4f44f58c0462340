"""Small document tables with every awkward case."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size int, kept int, failed string, _row int, _n int, key int, bucket int, `group` int, print int, target string"
)
CLASH = (1, 2, "x", 4, 5, 6, 7, 8, 9, "t")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["ra", "Tion", "ande", "os", "Éla", "über", "kel", "min", "do", "ser", "va", "lo"]
    out = []
    for i in range(n):
        out.append("".join(rng.choice(words) for _ in range(rng.randint(1, 3))) + rng.choice(["", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        (1, base), (2, base), (3, base.upper()), (4, " ".join(near)), (5, prose(2, 300)), (6, ""), (7, None),
        (8, " \t\n\x0b\x0c\r "), (9, "one"), (10, "one two"), (11, "one two three"), (12, prose(3, 4000)),
        (13, "a b  c d　e"), (14, "line one here\n" * 40), (15, "\U0001F600 \U0001F600\U0001F601 x"),
        (16, prose(4, 25) + " " + prose(5, 30)), (17, prose(6, 40) + " " + prose(5, 30)), (18, prose(5, 30)),
        (19, "x" * 5000), (20, "<|endoftext|> a<|startoftext|>b 's it's <|"), (None, "no id " * 30), (None, None),
        (21, prose(7, 60)), (21, prose(7, 60)), (21, prose(8, 60)), (-4, prose(9, 90)), (22, "\x1c\x1f a\x00b"),
    ]
    sources = ["s1", "s2", None, "é", "S1"]
    return [
        (i, t, "en", sources[k % 5], None if t is None else len(t), *CLASH) for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3, "n_chars").persist()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain():
    """(doc_id, text, source) of the same rows."""
    return [(r[0], r[1], r[3]) for r in rows()]
