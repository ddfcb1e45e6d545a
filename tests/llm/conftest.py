import random

import pytest

LONG = " ".join(f"w{i % 977}x{i}" for i in range(12_000))


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(["stone", "river", "Moon", "glass", "paper,", "wind", "été.", "field", "salt", "iron"]) + str(r.randrange(50)) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows and ids, near copies, shared passages."""
    shared = prose(1, 120)
    base = prose(2, 90)
    near = base.split()
    near[40] = "changed"
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "   \n\t", "b"), (4, base, "b"), (5, " ".join(near), None), (6, base, "a"), (6, base, "a"), (7, prose(3, 60), "b"),
        (7, prose(4, 60), "b"), (None, base, "a"), (None, None, None), (8, LONG, "a"), (9, LONG + " end", "a"), (10, prose(5, 30) + " " + shared + " " + prose(6, 30), "c"),
        (11, prose(7, 45) + "\n" + shared + "\n" + prose(8, 20), None), (12, "one", "c"), (13, "One", "c"), (14, "two words", "a"), (15, "a b c d", "a"), (16, "ab " * 300, "b"),
    ]
    return rows


NAMES = ["n", "rep", "key", "component", "keep", "tag", "doc", "_range", "rank", "fingerprint", "h1", "target", "s0"]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns whose names operators use themselves."""
    rows = [(*r, len(r[1] or ""), *["x"] * len(NAMES)) for r in odd_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
