import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, length int, piece string"


def make_rows(seed: int = 3) -> list[tuple]:
    """Small documents: copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    random.seed(seed)
    words = ["".join(random.choices("abcdeé", k=random.randint(1, 4))) for _ in range(60)]
    draw = lambda n: random.choices(words, k=n)
    passage, base = draw(45), draw(60)
    texts: list[str | None] = [None, "", "   \n\t", "one", "Two words", " ".join(draw(5)), " ".join(draw(6000))]
    texts += [" ".join(base)] * 3
    for i in range(6):  # near copies
        near = list(base)
        near[i * 7] = f"x{i}"
        texts.append(" ".join(near).upper() if i == 5 else " ".join(near))
    texts += [" ".join(draw(20) + passage + draw(i)) for i in range(6)]
    texts += [" ".join(draw(random.randint(1, 80))) + random.choice(["", "\n", "  "]) for _ in range(25)]
    texts += ["a a a a a a " * 20, "é" * 30, "tab\tand\x0bfeed\x0cend", " ".join(passage)]
    rows = [(i + 1, t, "en", f"s{i % 3}", len(t or ""), 5, "clash") for i, t in enumerate(texts)]
    return [*rows, rows[8], rows[8], (None, " ".join(base), None, None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
