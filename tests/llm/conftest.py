import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, alphabet: str = "abdeklmnorst") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """(doc_id, text): nulls, empty, very long, copies, near copies, shared passages, ties, odd characters."""
    base, passage = prose(1, 200), prose(2, 60)
    swapped = base.split()
    swapped[50:53] = ["other", "words", "here"]
    far = base.split()
    for k in range(0, 200, 9):
        far[k] = f"x{k}"
    return [
        (1, base), (2, base), (3, base.upper()), (4, " ".join(swapped)), (5, None), (6, ""), (7, "  \n\t "), (8, "one two three"),
        (9, "One two  three"), (10, prose(3, 30) + " " + passage + " " + prose(4, 40)), (11, passage + "\n" + prose(5, 90)),
        (12, prose(6, 25) + "\n" + passage), (13, prose(7, 30_000)), (14, "la la la " * 100), (15, "same line here\n" * 12 + prose(8, 40)),
        (16, "héé ßtraße İstanbul 中文 don't we'll " + prose(9, 30) + " $$ ## <|endoftext|>"), (17, " ".join(far)), (18, "x" * 5000),
        (19, "a\x1cb \x85c\xa0d   e \n f" + " " * 40), (20, passage), (21, "word"), (22, " ".join(swapped[:-1] + ["end"])),
        (23, prose(10, 21)), (24, "ab " * 13), (25, "1 2 3 4 , . ; ! ? " * 5),
    ]


@pytest.fixture
def docs(spark, odd_texts):
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}", len(t or "")) for i, t in odd_texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)
