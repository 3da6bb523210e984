import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, key int, row int, block int, "
    "ids string, class_id string, lang_pred string, part int, rep long, length int"
)


def table(spark, rows):
    """Documents with columns whose names the operators use inside; ``rows`` are (doc_id, text, lang)."""
    return spark.createDataFrame([(i, t, g, "s", None if t is None else len(t), "x", 1, 2, 3, "y", "z", "w", 4, 5, 6) for i, t, g in rows], SCHEMA)


def invented(rng: random.Random, n: int, syllables: str = "ka lo mi ten sar ou ei ph rat und") -> str:
    parts = syllables.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and wordless texts, copies, repeated rows, a very long text, one very long word, unusual characters."""
    rng = random.Random(7)
    long = invented(rng, 60_000)
    base = invented(rng, 120)
    near = base.split()
    near[60] = "other"
    rows = [
        (1, None, "en"), (2, "", "en"), (3, "   \n ?!", None), (4, base, "en"), (5, base, "fr"), (5, base, "fr"), (6, " ".join(near), "en"),
        (7, long, "en"), (8, "x" * 70_000, "en"), (None, base, "en"), (None, None, None), (9, "one two", "en"), (10, "one two", "en"),
        (11, "é̀ ́ß 日本語 \U0001f642 ²Ⅷ   <|endoftext|> \x1c\x85", "fr"), (12, "ONE two", "en"), (13, invented(rng, 40), "fr"), (14, "one", "en"),
    ]
    return table(spark, rows).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return table(spark, [])
