"""Small documents with every awkward case, shared by the tests of the corpus operators."""

import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("aeiou") + pick.choice("lmnrst") for _ in range(pick.randint(1, 4))) for _ in range(n))


def awkward_rows() -> list[tuple]:
    base = words(1, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (0, base, "en", "a", 1),
        (1, " ".join(near), "en", "a", None),
        (2, base.replace(" ", "\n\t", 3), "en", "b", 2),  # equal up to white space
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n ", "de", None, 4),
        (6, "one", "de", "b", 3),
        (None, words(2, 40), "de", "b", 5),
        (None, words(2, 40), "de", "b", 5),  # a repeated row with a null id
        (8, words(3, 30), None, "c", 7),
        (8, words(3, 30), None, "c", 7),  # a repeated row
        (8, words(4, 30), "fr", "c", 7),  # the same id again
        (9, words(5, 30_000), "en", "long", 9),
        (10, "x" * 20_000, "en", "long", 9),
        (11, "naïve Ünïcode 日本語 🙂 текст " * 3, "fr", "é", 9),
        (12, "repeat this line. " * 50, "en", "a", 9),
    ]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def clashing(awkward):
    """The awkward rows with columns named like those that operators make or use inside."""
    from pyspark.sql import functions as F

    names = "score row size content kept keep_id group_size digest keys root node label token_ids n_tokens spans found base target sid bucket"
    return awkward.select("*", *(F.lit(f"extra {n}").alias(n) for n in names.split()))
