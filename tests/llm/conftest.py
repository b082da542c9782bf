"""Rows that every operator has to take: nulls, empty and long texts, ties, repeats,
and columns whose names the operators use themselves."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, rules string, node string, run int, word string, weight double, _id long, _hash long, _mix_p double, _mix_source string, _digest string, h long, id string, place string"


@pytest.fixture(scope="session")
def awkward(spark):
    long = " ".join(f"word{i % 977} tail{i}" for i in range(40_000))
    texts = [
        (1, "one two three four five six seven"),
        (2, "one two three four five six seven"),
        (2, "one two three four five six seven"),
        (3, "ONE two\tthree  four\nfive six seven"),
        (4, ""),
        (5, None),
        (6, " \n\t "),
        (None, "one two three four five six seven"),
        (None, None),
        (7, long),
        (8, long + " more"),
        (9, "few words"),
        (9, "other words under the same id"),
        (10, "é́ 漢字 🎉 \u0000 ﷺ ǆ ŉ"),
        (11, "x" * 30_000),
    ]
    rows = [(i, t, None if i in (1, None) else "en", None if i == 9 else "src", 0, 1.0, "r", "n", 1, "w", 0.5, 7, 8, 0.1, "m", "d", 3, "x", "p") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
