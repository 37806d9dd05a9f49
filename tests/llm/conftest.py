import pytest

# ids and texts that every operator on documents must take: null, empty, blank, repeated rows, ties, a very long text
AWKWARD = [
    (1, "the cat sat on the mat and looked at the dog", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "  \n\t ", "en"),
    (5, "the cat sat on the mat and looked at the dog", "en"),
    (5, "the cat sat on the mat and looked at the dog", "en"),
    (6, "le chat était assis sur le tapis et regardait le chien 😀", "fr"),
    (7, "word " * 30_000 + "end", "en"),
    (8, "a" * 50_000, None),
    (None, "no id but a text about a cat", "en"),
    (9, "12345 67890 !!! ???", "en"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string").repartition(3)


@pytest.fixture(scope="session")
def crowded(awkward):
    """The same with further columns whose names the operators use inside."""
    extra = ["key", "fp", "node", "row", "whole", "group", "label", "rank", "bucket", "gram", "spans", "count", "n", "size"]
    return awkward.selectExpr("*", *[f"'x' AS `{c}`" for c in extra])


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.filter("false")
