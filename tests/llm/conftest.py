import pytest

#: Texts with every special case: null, empty, spaces only, short, accents, repeats, a very long one.
LONG = "Lorem ipsum dolor sit amet, consectetur adipiscing elit. " * 3000
TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog and runs far away from it all.", "a"),
    (1, None, "b"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (4, "One two", "b"),
    (5, "The quick brown fox jumps over the lazy dog and runs far away from it all.", "a"),
    (6, "Élan vital, naïve façade — ÉCOLE d'été fin.", "c"),
    (7, LONG, "a"),
    (8, "the QUICK brown  fox jumps\nover the lazy dog and runs far away from it all.", None),
    (9, "x\x00y \x01 z <|endoftext|> it's [INST] 12,5.", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The special cases, with columns named like the operators' own and a repeated row."""
    rows = [(i, t, s, "n", 1, 2) for i, t, s in TEXTS] + [(5, TEXTS[5][1], "a", "n", 1, 2)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string, key int, id int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string, lang string, n_chars bigint")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
