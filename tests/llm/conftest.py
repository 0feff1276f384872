import pytest

LONG = "alpha beta gamma delta " * 3000
# ids, texts and sources that are null, empty, very long, repeated or alike
ROWS = [
    (1, "The cat sat on the mat today", "en", "a", 1.0, "x"),
    (2, "The cat sat on the mat today", "en", "a", 2.0, "y"),
    (2, "The cat sat on the mat today", "en", "a", 2.0, "y"),
    (3, "the CAT sat  on\tthe mat today", "en", None, 1.0, "x"),
    (4, None, "en", "b", None, None),
    (5, "", None, "b", 0.0, ""),
    (None, "Le chat est sur le tapis", "fr", "c", 0.0, ""),
    (None, None, None, None, None, None),
    (6, LONG, "en", "a", 0.0, "z"),
    (7, LONG + "epsilon", "en", "c", 0.0, "z"),
    (8, "12 34 !! ??", "fr", "c", 0.0, ""),
    (9, " \t\n ", "fr", "Ä", 0.0, ""),
]
# extra columns with names that operators use for their own
SCHEMA = "doc_id long, text string, lang string, source string, score double, component_id string"


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture
def folder_of(spark, tmp_path):
    """Writes tables to a folder as the queries expect it."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


