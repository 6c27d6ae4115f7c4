import pytest
from pyspark.sql import Row


@pytest.fixture()
def docs(spark):
    """Rows with nulls, empty and very long texts, repeats and a column whose name operators use themselves."""
    long_text = " ".join(f"word{i}" for i in range(30000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 5),
        (2, None, "en", "a", 5), (3, "", None, "b", 5), (4, "   \n\t ", "en", None, None),
        (5, long_text, "en", "b", 1), (6, long_text, "en", "b", 1), (6, long_text, "en", "b", 1),
        (7, "12345 --- 999 ...", "de", "c", 2), (None, "A row without an id, yet with text in it.", "en", "c", 3),
        (8, "Straße und Größe: don't <|endoftext|> x́ 漢字", "de", "c", 3), (9, "two words", "fr", "c", 3),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")


@pytest.fixture()
def none(docs):
    return docs.where("false")


def rows_of(df) -> list[Row]:
    return df.collect()
