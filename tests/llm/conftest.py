import pytest
from pyspark.sql import SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    """Makes a documents table from texts; ids count up, `repeat` adds every row again, others as given."""

    def make(texts, extra=None, repeat=False):
        rows = [(k, text, "en", "src", len(text or "")) for k, text in enumerate(texts)]
        rows += extra or []
        if repeat:
            rows += rows
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "one two",
    "  a   b \n\n c\t",
    "don't we're <|endoftext|> they'll <|startoftext|>x",
    "É é İ ΑΣ ß 中文 ¼ ² \U0001f600 Ᲊ",
    "x" * 5000,
    "the cat sat on the mat " * 3000,
    "1 2 3 " * 200,
]


@pytest.fixture(scope="session")
def odd_texts():
    return list(ODD_TEXTS)
