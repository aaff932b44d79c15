import pytest

TEXTS = [
    (5, "The cat sat on the mat.\nIt's  late, isn't it?", "en", "s", 44),
    (3, None, None, None, None),
    (9, "", "en", "s", 0),
    (1, "Ünïcode – 漢字 and 🙂🙂 <|endoftext|> here", "de", "s", 40),
    (12, "word " * 3000, "en", "s", 15000),
    (12, "a repeated id", "en", "s", 13),
    (14, "a" * 5000, None, "s", 5000),
    (15, " \t\n ", "en", "s", 4),
    (16, "The cat sat on the mat.\nIt's  late, isn't it?", "en", "s", 44),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    from daylog.llm.common import ship_code

    ship_code(spark)
    return spark.createDataFrame(TEXTS, SCHEMA)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
