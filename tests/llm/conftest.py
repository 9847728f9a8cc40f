import pytest

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "src0"),
    (2, "the quick  brown fox\tjumps over the lazy dog.", "en", "src0"),
    (3, "The quick brown fox jumps over the\nlazy dog.", None, "src1"),
    (4, None, "en", None),
    (5, "", None, "src7"),
    (6, "   \n ", "de", "src7"),
    (7, "Über die Brücke 🚀 gehen 日本語のテキスト naïve cafés, l'été.", "de", "src12"),
    (8, "word " * 6000 + "end", "en", "src0"),
    (9, "x" * 30_000, "en", "src0"),
    (None, "no id here", "en", "src0"),
    (None, "no id here", "en", "src0"),
    (11, "repeated row", "en", "weird"),
    (11, "repeated row", "en", "weird"),
    (12, "</s> <|endoftext|> [INST] \\ <s> ▁low▁bar  two  spaces ", "fr", "src2"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns whose names the operators use themselves."""
    schema = "doc_id bigint, text string, lang string, source string, ids string, bin int, `row` string, `a.b` int"
    return spark.createDataFrame([(*r, "x", 1, "y", None) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(1, 13)]
    return spark.createDataFrame([*rows, (3, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
