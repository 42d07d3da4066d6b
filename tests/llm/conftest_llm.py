import pytest

#: Names that operators use for columns of their own, or that their results carry.
CLASHING = ["lang_pred", "score", "rejected", "node", "h", "i", "w", "a", "b", "r", "n", "k", "spans", "candidates", "u", "v", "size", "sig", "words", "lines", "class_id", "label", "value", "text_", "ids"]

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    """n words, different for each seed."""
    return " ".join(f"{WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)]}{(seed * 31 + k) % 97}" for k in range(n))


def make_docs(spark, rows):
    """documents with nulls allowed anywhere and extra columns with clashing names."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame([(d, t, lang, "s", None if t is None else len(t)) for d, t, lang in rows], schema)
    return df.selectExpr("*", *(f"'x' as `{name}`" for name in CLASHING))


@pytest.fixture(scope="session")
def edge_rows():
    long_word = "x" * 60_000
    return [
        (1, None, "en"),
        (2, "", "en"),
        (3, " \n\t ", None),
        (None, "a text whose id is null, with some more words after it", "en"),
        (4, prose(4, 120), "en"),
        (4, prose(4, 120), "en"),  # a repeated row
        (4, "another text under the same id", "en"),
        (5, prose(5, 20_000), "en"),
        (6, long_word + " " + "1" * 40_000 + " a@" + "b." * 3_000 + "com " + "7 " * 20_000, None),
        (7, "\x01\x02\x03\x04 control <|endoftext|> \\### </turn> 漢字 🎉 é", "fr"),
        (8, "1234 !!!", None),
    ]


@pytest.fixture()
def edge_docs(spark, edge_rows):
    return make_docs(spark, edge_rows)


@pytest.fixture()
def empty_docs(spark):
    return make_docs(spark, [])
