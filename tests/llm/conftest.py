import pytest


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long, repeated, accented and broken texts."""
    return [
        None,
        "",
        " \t\n\x0b\f\r",
        "word",
        "two words",
        "The quick brown fox. " * 40,
        "the QUICK brown fox. " * 40,
        "É é ß İ ñ 日本語 🙂",
        "a" * 30_000,
        "line one\nline one\n\nline two " * 3_000,
        "<|endoftext|> in a text <|endoftext|>",
        "The quick brown fox. " * 40,
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_texts):
    """Documents with odd texts, ids that are null or repeated, and columns named like the operators' own."""
    rows = [(None if i == 3 else i // 2 if i > 9 else i, t, "x", "y", 1, "z", True, 7) for i, t in enumerate(odd_texts)]
    rows += [rows[5], rows[5], (5, "another text", "x", "y", 1, "z", True, 7)]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, kept boolean, quality int",
    ).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
