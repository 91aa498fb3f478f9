import pytest

# Rows that operators on documents must bear: missing values in every column, empty, blank and
# very long texts, equal texts and rows, special tokens, and columns whose names operators use.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. It was happy!"),
    (2, "The quick brown fox  jumps over\nthe lazy dog. It was happy!"),
    (3, ""),
    (4, None),
    (5, " \t\n\x0b\x0c\r "),
    (6, "word " * 30_000),
    (7, "x" * 100_000),
    (8, "Écrire à jean.dupont+test@mail.example.com ou +33 (0)1 23-45-67 89, 10.0.0.255."),
    (8, "Écrire à jean.dupont+test@mail.example.com ou +33 (0)1 23-45-67 89, 10.0.0.255."),
    (9, "<|endoftext|>ids<|startoftext|> 日本語 😀 é é     1²3 don't"),
    (None, "no id"),
    (None, None),
    (10, "no id"),
    (11, "12345"),
    (12, "a.b@c.d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 4111111111111112"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """(doc_id, text, lang, source, n_chars) and columns with names that could clash."""
    rows = [(i, t, None, None, None, 1, "k", b"d", 2.0, "s") for i, t in TEXTS]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, row int, "
        "key string, digest binary, n double, kind string",
    )


@pytest.fixture(scope="session")
def none(odd):
    """The same table without rows."""
    return odd.where("false")
