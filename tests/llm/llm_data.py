"""Small inputs that the tests of this folder share."""

LONG = "lorem ipsum dolor " * 6000
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, key int"


def odd_documents(spark):
    """Nulls anywhere, empty and long texts, ties, repeated rows, and names that clash."""
    texts = [
        (1, "Hello World and some more words"),
        (2, "hello world and some more words"),
        (3, None),
        (4, ""),
        (5, " \t\n"),
        (6, "É È 123"),
        (7, LONG),
        (8, LONG),
        (8, LONG),
        (None, "no id"),
        (None, "NO ID"),
        (9, "12345 !!!"),
        (10, "only two"),
    ]
    rows = [
        (i, t, "en" if n % 2 else None, None if n % 3 else f"s{n % 4}", None, n, None)
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
