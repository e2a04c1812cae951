import pytest

ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t\n", None, None), (4, "one", "fr", "b"), (5, "one", "fr", "b"),
    (5, "one", "fr", "b"), (None, "lost id with a few words", "en", None),
    (7, "word " * 30_000, "en", "a"), (8, "x" * 200_000, "de", "a"),
    (9, "Ünïcödé tëxt — 你好 mit license\n" * 3, "de", "c"),
    (10, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" mail a@b.example.com or +1 (743) 555-3824, 4111 1111 1111 1111 at 10.0.0.1', "en", "c"),
]

CLASHES = ["_s", "_q", "_d", "_h", "_r", "lines", "_source", "_tokens", "_id", "emptied", "n_lines", "topic", "kept", "stratum", "a.b", "_once"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, blanks, repeats, long texts, and columns with names that the operators use themselves."""
    rows = [(*r, None, "clash", 1, *[n for n in CLASHES]) for r in ODD]
    more = ", ".join(f"`{n}` string" for n in CLASHES)
    return spark.createDataFrame(
        rows, f"doc_id long, text string, lang string, source string, n_chars long, base string, tokens int, {more}"
    )


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
