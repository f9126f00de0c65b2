import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, node string, path int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, copies, near copies, repeated rows, clashing columns."""
    words = [f"w{i % 97}x{i * 7919 % 1009}" for i in range(4000)]
    base = " ".join(words[:120])
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, base + " end", "en", None), (4, None, None, "b"), (5, "", "en", "b"),
            (6, "# 12 !!", None, None), (7, "one two", "de", "c"), (8, " ".join(words), "en", "c"), (9, "ähnlich ß Wörter " * 30, "de", "a"),
            (9, "ähnlich ß Wörter " * 30, "de", "a"), (10, "one two", "de", "c"), (11, "\n\n a \nA\n", "de", "b"), (12, "A" * 400, None, "c")]
    rows += [(20 + i, f"Shared Line\nown text number {i} of its kind\nshared line ", "en", "d") for i in range(12)]
    return spark.createDataFrame([(*r, 0, 0.5, "x", "y", 3) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
