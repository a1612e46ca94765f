import pytest

DOCS = "doc_id long, text string, lang string, source string, fingerprint string, __x int"
EN = "the cat sat on the mat and looked at the old grey house. then it went away over the hill. nobody saw it again."
DE = "der Hund lief schnell über die grüne Wiese und bellte laut. dann schlief er unter dem Baum ein. niemand sah ihn."


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty, blank and very long texts, copies, a repeated row,
    and columns whose names clash with results."""
    rows = [(1, EN, "en", "a", "x", 1), (2, EN, "en", "b", "x", 2), (3, DE, "de", None, "x", 3), (4, None, "en", "a", None, None),
            (5, "", None, "b", "x", 5), (6, " \t\n ", "de", "c", "x", 6), (7, "12 34 !?", "en", "a", "x", 7),
            (8, (EN + " ") * 400, "en", "a", "x", 8), (9, DE, "de", "b", "x", 9), (9, DE, "de", "b", "x", 9),
            (None, EN.upper(), None, None, None, None), (11, DE + " " + EN, "en", "c", "x", 11)]
    rows += [(100 + k, f"{EN if k % 2 else DE} number {k}", "en" if k % 2 else "de", "a", "x", k) for k in range(24)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
