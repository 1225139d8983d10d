import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) or full rows."""
    def make(rows, extra=""):
        full = [r if len(r) > 2 else (r[0], r[1], "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS + extra)
    return make


def edge_rows():
    long = " ".join(f"word{i}" for i in range(30_000))
    return [(1, None, None, None, None), (2, "", "en", "src0", 0), (3, "a b", "en", "src0", 3),
            (3, "a b", "en", "src0", 3), (4, long, "en", "src1", len(long)),
            (None, "no id here", "en", None, 10), (5, " \n\t ", "en", "src0", 4),
            (6, "ünïcode – 🙂 text", "de", "src1", 16)]


@pytest.fixture
def edges(documents):
    return documents(edge_rows())


@pytest.fixture
def empty(documents):
    return documents([])
