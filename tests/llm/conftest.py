import pytest

DDL = ("doc_id long, text string, lang string, source string, n_chars long, "
       "row long, th long, h string, score double, node string, seed int, digest string, p int")
PAGES = "page_id long, url string, html string, id string, body string, digest string, n int, salt int"


@pytest.fixture
def docs(spark):
    """Documents with further columns whose names operators use themselves; rows are (id, text[, source])."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]),
                 7, 7, "x", 0.5, "x", 7, "x", 7) for r in rows]
        return spark.createDataFrame(full, DDL)
    return make


@pytest.fixture
def odd():
    """Null and empty texts, null ids, blanks, repeated rows, and a very long text."""
    return [(None, None), (None, ""), (None, "alpha beta"), (1, None), (2, ""), (3, " \n\t\n "), (4, "alpha"),
            (5, "alpha beta"), (5, "alpha beta"), (5, "other words here"),
            (6, "long " + "\n".join(f"word{i} and{i % 97} more{i % 13}" for i in range(30_000)))]
