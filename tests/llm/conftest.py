import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, chunk int, _text string, node string"


@pytest.fixture
def frame(spark):
    """Documents with clashing extra columns; a plain text list gets ids 0, 1, ..."""
    def make(rows):
        rows = [(i, r) if not isinstance(r, tuple) else r for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, None, "s", 1, 5, "x", "y") for i, t in rows], SCHEMA)
    return make
