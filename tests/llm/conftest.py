import pytest


@pytest.fixture
def docs_table(spark):
    """Rows (doc_id, text) with columns that clash with names the operators give."""

    def make(rows, *extra):
        names = ["doc_id", "text", "lang", "source", "n_chars", *extra]
        cells = [(i, t, "en", "s", None if t is None else len(t), *("x",) * len(extra)) for i, t in rows]
        return spark.createDataFrame(cells, "doc_id long, text string, lang string, source string, n_chars long"
                                     + "".join(f", {n} string" for n in extra)).select(*names)

    return make
