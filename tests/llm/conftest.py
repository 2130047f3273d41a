import pytest

from millrace.llm.common import tuned_batches, with_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    """Makes documents from (id, text) pairs, with an own language where a third value is given."""
    with_package(tuned_batches(spark))

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


# Cases that every operator must stand: NULL id and text, empty text, repeated rows, one very long line.
HARD = [(1, None), (2, ""), (3, "Same words here."), (3, "Same words here."), (None, "No id has this text."), (4, "long " * 30_000), (5, "é😀 \n\n\t ß"), (6, "!!! ??? 123")]
