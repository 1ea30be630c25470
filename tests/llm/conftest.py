import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang[, source]]) rows."""
    def make(rows):
        full = [(r + (None,) * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string").withColumn(
            "n_chars", F.char_length("text").cast("long"))
    return make
