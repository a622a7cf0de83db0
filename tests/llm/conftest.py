import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) tuples, with a clashing extra column or two."""
    def make(rows, **extra):
        full = [(*r, *[None] * (3 - len(r)), "src", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name, value in extra.items():
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit(value))
        return df
    return make
