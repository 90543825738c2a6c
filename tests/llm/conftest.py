import pytest
from pyspark.sql import Row


@pytest.fixture
def odd_docs(spark):
    """Nulls everywhere, empty, long, repeated and extra columns whose names operators also use."""
    long_text = "word " * 30_000
    rows = [
        Row(doc_id=1, text="a b c d e f g", lang="en", source="s1", n_chars=13, score=1.5, shard="x", size="y", key="k", label="l"),
        Row(doc_id=1, text="a b c d e f g", lang="en", source="s1", n_chars=13, score=1.5, shard="x", size="y", key="k", label="l"),
        Row(doc_id=2, text="", lang=None, source=None, n_chars=0, score=None, shard=None, size=None, key=None, label=None),
        Row(doc_id=3, text=None, lang=None, source="s2", n_chars=None, score=None, shard=None, size=None, key=None, label=None),
        Row(doc_id=None, text="lonely words here", lang="de", source="s2", n_chars=3, score=0.0, shard="", size="", key="", label=""),
        Row(doc_id=5, text=long_text, lang="fr", source="s1", n_chars=len(long_text), score=0.0, shard="", size="", key="", label=""),
        Row(doc_id=6, text=" \t\n ", lang="fr", source="s1", n_chars=4, score=0.0, shard="", size="", key="", label=""),
    ]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, score double, shard string, "
              "size string, key string, label string")
    return spark.createDataFrame(rows, schema)
