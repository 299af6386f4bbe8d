import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts; ids count from 0 unless given. It has columns whose names the operators use inside."""

    def make(texts, ids=None, lang="en", source="s"):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, lang, source if isinstance(source, str) else source[k], None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        return df.withColumns({"n": F.lit("x"), "digest": F.lit(1), "seg": F.lit(2), "label": F.lit("y"), "a": F.lit(0), "n_words": F.lit("z"), "words": F.lit("w"), "shard": F.lit(9)})

    return make


def vocabulary(rng, n=400):
    return ["".join(rng.choices("abcdefghij", k=5)) for _ in range(n)]
