import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that operators use themselves
                     T.StructField("score", T.DoubleType()), T.StructField("name", T.StringType()), T.StructField("_row", T.StringType()), T.StructField("h", T.LongType())])


@pytest.fixture
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, lang)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1]), None, "x", None, 1) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


def prose(seed: int, n: int) -> str:
    import random
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


#: null, empty, blank, letterless, long, tied and repeated rows
ODD = [(None, None), (None, "no id here"), (1, None), (2, ""), (3, " \t\n"), (4, "12 34 !!"), (5, "Ünïcode – wörds 漢字 café"), (6, "x" * 300_000),
       (7, prose(7, 60_000)), (8, "same text twice"), (8, "same text twice"), (9, "same text twice"), (10, "the the the " * 500)]
