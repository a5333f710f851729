import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text) pairs; more columns by keyword, all null."""

    def make(pairs, parts=3, **extra):
        schema = T.StructType(DOCS.fields + [T.StructField(k, v) for k, v in extra.items()])
        rows = [(i, t, None, None, None, *[None] * len(extra)) for i, t in pairs]
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_pairs():
    """Null, empty, blank, repeated, tied, accented, very long, null-id rows."""
    long = " ".join(f"Wörd{i % 977} the-end's, of {i}!!" for i in range(9000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "The same text, twice."), (4, "The same text, twice."),
            (5, "The same text, twice."), (4, "another text of id 4"), (None, "a text without id"), (None, None),
            (6, "héllo  wörld — naïve café ☃   x\x1cy <| x"), (7, long), (8, "a" * 3000), (9, "A"),
            (10, "don't DON'T we'll 12345 67 ** ?! end."), (-3, "negative id"), (11, "İstanbul ΣΑΣ ́x")]
