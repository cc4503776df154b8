import random

import pytest
from pyspark.sql import types as T

#: Columns whose names the operators use inside or return.
CLASHES = ("id", "hash", "key", "n_lines", "n_dropped", "score", "lang_pred", "verdict", "host", "shard", "fp", "n")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHES]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table with the columns of documents and clashing ones, of (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *CLASHES) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abdeghilmnorst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(prose)]
    rows += [(100, prose[0]), (101, prose[0]), (101, prose[0]), (102, prose[1] + " end"), (103, prose[1].upper())]
    rows += [(200, None), (201, None), (202, ""), (203, ""), (204, " \t\n"), (205, "one"), (206, "ONE"), (207, "one two"), (208, "12 34 !")]
    rows += [(300, " ".join(rng.choice(vocabulary) for _ in range(30_000))), (301, "x" * 20_000), (302, "a  b \n\n  c\r\n é日本 \x1c z  ")]
    rows += [(None, prose[2]), (None, None), (None, prose[3] + " more")]
    return rows
