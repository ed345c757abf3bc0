import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = "\n".join(f"Word{i % 977} and{i} more{i * 7} of x{i}, line{i // 7}." for i in range(40_000))

#: Columns whose names operators use inside.
CLASH = ["key", "row", "size", "target", "fp", "line", "stay", "name", "times", "copies", "doc", "clean", "at", "kept"]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [
        (1, "Plain text of five words.", "en", "a", 25),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \n\t\n", "de", "b", 4),
        (5, LONG, "en", "b", len(LONG)),
        (6, "Plain text of five words.", "en", "b", 25),
        (6, "Plain text of five words.", "en", "b", 25),
        (None, "Plain text of five words.", "en", "b", 25),
        (None, None, None, None, None),
        (7, "All rights reserved.\nOne, two 🎉 three\u00a0four.\nAll rights reserved.", "fr", "", 40),
        (7, "Another text with the same id.", "fr", "", 30),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame(rows, schema)
    for i, c in enumerate(CLASH):
        df = df.selectExpr("*", f"CAST({i} AS INT) AS `{c}`")
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()),
              ("source", T.StringType()), ("n_chars", T.LongType())]
    return spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in fields]))
