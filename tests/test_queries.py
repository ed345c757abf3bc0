"""Every registered query with SQL gives the same rows in DuckDB."""

import math

import duckdb
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return "" if v is None else repr(v)


def rows(data):
    return sorted(tuple(plain(v) for v in r) for r in data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in cols)
    want = duck.sql(f"SELECT {quoted} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert rows(df.select(*[f"`{c}`" for c in cols]).collect()) == rows(want)
    spark.catalog.clearCache()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs_without_sql(spark, name):
    """All rows and columns are computed: a count would leave out what is only projected."""
    rows = Observation()
    df = entry.queries()[name](spark, SF).observe(rows, F.count(F.lit(1)).alias("n"))
    df.write.format("noop").mode("overwrite").save()
    assert rows.get["n"] > 0
    spark.catalog.clearCache()


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
