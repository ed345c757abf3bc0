"""Tables derived from the supplied ones, as DataFrames and as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.arrays import doubles
from tablewright.plans.registry import Tables

LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def nulls_li(t: Tables) -> DataFrame:
    """Line items with gaps and with 999 as an outlier mark."""
    return t.lineitem.select(
        *LI_KEY,
        "l_returnflag",
        "l_shipdate",
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_linestatus")).alias("k_null"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("qty_n"),
        F.when(F.col("l_partkey") % 11 == 0, F.lit(None))
        .when(F.col("l_partkey") % 13 == 0, F.lit(999.0))
        .otherwise(F.col("l_quantity"))
        .alias("age_n"),
    )


SQL_NULLS_LI = """nulls_li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate,
 CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_linestatus END AS k_null,
 CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS qty_n,
 CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN 999::DOUBLE ELSE l_quantity END AS age_n
 FROM lineitem)"""


def order_series(t: Tables) -> DataFrame:
    """Mean log price per day, the target series."""
    return t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.avg(F.log("o_totalprice")).alias("t"))


def quantity_series(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.avg(F.log("l_quantity")).alias("e1"))


def returned_series(t: Tables) -> DataFrame:
    returned = t.lineitem.where(F.col("l_returnflag") == "R")
    return returned.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.avg(F.log("l_extendedprice")).alias("e2"))


SQL_SERIES = """s_t AS (SELECT CAST(o_orderdate AS DATE) AS d, avg(ln(o_totalprice)) AS t FROM orders GROUP BY 1),
s_e1 AS (SELECT CAST(l_shipdate AS DATE) AS d, avg(ln(l_quantity)) AS e1 FROM lineitem GROUP BY 1),
s_e2 AS (SELECT CAST(l_shipdate AS DATE) AS d, avg(ln(l_extendedprice)) AS e2 FROM lineitem
 WHERE l_returnflag = 'R' GROUP BY 1),
daily AS (SELECT d, t, e1, e2 FROM s_t FULL OUTER JOIN s_e1 USING (d) FULL OUTER JOIN s_e2 USING (d))"""


def daily(t: Tables) -> DataFrame:
    """Three series aligned on the date: one row per calendar day."""
    from tablewright.operators.series import outer_align

    return outer_align([order_series(t), quantity_series(t), returned_series(t)], "d")


def grid(t: Tables) -> DataFrame:
    """Date x member x hour x lat x lon cells."""
    ship = F.col("l_shipdate")
    return t.lineitem.groupBy(
        (F.year(ship) * 10000 + F.month(ship) * 100 + 1).alias("dt"),
        F.col("l_linenumber").alias("ens"),
        ((F.col("l_partkey") % 12) * 3).cast("int").alias("fhour"),
        (30 + F.col("l_suppkey") % 5).cast("double").alias("lat"),
        (260 + F.col("l_orderkey") % 6).cast("double").alias("lon"),
    ).agg(F.avg("l_quantity").alias("value"))


SQL_GRID = """grid AS (SELECT CAST(year(l_shipdate)*10000 + month(l_shipdate)*100 + 1 AS INT) AS dt, l_linenumber AS ens,
 CAST((l_partkey % 12)*3 AS INT) AS fhour, CAST(30 + l_suppkey % 5 AS DOUBLE) AS lat,
 CAST(260 + l_orderkey % 6 AS DOUBLE) AS lon, avg(l_quantity) AS value FROM lineitem GROUP BY 1,2,3,4,5)"""


def boxes(t: Tables) -> DataFrame:
    """Closed boxes given by two corners."""
    k = F.col("p_partkey")
    return t.part.select(
        (k + 1).alias("id"),
        ((k * 37) % 200 + 1).alias("x1"),
        ((k * 91) % 200 + 1).alias("y1"),
        ((k * 53) % 300 + 1).alias("z1"),
        ((k * 37) % 200 + 1 + F.col("p_size") % 10).alias("x2"),
        ((k * 91) % 200 + 1 + k % 7).alias("y2"),
        ((k * 53) % 300 + 1 + F.col("p_size") % 5).alias("z2"),
    )


SQL_BOXES = """boxes AS (SELECT id, x1, y1, z1, x1 + w - 1 AS x2, y1 + l - 1 AS y2, z1 + h - 1 AS z2 FROM (
 SELECT p_partkey + 1 AS id, (p_partkey * 37) % 200 + 1 AS x1, (p_partkey * 91) % 200 + 1 AS y1,
 (p_partkey * 53) % 300 + 1 AS z1, p_size % 10 + 1 AS w, p_partkey % 7 + 1 AS l, p_size % 5 + 1 AS h FROM part) b)"""


def height_grid(t: Tables) -> DataFrame:
    """Height and gap per (x, y) cell."""
    k = F.col("p_partkey")
    return t.part.select(
        (k % 20).alias("x"),
        F.floor(k / 20).cast("bigint").alias("y"),
        F.col("p_size").alias("h"),
        (k % 3).alias("gap"),
    )


SQL_HEIGHT = """height_grid AS (SELECT p_partkey % 20 AS x, p_partkey // 20 AS y, p_size AS h, p_partkey % 3 AS gap
 FROM part)"""

WIDE_COLS = ["c_const", "c_q95", "c_q80", "c_q67", "c_bin80", "c_price", "c_size"]


def wide(t: Tables) -> DataFrame:
    """Numeric columns with one dominant value in some."""
    k, size = F.col("p_partkey"), F.col("p_size")
    dbl = lambda c: c.cast("double")
    return t.part.select(
        k.alias("id"),
        F.lit(1.0).alias("c_const"),
        dbl(F.when(k % 20 == 0, size).otherwise(0)).alias("c_q95"),
        dbl(F.when(k % 5 == 0, k % 6 + 1).otherwise(0)).alias("c_q80"),
        dbl(F.when(k % 3 == 0, size).otherwise(0)).alias("c_q67"),
        dbl(F.when(k % 5 == 0, 1).otherwise(0)).alias("c_bin80"),
        F.col("p_retailprice").alias("c_price"),
        dbl(size).alias("c_size"),
    )


SQL_WIDE = """wide AS (SELECT p_partkey AS id, 1::DOUBLE AS c_const,
 CAST(CASE WHEN p_partkey % 20 = 0 THEN p_size ELSE 0 END AS DOUBLE) AS c_q95,
 CAST(CASE WHEN p_partkey % 5 = 0 THEN p_partkey % 6 + 1 ELSE 0 END AS DOUBLE) AS c_q80,
 CAST(CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE 0 END AS DOUBLE) AS c_q67,
 CAST(CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS c_bin80,
 p_retailprice AS c_price, CAST(p_size AS DOUBLE) AS c_size FROM part)"""


def variants(t: Tables) -> DataFrame:
    return t.embeddings.select(
        "vec_id", F.explode(F.array(F.lit("raw"), F.lit("proc"))).alias("variant"), "label"
    )


SQL_VARIANTS = """variants AS (SELECT vec_id, unnest(['raw', 'proc']) AS variant, label FROM embeddings)"""


def points(t: Tables) -> DataFrame:
    e = doubles("embedding")
    return t.embeddings.select(F.col("vec_id").alias("id"), e[0].alias("x"), e[1].alias("y"), e[2].alias("z"))


SQL_POINTS = """points AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y,
 embedding[3]::DOUBLE AS z FROM embeddings)"""


def vectors(t: Tables) -> DataFrame:
    """Embeddings as array<double>."""
    return t.embeddings.select("vec_id", "label", doubles("embedding").alias("v"))


SQL_CELLS = """cells AS (SELECT vec_id, label, unnest(range(0, len(embedding)))::INT AS i,
 unnest(embedding)::DOUBLE AS x FROM embeddings)"""


def long_cells(df: DataFrame, arr, *keep: str, digits: int | None = 6) -> DataFrame:
    """One row per array cell."""
    out = df.select(*keep, F.posexplode(arr).alias("i", "x"))
    return out if digits is None else out.withColumn("x", F.round("x", digits))


def votes(t: Tables) -> DataFrame:
    """37 nonnegative vote columns per vector; a few sibling groups are all zero."""
    empty = (F.col("vec_id") % 10 == 0)
    v = F.transform(
        F.slice(doubles("embedding"), 1, 37),
        lambda x, i: F.when(empty & i.isin(7, 8), F.lit(0.0)).otherwise(F.abs(x)),
    )
    return t.embeddings.select("vec_id", v.alias("votes"))


SQL_VOTES = """votes AS (SELECT vec_id, i AS q, CASE WHEN vec_id % 10 = 0 AND i IN (7, 8) THEN 0.0::DOUBLE ELSE abs(x) END AS v
 FROM cells WHERE i < 37)"""
