"""Scalar functions over text, dates, numbers and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import scalar as S
from tablewright.plans.fixtures import SQL_POINTS, points
from tablewright.plans.registry import Tables, query


def _code(c: str, third: int) -> str:
    at = "(ascii(substr({h}, {i}, 1)) - 97)"
    h = f"lower(replace(substr({c}, 1, 3), '''', 'z'))"
    a, b, d = (at.format(h=h, i=i) for i in (1, 2, third))
    return f"CASE WHEN regexp_full_match({h}, '[a-z]{{3}}') THEN {a} * 900 + {b} * 30 + {d} END"


@query("prefix_code", f"SELECT p_partkey, {_code('p_name', 2)} AS legacy, {_code('p_name', 3)} AS code FROM part")
def prefix_code(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.select(
        "p_partkey", S.prefix_code(name).alias("legacy"), S.prefix_code(name, legacy=False).alias("code")
    )


@query("strip_cast", "SELECT c_name, replace(replace(c_name, 'Customer', ''), '#', '')::BIGINT AS id FROM customer")
def strip_cast(t: Tables) -> DataFrame:
    return t.customer.select("c_name", S.strip_cast(F.col("c_name"), ["Customer", "#"]).alias("id"))


@query(
    "regex_extract",
    r"""SELECT page_id, regexp_extract(url, '(\d+)', 1) AS digits, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
 split_part(url, '.', 1) AS stem FROM pages""",
)
def regex_extract(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select(
        "page_id",
        S.first_digits(url).alias("digits"),
        F.regexp_extract(url, r"^https?://([^/?#]+)", 1).alias("host"),
        F.substring_index(url, ".", 1).alias("stem"),
    )


@query("zero_pad", "SELECT o_orderkey, lpad((o_custkey % 10000)::VARCHAR, 4, '0') AS key FROM orders")
def zero_pad(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", S.zero_pad(F.col("o_custkey") % 10000).alias("key"))


@query(
    "date_parts",
    """SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, day(o_orderdate)::INT AS d FROM orders""",
)
def date_parts(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.year(day).alias("y"), F.month(day).alias("m"), F.dayofmonth(day).alias("d"))


@query("log_exp", "SELECT o_orderkey, round(ln(o_totalprice), 8) AS lp, round(exp(ln(o_totalprice)), 2) AS p FROM orders")
def log_exp(t: Tables) -> DataFrame:
    lp = F.log("o_totalprice")
    return t.orders.select("o_orderkey", F.round(lp, 8).alias("lp"), F.round(F.exp(lp), 2).alias("p"))


@query(
    "geometry",
    f"""WITH {SQL_POINTS} SELECT id, round(sqrt(x * x + y * y), 6) AS r, round(atan2(x, y), 6) AS bearing,
 round(z * pi() / 180, 8) AS rad, round(z * cos(x), 6) AS px, round(z * sin(x), 6) AS py,
 round(CASE WHEN x > 0 THEN x * 360 - 360 ELSE x END, 4) AS lon FROM points""",
)
def geometry(t: Tables) -> DataFrame:
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    px, py = S.polar_to_xy(z, x)
    r6 = lambda c, d=6: F.round(c, d)
    return points(t).select(
        "id", r6(F.hypot(x, y)).alias("r"), r6(S.bearing(x, y)).alias("bearing"), r6(F.radians(z), 8).alias("rad"),
        r6(px).alias("px"), r6(py).alias("py"),
        r6(F.when(x > 0, x * 360 - 360).otherwise(x), 4).alias("lon"),
    )


@query(
    "json_field",
    """SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'empty') AS k FROM events""",
)
def json_field(t: Tables) -> DataFrame:
    return t.events.select("event_id", S.json_field(F.col("props"), "k").alias("k"))


@query("json_missing", "SELECT event_id, coalesce(json_extract_string(props, '$.title'), 'empty') AS title FROM events")
def json_missing(t: Tables) -> DataFrame:
    return t.events.select("event_id", S.json_field(F.col("props"), "title").alias("title"))


@query(
    "feature_cross",
    """SELECT p_partkey, p_brand || '|' || p_type AS p_brand_x_p_type, p_brand || '|' || p_size AS p_brand_x_p_size,
 p_type || '|' || p_size AS p_type_x_p_size, p_brand || '|' || p_type || '|' || p_size AS p_brand_x_p_type_x_p_size FROM part""",
)
def feature_cross(t: Tables) -> DataFrame:
    cols = ["p_brand", "p_type", "p_size"]
    keys = [c for d in (2, 3) for c in S.crosses(cols, d, hashed=False)]
    return t.part.select("p_partkey", *keys)
