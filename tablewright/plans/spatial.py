"""Points, grids and boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import joins
from tablewright.operators import spatial as P
from tablewright.plans.fixtures import (
    SQL_BOXES,
    SQL_GRID,
    SQL_HEIGHT,
    SQL_POINTS,
    boxes,
    grid,
    height_grid,
    points,
)
from tablewright.plans.registry import Tables, query


@query(
    "point_pair_totals",
    f"""WITH {SQL_POINTS} SELECT count(*) AS pairs, round(avg((a.z - b.z) * (a.z - b.z)), 8) AS mean_sq_diff
 FROM points a JOIN points b ON a.id <> b.id""",
)
def point_pair_totals(t: Tables) -> DataFrame:
    """Totals over all point pairs, from two sums."""
    return joins.pair_totals(points(t), [], "z").withColumn("mean_sq_diff", F.round("mean_sq_diff", 8))


def _sql_variogram(step: int | None) -> str:
    tbin = "0"
    if step:
        n = 180 // step
        tbin = (
            f"least(floor((CASE WHEN h >= pi() - {step} * pi() / 360 THEN 0.0::DOUBLE ELSE h END + {step} * pi() / 360)"
            f" / ({step} * pi() / 180)), {n - 1})"
        )
    return f"""WITH {SQL_POINTS}, m AS (SELECT sqrt(pow(max(x) - min(x), 2) + pow(max(y) - min(y), 2)) AS maxdist FROM points),
 p AS (SELECT sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS dist, (b.z - a.z) * (b.z - a.z) AS sq,
  atan2(b.x - a.x, b.y - a.y) AS th FROM points a JOIN points b ON a.id < b.id),
 q AS (SELECT *, CASE WHEN th < 0 THEN th + pi() ELSE th END AS h, least(floor(dist / (maxdist * 0.5 / 10)), 9)::INT AS dbin FROM p, m)
 SELECT dbin, {tbin}::INT AS tbin, round(any_value((dbin + 1) * maxdist * 0.5 / 10 + maxdist / 20), 8) AS distance,
  count(*) AS n, round(sum(sq) / (2 * count(*)), 8) AS gamma FROM q WHERE dbin < 9 GROUP BY 1, 2"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 8) for c in ("distance", "gamma")})


@query("variogram_iso", _sql_variogram(None))
def variogram_iso(t: Tables) -> DataFrame:
    return _rounded(P.variogram(points(t), bins=10, max_frac=0.5))


@query("variogram_aniso", _sql_variogram(30))
def variogram_aniso(t: Tables) -> DataFrame:
    return _rounded(P.variogram(points(t), bins=10, max_frac=0.5, theta_step=30))


@query(
    "extents",
    f"""WITH {SQL_POINTS} SELECT round(min(x), 6) AS min_x, round(max(x), 6) AS max_x, round(min(y), 6) AS min_y, round(max(y), 6) AS max_y,
 round(sqrt(pow(max(x) - min(x), 2) + pow(max(y) - min(y), 2)), 6) AS diagonal, round(max(z), 6) AS top FROM points""",
)
def extents(t: Tables) -> DataFrame:
    dx, dy = F.max("x") - F.min("x"), F.max("y") - F.min("y")
    return points(t).agg(
        F.round(F.min("x"), 6).alias("min_x"), F.round(F.max("x"), 6).alias("max_x"),
        F.round(F.min("y"), 6).alias("min_y"), F.round(F.max("y"), 6).alias("max_y"),
        F.round(F.hypot(dx, dy), 6).alias("diagonal"), F.round(F.max("z"), 6).alias("top"),
    )


SQL_DAILY = """m AS (SELECT dt, ens, lat, lon, sum(value) AS v FROM grid WHERE fhour <= 24 GROUP BY 1, 2, 3, 4),
 dm AS (SELECT dt, lat, lon, avg(v) * 10800 AS value FROM m GROUP BY 1, 2, 3)"""


@query("daily_mean_sum", f"WITH {SQL_GRID}, {SQL_DAILY} SELECT dt, lat, lon, round(ln(value), 6) AS value FROM dm")
def daily_mean_sum(t: Tables) -> DataFrame:
    return P.daily_mean_sum(grid(t)).withColumn("value", F.round(F.log("value"), 6))


@query("mean_over_axes", f"WITH {SQL_GRID} SELECT dt, lat, lon, round(ln(avg(value)), 6) AS value FROM grid GROUP BY 1, 2, 3")
def mean_over_axes(t: Tables) -> DataFrame:
    return grid(t).groupBy("dt", "lat", "lon").agg(F.round(F.log(F.avg("value")), 6).alias("value"))


@query(
    "grid_to_station",
    f"""WITH {SQL_GRID}, {SQL_DAILY}, st AS (SELECT s_suppkey AS stid, 30 + (s_suppkey * 37 % 400) / 100.0::DOUBLE AS lat,
  260 + (s_suppkey * 91 % 500) / 100.0::DOUBLE AS lon FROM supplier),
 c AS (SELECT dt, stid, value, pow(st.lat - dm.lat, 2) + pow(st.lon - dm.lon, 2) AS d2 FROM st JOIN dm
  ON dm.lat - floor(st.lat) IN (0, 1) AND dm.lon - floor(st.lon) IN (0, 1))
 SELECT dt, stid, round(ln(coalesce(max(value) FILTER (d2 = 0), sum(value / nullif(d2, 0)) / sum(1 / nullif(d2, 0)))), 6) AS value
 FROM c GROUP BY 1, 2""",
)
def grid_to_station(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    stations = t.supplier.select(
        k.alias("stid"), (30 + (k * 37 % 400) / 100).alias("lat"), (260 + (k * 91 % 500) / 100).alias("lon")
    )
    out = P.grid_to_station(P.daily_mean_sum(grid(t)), stations)
    return out.withColumn("value", F.round(F.log("value"), 6))


@query("fill_rate", f"""WITH {SQL_HEIGHT}, m AS (SELECT max(h) AS top FROM height_grid)
 SELECT round((count(*) * any_value(top) - sum(gap) - sum(abs(h - top)))::DOUBLE / (count(*) * any_value(top)), 8) AS fill_rate FROM height_grid, m""")
def fill_rate(t: Tables) -> DataFrame:
    return P.fill_rate(height_grid(t)).select(F.round("fill_rate", 8).alias("fill_rate"))


@query(
    "grid_diff",
    f"""WITH {SQL_HEIGHT} SELECT x, y, h - lag(h) OVER (PARTITION BY y ORDER BY x) AS dx, h - lag(h) OVER (PARTITION BY x ORDER BY y) AS dy FROM height_grid""",
)
def grid_diff(t: Tables) -> DataFrame:
    return P.neighbour_diff(height_grid(t)).select("x", "y", "dx", "dy")


@query(
    "surface_objective",
    f"""WITH {SQL_HEIGHT}, c AS (SELECT x, y, gap, least(0, h - (SELECT min(h) FROM height_grid) - 500) AS h FROM height_grid),
 d AS (SELECT *, abs(h - lag(h) OVER (PARTITION BY y ORDER BY x)) AS dx, abs(h - lag(h) OVER (PARTITION BY x ORDER BY y)) AS dy FROM c)
 SELECT round(pow(avg(h), 2) + var_samp(h) + sum(coalesce(dx, 0) + coalesce(dy, 0)) + count(*) + 8 * sum(gap), 4) AS objective FROM d""",
)
def surface_objective(t: Tables) -> DataFrame:
    return P.surface_objective(height_grid(t)).select(F.round("objective", 4).alias("objective"))


@query(
    "order_score",
    f"""WITH {SQL_BOXES}, r AS (SELECT id, z2, row_number() OVER (ORDER BY z2 DESC, id) AS r FROM boxes)
 SELECT (2 * max(z2) + sum(abs(r - id)))::BIGINT AS score FROM r""",
)
def order_score(t: Tables) -> DataFrame:
    return P.order_score(boxes(t))


SQL_PAIR = "a.id <> b.id AND a.x1 <= b.x2 AND b.x1 <= a.x2 AND a.y1 <= b.y2 AND b.y1 <= a.y2 AND a.z1 <= b.z2 AND b.z1 <= a.z2"


@query("box_overlap", f"WITH {SQL_BOXES} SELECT id, EXISTS (SELECT 1 FROM boxes b WHERE {SQL_PAIR}) AS overlaps FROM boxes a")
def box_overlap(t: Tables) -> DataFrame:
    return P.overlapping_boxes(boxes(t))


@query("overlap_flag", f"WITH {SQL_BOXES} SELECT count(*) > 0 AS any_overlap FROM boxes a JOIN boxes b ON {SQL_PAIR}")
def overlap_flag(t: Tables) -> DataFrame:
    return P.any_overlap(boxes(t))


@query(
    "box_corners",
    f"""WITH {SQL_BOXES} SELECT id, 1 AS corner, x1 AS x, y1 AS y, z1 AS z FROM boxes UNION ALL SELECT id, 2, x1, y1, z2 FROM boxes
 UNION ALL SELECT id, 3, x1, y2, z2 FROM boxes UNION ALL SELECT id, 4, x1, y2, z1 FROM boxes UNION ALL SELECT id, 5, x2, y2, z1 FROM boxes
 UNION ALL SELECT id, 6, x2, y1, z1 FROM boxes UNION ALL SELECT id, 7, x2, y1, z2 FROM boxes UNION ALL SELECT id, 8, x2, y2, z2 FROM boxes""",
)
def box_corners(t: Tables) -> DataFrame:
    return P.box_corners(boxes(t))


@query(
    "orientation_order",
    """WITH s AS (SELECT p_partkey, p_size % 10 + 1 AS h, p_partkey % 7 + 1 AS l, p_size % 5 + 1 AS w FROM part)
 SELECT p_partkey, CASE WHEN h = least(h, l, w) THEN CASE WHEN l = least(l, w) THEN '123456' ELSE '125634' END
 WHEN l = least(h, l, w) THEN CASE WHEN h = least(h, w) THEN '341256' ELSE '345612' END
 ELSE CASE WHEN l = least(h, l) THEN '563412' ELSE '561234' END END AS orientations FROM s""",
)
def orientation_order(t: Tables) -> DataFrame:
    order = P.orientation_order(F.col("p_size") % 10 + 1, F.col("p_partkey") % 7 + 1, F.col("p_size") % 5 + 1)
    return t.part.select("p_partkey", F.array_join(order.cast("array<string>"), "").alias("orientations"))


@query(
    "shift_positive",
    f"WITH {SQL_BOXES}, m AS (SELECT min(z1) AS low FROM boxes) SELECT id, z1 - low + 1 AS z1, z2 - low + 1 AS z2 FROM boxes, m",
)
def shift_positive(t: Tables) -> DataFrame:
    return P.shift_to_positive(boxes(t)).select("id", "z1", "z2")
