"""Aligned series, lags, smoothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import series as Q
from tablewright.operators.clean import apply_scale, fit_standardise
from tablewright.plans.fixtures import SQL_SERIES, daily, order_series, quantity_series, returned_series
from tablewright.plans.registry import Tables, query


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("outer_align", f"WITH {SQL_SERIES} SELECT d, round(t, 6) AS t, round(e1, 6) AS e1, round(e2, 6) AS e2 FROM daily")
def outer_align(t: Tables) -> DataFrame:
    return rounded(daily(t), "t", "e1", "e2")


@query(
    "inner_align",
    f"""WITH {SQL_SERIES} SELECT d, round(t, 6) AS t, round(e1, 6) AS e1, round(e2, 6) AS e2
 FROM s_t JOIN s_e1 USING (d) JOIN s_e2 USING (d)""",
)
def inner_align(t: Tables) -> DataFrame:
    return rounded(Q.inner_align([order_series(t), quantity_series(t), returned_series(t)], "d"), "t", "e1", "e2")


@query(
    "lag_shift",
    f"""WITH {SQL_SERIES} SELECT d, round(lag(t, 2) OVER (ORDER BY d), 6) AS t2, round(lag(e1, 3) OVER (ORDER BY d), 6) AS e13 FROM daily""",
)
def lag_shift(t: Tables) -> DataFrame:
    table = daily(t)
    return table.select(
        "d", F.round(Q.lagged(table, "d", "t", 2), 6).alias("t2"), F.round(Q.lagged(table, "d", "e1", 3), 6).alias("e13")
    )


LAGS = [1, 2, 3, 4, 7, 13, 25]


@query(
    "delay_line",
    f"""WITH {SQL_SERIES} SELECT d, round(e1, 6) AS e1, {', '.join(f'round(coalesce(lag(e1, {k}) OVER (ORDER BY d), 0), 6) AS e1_lag{k}' for k in LAGS)}
 FROM daily""",
)
def delay_line(t: Tables) -> DataFrame:
    out = Q.delay_line(daily(t).select("d", "e1"), "d", ["e1"], LAGS)
    return rounded(out, "e1", *[f"e1_lag{k}" for k in LAGS])


@query(
    "series_diff",
    f"""WITH {SQL_SERIES} SELECT d, round(t - lag(t) OVER (ORDER BY d), 6) AS t, round(e2 - lag(e2) OVER (ORDER BY d), 6) AS e2 FROM daily""",
)
def series_diff(t: Tables) -> DataFrame:
    return rounded(Q.diff(daily(t), "d", ["t", "e2"]), "t", "e2")


@query(
    "rolling_mean",
    f"""WITH {SQL_SERIES} SELECT d, CASE WHEN count(t) OVER w = 6 THEN round(avg(t) OVER w, 6) END AS t,
 CASE WHEN count(e2) OVER w = 6 THEN round(avg(e2) OVER w, 6) END AS e2 FROM daily WINDOW w AS (ORDER BY d ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean(t: Tables) -> DataFrame:
    return rounded(Q.rolling_mean(daily(t), "d", ["t", "e2"], 6), "t", "e2")


@query(
    "ewma",
    """WITH e AS (SELECT event_id, value, row_number() OVER w - 1 AS k, list(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
 ROWS BETWEEN 300 PRECEDING AND CURRENT ROW) AS h FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
 SELECT event_id, round(list_reduce(h, lambda a, x: a * 11 / 13 + x) / ((1 - pow(11.0::DOUBLE / 13, len(h))) / (1 - 11.0::DOUBLE / 13)), 6) AS ewma FROM e""",
)
def ewma(t: Tables) -> DataFrame:
    """Span 12 per user; a busy user's series is cut into blocks."""
    ev = t.events.select("event_id", "user_id", F.struct("ts", "event_id").alias("at"), "value")
    return Q.ewma(ev, ["user_id"], "at", ["value"], 12).select("event_id", F.round("value", 6).alias("ewma"))


@query(
    "shift_seed",
    f"""WITH {SQL_SERIES}, s AS (SELECT avg(e1) AS m, stddev_samp(e1) AS sd FROM s_e1)
 SELECT d, round(coalesce(lag((e1 - m) / sd) OVER (ORDER BY d), 1) * sd + m, 6) AS e1 FROM s_e1, s""",
)
def shift_seed(t: Tables) -> DataFrame:
    src = quantity_series(t)
    model = fit_standardise(src, ["e1"])
    out = Q.shift_with_seed(apply_scale(src, model), "d", "e1", 1.0, model.spread["e1"], model.centre["e1"])
    return rounded(out, "e1")


@query(
    "pair_dispersion",
    """WITH s AS (SELECT o_orderdate::DATE AS d, o_orderpriority AS p, avg(ln(o_totalprice)) AS v FROM orders GROUP BY 1, 2)
 SELECT a.p AS a, b.p AS b, count(*) AS n, round(var_pop(a.v - b.v), 6) AS dispersion FROM s a JOIN s b ON a.d = b.d AND a.p < b.p GROUP BY 1, 2""",
)
def pair_dispersion(t: Tables) -> DataFrame:
    """Each order priority as a station with one value per day."""
    day = F.to_date("o_orderdate").alias("d")
    values = t.orders.groupBy(day, F.col("o_orderpriority").alias("p")).agg(F.avg(F.log("o_totalprice")).alias("v"))
    return rounded(Q.station_dispersion(values, "d", "p", "v").drop("distance"), "dispersion")


@query(
    "station_dispersion",
    """WITH s AS (SELECT o_orderdate::DATE AS d, c_custkey % 200 AS p, avg(ln(o_totalprice)) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
 w AS (SELECT c_custkey % 200 AS p, avg(c_acctbal) / 100 AS x, avg(c_nationkey) AS y FROM customer GROUP BY 1)
 SELECT a.p AS a, b.p AS b, count(*) AS n,
  round(sqrt(pow(any_value(wa.x) - any_value(wb.x), 2) + pow(any_value(wa.y) - any_value(wb.y), 2)), 6) AS distance,
  round(var_pop(a.v - b.v), 6) AS dispersion
 FROM s a JOIN s b ON a.d = b.d AND a.p < b.p JOIN w wa ON wa.p = a.p JOIN w wb ON wb.p = b.p GROUP BY 1, 2""",
)
def station_dispersion(t: Tables) -> DataFrame:
    """Customers in 200 stations: dispersion of their daily mean orders beside the distance of their mean places."""
    p = (F.col("c_custkey") % 200).alias("p")
    places = t.customer.groupBy(p).agg((F.avg("c_acctbal") / 100).alias("x"), F.avg("c_nationkey").alias("y"))
    day = F.to_date("o_orderdate").alias("d")
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    values = orders.groupBy(day, p).agg(F.avg(F.log("o_totalprice")).alias("v"))
    return rounded(Q.station_dispersion(values, "d", "p", "v", places), "distance", "dispersion")


def economy_features(t: Tables) -> DataFrame:
    """Smoothed differences of two outside series next to the smoothed target, with delays, standardised."""
    outside = Q.diff(Q.rolling_mean(Q.outer_align([quantity_series(t), returned_series(t)], "d"), "d", ["e1", "e2"], 6), "d", ["e1", "e2"])
    target = Q.diff(order_series(t), "d", ["t"])
    joined = Q.inner_align([target, outside], "d").na.drop()
    smooth = Q.ewma(joined, [], "d", ["t", "e1", "e2"], 12)
    return Q.delay_line(smooth, "d", ["e1", "e2"], LAGS)


ECON_COLS = ["t", "e1", "e2", *[f"{c}_lag{k}" for c in ("e1", "e2") for k in LAGS]]


def _sql_ewma(c: str) -> str:
    return (
        f"list_reduce(list({c}) OVER w, lambda a, x: a * 11 / 13 + x) / "
        f"((1 - pow(11.0::DOUBLE / 13, len(list({c}) OVER w))) / (1 - 11.0::DOUBLE / 13))"
    )


@query(
    "econ_features",
    f"""WITH {SQL_SERIES}, o AS (SELECT d, CASE WHEN count(e1) OVER w = 6 THEN avg(e1) OVER w END AS e1,
  CASE WHEN count(e2) OVER w = 6 THEN avg(e2) OVER w END AS e2 FROM (SELECT * FROM s_e1 FULL OUTER JOIN s_e2 USING (d)) z
  WINDOW w AS (ORDER BY d ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
 od AS (SELECT d, e1 - lag(e1) OVER (ORDER BY d) AS e1, e2 - lag(e2) OVER (ORDER BY d) AS e2 FROM o),
 td AS (SELECT d, t - lag(t) OVER (ORDER BY d) AS t FROM s_t),
 j AS (SELECT * FROM td JOIN od USING (d) WHERE t IS NOT NULL AND e1 IS NOT NULL AND e2 IS NOT NULL),
 e AS (SELECT d, {_sql_ewma('t')} AS t, {_sql_ewma('e1')} AS e1, {_sql_ewma('e2')} AS e2 FROM j
  WINDOW w AS (ORDER BY d ROWS BETWEEN 300 PRECEDING AND CURRENT ROW)),
 f AS (SELECT d, t, e1, e2, {', '.join(f'coalesce(lag({c}, {k}) OVER (ORDER BY d), 0) AS {c}_lag{k}' for c in ('e1', 'e2') for k in LAGS)} FROM e),
 s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in ECON_COLS)} FROM f)
 SELECT d, {', '.join(f'round(({c} - m_{c}) / s_{c}, 5) AS {c}' for c in ECON_COLS)} FROM f, s""",
)
def econ_features(t: Tables) -> DataFrame:
    table = economy_features(t)
    scaled = apply_scale(table, fit_standardise(table, ECON_COLS))
    return rounded(scaled, *ECON_COLS, digits=5)
