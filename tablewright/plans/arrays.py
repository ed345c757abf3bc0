"""Signals, vectors and image-like arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import arrays as A
from tablewright.operators import images as I
from tablewright.operators.clean import fit_standardise
from tablewright.operators.signals import spectral_features
from tablewright.plans.fixtures import SQL_CELLS, SQL_VOTES, long_cells, vectors, votes
from tablewright.plans.registry import Tables, query
from tablewright.plans.relational import sql_draw

SQL_MOM = """avg(x) AS m, stddev_pop(x) AS s, (avg(x*x*x) - 3*avg(x)*avg(x*x) + 2*pow(avg(x), 3)) / pow(var_pop(x), 1.5::DOUBLE) AS sk,
 kurtosis_pop(x) AS ku"""


@query(
    "vector_moments",
    f"""WITH {SQL_CELLS}, g AS (SELECT vec_id, {SQL_MOM} FROM cells GROUP BY vec_id)
 SELECT vec_id, round(m, 6) AS mean, round(s, 6) AS std, round(sk, 5) AS skew, round(ku, 5) AS kurt FROM g""",
)
def vector_moments(t: Tables) -> DataFrame:
    m = vectors(t).select("vec_id", A.moments(F.col("v")).alias("m"))
    return m.select(
        "vec_id", F.round("m.mean", 6).alias("mean"), F.round("m.std", 6).alias("std"),
        F.round("m.skew", 5).alias("skew"), F.round("m.kurt", 5).alias("kurt"),
    )


@query(
    "mean_step",
    """SELECT vec_id, round((embedding[64]::DOUBLE - embedding[1]::DOUBLE) / 63, 8) AS mean_step FROM embeddings""",
)
def mean_step(t: Tables) -> DataFrame:
    """Mean of consecutive differences: it telescopes to the ends."""
    step = F.try_divide(F.element_at(F.col("v"), -1) - F.element_at(F.col("v"), 1), F.size(F.col("v")) - 1)
    return vectors(t).select("vec_id", F.round(step, 8).alias("mean_step"))


@query(
    "standardise_global",
    f"WITH {SQL_CELLS}, s AS (SELECT avg(x) AS m, stddev_pop(x) AS sd FROM cells) SELECT vec_id, i, round((x - m) / sd, 6) AS x FROM cells, s",
)
def standardise_global(t: Tables) -> DataFrame:
    v = vectors(t)
    model = fit_standardise(v.select(F.explode("v").alias("x")), ["x"], ddof=0)
    return long_cells(v, A.affine(F.col("v"), model.centre["x"], model.spread["x"]), "vec_id")


@query(
    "standardise_rows",
    f"""WITH {SQL_CELLS} SELECT vec_id, i, round((x - avg(x) OVER w) / stddev_pop(x) OVER w, 6) AS x FROM cells WINDOW w AS (PARTITION BY vec_id)""",
)
def standardise_rows(t: Tables) -> DataFrame:
    return long_cells(vectors(t), A.standardise_row(F.col("v")), "vec_id")


@query(
    "minmax_rows",
    f"""WITH {SQL_CELLS} SELECT vec_id, i, round((x - min(x) OVER w) / (max(x) OVER w - min(x) OVER w), 6) AS x FROM cells WINDOW w AS (PARTITION BY vec_id)""",
)
def minmax_rows(t: Tables) -> DataFrame:
    return long_cells(vectors(t), A.minmax_row(F.col("v")), "vec_id")


@query(
    "contrast_normalise",
    f"""WITH {SQL_CELLS} SELECT vec_id, i, round((x - avg(x) OVER w) / sqrt(0.01::DOUBLE + var_pop(x) OVER w), 6) AS x FROM cells WINDOW w AS (PARTITION BY vec_id)""",
)
def contrast_normalise(t: Tables) -> DataFrame:
    return long_cells(vectors(t), A.contrast_normalise(F.col("v"), bias=0.01), "vec_id")


@query(
    "remove_trend",
    f"""WITH {SQL_CELLS} SELECT vec_id, i, round(x - avg(x) OVER (PARTITION BY vec_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), 6) AS x FROM cells""",
)
def remove_trend(t: Tables) -> DataFrame:
    return long_cells(vectors(t), A.trend_removed(F.col("v"), 8), "vec_id")


@query(
    "circular_smooth",
    f"""WITH {SQL_CELLS} SELECT a.vec_id, a.i, round((a.x + b.x + c.x) / 3, 6) AS x FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND b.i = (a.i + 63) % 64
 JOIN cells c ON a.vec_id = c.vec_id AND c.i = (a.i + 1) % 64""",
)
def circular_smooth(t: Tables) -> DataFrame:
    return long_cells(vectors(t), A.circular_mean3(F.col("v")), "vec_id")


@query("affine_rescale", f"WITH {SQL_CELLS} SELECT vec_id, i, round((x * 255 - 127.5::DOUBLE) / 127.5::DOUBLE, 6) AS x FROM cells")
def affine_rescale(t: Tables) -> DataFrame:
    return long_cells(vectors(t), A.affine(F.transform(F.col("v"), lambda x: x * 255), 127.5, 127.5), "vec_id")


@query(
    "one_hot_array",
    "SELECT vec_id, unnest(range(0, 10))::INT AS i, CASE WHEN unnest(range(0, 10)) = label THEN 1 ELSE 0 END AS x FROM embeddings",
)
def one_hot_array(t: Tables) -> DataFrame:
    return long_cells(vectors(t), A.one_hot(F.col("label"), 10), "vec_id", digits=None)


@query(
    "fit_length",
    f"""WITH {SQL_CELLS} SELECT vec_id, 48 AS n, (i - 8)::INT AS i, round(x, 6) AS x FROM cells WHERE i >= 8 AND i < 56
 UNION ALL SELECT vec_id, 80, i, round(x, 6) FROM cells UNION ALL SELECT vec_id, 80, unnest(range(64, 80))::INT, 0.0::DOUBLE FROM embeddings""",
)
def fit_length(t: Tables) -> DataFrame:
    v = vectors(t).withColumn("n", F.explode(F.array(F.lit(48), F.lit(80))))
    fitted = F.when(F.col("n") == 48, A.fit_length(F.col("v"), 48)).otherwise(A.fit_length(F.col("v"), 80))
    return long_cells(v, fitted, "vec_id", "n")


@query(
    "frames",
    f"""WITH {SQL_CELLS}, k AS (SELECT vec_id, f, j, f * 4 + j AS i FROM embeddings, range(0, 16) a(f), range(0, 8) b(j))
 SELECT k.vec_id, f::INT AS frame, j::INT AS i, round(coalesce(x, 0), 6) AS x FROM k LEFT JOIN cells USING (vec_id, i)""",
)
def frames(t: Tables) -> DataFrame:
    f = vectors(t).select("vec_id", F.posexplode(A.frames(F.col("v"), 8, 4)).alias("frame", "v"))
    return long_cells(f, F.col("v"), "vec_id", "frame")


@query(
    "argmax",
    f"""WITH {SQL_CELLS} SELECT vec_id, (min(i) FILTER (x = mx))::INT AS argmax, round(max(mx), 6) AS top FROM
 (SELECT *, max(x) OVER (PARTITION BY vec_id) AS mx FROM cells) c GROUP BY vec_id""",
)
def argmax(t: Tables) -> DataFrame:
    return vectors(t).select("vec_id", A.argmax(F.col("v")).alias("argmax"), F.round(F.array_max(F.col("v")), 6).alias("top"))


@query(
    "order_by_row_mean",
    f"""WITH {SQL_CELLS}, m AS (SELECT vec_id, avg(x) AS m FROM cells GROUP BY 1) SELECT vec_id, row_number() OVER (ORDER BY m, vec_id) - 1 AS pos FROM m""",
)
def order_by_row_mean(t: Tables) -> DataFrame:
    from tablewright.operators.ranking import positioned

    means = vectors(t).select("vec_id", A.mean(F.col("v")).alias("m"))
    return positioned(means, ["m", "vec_id"]).select("vec_id", "pos")


@query(
    "blend_mean",
    f"WITH {SQL_CELLS} SELECT vec_id, round(avg(x), 6) AS p FROM cells GROUP BY 1",
)
def blend_mean(t: Tables) -> DataFrame:
    """Each dimension as one model's output; models sit in one row, so blending is a projection."""
    return vectors(t).select("vec_id", F.round(A.mean(F.col("v")), 6).alias("p"))


@query(
    "blend_median",
    f"WITH {SQL_CELLS} SELECT vec_id, trunc(median(x * 10))::INT AS klass FROM cells GROUP BY 1",
)
def blend_median(t: Tables) -> DataFrame:
    """Median over the models, truncated to an integer."""
    return vectors(t).select("vec_id", A.median(F.transform(F.col("v"), lambda x: x * 10)).cast("int").alias("klass"))


@query(
    "blend_argmax",
    f"""WITH {SQL_CELLS}, m AS (SELECT vec_id, (i % 16)::INT AS k, avg(x) AS p FROM cells GROUP BY 1, 2)
 SELECT vec_id, k AS klass FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, k) AS r FROM m) z WHERE r = 1""",
)
def blend_argmax(t: Tables) -> DataFrame:
    """Four models with 16 class outputs each: mean per class, then the best class."""
    return vectors(t).select("vec_id", A.argmax(A.blend_classes(F.col("v"), 16)).alias("klass"))


# ---- 8 x 8 pages


@query(
    "grid_patches",
    f"""WITH {SQL_CELLS}, k AS (SELECT (r * 3 + c)::INT AS patch_no, pr, pc, (r * 2 + pr) * 8 + c * 2 + pc AS i
 FROM range(0, 3) a(r), range(0, 3) b(c), range(0, 4) d(pr), range(0, 4) e(pc))
 SELECT vec_id, label, patch_no, (pr * 4 + pc)::INT AS i, round(x, 6) AS x FROM cells JOIN k USING (i)""",
)
def grid_patches(t: Tables) -> DataFrame:
    p = I.grid_patches(vectors(t), "v", (8, 8), (4, 4), (2, 2))
    return long_cells(p, F.col("patch"), "vec_id", "label", "patch_no")


@query(
    "channel_patches",
    f"""WITH {SQL_CELLS}, k AS (SELECT (r * 3 + c)::INT AS patch_no, (pr * 2 + pc) * 4 + ch AS j, ((r + pr) * 4 + c + pc) * 4 + ch AS i
 FROM range(0, 3) a(r), range(0, 3) b(c), range(0, 2) d(pr), range(0, 2) e(pc), range(0, 4) f(ch))
 SELECT vec_id, patch_no, j::INT AS i, round(x, 6) AS x FROM cells JOIN k USING (i)""",
)
def channel_patches(t: Tables) -> DataFrame:
    """Vectors as pages of 4 x 4 cells in four channels."""
    p = I.grid_patches(vectors(t), "v", (4, 4), (2, 2), (1, 1), channels=4)
    return long_cells(p, F.col("patch"), "vec_id", "patch_no")


@query(
    "random_patches",
    f"""WITH {SQL_CELLS}, d AS (SELECT vec_id, top::INT AS top, lft::INT AS lft, {sql_draw('patch', '1', 'vec_id', 'top', 'lft')} AS u
  FROM embeddings, range(0, 5) r(top), range(0, 5) c(lft)),
 s AS (SELECT d.vec_id, u, top, lft, stddev_pop(x) AS sd, avg(x) AS m FROM d JOIN cells c ON d.vec_id = c.vec_id
  AND c.i // 8 >= top AND c.i // 8 < top + 3 AND c.i % 8 >= lft AND c.i % 8 < lft + 3 GROUP BY 1, 2, 3, 4),
 k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY u, top, lft) - 1 AS r, count(*) OVER (PARTITION BY vec_id) AS n FROM s WHERE sd > 0.1)
 SELECT vec_id, draw::INT AS draw, top, lft AS "left", round(m, 6) AS mean FROM k JOIN range(0, 3) z(draw) ON r = draw % n""",
)
def random_patches(t: Tables) -> DataFrame:
    p = I.random_patches(vectors(t), "vec_id", "v", (8, 8), (3, 3), n=3, min_std=0.1)
    return p.select("vec_id", "draw", "top", "left", F.round(A.mean(F.col("patch")), 6).alias("mean"))


@query(
    "crop_extent",
    f"""WITH {SQL_CELLS}, r AS (SELECT vec_id, i // 8 AS k FROM cells GROUP BY 1, 2 HAVING stddev_pop(x) > 0.13),
 c AS (SELECT vec_id, i % 8 AS k FROM cells GROUP BY 1, 2 HAVING stddev_pop(x) > 0.13),
 rr AS (SELECT vec_id, greatest(min(k) - 1, 0)::INT AS top, least(max(k) + 1, 7)::INT AS bottom FROM r GROUP BY 1),
 cc AS (SELECT vec_id, greatest(min(k) - 1, 0)::INT AS lft, least(max(k) + 1, 7)::INT AS rgt FROM c GROUP BY 1)
 SELECT vec_id, top, bottom, lft AS "left", rgt AS "right", coalesce((bottom - top + 1) * (rgt - lft + 1), 0)::INT AS kept
 FROM embeddings LEFT JOIN rr USING (vec_id) LEFT JOIN cc USING (vec_id)""",
)
def crop_extent(t: Tables) -> DataFrame:
    boxed = vectors(t).withColumn("b", I.crop_extent(F.col("v"), (8, 8), 0.13, 1))
    return boxed.select("vec_id", "b.*", F.size(I.crop(F.col("v"), (8, 8), F.col("b"))).alias("kept"))


@query(
    "centre_crop",
    f"""WITH {SQL_CELLS} SELECT vec_id, ((i // 8 - 2) * 4 + i % 8 - 2)::INT AS i, round(x, 6) AS x FROM cells
 WHERE i // 8 BETWEEN 2 AND 5 AND i % 8 BETWEEN 2 AND 5""",
)
def centre_crop(t: Tables) -> DataFrame:
    return long_cells(vectors(t), A.centre_crop(F.col("v"), 8, 8, 4), "vec_id")


@query(
    "channel_offsets",
    f"""WITH {SQL_CELLS}, a AS (SELECT vec_id, avg(x) AS m FROM cells GROUP BY 1)
 SELECT vec_id, (i % 4)::INT AS i, round(avg(x) - any_value(m), 6) AS x FROM cells JOIN a USING (vec_id) GROUP BY 1, 2""",
)
def channel_offsets(t: Tables) -> DataFrame:
    return long_cells(vectors(t), I.channel_offsets(F.col("v"), 4), "vec_id")


RINGS = I.RADII


def _sql_profile(cells: str = SQL_CELLS, start: int = 0) -> str:
    """Numbered from ``start``, with CTEs ``cells`` (vec_id, i, x) first."""
    reg = I.profile_regions(8, 8)
    names = [n for n in reg if n not in ("inner", "outer")]
    sets = list(reg.items()) + [(f"ring{k}", I.ring_index(8, 8, r)) for k, r in enumerate(RINGS)]
    values = ", ".join(f"('{n}', {i})" for n, idx in sets for i in idx)
    place = ", ".join(f"('{n}', {k})" for k, n in enumerate(names))
    circle = ", ".join(f"({k}, {p}, {i})" for k, r in enumerate(RINGS) for p, i in enumerate(I.ring_index(8, 8, r)))
    return f"""WITH RECURSIVE {cells}, reg(g, i) AS (VALUES {values}), place(g, k) AS (VALUES {place}),
 c AS (SELECT vec_id, g, x - avg(x) OVER (PARTITION BY vec_id, g) AS z, avg(x) OVER (PARTITION BY vec_id, g) AS mu FROM cells JOIN reg USING (i)),
 m AS (SELECT vec_id, g, any_value(mu) AS m0, sqrt(avg(z*z)) AS m1, avg(z*z*z) / pow(avg(z*z), 1.5::DOUBLE) AS m2,
  avg(z*z*z*z) / pow(avg(z*z), 2) - 3 AS m3 FROM c GROUP BY 1, 2),
 l AS (SELECT vec_id, g, unnest(range(0, 4)) AS f, unnest([m0, m1, m2, m3]) AS val FROM m),
 a AS (SELECT vec_id, avg(x) AS mean FROM cells GROUP BY 1),
 circle(k, p, i) AS (VALUES {circle}),
 sm AS (SELECT vec_id, k, p, (coalesce(lag(x) OVER w, last_value(x) OVER f) + x + coalesce(lead(x) OVER w, first_value(x) OVER f)) / 3 AS x
  FROM cells JOIN circle USING (i) WINDOW w AS (PARTITION BY vec_id, k ORDER BY p),
  f AS (PARTITION BY vec_id, k ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
 z AS (SELECT vec_id, k, p, (x - avg(x) OVER v) / stddev_pop(x) OVER v AS x FROM sm WINDOW v AS (PARTITION BY vec_id, k)),
 st AS (SELECT DISTINCT vec_id, k, -1 AS p, true AS tr, false AS pk, 2 AS last, 0 AS nt, 0 AS np FROM z
  UNION ALL SELECT vec_id, k, p, x < -1.5, x > 1.5, CASE WHEN up AND pk AND x <= 1.5 THEN 2 WHEN up THEN 1 WHEN pk AND x <= 1.5 AND last = 1 THEN 2 ELSE last END,
   nt + up::INT, np + (pk AND x <= 1.5 AND (up OR last = 1))::INT
   FROM (SELECT st.vec_id, z.k, z.p, z.x, st.tr, st.pk, st.last, st.nt, st.np, (st.tr AND z.x >= -1.5 AND st.last = 2) AS up
    FROM st JOIN z ON st.vec_id = z.vec_id AND st.k = z.k AND z.p = st.p + 1) q)
 SELECT vec_id, ({start} + f * 11)::INT AS i, round(mean, 5) AS x FROM a, range(0, 4) r(f)
 UNION ALL SELECT vec_id, ({start} + f * 11 + 1 + k)::INT, round(val, 5) FROM l JOIN place USING (g)
 UNION ALL SELECT n.vec_id, ({start} + 44 + n.f)::INT, round(CASE WHEN o.val = 0 THEN 10 WHEN n.val / o.val > 10 THEN 10 WHEN n.val / o.val < 0 THEN 0 ELSE coalesce(n.val / o.val, 10) END, 5)
  FROM l n JOIN l o ON n.vec_id = o.vec_id AND n.f = o.f WHERE n.g = 'inner' AND o.g = 'outer'
 UNION ALL SELECT vec_id, ({start} + 48 + 4 * substr(g, 5)::INT + f)::INT, round(val, 5) FROM l WHERE g LIKE 'ring%'
 UNION ALL SELECT vec_id, ({start} + 48 + 4 * {len(RINGS)} + k)::INT, least(max(nt), max(np))::DOUBLE FROM st GROUP BY vec_id, k"""


@query("profile_features", _sql_profile())
def profile_features(t: Tables) -> DataFrame:
    """Section, square and ring numbers and the peak counts."""
    return long_cells(vectors(t), I.profile_vector(F.col("v"), 8, 8, RINGS), "vec_id", digits=5)


SQL_PAGES = """page AS (SELECT vec_id, (k // 3)::INT AS i, (k % 3)::INT AS c, embedding[((k // 3) + 21 * (k % 3)) % 64 + 1]::DOUBLE AS x
  FROM embeddings, range(0, 192) r(k)),
 cells AS (SELECT vec_id, i, sum(CASE c WHEN 0 THEN 0.299::DOUBLE WHEN 1 THEN 0.587::DOUBLE ELSE 0.114::DOUBLE END * x) AS x FROM page GROUP BY 1, 2)"""


@query(
    "image_features",
    _sql_profile(SQL_PAGES, 3)
    + """
 UNION ALL SELECT vec_id, c, round(avg(x) - any_value(mean), 5) FROM page JOIN (SELECT vec_id, avg(x) AS mean FROM page GROUP BY 1) USING (vec_id) GROUP BY 1, 2""",
)
def image_features(t: Tables) -> DataFrame:
    """All 86 numbers of pages of 8 x 8 cells in three channels, each a vector turned by another third."""
    at = F.sequence(F.lit(0), F.lit(191))
    page = F.transform(at, lambda k: F.get("v", ((F.floor(k / 3) + k % 3 * 21) % 64).cast("int")))
    return long_cells(vectors(t).select("vec_id", page.alias("v")), I.image_features(F.col("v"), 8, 8, RINGS), "vec_id", digits=5)




@query(
    "peak_trough",
    f"""WITH RECURSIVE {SQL_CELLS}, z AS (SELECT vec_id, i, (x - avg(x) OVER w) / stddev_pop(x) OVER w AS x FROM cells WINDOW w AS (PARTITION BY vec_id)),
 s AS (SELECT vec_id, -1 AS i, true AS tr, false AS pk, 2 AS last, 0 AS nt, 0 AS np FROM embeddings
  UNION ALL SELECT vec_id, i, x < -1.5, x > 1.5, CASE WHEN up AND pk AND x <= 1.5 THEN 2 WHEN up THEN 1 WHEN pk AND x <= 1.5 AND last = 1 THEN 2 ELSE last END,
   nt + up::INT, np + (pk AND x <= 1.5 AND (up OR last = 1))::INT
   FROM (SELECT s.vec_id, z.i, z.x, s.tr, s.pk, s.last, s.nt, s.np, (s.tr AND z.x >= -1.5 AND s.last = 2) AS up FROM s JOIN z ON s.vec_id = z.vec_id AND z.i = s.i + 1) q)
 SELECT vec_id, least(nt, np)::INT AS peaks FROM s WHERE i = 63""",
)
def peak_trough(t: Tables) -> DataFrame:
    return vectors(t).select("vec_id", A.peak_trough(A.standardise_row(F.col("v"))).alias("peaks"))


@query(
    "augment_noise",
    f"""WITH {SQL_CELLS}, u AS (SELECT vec_id, i, x, {sql_draw('noise radius', 'vec_id', 'i')} AS u1, {sql_draw('noise angle', 'vec_id', 'i')} AS u2 FROM
  (SELECT vec_id, i, (x - min(x) OVER v) / (max(x) OVER v - min(x) OVER v) AS x FROM cells WINDOW v AS (PARTITION BY vec_id)))
 SELECT vec_id, i, round(greatest(0, least(1, x + 0.1::DOUBLE * sqrt(-2 * ln(u1 + 1 / 4294967296.0::DOUBLE)) * cos(u2 * 2 * pi()))), 6) AS x FROM u""",
)
def augment_noise(t: Tables) -> DataFrame:
    return long_cells(vectors(t), I.noise(A.minmax_row(F.col("v")), F.col("vec_id")), "vec_id")


def _sql_affine() -> str:
    u = lambda what: sql_draw(what, "1", "vec_id", "variant")
    only = lambda name, value: f"CASE WHEN variant = '{name}' THEN {value} ELSE 0 END::DOUBLE"
    whole = lambda what, lo, hi: f"floor({u(what)} * {hi - lo + 1}) + {lo}"
    near = "(SELECT vec_id, r, c, x FROM s)"
    corners = " ".join(f"JOIN {near} {n} ON {n}.vec_id = f.vec_id AND {n}.r = f.{a} AND {n}.c = f.{b}"
                       for n, a, b in (("tl", "r0", "c0"), ("tr", "r0", "c1"), ("bl", "r1", "c0"), ("br", "r1", "c1")))
    slope = lambda at, w: (
        f"CASE {at} WHEN 0 THEN lead(x) OVER {w} - x WHEN 7 THEN x - lag(x) OVER {w} "
        f"ELSE (lead(x) OVER {w} - lag(x) OVER {w}) / 2 END * depth * 2.55"
    )
    return f"""WITH {SQL_CELLS},
 s AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, (x - min(x) OVER v) / (max(x) OVER v - min(x) OVER v) AS x
  FROM cells WINDOW v AS (PARTITION BY vec_id)),
 p AS (SELECT vec_id, variant, radians({only('rotate', whole('angle', -40, 40))}) AS a,
  {only('shear_h', f"{u('shear')} * 2 - 1")} AS sh, {only('shear_v', f"{u('shear')} * 2 - 1")} AS sv,
  {', '.join(f"{only('cut', whole(e, 0, 4))} AS e_{e}" for e in ('top', 'bottom', 'left', 'right'))},
  radians({only('emboss', whole('azimuth', -40, 40))}) AS az, radians({only('emboss', whole('elevation', 0, 60))}) AS el,
  {only('emboss', '2')} AS depth
  FROM embeddings, (VALUES ('rotate'), ('shear_h'), ('shear_v'), ('cut'), ('emboss')) v(variant)),
 q AS (SELECT p.*, r, c, (cos(a) * (r - 3.5) + sin(a) * (c - 3.5) + sv * (c - 3.5)) * (8 - e_top - e_bottom) / 8 + (e_top - e_bottom) / 2 + 3.5 AS y,
  (-sin(a) * (r - 3.5) + cos(a) * (c - 3.5) + sh * (r - 3.5)) * (8 - e_left - e_right) / 8 + (e_left - e_right) / 2 + 3.5 AS z
  FROM p, range(0, 8) m(r), range(0, 8) n(c)),
 k AS (SELECT *, y >= -0.5 AND y < 7.5 AND z >= -0.5 AND z < 7.5 AS inside, greatest(0, least(7, y)) AS yy, greatest(0, least(7, z)) AS zz FROM q),
 f AS (SELECT *, floor(yy)::INT AS r0, floor(zz)::INT AS c0, least(floor(yy) + 1, 7)::INT AS r1, least(floor(zz) + 1, 7)::INT AS c1,
  yy - floor(yy) AS fr, zz - floor(zz) AS fc FROM k),
 o AS (SELECT f.*, CASE WHEN inside THEN (tl.x * (1 - fc) + tr.x * fc) * (1 - fr) + (bl.x * (1 - fc) + br.x * fc) * fr ELSE 0 END AS x
  FROM f {corners}),
 g AS (SELECT *, {slope('r', 'dn')} AS down, {slope('c', 'rt')} AS rght FROM o
  WINDOW dn AS (PARTITION BY vec_id, variant, c ORDER BY r), rt AS (PARTITION BY vec_id, variant, r ORDER BY c))
 SELECT vec_id, variant, (r * 8 + c)::INT AS i, round(CASE WHEN depth = 0 THEN x ELSE greatest(0, least(1,
  (cos(el) * cos(az) * down + cos(el) * sin(az) * rght + sin(el)) / sqrt(down * down + rght * rght + 1))) END, 6) + 0.0 AS x FROM g"""


@query("augment_affine", _sql_affine())
def augment_affine(t: Tables) -> DataFrame:
    """Five changed copies of each page, cell by cell."""
    changed = I.augment_affine(vectors(t), "vec_id", "v", 8)
    return long_cells(changed, F.col("v"), "vec_id", "variant")


SHARES = "v / nullif(sum(v) OVER (PARTITION BY vec_id, g), 0)"


@query(
    "leaf_probs",
    f"""WITH {SQL_CELLS}, {SQL_VOTES}, g AS (SELECT vec_id, q, v, CASE WHEN q < 3 THEN 1 WHEN q < 5 THEN 2 WHEN q < 7 THEN 3 WHEN q < 9 THEN 4
  WHEN q < 13 THEN 5 WHEN q < 15 THEN 6 WHEN q < 18 THEN 7 WHEN q < 25 THEN 8 WHEN q < 28 THEN 9 WHEN q < 31 THEN 10 ELSE 11 END AS g FROM votes),
 s AS (SELECT *, coalesce({SHARES}, 0) AS s FROM g)
 SELECT vec_id, (q - 15)::INT AS i, round(v, 8) AS x FROM s WHERE g = 7
 UNION ALL SELECT vec_id, (q - 25 + 3)::INT, round(v, 8) FROM s WHERE g = 9
 UNION ALL SELECT a.vec_id, (6 + (a.q - 5) * 76 + (b.q - 28) * 24 + (c.q - 31) * 4 + d.q - 9)::INT, round(a.v * e.s * b.s * c.s * d.s, 8)
  FROM s a JOIN s b USING (vec_id) JOIN s c USING (vec_id) JOIN s d USING (vec_id) JOIN s e USING (vec_id)
  WHERE a.g = 3 AND b.g = 10 AND c.g = 11 AND d.g = 5 AND e.q = 7
 UNION ALL SELECT a.vec_id, (6 + (a.q - 5) * 76 + 72 + d.q - 9)::INT, round(a.v * e.s * d.s, 8)
  FROM s a JOIN s d USING (vec_id) JOIN s e USING (vec_id) WHERE a.g = 3 AND d.g = 5 AND e.q = 8
 UNION ALL SELECT vec_id, 158, round(v, 8) FROM s WHERE q = 2""",
)
def leaf_probs(t: Tables) -> DataFrame:
    return long_cells(votes(t), I.leaf_probabilities(F.col("votes")), "vec_id", digits=8)


@query(
    "odd_votes",
    f"WITH {SQL_CELLS}, {SQL_VOTES} SELECT vec_id, CASE WHEN q = 14 THEN 0 ELSE (q - 17)::INT END AS i, round(v, 8) AS x FROM votes WHERE q = 14 OR q BETWEEN 18 AND 24",
)
def odd_votes(t: Tables) -> DataFrame:
    return long_cells(votes(t), I.odd_votes(F.col("votes")), "vec_id", digits=8)


@query("spectral_shape")
def spectral_shape(t: Tables) -> DataFrame:
    """Each vector as a short signal: frames of 16 every 8."""
    signals = vectors(t).select("vec_id", A.standardise_row(F.col("v")).alias("signal"))
    return spectral_features(signals, "vec_id", "signal", 16, 8, rate=2000.0, bands=8, mfcc=6)
