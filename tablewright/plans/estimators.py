"""Encodings, selection, whitening, clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import arrays as A
from tablewright.operators import cluster as C
from tablewright.operators import encode as N
from tablewright.operators import project as P
from tablewright.operators.clean import apply_cells, apply_scale, fit_cells, fit_standardise
from tablewright.plans.fixtures import SQL_CELLS, long_cells, vectors
from tablewright.plans.registry import Tables, query

CAT = ["p_brand", "p_type", "p_size"]
SQL_LONG = """l AS (SELECT p_partkey, unnest(['p_brand', 'p_type', 'p_size']) AS feature, unnest([p_brand, p_type, p_size::VARCHAR]) AS value FROM part)"""
# Frequent English words left out of word counts.
STOP = ["the", "and", "of", "to", "in", "is", "it", "that", "for", "on", "with", "as", "by", "at", "an"]
SQL_STOP = ", ".join(f"'{w}'" for w in STOP)


@query(
    "target_encode",
    """WITH j AS (SELECT d.doc_id, source, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
 l AS (SELECT doc_id, quality, unnest(['source', 'lang']) AS feature, unnest([source, lang]) AS value FROM j)
 SELECT doc_id, feature, round(avg(coalesce(quality, 0.5::DOUBLE)) OVER (PARTITION BY feature, value) , 10) AS encoded FROM l""",
)
def target_encode(t: Tables) -> DataFrame:
    """Labelled documents train, unlabelled ones count one half."""
    table = t.documents.select("doc_id", "source", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    out = N.target_encode(table, "doc_id", ["source", "lang"], "quality")
    return out.select("doc_id", "feature", F.round("encoded", 10).alias("encoded"))


@query(
    "one_hot_wide",
    """SELECT o_orderkey, o_totalprice, """
    + ", ".join(f"(o_orderstatus = '{v}')::INT AS \"o_orderstatus={v}\"" for v in "FOP")
    + ", "
    + ", ".join(
        f"(o_orderpriority = '{v}')::INT AS \"o_orderpriority={v}\""
        for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " FROM orders",
)
def one_hot_wide(t: Tables) -> DataFrame:
    table = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    cols = ["o_orderstatus", "o_orderpriority"]
    return N.one_hot_wide(table, N.fit_one_hot(table, cols), cols)


@query(
    "one_hot_frequent",
    f"""WITH {SQL_LONG}, v AS (SELECT feature, value FROM l GROUP BY 1, 2 HAVING count(*) > 40),
 k AS (SELECT feature, value, row_number() OVER (ORDER BY feature, value) - 1 AS idx FROM v)
 SELECT p_partkey, idx FROM l JOIN k USING (feature, value)""",
)
def one_hot_frequent(t: Tables) -> DataFrame:
    return N.one_hot_long(t.part, "p_partkey", N.fit_one_hot(t.part, CAT, 40), CAT)


@query(
    "one_hot_reuse",
    f"""WITH {SQL_LONG}, v AS (SELECT DISTINCT feature, value FROM l WHERE p_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25)),
 k AS (SELECT feature, value, row_number() OVER (ORDER BY feature, value) - 1 AS idx FROM v)
 SELECT p_partkey, idx FROM l JOIN k USING (feature, value)""",
)
def one_hot_reuse(t: Tables) -> DataFrame:
    """Vocabulary from the smaller parts, used on all parts."""
    vocabulary = N.fit_one_hot(t.part.where(F.col("p_size") <= 25), CAT)
    return N.one_hot_long(t.part, "p_partkey", vocabulary, CAT)


SQL_TOKENS = f"tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{N.TOKEN}')) AS term FROM documents)"


@query(
    "doc_frequency",
    f"""WITH {SQL_TOKENS} SELECT term, count(DISTINCT doc_id) AS df FROM tok WHERE term NOT IN ({SQL_STOP}) GROUP BY 1 HAVING count(DISTINCT doc_id) >= 10""",
)
def doc_frequency(t: Tables) -> DataFrame:
    return N.document_frequency(t.documents, "doc_id", "text", 10, STOP)


@query(
    "term_counts",
    f"""WITH {SQL_TOKENS}, v AS (SELECT term FROM tok WHERE term NOT IN ({SQL_STOP}) GROUP BY 1 HAVING count(DISTINCT doc_id) >= 10)
 SELECT doc_id, term, count(*) AS n FROM tok WHERE term IN (SELECT term FROM v) GROUP BY 1, 2""",
)
def term_counts(t: Tables) -> DataFrame:
    return N.bag_of_words(t.documents, "doc_id", "text", 10, STOP)


SQL_F = """per AS (SELECT i, label, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS ss FROM cells GROUP BY 1, 2),
 al AS (SELECT i, avg(x) AS gm, count(*) AS nn FROM cells GROUP BY 1),
 f AS (SELECT per.i, (sum(n * pow(m - gm, 2)) / (count(*) - 1)) / (sum(ss) / (any_value(nn) - count(*))) AS f FROM per JOIN al USING (i) GROUP BY per.i)"""


@query("anova_f", f"WITH {SQL_CELLS}, {SQL_F} SELECT i, round(f, 6) AS f FROM f")
def anova_f(t: Tables) -> DataFrame:
    return N.anova_f(vectors(t), "v", "label").withColumn("f", F.round("f", 6))


@query(
    "select_k_best",
    f"""WITH {SQL_CELLS}, {SQL_F}, b AS (SELECT i FROM f ORDER BY f DESC, i LIMIT 20)
 SELECT vec_id, i, round(x, 6) AS x FROM cells WHERE i IN (SELECT i FROM b)""",
)
def select_k_best(t: Tables) -> DataFrame:
    """Select 20 cells on the training rows, keep those of every row."""
    v = vectors(t)
    chosen = N.select_k_best(v, "v", "label", 20)
    place = F.create_map(*[F.lit(int(x)) for pair in enumerate(chosen) for x in pair])
    out = long_cells(v, A.pick(F.col("v"), chosen), "vec_id")
    return out.select("vec_id", place[F.col("i")].alias("i"), "x")


@query(
    "covariance",
    f"""WITH {SQL_CELLS} SELECT a.i AS i, b.i AS j, round(covar_pop(a.x, b.x), 8) + 0.0 AS cov FROM cells a JOIN cells b USING (vec_id) GROUP BY 1, 2""",
)
def covariance(t: Tables) -> DataFrame:
    return P.covariance_rows(vectors(t), "v").withColumn("cov", F.round("cov", 8) + 0.0)


@query(
    "zca",
    """WITH d AS (SELECT max(len(embedding)) AS d FROM embeddings)
 SELECT i::INT AS i, j::INT AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cov
 FROM (SELECT unnest(range(0, d)) AS i FROM d) a, (SELECT unnest(range(0, d)) AS j FROM d) b""",
)
def zca(t: Tables) -> DataFrame:
    """Covariance after whitening: the identity."""
    v = vectors(t)
    white = P.fit_zca(v, "v").apply(v, "v")
    return P.covariance_rows(white, "v").withColumn("cov", F.round("cov", 6) + 0.0)


@query("zca_vectors")
def zca_vectors(t: Tables) -> DataFrame:
    v = vectors(t)
    return long_cells(P.fit_zca(v, "v").apply(v, "v"), F.col("v"), "vec_id")


@query("pca")
def pca(t: Tables) -> DataFrame:
    v = vectors(t)
    return long_cells(P.fit_pca(v, "v", 8).apply(v, "v"), F.col("v"), "vec_id")


@query(
    "pca_whiten",
    """SELECT i::INT AS i, j::INT AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cov FROM range(0, 8) a(i), range(0, 8) b(j)""",
)
def pca_whiten(t: Tables) -> DataFrame:
    """Covariance of whitened components: the identity."""
    v = vectors(t)
    white = P.fit_pca(v, "v", 8, whiten=True).apply(v, "v")
    return P.covariance_rows(white, "v").withColumn("cov", F.round("cov", 6) + 0.0)


@query(
    "standardise_cells",
    f"""WITH {SQL_CELLS} SELECT vec_id, i, round((x - avg(x) OVER w) / stddev_pop(x) OVER w, 6) AS x FROM cells WINDOW w AS (PARTITION BY i)""",
)
def standardise_cells(t: Tables) -> DataFrame:
    """Every vector position scaled by its own mean and std."""
    v = vectors(t)
    return long_cells(apply_cells(v, "v", fit_cells(v, "v")), F.col("v"), "vec_id")


@query(
    "minmax_cells",
    f"""WITH {SQL_CELLS} SELECT vec_id, i, round((x - min(x) OVER w) / (max(x) OVER w - min(x) OVER w), 6) AS x FROM cells WINDOW w AS (PARTITION BY i)""",
)
def minmax_cells(t: Tables) -> DataFrame:
    v = vectors(t)
    return long_cells(apply_cells(v, "v", fit_cells(v, "v", "minmax")), F.col("v"), "vec_id")


@query("nmf")
def nmf(t: Tables) -> DataFrame:
    """Weights on four nonnegative parts after scaling every position to [0, 1]."""
    v = vectors(t)
    scaled = apply_cells(v, "v", fit_cells(v, "v", "minmax")).persist()
    return long_cells(P.fit_nmf(scaled, "v", 4).apply(scaled, "v"), F.col("v"), "vec_id")


@query("rff")
def rff(t: Tables) -> DataFrame:
    """Random features of the rbf kernel, then the top components."""
    v = vectors(t)
    lifted = P.fit_rff(64, 128, gamma=0.5).apply(v, "v")
    return long_cells(P.fit_pca(lifted, "v", 8).apply(lifted, "v"), F.col("v"), "vec_id")


SQL_KM = """cen AS (SELECT row_number() OVER (ORDER BY n DESC, p_brand, p_type, p_size) - 1 AS k, p_brand, p_type, p_size FROM
  (SELECT p_brand, p_type, p_size::VARCHAR AS p_size, count(*) AS n FROM part GROUP BY 1, 2, 3) g ORDER BY k LIMIT 4),
 d AS (SELECT p_partkey, k, (p.p_brand <> c.p_brand)::INT + (p.p_type <> c.p_type)::INT + (p.p_size::VARCHAR <> c.p_size)::INT AS m,
  p.p_brand, p.p_type, p.p_size::VARCHAR AS p_size FROM part p, cen c),
 a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY m, k) AS r FROM d) z WHERE r = 1)"""


@query(
    "kmodes_step",
    f"""WITH {SQL_KM}, l AS (SELECT k, unnest(['p_brand', 'p_type', 'p_size']) AS feature, unnest([p_brand, p_type, p_size]) AS value FROM a),
 c AS (SELECT k, feature, value, count(*) AS n FROM l GROUP BY 1, 2, 3)
 SELECT k::INT AS cluster, feature, value, n FROM (SELECT *, row_number() OVER (PARTITION BY k, feature ORDER BY n DESC, value) AS r FROM c) z WHERE r = 1""",
)
def kmodes_step(t: Tables) -> DataFrame:
    """One exact round from the most frequent rows."""
    start = C.Centroids(tuple(C.frequent_rows(t.part, CAT, 4)))
    return C.modes(C.assign(t.part, start), CAT)


@query("kmodes")
def kmodes(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey", *CAT).persist()
    best, _ = C.kmodes(part, CAT, 4)
    part.unpersist()
    return C.assign(t.part, best).select("p_partkey", "cluster", "cost")


@query(
    "kprototypes_step",
    """WITH s AS (SELECT p_partkey, p_brand, p_type, (p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER () AS price,
  (p_size - avg(p_size) OVER ()) / stddev_samp(p_size) OVER () AS size FROM part),
 cen AS (SELECT row_number() OVER (ORDER BY n DESC, p_brand, p_type) - 1 AS k, * FROM
  (SELECT p_brand, p_type, count(*) AS n, avg(price) AS price, avg(size) AS size FROM s GROUP BY 1, 2) g ORDER BY k LIMIT 5),
 d AS (SELECT p_partkey, k, pow(s.price - c.price, 2) + pow(s.size - c.size, 2) + 0.7::DOUBLE * ((s.p_brand <> c.p_brand)::INT + (s.p_type <> c.p_type)::INT) AS m, s.price, s.size
  FROM s, cen c),
 a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY m, k) AS r FROM d) z WHERE r = 1)
 SELECT k::INT AS cluster, count(*) AS n, round(avg(price), 6) AS price, round(avg(size), 6) AS size, round(sum(m), 4) AS cost FROM a GROUP BY 1""",
)
def kprototypes_step(t: Tables) -> DataFrame:
    """One exact round on two categories and two standardised numbers."""
    raw = t.part.select("p_partkey", "p_brand", "p_type", F.col("p_retailprice").alias("price"), F.col("p_size").cast("double").alias("size"))
    table = apply_scale(raw, fit_standardise(raw, ["price", "size"]))
    start = C.start_prototypes(table, ["p_brand", "p_type"], ["price", "size"], 5, gamma=0.7)
    return C.assign(table, start).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 6).alias("price"),
        F.round(F.avg("size"), 6).alias("size"), F.round(F.sum("cost"), 4).alias("cost"),
    )


@query("kprototypes")
def kprototypes(t: Tables) -> DataFrame:
    """Cluster numbers for three values of k as features."""
    raw = t.part.select("p_partkey", "p_brand", "p_type", F.col("p_retailprice").alias("price"), F.col("p_size").cast("double").alias("size"))
    table = apply_scale(raw, fit_standardise(raw, ["price", "size"]))
    cat, num = ["p_brand", "p_type"], ["price", "size"]
    kinds = C.equal_rows(table, cat + num).persist()
    out = table
    for k, best in C.kprototypes(kinds, cat, num, (5, 10, 50), gamma=0.7, weight="weight").items():
        out = C.assign(out, best, cluster=f"c{k}", cost="_cost").drop("_cost")
    kinds.unpersist()
    return out.select("p_partkey", "c5", "c10", "c50")
