"""Scores, folds and model jobs."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import crosses, draw
from tablewright.operators import folds, metrics, newton
from tablewright.operators import models as M
from tablewright.operators import project as P
from tablewright.operators.clean import apply_scale, fit_standardise
from tablewright.operators.joins import left_join_default
from tablewright.operators.newton import spread
from tablewright.plans.fixtures import SQL_CELLS, vectors
from tablewright.plans.registry import Tables, query
from tablewright.plans.relational import sql_draw
from tablewright.plans.series import ECON_COLS, economy_features
from tablewright.session import durable

SQL_SCORED = """sc AS (SELECT doc_id, quality, n_chars / (n_chars + 1500.0::DOUBLE) AS p FROM labels JOIN documents USING (doc_id))"""


def scored(t: Tables) -> DataFrame:
    n = F.col("n_chars")
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", "quality", (n / (n + 1500.0)).alias("p")
    )


@query("logloss", f"WITH {SQL_SCORED} SELECT round(-avg(CASE WHEN quality = 1 THEN ln(p) ELSE ln(1 - p) END), 8) AS logloss FROM sc")
def logloss(t: Tables) -> DataFrame:
    return scored(t).agg(F.round(metrics.logloss(F.col("quality"), F.col("p")), 8).alias("logloss"))


@query(
    "rmse",
    f"""WITH {SQL_CELLS}, e AS (SELECT x - (lag(x) OVER w + x) / 2 AS e FROM cells WINDOW w AS (PARTITION BY vec_id ORDER BY i))
 SELECT round(sqrt(avg(e * e)), 8) AS rmse, round(avg(e * e), 8) AS mse FROM e WHERE e IS NOT NULL""",
)
def rmse(t: Tables) -> DataFrame:
    """Error over many outputs: each cell predicted by the mean of itself and the one before."""
    v = F.col("v")
    truth, guess = F.slice(v, 2, 63), F.zip_with(F.slice(v, 1, 63), F.slice(v, 2, 63), lambda a, b: (a + b) / 2)
    cells = vectors(t).select(F.explode(F.arrays_zip(truth.alias("y"), guess.alias("p"))).alias("c"))
    y, p = F.col("c.y"), F.col("c.p")
    return cells.agg(F.round(metrics.rmse(y, p), 8).alias("rmse"), F.round(metrics.mse(y, p), 8).alias("mse"))


@query(
    "r2",
    """SELECT round(1 - avg(pow(l_extendedprice - 1500.0::DOUBLE * l_quantity, 2)) / var_pop(l_extendedprice), 8) AS r2 FROM lineitem""",
)
def r2(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.round(metrics.r2(F.col("l_extendedprice"), 1500.0 * F.col("l_quantity")), 8).alias("r2"))


@query("accuracy", f"WITH {SQL_SCORED} SELECT round(avg((quality = (p > 0.5)::INT)::INT), 8) AS accuracy FROM sc")
def accuracy(t: Tables) -> DataFrame:
    return scored(t).agg(F.round(metrics.accuracy(F.col("quality"), (F.col("p") > 0.5).cast("int")), 8).alias("accuracy"))


@query(
    "auc_exact",
    f"""WITH {SQL_SCORED}, r AS (SELECT quality, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM sc),
 s AS (SELECT sum(CASE WHEN quality = 1 THEN r ELSE 0 END) AS r, sum(quality)::DOUBLE AS p, count(*) - sum(quality)::DOUBLE AS n FROM r)
 SELECT round((r - p * (p + 1) / 2) / (p * n), 8) AS auc FROM s""",
)
def auc_exact(t: Tables) -> DataFrame:
    return metrics.auc(scored(t), "p", "quality").select(F.round("auc", 8).alias("auc"))


@query(
    "kfold",
    """WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p, count(*) OVER () AS n FROM labels)
 SELECT doc_id, (CASE WHEN p < (n % 10) * (n // 10 + 1) THEN p // (n // 10 + 1) ELSE n % 10 + (p - (n % 10) * (n // 10 + 1)) // (n // 10) END)::INT AS fold FROM p""",
)
def kfold(t: Tables) -> DataFrame:
    return folds.kfold(t.labels, "doc_id", 10).select("doc_id", "fold")


@query(
    "kfold_shuffled",
    f"""WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_draw('fold', '1', 'doc_id')}, doc_id) - 1 AS p, count(*) OVER () AS n FROM labels)
 SELECT doc_id, (CASE WHEN p < (n % 10) * (n // 10 + 1) THEN p // (n // 10 + 1) ELSE n % 10 + (p - (n % 10) * (n // 10 + 1)) // (n // 10) END)::INT AS fold FROM p""",
)
def kfold_shuffled(t: Tables) -> DataFrame:
    return folds.kfold(t.labels, "doc_id", 10, shuffle=True).select("doc_id", "fold")


@query(
    "stratified_folds",
    "SELECT doc_id, ((row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1) % 5)::INT AS fold FROM labels",
)
def stratified_folds(t: Tables) -> DataFrame:
    return folds.stratified(t.labels, "doc_id", "quality", 5).select("doc_id", "fold")


@query(
    "stratified_shuffle",
    f"""WITH p AS (SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY {sql_draw('fold', '1', 'doc_id')}, doc_id) - 1 AS p, count(*) OVER (PARTITION BY quality) AS n FROM labels)
 SELECT doc_id, p < round(n * 0.1::DOUBLE) AS is_test FROM p""",
)
def stratified_shuffle(t: Tables) -> DataFrame:
    return folds.stratified_shuffle(t.labels, "doc_id", "quality").select("doc_id", "is_test")


@query(
    "shuffle_split",
    f"""WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_draw('fold', '1', 'doc_id')}, doc_id) - 1 AS p, count(*) OVER () AS n FROM labels)
 SELECT doc_id, p < round_even(0.6::DOUBLE * n, 0) AS is_train FROM p""",
)
def shuffle_split(t: Tables) -> DataFrame:
    return folds.shuffle_split(t.labels, "doc_id", 0.6).select("doc_id", "is_train")


@query(
    "repeated_shuffles",
    f"""WITH s AS (SELECT doc_id, quality, split::INT AS split FROM labels, range(1, 11) r(split)),
 p AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split, quality ORDER BY {sql_draw('split', '1', 'split', 'doc_id')}, doc_id) - 1 AS p,
  count(*) OVER (PARTITION BY split, quality) AS n FROM s)
 SELECT doc_id, split, p < round(n * 0.1::DOUBLE) AS is_test FROM p""",
)
def repeated_shuffles(t: Tables) -> DataFrame:
    """Ten independent stratified splits."""
    return folds.repeated_shuffles(t.labels, "doc_id", "quality", 10)


# ---- model jobs

NUM = ["chars", "words", "lines", "digits", "uppers", "mean_word"]


def described_documents(t: Tables) -> DataFrame:
    """All documents with simple whole-text numbers and categories; the label is null where there is none."""
    text = F.col("text")
    chars = F.length(text).cast("double")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return (
        t.documents.join(t.labels, "doc_id", "left")
        .select(
            "doc_id", "lang", "source", F.col("quality").cast("double").alias("label"),
            F.log1p(chars).alias("chars"), F.log1p(count(r"\S+")).alias("words"), F.log1p(count("\n")).alias("lines"),
            F.try_divide(count(r"\d"), chars).alias("digits"), F.try_divide(count("[A-Z]"), chars).alias("uppers"),
            F.try_divide(chars, count(r"\S+") + 1).alias("mean_word"),
        )
        .withColumn("size", F.floor("chars").cast("string"))
    )


def ready(t: Tables, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """Standardised features: labelled rows with a fold column, and all rows. The scale is that of the labelled."""
    base = durable(described_documents(t))  # the texts are read once
    labelled = F.col("label").isNotNull()
    scaled = apply_scale(base, fit_standardise(base.where(labelled), NUM)).na.fill(0.0, NUM)
    everything = M.assemble(spread(scaled, "doc_id"), NUM)
    return folds.stratified(everything.where(labelled), "doc_id", "label", k).persist(), everything


def probabilities(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "label", F.round(M.positive(), 6).alias("p"))


@query("logreg")
def logreg(t: Tables) -> DataFrame:
    """Fitted on the labelled documents, applied to all."""
    labelled, everything = ready(t)
    data = M.balanced_weights(labelled, "label")
    model = M.fitted(M.logistic(4.0, data.count(), weight="weight"), data)
    labelled.unpersist()
    return probabilities(model.transform(everything))


@query(
    "submission",
    """SELECT d.doc_id, l.doc_id IS NOT NULL AS labelled, true AS is_probability
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def submission(t: Tables) -> DataFrame:
    """Fit on the labelled rows, predict every row, write the file and read it again."""
    scored = logreg(t).select("doc_id", F.col("label").isNotNull().alias("labelled"), "p")
    path = t.scratch()
    scored.write.option("header", True).csv(path)
    back = t.spark.read.csv(path, header=True, schema="doc_id bigint, labelled boolean, p double")
    return back.select("doc_id", "labelled", F.col("p").between(0, 1).alias("is_probability"))


@query("rf_classifier")
def rf_classifier(t: Tables) -> DataFrame:
    data, everything = ready(t)
    model = M.fitted(M.forest_classifier(20, 3, 5), data)
    data.unpersist()
    return probabilities(model.transform(everything))


@query("gbt_classifier")
def gbt_classifier(t: Tables) -> DataFrame:
    data, everything = ready(t)
    model = M.boosting(10, 3, 5, subset="0.5").fit(data)
    data.unpersist()
    return probabilities(model.transform(everything))


LI_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]


def priced(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    held = draw("held out", 1, F.col("l_orderkey"), F.col("l_linenumber")) < 0.2
    rows = t.lineitem.join(part, "l_partkey").select(
        "l_returnflag", "l_linestatus", *LI_FEATURES, F.log("l_extendedprice").alias("y"), held.alias("held"),
        "l_orderkey", "l_linenumber",
    )
    dealt = M.dealt(rows, t.lineitem.count(), ["l_orderkey", "l_linenumber"]).drop("l_orderkey", "l_linenumber")
    return M.assemble(dealt, LI_FEATURES)


@query("rf_regressor")
def rf_regressor(t: Tables) -> DataFrame:
    """Log price from line item columns; rows and errors per group, errors of the fifth that is held out."""
    data = priced(t).persist()
    out = M.forest_regressor(10, 5, 25, "sqrt", "y").fit(data.where(~F.col("held"))).transform(data)
    y, guess = (F.when(F.col("held"), F.col(c)) for c in ("y", "prediction"))
    return out.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), metrics.rmse(y, guess).alias("rmse"), metrics.r2(y, guess).alias("r2"),
    )


@query("rf_multi_regressor")
def rf_multi_regressor(t: Tables) -> DataFrame:
    """One forest per target on one cached input; error over all outputs."""
    data = vectors(t).select(
        "vec_id", array_to_vector(F.slice("v", 5, 16)).alias("features"), *[F.col("v")[i].alias(f"y{i}") for i in range(4)]
    ).persist()
    out = data
    for i in range(4):
        model = M.forest_regressor(10, 5, 10, "sqrt", f"y{i}").setPredictionCol(f"p{i}").fit(data)
        out = model.transform(out)
    err = sum((F.col(f"y{i}") - F.col(f"p{i}")) ** 2 for i in range(4)) / 4
    return out.select("vec_id", err.alias("squared_error"))


@query("feature_importance")
def feature_importance(t: Tables) -> DataFrame:
    data = priced(t).select("features", "y").persist()
    model = M.forest_regressor(10, 5, 25, "sqrt", "y").fit(data)
    data.unpersist()
    return M.importances(model, LI_FEATURES, data)


@query("rbf_regression")
def rbf_regression(t: Tables) -> DataFrame:
    """Target series from delayed outside series; R2 on the fit."""
    table = economy_features(t)
    lagged = [c for c in ECON_COLS if c != "t"]
    scaled = apply_scale(table, fit_standardise(table, ECON_COLS)).na.fill(0.0)
    rows = scaled.select("d", "t", F.array(*lagged).alias("v"))
    lifted = P.fit_rff(len(lagged), 64, gamma=0.05).apply(rows, "v").select("d", "t", array_to_vector("v").alias("features")).persist()
    out = M.rbf_regression(lifted, "t", "features").transform(lifted)
    return out.agg(F.count(F.lit(1)).alias("n"), metrics.r2(F.col("t"), F.col("prediction")).alias("r2"))


@query("cv_report")
def cv_report(t: Tables) -> DataFrame:
    data, _ = ready(t)
    n = data.count()
    rows = []
    for name, model in (("logistic", M.logistic(4.0, n)), ("forest", M.forest_classifier(10, 3, 5))):
        mean, half = M.cv_score(data, model, "fold", 3, M.auc_evaluator())
        rows.append((name, float(mean), float(half)))
    return t.spark.createDataFrame(rows, "model string, mean_auc double, half_std double")


CATS = ["lang", "source", "size", "lang_x_source"]
#: Folds of feature selection and of the sweep over C.
SELECTION_FOLDS, SWEEP_FOLDS = 8, 10


def category_scorer(t: Tables) -> newton.Selection:
    """Cross-validated AUC of sets of one-hot features; the texts are not read, and rows of one kind are counted once."""
    base = t.documents.select("doc_id", "lang", "source", F.floor(F.log1p("n_chars")).cast("string").alias("size"))
    label = F.col("quality").cast("double").alias("label")
    base = base.join(t.labels.where("quality is not null").select("doc_id", label), "doc_id")
    crossed = base.select("doc_id", "label", "lang", "source", "size", *[c.cast("string") for c in crosses(["lang", "source"], 2)])
    crossed = crossed.toDF("doc_id", "label", *CATS)
    dealt = folds.stratified(crossed, "doc_id", "label", SELECTION_FOLDS)
    counted = durable(newton.counted_rows(dealt, CATS, "label", "fold"))
    found = newton.levels(counted, CATS)
    return newton.Selection(newton.one_hot_rows(counted, found), found, SELECTION_FOLDS)


def _selection(t: Tables, chosen: list[tuple[str, float]]) -> DataFrame:
    rows = [(i, f, float(s)) for i, (f, s) in enumerate(chosen)]
    return t.spark.createDataFrame(rows, "step int, feature string, auc double")


@query("forward_selection")
def forward_selection(t: Tables) -> DataFrame:
    score = category_scorer(t)
    return _selection(t, M.forward_selection(score, CATS, score.ahead))


@query("approx_selection")
def approx_selection(t: Tables) -> DataFrame:
    score = category_scorer(t)
    return _selection(t, M.approximate_selection(score, CATS, 3, score.ahead))


def design_rows(data: DataFrame) -> DataFrame:
    """Assembled rows as the joint fits read them, each of weight 1."""
    return data.select(vector_to_array("features").alias("features"), "label", F.lit(1.0).alias("weight"), "fold")


@query("c_sweep")
def c_sweep(t: Tables) -> DataFrame:
    data, _ = ready(t, SWEEP_FOLDS)
    scores = M.sweep_c(design_rows(data), SWEEP_FOLDS, M.c_grid(1.0))
    data.unpersist()
    best, _ = M.best_c(scores)
    rows = [(float(c), float(s), c == best) for c, s in scores]
    return t.spark.createDataFrame(rows, "c double, auc double, best boolean")


@query("stacking")
def stacking(t: Tables) -> DataFrame:
    """Two levels, each out of fold for the labelled documents and refitted on all of them for the others."""
    data, everything = ready(t)
    n = data.count()
    models = {"p_lr": M.logistic(4.0, n), "p_rf": M.forest_classifier(10, 3, 5)}
    level1 = M.out_of_fold(data, models, "fold", 3, ["doc_id", "label", "fold"])
    level2 = M.assemble(durable(level1), list(models))
    known = M.out_of_fold(level2, {"p": M.logistic(4.0, n)}, "fold", 3, ["doc_id", "label"])
    rest = everything.where("label is null")
    for name, model in models.items():
        rest = M.fitted(model, data).transform(rest).withColumn(name, M.positive())
        rest = rest.drop("rawPrediction", "probability", "prediction")
    rest = M.assemble(rest.drop("features"), list(models))
    others = M.fitted(M.logistic(4.0, n), level2).transform(rest).select("doc_id", "label", M.positive().alias("p"))
    data.unpersist()
    return known.unionByName(others).select("doc_id", "label", F.round("p", 6).alias("p"))


# The groups that get a model of their own.
LANGS = ["de", "en", "es", "fr"]


@query("group_models")
def group_models(t: Tables) -> DataFrame:
    """One model per language, named as an argument; documents of other languages get the one fitted on all."""
    data, everything = ready(t)
    return M.per_group(data, everything, "lang", LANGS, lambda: M.forest_classifier(10, 2, 5), ["doc_id", "lang", "label"])


@query("econ_price_model")
def econ_price_model(t: Tables) -> DataFrame:
    """Log price forest, daily residual factor from outside series, factor joined back, price per day.

    Every fifth day by draw is held out of both fits, so errors can be taken of days the models have not seen.
    """
    status = F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "O", 1.0).otherwise(2.0)
    rows = t.orders.select(
        "o_orderkey", F.to_date("o_orderdate").alias("d"), F.log("o_totalprice").alias("y"),
        F.month("o_orderdate").cast("double").alias("month"), F.year("o_orderdate").cast("double").alias("year"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"), status.alias("status"),
    ).withColumn("held", draw("held out", 1, F.unix_date("d")) < 0.2)
    seen = ~F.col("held")
    data = M.assemble(rows, ["month", "year", "priority", "status"]).persist()
    fitted = M.forest_regressor(10, 5, 25, "log2", "y").fit(data.where(seen)).transform(data)
    residual = fitted.groupBy("d", "held").agg((F.avg("y") / F.avg("prediction")).alias("factor"))
    lagged = [c for c in ECON_COLS if c != "t"]
    outside = economy_features(t).join(residual, "d")
    scaled = apply_scale(outside, fit_standardise(outside.where(seen), lagged)).na.fill(0.0, lagged)
    lifted = P.fit_rff(len(lagged), 64, gamma=0.05).apply(scaled.select("d", "held", "factor", F.array(*lagged).alias("v")), "v")
    lifted = lifted.select("d", "held", "factor", array_to_vector("v").alias("features")).persist()
    factors = M.rbf_regression(lifted.where(seen), "factor", "features").transform(lifted).select("d", F.col("prediction").alias("econ"))
    priced_rows = left_join_default(fitted.select("d", "held", "y", "prediction"), factors, "d", "econ", 1.0)
    return priced_rows.groupBy("d", "held").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.exp(F.col("prediction") * F.col("econ"))).alias("predicted"),
        F.avg(F.exp("y")).alias("actual"),
    )
