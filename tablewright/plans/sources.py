"""Reading and writing files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import try_dates
from tablewright.plans.fixtures import SQL_CELLS, SQL_GRID, grid
from tablewright.plans.registry import Tables, query
from tablewright.sources import delimited as D
from tablewright.sources import files


@query("csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(t: Tables) -> DataFrame:
    path, src = t.scratch(), t.customer
    src.write.option("header", True).csv(path)
    return D.read_csv(t.spark, path, src.schema)


@query("csv_rename_scan", "SELECT s_suppkey AS id, s_name AS label, s_nationkey AS place, s_acctbal AS amount FROM supplier")
def csv_rename_scan(t: Tables) -> DataFrame:
    path = t.scratch()
    t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").write.option("header", True).csv(path)
    return D.read_csv_renamed(t.spark, path, "id BIGINT, label STRING, place INT, amount DOUBLE")


@query("tsv_scan", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def tsv_scan(t: Tables) -> DataFrame:
    path, src = t.scratch(), t.part
    src.write.option("header", True).option("sep", "\t").csv(path)
    return D.read_tsv(t.spark, path, src.schema)


@query(
    "numeric_scan_fill",
    """SELECT c_custkey::DOUBLE AS c_custkey,
 CASE WHEN c_nationkey % 4 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal,
 CASE WHEN c_custkey % 9 = 0 THEN 0.0::DOUBLE ELSE c_nationkey::DOUBLE END AS c_nationkey FROM customer""",
)
def numeric_scan_fill(t: Tables) -> DataFrame:
    path = t.scratch()
    t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") % 4 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_nationkey")).alias("c_nationkey"),
    ).write.option("header", True).csv(path)
    return D.read_numeric(t.spark, path, ["c_custkey", "c_acctbal", "c_nationkey"], fill=0.0)


@query("labelled_rows", f"WITH {SQL_CELLS} SELECT vec_id, label::BIGINT + 1 AS label, i, x::FLOAT AS x FROM cells")
def labelled_rows(t: Tables) -> DataFrame:
    path, width = t.scratch(), 64
    cells = [F.col("embedding")[i].alias(f"f{i}") for i in range(width)]
    t.embeddings.select("vec_id", (F.col("label") + 1).alias("label"), *cells).write.option("header", True).csv(path)
    rows = D.read_labelled_rows(t.spark, path, width, key="vec_id")
    return rows.select("vec_id", "label", F.posexplode("features").alias("i", "x"))


@query("parse_dates", "SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderdate END AS parsed FROM orders")
def parse_dates(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_custkey") % 10 == 0, "unknown")
        .when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "M/d/yyyy H:mm"))
    )
    return t.orders.select("o_orderkey", try_dates(text, ["yyyy-MM-dd", "M/d/yyyy H:mm"]).alias("parsed"))


SQL_SAMPLES = f"WITH {SQL_CELLS} SELECT vec_id, i, round(x * 10000) + 0.0 AS x FROM cells"


def sample_digits() -> Column:
    """Each vector as big-endian 16-bit samples, in hexadecimal digits."""
    code = lambda x: F.lpad(F.hex(F.pmod(F.round(x.cast("double") * 10000).cast("int"), F.lit(65536))), 4, "0")
    return F.array_join(F.transform("embedding", code), "")


@query("file_scan", SQL_SAMPLES)
def file_scan(t: Tables) -> DataFrame:
    """Clips written to files, found by their extension, read whole and decoded."""
    path = t.scratch()
    t.embeddings.select(F.concat_ws(" ", "vec_id", sample_digits())).write.text(path)
    found = files.scan_files(t.spark, path, "txt", content=True)
    lines = found.select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).where("line <> ''")
    raw = lines.select(
        F.substring_index("line", " ", 1).cast("bigint").alias("vec_id"),
        F.unhex(F.substring_index("line", " ", -1)).alias("content"),
    )
    decoded = files.decode_pcm16be(raw, "vec_id", "content")
    return decoded.select("vec_id", F.posexplode("samples").alias("i", "x"))


@query("pcm_decode", SQL_SAMPLES)
def pcm_decode(t: Tables) -> DataFrame:
    """Each vector written as big-endian 16-bit samples, then decoded."""
    raw = t.embeddings.select("vec_id", F.unhex(sample_digits()).alias("content"))
    decoded = files.decode_pcm16be(raw, "vec_id", "content")
    return decoded.select("vec_id", F.posexplode("samples").alias("i", "x"))


@query("grid_lookup", f"WITH {SQL_GRID} SELECT lat, lon, round(value, 6) AS value FROM grid WHERE dt = 19970301 AND fhour = 12 AND ens = 3")
def grid_lookup(t: Tables) -> DataFrame:
    path = t.scratch()
    # ranges over a unique key: few files per date, and a busy date spreads over several tasks
    cells = grid(t).repartitionByRange("dt", "fhour", "ens", "lat", "lon")
    cells.write.partitionBy("dt").parquet(path)
    found = files.grid_lookup(t.spark.read.parquet(path), 19970301, 12, 3)
    return found.withColumn("value", F.round("value", 6))


@query(
    "stage_cache",
    "SELECT o_orderpriority, count(*) AS n, round(avg(ln(o_totalprice)), 6) AS mean_log FROM orders GROUP BY 1",
)
def stage_cache(t: Tables) -> DataFrame:
    path = t.scratch()

    def build() -> DataFrame:
        return t.orders.groupBy("o_orderpriority").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg(F.log("o_totalprice")), 6).alias("mean_log")
        )

    files.materialise_or_load(t.spark, path, build)

    def again() -> DataFrame:
        raise AssertionError("a finished stage must not be built twice")

    return files.materialise_or_load(t.spark, path, again)


@query("write_predictions", "SELECT o_orderkey, o_totalprice / 1000 AS prediction FROM orders")
def write_predictions(t: Tables) -> DataFrame:
    path = t.scratch()
    pred = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("prediction"))
    D.write_predictions(pred, path, "o_orderkey", ["o_orderkey", "prediction"])
    return D.read_csv(t.spark, path, "o_orderkey BIGINT, prediction DOUBLE")


@query(
    "format_rows",
    "SELECT p_partkey, printf('%d,%6d,%8.3f,%.1f', p_partkey, p_size, p_retailprice, (p_size + 1)::DOUBLE) AS line FROM part",
)
def format_rows(t: Tables) -> DataFrame:
    rows = t.part.withColumn("klass", (F.col("p_size") + 1).cast("double")).withColumn("key", F.col("p_partkey"))
    line = D.format_rows({"key": "%d", "p_size": "%6d", "p_retailprice": "%8.3f", "klass": "%.1f"})
    return rows.select("p_partkey", line.alias("line"))


@query("write_gzip", "SELECT o_orderkey, o_orderstatus FROM orders")
def write_gzip(t: Tables) -> DataFrame:
    path = t.scratch()
    D.write_predictions(t.orders, path, "o_orderkey", ["o_orderkey", "o_orderstatus"], gzip=True)
    return D.read_csv(t.spark, path, "o_orderkey BIGINT, o_orderstatus STRING")
