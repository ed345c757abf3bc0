"""Helpers shared by the corpus operators: words, staged tables, linked groups."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import shared_folder

#: Words are runs of anything but these six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the folder that all executors share and go on from there.

    Cuts the lineage and makes later steps independent of recomputation.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def whole(text: Column) -> Column:
    """Null texts count as empty ones."""
    return F.coalesce(text.cast("string"), F.lit(""))


def row_key(doc_id: Column, text: Column) -> Column:
    """Strong digest of id and whole text: rows that share it are one row repeated."""
    named = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.sha2(F.concat_ws("|", named, whole(text)).cast("binary"), 256)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.select(*columns) if columns else table


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``links`` (a, b): the smallest node that can be reached.

    Alternates two steps until nothing changes: every node sends its larger
    neighbours to its smallest one, then its smaller neighbours to the
    smallest of them. A hub is only ever a minimum (partial sums) and one side
    of a join that Spark can split, never a collected group. Each round is
    written to the shared folder. Null ends and loops are ignored.
    """
    a, b = F.col("a"), F.col("b")
    edges = staged(
        links.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "links",
    )
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(F.struct(a.alias("a"), F.col("m").alias("b")), F.struct(b.alias("a"), F.col("m").alias("b")))
            ).alias("e")
        )
        after = staged(small.select("e.*").where(a != b).distinct(), "links")
        now = _mark(after)
        discard(edges)
        edges = after
        if now == seen:
            break
        seen = now
    stars = edges.select(a.alias("node"), b.alias("component"))
    return stars.unionByName(edges.select(b.alias("node"), b.alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    """Number and combined hash of distinct edges: two numbers reach the driver."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
