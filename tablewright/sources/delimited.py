"""Delimited text in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """Header row, typed by the given schema; empty cells are null."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return read_csv(spark, path, schema, sep="\t")


def read_csv_renamed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The file's own header line is skipped and the schema's names are used instead."""
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    )


def read_numeric(spark: SparkSession, path: str, names: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """Numeric matrix: missing or unparsable cells become ``fill`` (null when None)."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(schema).option("header", True).csv(path)
    out = raw.select(*[F.col(n).try_cast("double").alias(n) for n in names])
    return out if fill is None else out.na.fill(fill)


def read_labelled_rows(
    spark: SparkSession, path: str, width: int, labelled: bool = True, key: str | None = None
) -> DataFrame:
    """First column a 1-based class, then ``width`` features as array<float>."""
    lead = ([key] if key else []) + (["label"] if labelled else [])
    fields = [T.StructField(n, T.LongType()) for n in lead]
    fields += [T.StructField(f"f{i}", T.FloatType()) for i in range(width)]
    raw = spark.read.schema(T.StructType(fields)).option("header", True).csv(path)
    return raw.select(*lead, F.array(*[F.col(f"f{i}") for i in range(width)]).alias("features"))


def write_predictions(
    df: DataFrame, path: str, id_col: str, cols: Sequence[str], header: bool = True,
    gzip: bool = False, single_file: bool = False,
) -> None:
    """CSV sorted by id. Many files in id order unless a single one is asked for."""
    out = df.select(*cols)
    out = out.coalesce(1).sortWithinPartitions(id_col) if single_file else out.sort(id_col)
    writer = out.write.mode("errorifexists").option("header", header)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def format_rows(formats: Mapping[str, str], sep: str = ",") -> Column:
    """One text line per row from per-column printf formats."""
    return F.concat_ws(sep, *[F.format_string(fmt, F.col(c)) for c, fmt in formats.items()])
