"""Binary files and stage tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_files(spark: SparkSession, folder: str, ext: str, content: bool = False) -> DataFrame:
    """Regular files with one extension; the key is the file name without it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ext}").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    cols = [F.substring_index(name, f".{ext}", 1).alias("key"), name.alias("file"), "length"]
    return files.select(*cols, *(["content"] if content else []))


def decode_pcm16be(df: DataFrame, key: str, content: str) -> DataFrame:
    """Raw big-endian signed 16-bit samples to array<double>."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            samples = [np.frombuffer(b, ">i2").astype("float64") for b in pdf[content]]
            yield pd.DataFrame({key: pdf[key], "samples": samples})

    return df.select(key, content).mapInPandas(decode, f"{key} bigint, samples array<double>")


def materialise_or_load(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read a finished stage table, or build and write it first."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def grid_lookup(grid: DataFrame, dt: int, fhour: int, ens: int) -> DataFrame:
    """One 2-D grid; on a table partitioned by date the filter prunes the files."""
    return grid.where((F.col("dt") == dt) & (F.col("fhour") == fhour) & (F.col("ens") == ens)).select(
        "lat", "lon", "value"
    )
