"""Readers of the Parquet tables a query runs over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, waves: int = 1) -> DataFrame:
    """The rows over at least ``waves`` partitions for each core, before work that is heavy for its bytes.

    A table of many files comes in enough partitions and is left as it is; one small
    file, or a few row groups of uneven size, would keep some cores busy alone.
    """
    n = waves * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(n) if rows.rdd.getNumPartitions() < n else rows


def row_digest(rows: DataFrame) -> list[Column]:
    """_row_a and _row_b: a 128-bit digest of a whole row, which tells rows apart in the place of their texts."""
    columns = [F.to_json(c) if kind.startswith("map") else F.col(c) for c, kind in rows.dtypes]
    # a hash passes NULLs over, so which columns are NULL is part of it
    columns.append(F.concat(*(F.isnull(c).cast("int").cast("string") for c in rows.columns)))
    return [F.xxhash64(*columns).alias("_row_a"), F.xxhash64(F.lit(1), *columns).alias("_row_b")]


def distinct_rows(rows: DataFrame, *made: Column) -> DataFrame:
    """``made`` for each distinct row of ``rows``: computed first, so that only it and a digest of the row are shuffled."""
    rows = spread(rows)
    return rows.select(*made, *row_digest(rows)).dropDuplicates(["_row_a", "_row_b"]).drop("_row_a", "_row_b")


def read_artifact(extractions: DataFrame, artifact_id: str, folder: str, path: str = "text_blob_path") -> DataFrame:
    """(artifact_id, path, content BINARY): an extraction's file below ``folder``, found by its id; no row without one."""
    found = extractions.where(F.col("artifact_id") == artifact_id).select(path).limit(1).collect()
    files = extractions.sparkSession.read.format("binaryFile").load(f"{folder}/{found[0][0]}") if found else None
    if files is None:
        return extractions.sparkSession.createDataFrame([], "artifact_id string, path string, content binary")
    return files.select(F.lit(artifact_id).alias("artifact_id"), "path", "content")
