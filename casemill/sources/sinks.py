"""Writers: the relational products, and one file for each document."""

from __future__ import annotations

import hashlib
import os
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.operators import cases


def write_documents(documents: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    documents.write.mode("overwrite").partitionBy(*(partitions or [])).parquet(path)


def write_manifest(rows: DataFrame, path: str, order: list[str]) -> None:
    """A CSV manifest with header, in files whose names keep the order."""
    rows.orderBy(*order).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A one-row table as a JSON document."""
    metrics.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def append_snapshot(rows: DataFrame, path: str, snapshot_id: str) -> None:
    rows.withColumn("snapshot_id", F.lit(snapshot_id)).write.mode("append").partitionBy("snapshot_id").parquet(path)


def create_snapshot(rows: DataFrame, inventory: str, headers: str, scope_id: str, at: datetime, source: str = "inventory") -> str:
    """Appends a full delivery of a scope: its rows, and then a header row. Returns its id, which scope and time determine."""
    time = at.isoformat()
    snapshot_id = hashlib.sha256(f"{scope_id}_{time}".encode()).hexdigest()[:16]
    append_snapshot(rows, inventory, snapshot_id)
    n = rows.sparkSession.read.parquet(inventory).where(F.col("snapshot_id") == snapshot_id).count()
    header = rows.sparkSession.createDataFrame(
        [(snapshot_id, scope_id, time, n, source)], "snapshot_id string, scope_id string, timestamp string, total_cases int, source string"
    )
    header.write.mode("append").parquet(headers)
    return snapshot_id


def append_new(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Appends one row for each key that the table doesn't have: artifacts, extractions, canonical texts by their ids."""
    spark = rows.sparkSession
    try:
        known = spark.read.parquet(path).select(*keys)
    except AnalysisException:  # no table yet
        known = rows.select(*keys).limit(0)
    cases.not_yet_known(rows, known, keys).select(*rows.columns).write.mode("append").parquet(path)


def export_files(documents: DataFrame, folder: str, name: str = "rel_path", text: str = "document") -> None:
    """Writes each row to a file of its own below a folder that all workers share."""

    def write(rows) -> None:
        for row in rows:
            target = os.path.join(folder, row[name])
            os.makedirs(os.path.dirname(target), exist_ok=True)
            part = f"{target}.part-{os.getpid()}"
            with open(part, "w", encoding="utf-8", newline="\n") as f:
                f.write(row[text])
            os.replace(part, target)  # a task that runs again leaves whole files

    documents.select(name, text).foreachPartition(write)
