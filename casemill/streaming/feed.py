"""The change feed as a stream: deliveries come in as files, changes go out as they come."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from casemill.operators.cases import compare, latest
from casemill.operators.snapshots import clean_key, utc_instant

_LOG = "scope_id string, snapshot_id string, place int"


def stream_changes(spark: SparkSession, deliveries: str, headers: str, state: str, changes: str, checkpoint: str) -> StreamingQuery:
    """Compares each new delivery (a partition snapshot_id=... below ``deliveries``) with the one before of its scope.

    ``headers`` is a table of (snapshot_id, scope_id, timestamp). Deliveries that one
    batch brings together are worked on one after the other, in order of their time;
    a delivery is taken to come in one batch, and one without a header doesn't count.
    Below ``state`` are the keys of each delivery and, by batch, a log of which
    deliveries came: a batch that runs again reads the logs of earlier batches only,
    and overwrites its own results. Keys are clean as in snapshot_changes. Changes
    (scope_id, case_id, status) go out by snapshot_id; a scope's first delivery has none.
    """
    found = spark.read.parquet(deliveries).schema
    schema = StructType([f if f.name != "snapshot_id" else StructField("snapshot_id", StringType()) for f in found])
    source = spark.readStream.schema(schema).parquet(deliveries)

    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        own = batch.select("snapshot_id").distinct()
        heads = session.read.parquet(headers).select("snapshot_id", "scope_id", utc_instant(F.col("timestamp")).alias("at"))
        heads = heads.where("at IS NOT NULL AND scope_id IS NOT NULL").groupBy("snapshot_id").agg(F.min(F.struct("at", "scope_id")).alias("h"))
        order = own.join(heads, "snapshot_id").orderBy("h.at", "snapshot_id").select("h.scope_id", "snapshot_id").collect()
        try:
            log = session.read.schema(_LOG + ", batch int").parquet(f"{state}/log").where(F.col("batch") < number)
            last = {r["scope_id"]: r["s"]["snapshot_id"] for r in log.groupBy("scope_id").agg(F.max(F.struct("batch", "place", "snapshot_id")).alias("s")).collect()}
        except AnalysisException:  # nothing came yet
            last = {}
        for scope, snapshot in order:
            rows = batch.where(F.col("snapshot_id") == snapshot).select(
                clean_key(F.col("case_id")).alias("case_id"),
                clean_key(F.col("content_hash")).alias("content_hash"),
                utc_instant(F.col("discovered_at")).alias("at"),
            ).where("case_id IS NOT NULL")
            now = latest(rows, ["case_id"], F.desc("at"), F.desc_nulls_last("content_hash")).drop("at")
            now.write.mode("overwrite").parquet(f"{state}/keys/{snapshot}")
            if last.get(scope, snapshot) != snapshot:
                before, after = (session.read.parquet(f"{state}/keys/{s}") for s in (last[scope], snapshot))
                status = compare(before, after, ["case_id"], "content_hash").where("status <> 'unchanged'")
                status.select(F.lit(scope).alias("scope_id"), "case_id", "status").write.mode("overwrite").parquet(f"{changes}/snapshot_id={snapshot}")
            last[scope] = snapshot
        entries = [(scope, snapshot, k) for k, (scope, snapshot) in enumerate(order)]
        session.createDataFrame(entries, _LOG).write.mode("overwrite").parquet(f"{state}/log/batch={number}")

    return source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
