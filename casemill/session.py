"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Points checkpoint() at the shared folder the cluster names.

    ``spark.checkpoint.dir`` wins when it is set; only a session of one machine may go
    without it, as in tests, and gets a folder of its own.
    """
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="casemill-ckpt-"))


def materialise(df: DataFrame) -> DataFrame:
    """Computes ``df`` once and cuts its lineage in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def task_slots(spark: SparkSession) -> int:
    """Partitions to aim at when a stage has to be spread by hand."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
