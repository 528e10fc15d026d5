"""Reproducible samples: the order of rows and partitions never matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.session import materialise, task_slots


def hash_order(seed: str, key: Column) -> Column:
    """A fixed random order: the first eight hex digits of SHA-256 over seed and key."""
    return F.substring(F.sha2(F.concat(F.lit(seed), key), 256), 1, 8)


def stratified(rows: DataFrame, strata: list[str], key: str, per_stratum: int, seed: str) -> DataFrame:
    """``per_stratum`` rows of each stratum, with their rank rn.

    The rank is cut by a constant, so that every task keeps only its own best rows of
    a stratum before the shuffle, however large the stratum is.
    """
    w = Window.partitionBy(*strata).orderBy(hash_order(seed, F.col(key)), key)
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= per_stratum)


def proportional(rows: DataFrame, stratum: str, key: str, limit: int, seed: str) -> DataFrame:
    """``limit`` rows: as many of each stratum, strata in the order of their first key, cut at ``limit``."""
    strata = max(1, rows.select(stratum).distinct().count())
    first = rows.groupBy(stratum).agg(F.min(key).alias("_first"))
    taken = stratified(rows, [stratum], key, -(-limit // strata), seed).join(first, stratum)
    return taken.orderBy("_first", "rn").limit(limit).drop("_first")


def numbered(rows: DataFrame, group: str, key: str, name: str = "n") -> DataFrame:
    """The rows with their number in the order of ``key`` within their group, from 1.

    The rows are sorted by ranges of (group, key) and numbered within a range; how many
    rows of a group stand in the ranges before is added. So no task has more than a
    range, however large the group is. Equal keys are numbered in any order.
    """
    ranges = rows.repartitionByRange(task_slots(rows.sparkSession), group, key).withColumn("_range", F.spark_partition_id())
    ranges = materialise(ranges)
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(group).alias("_group"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    own = ranges.withColumn(name, F.row_number().over(Window.partitionBy("_range", group).orderBy(key)))
    joined = own.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_at")))
    return joined.select(*rows.columns, (F.col(name) + F.col("_before")).cast("int").alias(name))
