"""What changed between consecutive full deliveries of a table.

The rows of every delivery are reduced to one per key, range-partitioned by
(scope, key) and sorted by delivery inside each range.  One pass over a sorted
range is then the merge of all consecutive deliveries at once: a key's row and
the row before it are the two pointers, and a gap in the delivery numbers is an
absence.  Nothing but the compared columns is shuffled, and the state of the
merge is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.session import task_slots


def utc_instant(text: Column) -> Column:
    """ISO text to a timestamp; text without a zone is UTC; NULL when unreadable."""
    t = F.trim(text)
    zoned = F.when(t.rlike(r"(?i)(z|[+-]\d{2}:?\d{2})$"), t).otherwise(F.concat(t, F.lit("Z")))
    return zoned.try_cast("timestamp")


def clean_key(text: Column) -> Column:
    """A key without outer blanks, in lower case; blank counts as missing."""
    return F.nullif(F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")), F.lit(""))


def delivery_order(headers: DataFrame, inventory: DataFrame) -> DataFrame:
    """(scope_id, snapshot_id, seq, last_seq): the deliveries of a scope in order of time.

    Headers without inventory rows, or without a readable time, don't count. A
    header delivered twice counts once, at its earliest time.
    """
    present = inventory.select("snapshot_id").distinct()
    known = (
        headers.select("snapshot_id", "scope_id", utc_instant(F.col("timestamp")).alias("at"))
        .where("at IS NOT NULL AND scope_id IS NOT NULL")
        .groupBy("snapshot_id")
        .agg(F.min(F.struct("at", "scope_id")).alias("h"))
        .select("snapshot_id", "h.scope_id", "h.at")
        .join(present, "snapshot_id", "left_semi")
    )
    scope = Window.partitionBy("scope_id")
    return known.select(
        "scope_id",
        "snapshot_id",
        F.row_number().over(scope.orderBy("at", "snapshot_id")).alias("seq"),
        F.count(F.lit(1)).over(scope).cast("int").alias("last_seq"),
    )


def latest_per_key(inventory: DataFrame) -> DataFrame:
    """(snapshot_id, case_id, content_hash): of several rows for one key the latest.

    Rows discovered at the same time are told apart by the greater hash, so that the
    result doesn't depend on the order of rows. An unreadable time is the earliest.
    """
    return (
        inventory.select(
            "snapshot_id",
            clean_key(F.col("case_id")).alias("case_id"),
            F.struct(
                utc_instant(F.col("discovered_at")).alias("at"), clean_key(F.col("content_hash")).alias("content_hash")
            ).alias("v"),
        )
        .where("snapshot_id IS NOT NULL AND case_id IS NOT NULL")
        .groupBy("snapshot_id", "case_id")
        .agg(F.max("v").alias("v"))
        .select("snapshot_id", "case_id", "v.content_hash")
    )


def snapshot_changes(inventory: DataFrame, headers: DataFrame, partitions: int | None = None) -> DataFrame:
    """(snapshot_id, case_id, change_type) of each delivery against the one before.

    change_type is added, removed or changed; snapshot_id is the later delivery. Two
    missing hashes are equal, a missing and a present one differ. The first delivery
    of a scope gives no rows; an empty inventory gives none. Rows with a NULL or blank
    case_id, rows without a header and columns besides those named are left alone.
    """
    order = delivery_order(headers, inventory)
    n = partitions or task_slots(inventory.sparkSession)
    ranges = (
        latest_per_key(inventory)
        .join(order, "snapshot_id")
        .select("scope_id", "case_id", "seq", "last_seq", "content_hash")
        .repartitionByRange(n, "scope_id", "case_id")
        .sortWithinPartitions("scope_id", "case_id", "seq")
    )
    key = Window.partitionBy("scope_id", "case_id").orderBy("seq")
    merged = ranges.select(
        "scope_id",
        "case_id",
        "seq",
        "last_seq",
        "content_hash",
        F.lag("seq").over(key).alias("before"),
        F.lag("content_hash").over(key).alias("hash_before"),
        F.lead("seq").over(key).alias("after"),
    )
    adjacent = F.col("before") == F.col("seq") - 1
    arrived = F.when(
        adjacent & ~F.col("content_hash").eqNullSafe(F.col("hash_before")),
        F.struct(F.col("seq"), F.lit("changed").alias("change_type")),
    ).when((F.col("seq") > 1) & ~F.coalesce(adjacent, F.lit(False)), F.struct("seq", F.lit("added").alias("change_type")))
    left = F.when(
        (F.col("seq") < F.col("last_seq")) & (F.coalesce("after", F.lit(0)) != F.col("seq") + 1),
        F.struct((F.col("seq") + 1).alias("seq"), F.lit("removed").alias("change_type")),
    )
    return (
        merged.select("scope_id", "case_id", F.inline(F.array_compact(F.array(arrived, left))))
        .join(order.select("scope_id", "seq", "snapshot_id"), ["scope_id", "seq"])
        .select("snapshot_id", "case_id", "change_type")
    )


def change_totals(changes: DataFrame) -> DataFrame:
    """(snapshot_id, change_type, n): how many keys each delivery added, removed, changed."""
    return changes.groupBy("snapshot_id", "change_type").agg(F.count(F.lit(1)).alias("n"))
