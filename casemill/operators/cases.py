"""Pages to cases, versions to the latest, and the comparison of two deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.text import content_hash, page_number, without_page_suffix


def assemble_cases(pages: DataFrame, page_id: str = "page_id", content: str = "content") -> DataFrame:
    """(case_id, content, page_count, content_length, hash): the pages of each case, joined in order of number.

    Empty and NULL pages count as pages but add no text; a case of such pages has the
    empty text. Pages of one number keep the order of their ids.
    """
    ordered = F.array_sort(F.collect_list(F.struct(page_number(F.col(page_id)).alias("n"), F.col(page_id).alias("id"), F.col(content).alias("text"))))
    texts = F.filter(F.transform("pages", lambda p: p["text"]), lambda t: t.isNotNull() & (t != ""))
    return (
        pages.groupBy(without_page_suffix(F.col(page_id)).alias("case_id"))
        .agg(ordered.alias("pages"))
        .select("case_id", F.array_join(texts, "\n\n").alias("content"), F.size("pages").alias("page_count"))
        .select("case_id", "content", "page_count", F.length("content").alias("content_length"), content_hash(F.col("content")).alias("hash"))
    )


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def compare(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, status): new, changed, unchanged or deleted; two missing values are equal."""
    b = before.select(*keys, F.col(value).alias("_old"), F.lit(1).alias("_b"))
    a = after.select(*keys, F.col(value).alias("_new"), F.lit(1).alias("_a"))
    status = (
        F.when(F.col("_b").isNull(), "new")
        .when(F.col("_a").isNull(), "deleted")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("changed")
    )
    return b.join(a, keys, "full_outer").select(*keys, status.alias("status"))


def not_yet_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key that ``known`` doesn't have."""
    return rows.dropDuplicates(keys).join(known, keys, "left_anti")
