"""Shared views of the case_records table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_records(case_records: DataFrame, *columns: str) -> DataFrame:
    """The distinct rows of case_records, of which only ``columns`` are kept.

    Rows are told apart by all their columns, so that two records which differ in a
    column that isn't asked for stay two records. Without ``content`` among the
    columns asked for, its digest is shuffled in its place.
    """
    if columns and "content" not in columns:
        case_records = case_records.withColumn("content", F.md5(F.coalesce("content", F.lit("\0"))))
    # maps can't be compared; their JSON can
    maps = {c: F.to_json(c) for c, kind in case_records.dtypes if kind.startswith("map")}
    rows = case_records.withColumns(maps).distinct() if maps else case_records.distinct()
    return rows.select(*columns) if columns else rows


def site_of(source_name: Column, tribunal: Column) -> Column:
    """source_name, trimmed and in lower case, or tribunal where it is NULL."""
    return F.coalesce(F.lower(F.regexp_replace(source_name, r"(?U)^\s+|\s+\z", "")), F.lower(tribunal))
