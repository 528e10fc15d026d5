"""Texts as numbered, self-describing chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.functions.text import chunk_cuts, marker, once


def chunk_table(documents: DataFrame, key: str, text: str, every: int = 1500, back: int = 100) -> DataFrame:
    """(key, counter, start, end, chunk): consecutive chunks that together are the text; NULL and empty texts have none."""
    whole = F.col(text)

    def cut(bounds: Column) -> Column:
        def part(a: Column, i: Column) -> Column:
            end = F.element_at(bounds, i + 2)
            return F.struct(i.alias("counter"), a.alias("start"), end.alias("end"), F.substring(whole, a + 1, end - a).alias("chunk"))

        return F.transform(F.slice(bounds, 1, F.size(bounds) - 1), part)

    ends = F.concat(F.array(F.lit(0)), chunk_cuts(whole, every, back), F.array(F.length(whole)))
    return documents.where(F.length(text) > 0).select(key, F.inline(once(ends, cut)))


def marked_text(tag: str = "DOC", every: int = 1500, back: int = 100) -> Column:
    """The content of a case record with a marker before each chunk and one at the end; NULL for a text without chunks."""
    fields = ["language", "tribunal", "tribunal_rank", "publication_date", "citation", "file_stem"]
    content = F.col("content")
    cuts = chunk_cuts(content, every, back)
    # one array of bounds, so that the cuts are computed once
    ends = F.concat(F.array(F.lit(0)), cuts, F.array(F.length(content)))

    def head(i: Column) -> Column:
        return marker(tag, i, *(F.col(f) for f in fields))

    def assemble(bounds: Column) -> Column:
        starts = F.slice(bounds, 1, F.size(bounds) - 1)
        parts = F.transform(starts, lambda a, i: F.concat(head(i), F.lit("\n\n"), F.substring(content, a + 1, F.element_at(bounds, i + 2) - a)))
        return F.concat(F.array_join(parts, "\n\n"), F.lit("\n"), head(F.size(starts)))

    return once(ends, assemble)


def marked_documents(cases: DataFrame, tag: str = "DOC", every: int = 1500, back: int = 100) -> DataFrame:
    """(id, document): the content of case records with a marker before each chunk and one at the end."""
    return cases.where(F.length("content") > 0).select("id", marked_text(tag, every, back).alias("document"))
