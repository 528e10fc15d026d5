"""Queries p2 to p10 and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import alignment, language, leaks, repeated_lines, scans, sentences, target_sample, tokens
from casemill.llm.records import distinct_records, site_of
from casemill.sources.tables import row_digest, spread, table


def _line_tables(rows: DataFrame, delta: Column, deltas: list[str]) -> repeated_lines.LineTables:
    """The rows' repeated lines after all ``deltas``, which come in one after the other.

    The texts are read once: their lines' keys are staged by delta.
    """
    tables = repeated_lines.LineTables.new(rows.sparkSession)
    keyed = repeated_lines.keyed_records(rows, site_of(F.col("source_name"), F.col("tribunal")), delta)
    keyed.write.partitionBy("delta").parquet(f"{tables.folder}/staged")
    staged = rows.sparkSession.read.schema(keyed.schema).parquet(f"{tables.folder}/staged")
    for own in deltas:
        tables.add(staged.where(F.col("delta") == own).drop("delta"))
    return tables


def _by_period(rows: DataFrame) -> repeated_lines.LineTables:
    """Records come in by the century of their date; those without a readable one come first."""
    century = F.when(F.col("publication_date").rlike(r"^(19|20)\d\d"), F.substring("publication_date", 1, 2)).otherwise("none")
    return _line_tables(rows, century, ["none", "19", "20"])


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct rows with their number of tokens: counted first, so that digests are shuffled in the place of texts."""
    rows = spread(table(spark, sf, "case_records"), waves=3)
    clean = {c: F.lower(F.trim(c)) for c in ("source_name", "language", "tribunal")}
    keyed = rows.select("id", *(v.alias(c) for c, v in clean.items()), "content", *row_digest(rows))
    return tokens.token_counts(keyed).distinct().drop("_row_a", "_row_b")


def p2_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens and tokens per record of every slice of case_records."""
    return tokens.token_budget(_counted(spark, sf), ["source_name", "language", "tribunal"])


def p2_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of each record."""
    return _counted(spark, sf)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Lines repeated excessively on their site: the records come in by period, each a delta to the state."""
    rows = table(spark, sf, "case_records")
    return _by_period(rows).found().select("id", "line_no")


def p3_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Each record without its site's repeated lines."""
    rows = table(spark, sf, "case_records")
    clean = repeated_lines.without_lines(rows, _by_period(rows).found())
    return clean.select("id", site_of(F.col("source_name"), F.col("tribunal")).alias("site"), "content")


def p3_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Records dated 2015 or later come in as a delta: the older ones that are built again for it, and their new text."""
    rows = table(spark, sf, "case_records")
    late = F.coalesce(F.substring("publication_date", 1, 4) >= "2015", F.lit(False))
    tables = _line_tables(rows, F.when(late, "late").otherwise("old"), ["old", "late"])
    rebuilt = repeated_lines.without_lines(rows, tables.found(), tables.rebuilt())
    return rebuilt.select("id", site_of(F.col("source_name"), F.col("tribunal")).alias("site"), "content")


def _target_sample(spark: SparkSession, sf: str) -> target_sample.TargetSample:
    records = distinct_records(table(spark, sf, "case_records"), "id", "tribunal", "language", "publication_date")
    return target_sample.target_sample(records, table(spark, sf, "sample_targets"), records.count() // 10)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Target cells of which the sample has fewer records than needed."""
    return _target_sample(spark, sf).report.where("gap > 0").select("target_id")


def p4_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The sample: (target_id, id)."""
    return _target_sample(spark, sf).sample.select("target_id", "id")


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    """What each target cell has, needs and got."""
    return _target_sample(spark, sf).report.select("target_id", "available", "needed", "gap")


def p4_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the sample keeps each cell's minimum as far as there are records, and its size."""
    made = _target_sample(spark, sf)
    drawn = made.sample.groupBy("target_id").agg(F.count(F.lit(1)).alias("drawn"))
    rows = made.report.select("target_id", "available", "needed").join(drawn, "target_id", "left").fillna(0, ["drawn"])
    return rows.select("target_id", "available", (F.col("drawn") >= F.least("needed", "available")).alias("kept"), (F.col("drawn") <= F.col("available")).alias("once"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of English and French versions of a decision that translate each other."""
    return alignment.aligned_lines(distinct_records(table(spark, sf, "case_records"), "id", "content", "tribunal", "citation"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of scans that are furniture, cut a word or are misread."""
    return scans.flawed_lines(scans.repair(distinct_records(table(spark, sf, "case_records"), "id", "content")))


def p6_text(spark: SparkSession, sf: str) -> DataFrame:
    """The scans' text as continuous paragraphs."""
    return scans.repaired_text(scans.repair(distinct_records(table(spark, sf, "case_records"), "id", "content")))


def _languages(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "case_records").select("id", "language", "content")
    labelled = rows.select(F.col("content").alias("text"), F.col("language").alias("label")).unionByName(
        table(spark, sf, "documents").select("text", F.col("lang").alias("label"))
    )
    model = language.train(language.training_sample(labelled))
    return language.record_languages(spread(rows, waves=3), model, label="language")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose label is missing or wrong, and the stretches of mixed records."""
    return language.mislabelled(_languages(spark, sf))


def p7_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Every record's language, or stretches, with a confidence."""
    return _languages(spark, sf).drop("said").distinct()


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document by byte_bpe_50k."""
    return tokens.encode_corpus(spread(table(spark, sf, "documents").select("doc_id", "text")))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold at least half of an evaluation item."""
    return leaks.leaked_items(spread(table(spark, sf, "documents").select("doc_id", "text")), table(spark, sf, "eval_items")).distinct()


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """Sentence units of every document."""
    return sentences.split_corpus(spread(table(spark, sf, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_budget": p2_budget,
    "p2_tokens": p2_tokens,
    "p3_found": p3_found,
    "p3_clean": p3_clean,
    "p3_delta": p3_delta,
    "p4_found": p4_found,
    "p4_sample": p4_sample,
    "p4_report": p4_report,
    "p4_cells": p4_cells,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_text": p6_text,
    "p7_found": p7_found,
    "p7_languages": p7_languages,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p10_found": p10_found,
}



def _lines(p: str = "", where: str = "") -> str:
    return rf"""
{p}s AS (SELECT id, content, coalesce(lower(trim(source_name)), lower(tribunal)) AS site FROM r {where}),
{p}l AS (SELECT id, site, CAST(i AS INTEGER) AS line_no, regexp_replace(lower(x), '[^\p{{L}}]', '', 'g') AS k
      FROM (SELECT id, site, unnest(string_split(content, chr(10))) AS x,
                   unnest(range(1, len(string_split(content, chr(10))) + 1)) AS i FROM {p}s WHERE content IS NOT NULL)),
{p}c AS (SELECT site, k, count(DISTINCT id) AS n FROM {p}l WHERE length(k) >= 25 GROUP BY ALL),
{p}z AS (SELECT site, count(*) AS total FROM {p}s GROUP BY ALL),
{p}hot AS (SELECT site, k FROM {p}c JOIN {p}z USING (site) WHERE n >= 3 AND n >= round(0.03 * total, 9))
"""


_LINES = "WITH r AS (SELECT DISTINCT * FROM case_records)," + _lines()
_KEPT = r""", kept AS (SELECT id, site, string_agg(x, chr(10) ORDER BY i) AS content FROM (
        SELECT s.id, s.site, unnest(string_split(content, chr(10))) AS x,
               unnest(range(1, len(string_split(content, chr(10))) + 1)) AS i FROM s WHERE content IS NOT NULL)
        WHERE (site, regexp_replace(lower(x), '[^\p{L}]', '', 'g')) NOT IN (SELECT site, k FROM hot) GROUP BY ALL)
"""
_CLEAN = "SELECT s.id, s.site, CASE WHEN s.content IS NULL THEN NULL ELSE coalesce(kept.content, '') END AS content FROM s LEFT JOIN kept USING (id)"
_CELLS = """
WITH r AS (SELECT DISTINCT * FROM case_records),
x AS (SELECT lower(tribunal) AS t, substr(lower(trim(language)), 1, 2) AS l,
             CASE WHEN regexp_full_match(substr(publication_date, 1, 4), '[0-9]{4}')
                  THEN CAST(substr(publication_date, 1, 4) AS INTEGER) END AS y FROM r),
c AS (SELECT g.target_id, count(x.t) AS available, any_value(g.min_rows) AS min_rows, any_value(g.target_share) AS share
      FROM sample_targets g LEFT JOIN x ON x.t = g.tribunal AND x.l = g.language AND x.y BETWEEN g.year_from AND g.year_to
      GROUP BY g.target_id),
d AS (SELECT target_id, available,
             CAST(ceil(round(greatest(min_rows, share * ((SELECT count(*) FROM r) // 10)), 6)) AS BIGINT) AS needed FROM c)
"""

SQL: dict[str, str] = {
    "p3_found": _LINES + "SELECT id, line_no FROM l JOIN hot USING (site, k)",
    "p3_clean": _LINES + _KEPT + _CLEAN,
    "p3_delta": _LINES + "," + _lines("o", "WHERE NOT coalesce(substr(publication_date, 1, 4) >= '2015', false)") + _KEPT
    + """, crossed AS ((SELECT site, k FROM hot EXCEPT SELECT site, k FROM ohot) UNION ALL (SELECT site, k FROM ohot EXCEPT SELECT site, k FROM hot))
       """ + _CLEAN + " WHERE s.id IN (SELECT id FROM ol JOIN crossed USING (site, k))",
    "p4_found": _CELLS + "SELECT target_id FROM d WHERE available < needed",
    "p4_cells": _CELLS + "SELECT target_id, available, true AS kept, true AS once FROM d",
    "p4_report": _CELLS + "SELECT target_id, available, needed, greatest(0, needed - available) AS gap FROM d",
}
