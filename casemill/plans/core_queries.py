"""Queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions import quality
from casemill.functions import text as T
from casemill.functions.wordlists import ENGLISH_SIGNS_LONG, FRENCH_SIGNS_LONG, LEXICON
from casemill.operators import cases, chunks, documents, keywords, retrieval, sampling, snapshots
from casemill.plans import corpus
from casemill.sources.tables import distinct_rows, spread, table

SEED = "casemill"


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Keys added, removed or changed by each delivery."""
    return snapshots.snapshot_changes(table(spark, sf, "case_inventory"), table(spark, sf, "snapshots"))


def p1_totals(spark: SparkSession, sf: str) -> DataFrame:
    """How many keys each delivery added, removed and changed."""
    return snapshots.change_totals(p1_found(spark, sf))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "case_records")


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    tribunal = T.tribunal_of(c("citation"), c("metadata_relpath"), c("pdf_link"))
    return _records(spark, sf).withColumn("body", tribunal)


def _year(c: str = "publication_date"):
    return F.substring(c, 1, 4)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


def page_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with enough content and a citation, of one year's prefix."""
    rows = _records(spark, sf).where("content IS NOT NULL AND length(content) >= 100 AND citation IS NOT NULL")
    return rows.where(F.col("publication_date").startswith("201")).select("id", "citation", "publication_date")


def page_blob_join(spark: SparkSession, sf: str) -> DataFrame:
    """Records with the size of their blob."""
    rows = _records(spark, sf).where("content IS NOT NULL AND length(content) >= 100 AND citation IS NOT NULL")
    blobs = table(spark, sf, "blobs").select(F.col("name").alias("blob_name"), F.col("length").alias("blob_length"))
    return rows.join(blobs, "blob_name").select("id", "blob_name", "blob_length")


def missing_blobs(spark: SparkSession, sf: str) -> DataFrame:
    """Blob names of records that blobs doesn't have."""
    known = table(spark, sf, "blobs").select(F.col("name").alias("blob_name"))
    return cases.not_yet_known(_records(spark, sf).select("blob_name"), known, ["blob_name"])


def extracted_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records that have an extraction."""
    done = table(spark, sf, "extractions").select(F.col("case_id").alias("id"))
    return _records(spark, sf).join(done, "id", "left_semi").select("id").distinct()


def case_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of documents as pages, put together to cases again; cases of at least 1000 characters."""
    docs = table(spark, sf, "documents").where("text IS NOT NULL")
    pages = docs.select("doc_id", F.posexplode(F.split("text", "\n\n")).alias("n", "content"))
    pages = pages.select(F.format_string("%d_pages_%d", "doc_id", F.col("n") + 1).alias("page_id"), "content")
    made = cases.assemble_cases(pages)
    return made.where("content_length >= 1000").select("case_id", "page_count", "content_length", "hash")


def stratified_tribunal(spark: SparkSession, sf: str) -> DataFrame:
    """Five records of each issuing body, in seeded order."""
    rows = _classified(spark, sf).select("id", "body").distinct()
    picked = sampling.stratified(rows, ["body"], "id", 5, SEED)
    return picked.select("id", "body", T.tribunal_rank(F.col("body")).alias("rank"), "rn")


def stratified_year(spark: SparkSession, sf: str) -> DataFrame:
    """Three records of each year."""
    rows = _records(spark, sf).select("id", F.coalesce(_year(), F.lit("unknown")).alias("year")).distinct()
    return sampling.stratified(rows, ["year"], "id", 3, SEED).select("id", "year", "rn")


def stratified_tribunal_year(spark: SparkSession, sf: str) -> DataFrame:
    """Two records of each issuing body and year."""
    rows = _classified(spark, sf).select("id", "body", F.coalesce(_year(), F.lit("unknown")).alias("year")).distinct()
    return sampling.stratified(rows, ["body", "year"], "id", 2, SEED).select("id", "body", "year", "rn")


def proportional_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A hundred records, as many of each issuing body as there are."""
    rows = _classified(spark, sf).select("metadata_relpath", "body").distinct()
    return sampling.proportional(rows, "body", "metadata_relpath", 100, SEED).select("metadata_relpath", "body", "rn")


def yearly_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Cases and rows by year, the thirty latest years."""
    rows = _records(spark, sf).where("publication_date IS NOT NULL AND publication_date <> ''")
    counted = rows.groupBy(_year().alias("year")).agg(F.countDistinct("id").alias("cases"), F.count(F.lit(1)).alias("n_rows"))
    return counted.orderBy(F.desc("year")).limit(30)


def source_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Cases and rows by source, the thirty largest."""
    rows = _records(spark, sf).groupBy("source_name").agg(F.countDistinct("id").alias("cases"), F.count(F.lit(1)).alias("n_rows"))
    return rows.orderBy(F.desc("cases"), F.asc_nulls_first("source_name")).limit(30)


def content_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, rows with content and with long content, by source, in one pass."""
    n = F.length("content")
    return table(spark, sf, "case_records").groupBy("source_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("content").isNotNull()).alias("with_content"),
        F.count_if(n > 1000).alias("long_content"),
    )


def corpus_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Least, greatest and floored mean length of texts by label; 0 where there is none."""
    n = F.length("text")
    return table(spark, sf, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.min(n), F.lit(0)).alias("min_length"),
        F.coalesce(F.max(n), F.lit(0)).alias("max_length"),
        F.coalesce(F.expr("sum(length(text)) div count(text)"), F.lit(0)).alias("avg_length"),
    )


def tribunal_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by issuing body."""
    return _classified(spark, sf).groupBy("body").agg(F.count(F.lit(1)).alias("n"))


def group_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by issuing body and year as one key."""
    key = F.concat_ws("_", "body", F.coalesce(_year(), F.lit("unknown")))
    return _classified(spark, sf).groupBy(key.alias("group_key")).agg(F.count(F.lit(1)).alias("n"))


def date_range(spark: SparkSession, sf: str) -> DataFrame:
    """First and last date as text, by tribunal."""
    rows = _records(spark, sf).where("publication_date IS NOT NULL AND publication_date <> ''")
    return rows.groupBy(F.lower("tribunal").alias("court")).agg(F.min("publication_date").alias("first"), F.max("publication_date").alias("last"))


def recent_years(spark: SparkSession, sf: str) -> DataFrame:
    """The ten latest years of the inventory."""
    rows = table(spark, sf, "case_inventory").where(_year("decision_date").rlike("^[0-9]{4}$"))
    return rows.groupBy(_year("decision_date").alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("year")).limit(10)


def content_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Hashes that more than one document has."""
    rows = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", T.content_hash(F.col("text")).alias("hash"))
    return rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


def latest_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The newest extraction of each case."""
    rows = table(spark, sf, "extractions").select("case_id", "artifact_id", "extraction_method", "extraction_timestamp")
    order = [F.desc("extraction_timestamp"), F.desc("artifact_id"), F.asc("extraction_method")]
    return cases.latest(rows, ["case_id"], *order)


def previous_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """For each snapshot the latest other one of its scope, by the text of its time."""
    from pyspark.sql import Window

    heads = table(spark, sf, "snapshots").select("snapshot_id", "scope_id", "timestamp").distinct()
    w = Window.partitionBy("scope_id").orderBy(F.desc("timestamp"), F.desc("snapshot_id"))
    ranked = heads.withColumn("r", F.row_number().over(w))
    best = ranked.where("r <= 2").groupBy("scope_id").agg(
        F.max(F.when(F.col("r") == 1, F.col("snapshot_id"))).alias("one"), F.max(F.when(F.col("r") == 2, F.col("snapshot_id"))).alias("two")
    )
    return ranked.join(best, "scope_id").select("snapshot_id", F.when(F.col("r") == 1, F.col("two")).otherwise(F.col("one")).alias("previous_id"))


def last_delivery_status(spark: SparkSession, sf: str) -> DataFrame:
    """Of the last two deliveries of each scope, how many keys are new, changed, unchanged and deleted."""
    inventory = table(spark, sf, "case_inventory")
    order = snapshots.delivery_order(table(spark, sf, "snapshots"), inventory)
    rows = snapshots.latest_per_key(inventory).join(order, "snapshot_id")
    keys = ["scope_id", "case_id"]
    found = cases.compare(rows.where("seq = last_seq - 1"), rows.where("seq = last_seq"), keys, "content_hash")
    return found.groupBy("scope_id", "status").agg(F.count(F.lit(1)).alias("n"))


def extraction_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Runs, characters and cases by method, and of all."""
    rows = table(spark, sf, "extractions").rollup("extraction_method").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("char_count").alias("chars"), F.countDistinct("case_id").alias("cases"), F.grouping("extraction_method").alias("g")
    )
    return rows.select(F.when(F.col("g") == 1, "all").otherwise(F.col("extraction_method")).alias("method"), "runs", "chars", "cases")


def quality_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Mean quality by method, by language, and of all, in one pass."""
    rows = table(spark, sf, "extractions")
    rows.createOrReplaceTempView("_extraction_runs")
    return spark.sql(
        """SELECT CAST(grouping_id(extraction_method, language) AS BIGINT) AS level, extraction_method, language,
                  count(*) AS runs, round(avg(quality_score), 6) AS mean_quality
           FROM _extraction_runs GROUP BY GROUPING SETS ((extraction_method), (language), ())"""
    )


def flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many extractions pass each flag of their map."""
    rows = table(spark, sf, "extractions").select(F.explode("quality_flags").alias("flag", "passed"))
    return rows.groupBy("flag").agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Share of records with an extraction, by tribunal."""
    done = table(spark, sf, "extractions").select(F.col("case_id").alias("id")).distinct().withColumn("has", F.lit(1))
    rows = _records(spark, sf).select("id", F.lower("tribunal").alias("court")).distinct().join(done, "id", "left")
    return rows.groupBy("court").agg(F.count(F.lit(1)).alias("n_cases"), F.round(F.count("has") / F.count(F.lit(1)), 6).alias("covered"))


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Days from decision to ingestion, by source: least and greatest."""
    days = F.date_diff(F.to_date("ingested_at"), F.try_to_timestamp("decision_date", F.lit("yyyy-MM-dd")).cast("date"))
    rows = table(spark, sf, "documents").where(F.col("decision_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")).select("source", days.alias("days"))
    return rows.groupBy("source").agg(F.min("days").alias("least"), F.max("days").alias("most"), F.count("days").alias("n"))


def record_search(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty first records of a search by court, language and period, by rank and date."""
    rows = _records(spark, sf).where("lower(tribunal) IN ('scc', 'fca') AND lower(language) = 'en' AND publication_date BETWEEN '2005' AND '2020'")
    return rows.select("id", "tribunal_rank", "publication_date").distinct().orderBy(F.asc("tribunal_rank"), F.desc("publication_date"), "id").limit(20)


def record_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names derived from paths, citations and dates."""
    c = F.col
    return distinct_rows(
        _records(spark, sf),
        c("id"),
        T.file_stem(c("metadata_relpath")).alias("stem"),
        T.path_language(c("metadata_relpath")).alias("path_lang"),
        T.case_key(c("citation"), c("file_stem"), c("id")).alias("case_key"),
        T.compact_date(c("publication_date")).alias("day"),
        T.slug(c("source_name")).alias("source_slug"),
    )


def page_bases(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by what stands before the first _pages_ of their ids."""
    return _pages(spark, sf).groupBy(T.before_pages(F.col("page_id")).alias("base")).agg(F.count(F.lit(1)).alias("n_pages"))


def link_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Case numbers from links or paths."""
    made = T.link_id(F.col("pdf_link"), F.col("metadata_relpath"))
    return distinct_rows(_records(spark, sf), F.col("id"), made.alias("number"))


def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Export names by source and year; a name that occurs again gets _v2, _v3 and so on."""
    base = F.concat_ws("_", T.slug(F.col("source_name")), F.coalesce(_year(), F.lit("unknown")))
    rows = sampling.numbered(_records(spark, sf).select("id", base.alias("base")).distinct(), "base", "id")
    return rows.select("id", _versioned("base", ".txt").alias("file_name"))


def _versioned(base: str, suffix: str):
    return F.concat(base, F.when(F.col("n") > 1, F.concat(F.lit("_v"), "n")).otherwise(""), F.lit(suffix))


def export_names(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic export names by language, rank, date, case and document; one that occurs again gets _v2, _v3 and so on."""
    c = F.col
    base = T.export_name(c("language"), c("tribunal"), c("tribunal_rank"), c("publication_date"), c("citation"), c("file_stem"), c("id"))
    rows = sampling.numbered(_records(spark, sf).select("id", base.alias("base")).distinct(), "base", "id")
    return rows.select("id", _versioned("base", ".ecl.txt").alias("file_name"))


def inventory_slugs(spark: SparkSession, sf: str) -> DataFrame:
    """Slugs of titles and how many rows have them."""
    rows = table(spark, sf, "case_inventory").select(T.slug(F.col("title"), 30).alias("slug"))
    return rows.groupBy("slug").agg(F.count(F.lit(1)).alias("n"))


def sentence_truncation(spark: SparkSession, sf: str) -> DataFrame:
    """Texts cut at a sentence within 900 characters."""
    docs = _documents(spark, sf).where("text IS NOT NULL").select("doc_id", T.truncate_on_sentence(F.col("text"), 900).alias("t"))
    return docs.select("doc_id", F.length("t").alias("n"), F.md5("t").alias("digest"))


def discovery_anchor(spark: SparkSession, sf: str) -> DataFrame:
    """A clean opening of each document."""
    return _documents(spark, sf).where("text IS NOT NULL").select("doc_id", T.anchor(F.col("text")).alias("anchor"))


def top_terms(spark: SparkSession, sf: str) -> DataFrame:
    """The seven most frequent words of each document, ties in order of their first place."""
    docs = _documents(spark, sf).select("doc_id", F.posexplode(keywords.top_words(F.col("text"))).alias("pos", "t"))
    return docs.select("doc_id", "t.word", "t.n", (F.col("pos") + 1).alias("place"))


def document_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted keywords of each document."""
    return _documents(spark, sf).where("text IS NOT NULL").select("doc_id", keywords.keywords_of(F.col("text")).alias("keywords"))


def phrase_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How often each phrase of the lexicon stands in each document that has it."""
    lower = _documents(spark, sf).where("text IS NOT NULL").select("doc_id", F.lower("text").alias("t"))
    found = F.array(*(F.struct(F.lit(p).alias("phrase"), T.count_of(F.col("t"), p).alias("n")) for p in LEXICON if " " in p))
    return lower.select("doc_id", F.inline(found)).where("n > 0")


def statute_references(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct statute references by document."""
    from casemill.functions.wordlists import STATUTE_PATTERNS

    docs = _documents(spark, sf).where("text IS NOT NULL").select("doc_id", T.matches(F.col("text"), STATUTE_PATTERNS).alias("refs"))
    return docs.select("doc_id", F.size("refs").alias("n_refs"), F.array_join(F.array_sort("refs"), "|").alias("refs"))


def document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of about 1500 characters."""
    made = chunks.chunk_table(_documents(spark, sf), "doc_id", "text")
    return made.select("doc_id", "counter", "start", "end", F.md5("chunk").alias("digest"))


def marked_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records with their markers."""
    rows = _records(spark, sf).where(F.length("content") > 0)
    return distinct_rows(rows, F.col("id"), chunks.marked_text().alias("document"))


def quality_gates(spark: SparkSession, sf: str) -> DataFrame:
    """Gates and score of each record's content."""
    made = quality.gates(F.col("content"), F.col("page_count"))
    return distinct_rows(_records(spark, sf), F.col("id"), *(v.alias(k) for k, v in made.items()))


def language_by_signs(spark: SparkSession, sf: str) -> DataFrame:
    """en, fr or bi by counts of small words."""
    lower = _documents(spark, sf).select("doc_id", F.lower("text").alias("t"))
    return lower.select("doc_id", quality.two_languages(F.col("t")).alias("found"))


def language_checks(spark: SparkSession, sf: str) -> DataFrame:
    """en, fr or bi by counts of more small words, and whether the label agrees."""
    lower = spread(table(spark, sf, "documents").select("doc_id", "lang", "text")).select("doc_id", "lang", F.lower("text").alias("t"))
    found = lower.select("doc_id", "lang", quality.two_languages(F.col("t"), FRENCH_SIGNS_LONG, ENGLISH_SIGNS_LONG).alias("found"))
    return found.select("doc_id", "found", quality.language_consistent(F.col("found"), F.col("lang")).alias("consistent"))


def record_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The checks that each record fails."""
    rows = distinct_rows(_records(spark, sf), F.col("id"), quality.record_failures().alias("f"))
    return rows.select("id", F.size("f").alias("n_failed"), F.array_join("f", "|").alias("failed"))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One manifest row for each record."""
    return distinct_rows(_records(spark, sf), *documents.manifest_columns())


def hash_check(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose content isn't what the manifest says; blobs' checksums are those of documents without outer blanks."""
    rows = spread(_records(spark, sf)).select("id", "content").where("content IS NOT NULL")
    listed = distinct_rows(rows, F.col("id"), T.content_hash(F.col("content")).alias("content_hash"))
    now = distinct_rows(rows, F.col("id"), T.strip(F.col("content")).alias("content"))
    return documents.hash_mismatches(now, listed).select("id", "content_hash")


def extraction_choice(spark: SparkSession, sf: str) -> DataFrame:
    """For each case the extraction to use: of the text layer where it passes its flags, else of the scan."""
    return documents.choose_extraction(table(spark, sf, "extractions"))


def record_previews(spark: SparkSession, sf: str) -> DataFrame:
    """Header and first lines of each record."""
    rows = _records(spark, sf).where(F.length("content") > 0)
    made = distinct_rows(rows, F.col("id"), documents.preview("2025-01-01T00:00:00", 20).alias("p"))
    return made.select("id", F.length("p").alias("n_chars"), F.md5("p").alias("digest"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where("text IS NOT NULL")
    pages = docs.select("doc_id", F.posexplode(F.split("text", "\n\n")).alias("n", "content"))
    return pages.select(F.format_string("%d_pages_%d", "doc_id", "n").alias("page_id"), "content")


def canonical_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of documents as numbered pages of canonical texts; page 0 comes last, without a number."""
    made = documents.canonical_texts(_pages(spark, sf)).withColumn("lower", F.lower("content"))
    c = F.col
    lang = quality.two_languages(c("lower"), FRENCH_SIGNS_LONG, ENGLISH_SIGNS_LONG)
    return made.select("case_id", "pages", F.md5("content").alias("digest"), documents.canonical_id(c("case_id"), lang, c("content")).alias("canonical_id"))


def content_warnings(spark: SparkSession, sf: str) -> DataFrame:
    """Warnings on each record's content."""
    made = documents.quality_warnings(F.col("content"), F.col("page_count"))
    return distinct_rows(_records(spark, sf), F.col("id"), F.array_join(made, "|").alias("warnings"))


def document_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by topic of their text."""
    lower = _documents(spark, sf).where("text IS NOT NULL").select("doc_id", F.lower("text").alias("t"))
    rows = lower.select("doc_id", documents.topic_of(F.col("t")).alias("topic"))
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def record_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Records as documents with header and markers, and what a check finds wrong with them."""
    rows = spread(_records(spark, sf).where(F.length("content") > 0))
    made = rows.withColumn("document", documents.text_document("2025-01-01T00:00:00"))
    d = F.col("document")
    checked = made.select("id", F.length(d).alias("n_chars"), F.md5(d).alias("digest"), F.array_join(documents.format_errors(d), "|").alias("errors"))
    return checked.distinct()


def compact_markers(spark: SparkSession, sf: str) -> DataFrame:
    """The first compact marker of each record."""
    return distinct_rows(_records(spark, sf), F.col("id"), documents.compact_marker("DOC", F.lit(0)).alias("marker"))


def vector_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100, against all."""
    vectors = table(spark, sf, "embeddings")
    return retrieval.nearest(vectors, vectors.where("vec_id % 100 = 0")).select("query_id", "vec_id", "rank")


def vector_precision(spark: SparkSession, sf: str) -> DataFrame:
    """How many of the ten nearest have the query's label."""
    vectors = table(spark, sf, "embeddings")
    return retrieval.precision_at_k(retrieval.nearest(vectors, vectors.where("vec_id % 100 = 0")), vectors)


def vector_recall(spark: SparkSession, sf: str) -> DataFrame:
    """How many of the vectors with the query's label are among its ten nearest."""
    vectors = table(spark, sf, "embeddings")
    return retrieval.recall_at_k(retrieval.nearest(vectors, vectors.where("vec_id % 100 = 0")), vectors)


def last_delivery_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and cases of the last delivery of each scope, looked up by its id."""
    inventory = table(spark, sf, "case_inventory")
    last = snapshots.delivery_order(table(spark, sf, "snapshots"), inventory).where("seq = last_seq").select("snapshot_id")
    found = inventory.join(F.broadcast(last), "snapshot_id", "left_semi")
    return found.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(snapshots.clean_key(F.col("case_id"))).alias("n_cases"))


def validated_search(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty newest records of one court whose content passes all gates."""
    made = quality.gates(F.col("content"), F.col("page_count"))
    rows = _records(spark, sf).where((F.lower("tribunal") == "sst") & (made["score"] == 1.0)).select("id", "publication_date").distinct()
    return rows.orderBy(F.desc_nulls_last("publication_date"), "id").limit(20)


def review_list(spark: SparkSession, sf: str) -> DataFrame:
    """English records whose content fails a gate, with their score."""
    made = quality.gates(F.col("content"), F.col("page_count"))
    rows = _records(spark, sf).where((F.lower(F.substring(F.trim("language"), 1, 2)) == "en") & (made["score"] < 1.0))
    return rows.select("id", made["score"].alias("score")).distinct()


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics of a run over all records: cases by language, bodies, and lengths."""
    rows = _records(spark, sf).select("tribunal", "language", F.length("content").alias("content_length"))
    made = corpus.metrics(rows)
    return made.select("total_cases", "english_cases", "french_cases", "content_statistics.*", F.size("tribunal_distribution").alias("n_bodies"))


_ALL = [
    p1_found, p1_totals, page_scan, page_blob_join, missing_blobs, extracted_records, case_assembly, stratified_tribunal,
    stratified_year, stratified_tribunal_year, proportional_sample, yearly_inventory, source_inventory, content_presence,
    corpus_metrics, tribunal_distribution, group_distribution, date_range, recent_years, content_duplicates,
    latest_extraction, previous_snapshot, last_delivery_status, extraction_rollup, quality_sets, flag_counts, coverage,
    freshness, record_search, record_names, file_names, inventory_slugs, sentence_truncation, discovery_anchor, top_terms,
    document_keywords, phrase_counts, statute_references, document_chunks, marked_records, quality_gates,
    language_by_signs, record_checks, manifest, canonical_cases, content_warnings, document_topics, record_documents, compact_markers,
    vector_neighbours, vector_precision, vector_recall, page_bases, link_ids, export_names, language_checks, hash_check,
    extraction_choice, record_previews, last_delivery_rows, validated_search, review_list, run_metrics,
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
