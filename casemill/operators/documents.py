"""Records as self-describing text documents, their check, and canonical texts."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.functions import quality
from casemill.functions import text as T
from casemill.functions.wordlists import DEFAULT_TOPIC, TOPIC_PATTERNS
from casemill.operators.chunks import marked_text
from casemill.operators.keywords import keywords_of

REQUIRED = ("DOC_CLASS:", "FORMAT_VERSION:", "CONTENT_HASH:", "KEYWORDS:", "FILE_STEM:", "LANG:", "TRIBUNAL:", "TRIBUNAL_RANK:", "CONTENT_LENGTH:")


def header(
    generated: str, version: str, doc_class: str = "DOC", with_anchor: bool = True, keywords: Column | None = None, anchor: Column | None = None
) -> Column:
    """Header lines "KEY: value" of a record with its keywords and anchor; what is missing is empty.

    The anchor's line feeds become blanks, so that the header has one line for each key.
    Keywords and anchor are those of the content where they aren't given.
    """
    c = F.col
    keywords = keywords_of(c("content")) if keywords is None else keywords
    flat = T.strip(F.regexp_replace(T.anchor(c("content")) if anchor is None else anchor, r"\s+", " "))
    lines = {
        "DOC_CLASS": F.lit(doc_class), "FORMAT_VERSION": F.lit(version), "GENERATED": F.lit(generated), "CONTENT_HASH": T.content_hash(c("content")),
        "FILE_STEM": c("file_stem"), "LANG": F.upper("language"), "TRIBUNAL": F.upper("tribunal"), "TRIBUNAL_RANK": c("tribunal_rank"),
        "DECISION_DATE": c("publication_date"), "CITATION": c("citation"), "KEYWORDS": keywords,
    }
    lines |= {"RETRIEVAL_ANCHOR": flat} if with_anchor else {}
    lines |= {
        "PDF_LINK": c("pdf_link"), "WEB_LINK": c("web_link"), "BLOB_PATH": c("metadata_relpath"), "SOURCE_NAME": c("source_name"),
        "PAGE_COUNT": c("page_count"), "CONTENT_LENGTH": F.length("content"),
    }
    return F.concat_ws("\n", *(F.concat(F.lit(k + ": "), F.coalesce(v.cast("string"), F.lit(""))) for k, v in lines.items()))


def text_document(generated: str, version: str = "2.2", tag: str = "DOC", every: int = 1500, back: int = 100, **made: Column) -> Column:
    """A record's document: header, an empty line, and the content with its markers."""
    return F.concat_ws("\n\n", header(generated, version, **made), marked_text(tag, every, back))


def text_documents(cases: DataFrame, generated: str, version: str = "2.2", tag: str = "DOC", every: int = 1500, back: int = 100) -> DataFrame:
    """(id, document) of each record; records without content give none. A document is made from its own row alone."""
    rows = cases.where(F.length("content") > 0)
    return rows.select("id", text_document(generated, version, tag, every, back).alias("document"))


def short_anchor(anchor: Column) -> Column:
    """The first hundred characters of an anchor, with three points where more follows."""
    return F.when(F.length(anchor) > 100, F.concat(F.left(anchor, F.lit(100)), F.lit("..."))).otherwise(anchor)


def manifest_columns(min_content: int = 1000) -> list[Column]:
    """The columns of a manifest of case records, with their keywords and a short anchor."""
    c = F.col
    text = F.coalesce(c("content"), F.lit(""))
    short = T.once(T.anchor(text), short_anchor)
    return [
        c("id"), c("citation"), F.lower("tribunal").alias("court"), c("tribunal_rank"), c("page_count"), F.length(text).alias("content_length"),
        T.content_hash(text).alias("content_hash"), keywords_of(text).alias("keywords"), short.alias("anchor"),
        quality.manifest_exceptions(min_content).alias("exceptions"),
    ]


def preview(generated: str, lines: int = 30, version: str = "2.2") -> Column:
    """A record's header and the first lines of its content."""
    start = F.array_join(F.slice(F.split("content", "\n"), 1, lines), "\n")
    return F.concat_ws("\n\n", header(generated, version), start, F.lit("[... content continues ...]"))


def format_errors(document: Column, tag: str = "DOC", least: int = 1000) -> Column:
    """What is wrong with a document: header fields, length, and the order and place of its markers."""
    def found(parts: Column) -> Column:
        head, body, numbers, last = (parts[x] for x in ("head", "body", "numbers", "last"))
        checks = {
            "no_header": head.isNull(),
            **{f"no_{f.rstrip(':').lower()}": ~F.coalesce(F.contains(head, F.lit("\n" + f)), F.lit(False)) for f in REQUIRED},
            "short_body": F.length(body) < least,
            "no_first_marker": ~F.startswith(body, F.lit(f"[{tag}|MH00000|")),
            "marker_order": (F.size(numbers) > 0) & (numbers != F.sequence(F.lit(0), F.greatest(F.size(numbers), F.lit(1)) - 1)),
            "late_text": (F.size(numbers) == 0) | (F.length(last) - F.locate("]", last) > 200),
        }
        return F.array_compact(F.array(*(F.when(bad, name) for name, bad in checks.items())))

    def parts(document: Column) -> Column:
        at = F.locate("\n\n", document)
        body = F.when(at > 0, F.substring(document, at + 2, F.length(document))).otherwise(document)
        numbers = F.transform(F.regexp_extract_all(body, F.lit(rf"\[{tag}\|MH(\d{{5}})\|"), F.lit(1)), lambda x: x.cast("int"))
        head = F.when(at > 0, F.concat(F.lit("\n"), F.substring(document, F.lit(1), at - 1)))
        return F.struct(head.alias("head"), body.alias("body"), numbers.alias("numbers"), F.substring_index(body, f"[{tag}|MH", -1).alias("last"))

    return T.once(T.once(document, parts), found)


def compact_marker(tag: str, counter: Column, most: int = 160) -> Column:
    """A marker with a compact date, its citation and stem shortened to keep within ``most`` where they can."""
    c = F.col
    citation, stem = T.strip(T.marker_field(c("citation"))), T.marker_field(c("file_stem"))
    room = F.lit(most - 35) - F.length("tribunal")
    for_citation = F.floor(room * 0.6).cast("int")

    def build(cite: Column, name: Column) -> Column:
        return T.marker(tag, counter, c("language"), c("tribunal"), c("tribunal_rank"), T.compact_date(c("publication_date")), cite, name)

    whole = build(citation, stem)
    short = build(F.left(citation, F.greatest(for_citation, F.lit(10))), F.left(stem, F.greatest(room - for_citation, F.lit(20))))
    return F.when(F.length(whole) <= most, whole).otherwise(short)


def canonical_texts(pages: DataFrame, page_id: str = "page_id", content: str = "content") -> DataFrame:
    """(case_id, content, pages): pages in order, each after [p.N]; unnumbered pages come last, without it."""
    number = T.page_number(F.col(page_id))
    order = F.struct(F.when(number == 0, 999_999).otherwise(number).alias("n"), F.col(page_id).alias("id"), T.strip(F.col(content)).alias("text"))
    filled = F.filter(F.array_sort(F.collect_list(order)), lambda p: p["text"].isNotNull() & (p["text"] != ""))
    marked = F.transform(filled, lambda p: F.concat(F.when(p["n"] == 999_999, "").otherwise(F.concat(F.lit("[p."), p["n"], F.lit("] "))), p["text"]))
    return pages.groupBy(T.without_page_suffix(F.col(page_id)).alias("case_id")).agg(
        F.array_join(marked, "\n\n").alias("content"), F.count(F.lit(1)).alias("pages")
    )


def canonical_id(case_id: Column, language: Column, content: Column) -> Column:
    return F.concat_ws("_", case_id, language, F.substring(F.sha2(content, 256), 1, 8))


def quality_warnings(text: Column, pages: Column) -> Column:
    """Messages for the gates that a text fails."""
    g = quality.gates(text, pages)
    n = F.length(F.coalesce(text, F.lit("")))
    printable = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), quality.UNPRINTABLE, "")) / F.greatest(n, F.lit(1))
    return F.array_compact(
        F.array(
            F.when(~g["non_empty"], F.lit("CRITICAL: Empty content")),
            F.when(~g["min_length"], F.format_string("Short content: %d chars", n)),
            F.when(~g["readable"], F.format_string("Low readability: %.1f%%", printable * 100)),
            F.when(~g["coverage"], F.format_string("Sparse pages: %.0f chars/page (threshold: 200)", n / F.greatest(pages, F.lit(1)))),
        )
    )


def topic_of(lower: Column) -> Column:
    """The topic whose patterns match a text in lower case most often; the first of equals, and the default where none matches.

    A text that no pattern matches is told by all of them at once.
    """
    every = "|".join(p for patterns in TOPIC_PATTERNS.values() for p in patterns)
    some = lower.rlike("(?U)" + every)
    scores = [(t, reduce(add, (F.regexp_count(lower, F.lit("(?U)" + p)) for p in patterns))) for t, patterns in TOPIC_PATTERNS.items()]
    ranked = F.array(*(F.struct(n.alias("n"), F.lit(-k).alias("k"), F.lit(t).alias("topic")) for k, (t, n) in enumerate(scores)))
    best = T.once(F.array_max(ranked), lambda b: F.when(b["n"] > 0, b["topic"]).otherwise(DEFAULT_TOPIC))
    return F.when(some, best).otherwise(DEFAULT_TOPIC)


def hash_mismatches(documents: DataFrame, manifest: DataFrame, key: str = "id", text: str = "content") -> DataFrame:
    """Rows of the manifest whose text is missing or has another hash."""
    found = documents.select(key, T.content_hash(F.col(text)).alias("_found"))
    return manifest.join(found, key, "left").where(~F.col("content_hash").eqNullSafe(F.col("_found"))).drop("_found")


def choose_extraction(runs: DataFrame, first: str = "text_layer", fallback: str = "ocr") -> DataFrame:
    """(case_id, artifact_id, extraction_method, passed): the newest run of the first method where all its flags hold,
    else the newest of the fallback, else the first method's after all. A run without flags doesn't pass."""
    flags = F.map_values("quality_flags")
    passed = F.coalesce(F.size(flags) > 0, F.lit(False)) & F.coalesce(F.forall(flags, lambda x: x), F.lit(False))
    order = F.struct("extraction_timestamp", "artifact_id", "extraction_method", passed.alias("passed"))
    newest = runs.groupBy("case_id").agg(
        F.max(F.when(F.col("extraction_method") == first, order)).alias("a"), F.max(F.when(F.col("extraction_method") == fallback, order)).alias("b")
    )
    chosen = F.when(F.col("a.passed"), F.col("a")).otherwise(F.coalesce("b", "a"))
    return newest.select("case_id", chosen.alias("c")).where("c IS NOT NULL").select("case_id", "c.artifact_id", "c.extraction_method", "c.passed")
