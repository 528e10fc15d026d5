"""Column builders for quality gates, language detection and record checks."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemill.functions.text import count_of, once, strip
from casemill.functions.wordlists import ARTIFACTS, ENGLISH_SIGNS, FRENCH_SIGNS

#: Control, format and private characters other than white space.
UNPRINTABLE = r"[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f\p{Cf}\p{Co}]"
CITATION = r"(?i)\b(19|20)\d{2}\s+(SCC|FCA|FC|FCT|SST|SSTAD|SSTGDEI)\s+\d+\b"


def gates(text: Column, pages: Column) -> dict[str, Column]:
    """non_empty, min_length, readable, coverage and their mean as score; NULL counts as the empty text."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    flags = {
        "non_empty": strip(t) != "",
        "min_length": n >= 100,
        "readable": (n > 0) & (F.length(F.regexp_replace(t, UNPRINTABLE, "")) >= F.lit(0.8) * n),
        "coverage": n / F.greatest(pages, F.lit(1)) >= 200,
    }
    return flags | {"score": reduce(add, (f.cast("int") for f in flags.values())) / 4.0}


def two_languages(lower: Column, french_signs: tuple[str, ...] = FRENCH_SIGNS, english_signs: tuple[str, ...] = ENGLISH_SIGNS) -> Column:
    """en, fr or bi by counts of small words of a text in lower case; en for an empty text."""
    t = F.coalesce(lower, F.lit(""))
    french, english = (reduce(add, (count_of(t, s) for s in signs)) for signs in (french_signs, english_signs))
    return once(
        F.struct(french.alias("f"), english.alias("e"), (t == "").alias("empty")),
        lambda n: F.when(n["empty"], "en").when(n["f"] > 2 * n["e"], "fr").when(n["e"] > 2 * n["f"], "en").otherwise("bi"),
    )


def language_consistent(found: Column, label: Column) -> Column:
    """Whether a detected language fits a label: two languages fit any, else the label must name the detected one."""
    return (found == "bi") | F.coalesce(F.lower(F.substring(F.trim(label), 1, 2)) == found, F.lit(False))


def record_failures(min_content: int = 1000) -> Column:
    """Names of the checks that a record fails, in a fixed order."""
    c = F.col
    blank = lambda x: F.coalesce(strip(c(x)) == "", F.lit(True))
    n = F.coalesce(F.length("content"), F.lit(0))
    artifacts = reduce(add, (count_of(F.coalesce(c("content"), F.lit("")), a) for a in ARTIFACTS))
    date = strip(c("publication_date"))
    dated = F.coalesce(*(F.try_to_timestamp(date, F.lit(f)) for f in ("yyyy-M-d", "yyyy-M", "yyyy/M/d", "yyyy")))
    bad_link = lambda x: F.coalesce(~(c(x).startswith("http://") | c(x).startswith("https://")), F.lit(False))
    checks = {
        "id": blank("id"),
        "metadata_relpath": blank("metadata_relpath"),
        "content": blank("content"),
        "content_length": n < min_content,
        "artifacts": (n > 0) & (artifacts >= F.lit(0.01) * n),
        "citation": ~F.coalesce(c("citation").rlike(CITATION), F.lit(False)),
        "publication_date": dated.isNull(),
        "pdf_link": bad_link("pdf_link"),
        "web_link": bad_link("web_link"),
        "blob_name": F.coalesce(c("metadata_relpath") != c("blob_name"), F.lit(True)),
    }
    return F.array_compact(F.array(*(F.when(bad, name) for name, bad in checks.items())))


def manifest_exceptions(min_content: int = 1000) -> Column:
    """What a manifest row lacks, joined by |."""
    c = F.col
    missing = lambda x: F.coalesce(c(x) == "", F.lit(True))
    flags = {
        "MISSING_PDF_LINK": missing("pdf_link"),
        "MISSING_WEB_LINK": missing("web_link"),
        "MISSING_CITATION": missing("citation"),
        "MISSING_DATE": missing("publication_date"),
        "SHORT_CONTENT": F.coalesce(F.length("content"), F.lit(0)) < min_content,
        "ZERO_PAGES": F.coalesce(c("page_count"), F.lit(0)) == 0,
    }
    return F.array_join(F.array_compact(F.array(*(F.when(bad, name) for name, bad in flags.items()))), "|")
