"""Column builders for identifiers, names and text. All are native expressions.

White space is Unicode's throughout, offsets and lengths count code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemill.functions.wordlists import COVER_ENDS, EXPORT_FOLDERS, FRONT_MATTER, HEADINGS, START_PATTERNS, TRIBUNAL_RANKS

#: White space as a character class that Java and RE2 both read.
SPACE = r"[\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_SPACE = SPACE.replace("[", "[^", 1)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is dear to compute and used more than once."""
    return F.element_at(F.transform(F.array(value), use), 1)


# identifiers


def page_number(page_id: Column) -> Column:
    """The number after a trailing _pages_, 0 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(page_id, r"(?i)_pages_(\d+)\z", 1), F.lit("")).try_cast("int"), F.lit(0))


def without_page_suffix(page_id: Column) -> Column:
    return F.regexp_replace(page_id, r"(?i)_pages_\d+\z", "")


def before_pages(page_id: Column) -> Column:
    """What stands before the first _pages_, letter case as written."""
    return F.substring_index(page_id, "_pages_", 1)


def tribunal_of(*hints: Column) -> Column:
    """The issuing body that a citation, path or link points to; the first rule that fits holds."""
    s = F.lower(F.concat_ws(" ", *(F.coalesce(h, F.lit("")) for h in hints)))
    return (
        F.when(s.rlike(r"\bscc\b|supreme court"), "scc")
        .when(s.rlike(r"\bfca\b|federal court of appeal|caf\b"), "fca")
        .when(s.rlike(r"\bfct?\b|federal court"), "fc")
        .when(s.rlike(r"\bsst\b|social security|tss\b"), "sst")
        .otherwise("unknown")
    )


def tribunal_rank(tribunal: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in TRIBUNAL_RANKS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, tribunal), F.lit(TRIBUNAL_RANKS["unknown"]))


def file_stem(path: Column) -> Column:
    """The last part of a path without its last suffix."""
    name = F.substring_index(F.regexp_replace(path, r"/+\z", ""), "/", -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+\z", "")


def path_language(path: Column) -> Column:
    p = F.lower(path)
    return (
        F.when(p.contains("/english/") | p.endswith("_en.pdf"), "en")
        .when(p.contains("/french/") | p.endswith("_fr.pdf"), "fr")
        .otherwise("unknown")
    )


def case_key(citation: Column, stem: Column, row_id: Column) -> Column:
    """A name-safe key: from the citation, else from the inner parts of the file stem, else from the id."""
    dashed = F.regexp_replace(F.regexp_replace(strip(citation), rf"{SPACE}+", "-"), "[^A-Za-z0-9-]", "")
    parts = F.split(stem, "_")
    inner = F.when(F.size(parts) == 2, parts[1]).when(F.size(parts) > 2, F.array_join(F.slice(parts, 2, F.size(parts) - 2), "_"))
    return F.substring(F.coalesce(F.nullif(dashed, F.lit("")), F.nullif(inner, F.lit("")), row_id), 1, 50)


def compact_date(date: Column, missing: str = "99999999") -> Column:
    """Eight digits of a date; ``missing`` where there aren't just eight."""
    digits = strip(F.translate(date, "-/", ""))
    return F.when(digits.rlike(r"\A[0-9]{8}\z"), digits).otherwise(missing)


def link_id(link: Column, path: Column) -> Column:
    """The number of a case in its link (/decisions/xx/NUMBER/), else in its file's name (_NUMBER_xx.pdf or _NUMBER.pdf), else NULL."""
    in_link = F.nullif(F.regexp_extract(link, r"/decisions/[a-z]{2}/([0-9]+)/", 1), F.lit(""))
    return F.coalesce(in_link, F.nullif(F.regexp_extract(path, r"_([0-9]+)(?:_[a-z]{2})?\.pdf\z", 1), F.lit("")))


def export_name(language: Column, tribunal: Column, rank: Column, date: Column, citation: Column, stem: Column, row_id: Column) -> Column:
    """LANG_rank-folder_YYYYMMDD_CASE_DOC without a suffix: the parts of an export's name, whatever is missing told as unknown."""
    folder = F.when(F.lower(tribunal).isin(*EXPORT_FOLDERS), F.lower(tribunal)).otherwise("unknown")
    number = F.nullif(F.regexp_extract(stem, r"_([0-9]+)_[a-z]{2}\z", 1), F.lit(""))
    case = slug(case_key(citation, stem, row_id), 30)
    return F.concat_ws(
        "_", F.upper(F.coalesce(language, F.lit("unknown"))), F.concat_ws("-", rank, folder), compact_date(date), case,
        F.coalesce(number, slug(F.right(row_id, F.lit(12)), 12)),
    )


def slug(name: Column, most: int = 50) -> Column:
    """Lower case, dashes for blanks, nothing but [a-z0-9._-]; "unknown" where nothing is left."""
    kept = F.regexp_replace(F.replace(F.lower(name), F.lit(" "), F.lit("-")), "[^a-z0-9._-]", "")
    tidy = F.regexp_replace(F.regexp_replace(kept, "-+", "-"), r"\A-+|-+\z", "")
    return F.coalesce(F.nullif(F.substring(tidy, 1, most), F.lit("")), F.lit("unknown"))


def content_hash(text: Column) -> Column:
    """The first 16 hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


# counting and cutting


def count_of(text: Column, term: str) -> Column:
    """Occurrences of ``term`` that don't overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("int")


def matches(text: Column, patterns: tuple[str, ...], flags: str = "(?i)") -> Column:
    """The distinct matches of all patterns, in lower case and stripped."""
    found = F.flatten(F.array(*(F.regexp_extract_all(text, F.lit(flags + p), F.lit(0)) for p in patterns)))
    return F.array_distinct(F.transform(found, lambda x: strip(F.lower(x))))


def truncate_on_sentence(text: Column, most: int, search: int = 200) -> Column:
    """At most ``most`` characters, ending with the last . ! ? among the last ``search`` of them, if there is one."""
    window = F.substring(text, most - search + 2, search - 1)
    keep = F.length(F.regexp_extract(window, r"(?s)\A(.*[.!?])", 1))
    cut = F.when(keep > 0, keep + (most - search + 1)).otherwise(most)
    return F.when(F.length(text) <= most, text).otherwise(strip(F.substring(text, F.lit(1), cut)))


def chunk_cuts(text: Column, every: int = 1500, back: int = 100) -> Column:
    """Places where a text is cut into chunks of about ``every`` characters.

    Each cut stands after the last white space among the ``back`` characters before
    the mark, or at the mark where there is none. The state of the fold is the last
    cut, so that a text costs one pass.
    """
    if every <= back:
        raise ValueError("every must be greater than back")
    n = F.length(text)
    steps = F.sequence(F.lit(1), F.ceil(n / (every - back)).cast("int") + 1)

    def step(state: Column, _: Column) -> Column:
        p = state["p"]
        blank = F.length(F.regexp_replace(F.substring(text, p + (every - back + 1), F.lit(back)), rf"{NOT_SPACE}*\z", ""))
        following = p + F.when(blank == 0, every).otherwise(blank + (every - back))
        return F.when(p + every >= n, state).otherwise(
            F.struct(following.alias("p"), F.concat(state["cuts"], F.array(following)).alias("cuts"))
        )

    start = F.struct(F.lit(0).alias("p"), F.array().cast("array<int>").alias("cuts"))
    return F.when(n > 0, F.aggregate(steps, start, step, lambda s: s["cuts"]))


def marker_field(c: Column) -> Column:
    return F.translate(F.coalesce(c, F.lit("")), "|][", "/)(")


def marker(tag: str, counter: Column, language: Column, tribunal: Column, rank: Column, date: Column, citation: Column, stem: Column, most: int = 99_999) -> Column:
    """[tag|MH00000|LANG|TRIBUNAL|Rn|date|citation|stem]; a counter above ``most`` is an error."""
    number = F.when(counter <= most, F.format_string("MH%05d", counter)).otherwise(F.raise_error(F.lit("too many markers in one text")))
    fields = [F.upper(marker_field(language)), F.upper(marker_field(tribunal)), F.concat(F.lit("R"), rank), *map(marker_field, (date, citation, stem))]
    return F.concat(F.lit("["), F.concat_ws("|", F.lit(tag), number, *fields), F.lit("]"))


# discovery anchor

_HEADING = rf"(?i)\n\s*(?:{'|'.join(HEADINGS)})\s*\n"
_COVER_END = rf"(?i)(?:{'|'.join(COVER_ENDS)})"
_FRONT_PARAGRAPH = rf"(?iU)\A(?:{'|'.join(FRONT_MATTER)})\z"
_PARAGRAPH_START = r"\n\s*\n\s*[A-Z\[]"


def _length_to(text: Column, pattern: str, end: bool = False) -> Column:
    """Characters up to the first match's start (or end); NULL without a match."""
    around = rf"(?s)\A(.*?)(?-s:(?U){pattern})" if not end else rf"(?s)\A(.*?(?-s:(?U){pattern}))"
    return F.when(text.rlike("(?U)" + pattern), F.length(F.regexp_extract(text, around, 1)))


def substantive_start(text: Column) -> Column:
    """Where the reasons begin: a first numbered paragraph, else after a heading, else after the cover's last mark, else 0."""
    def after_cover(cover: Column) -> Column:
        rest = F.substring(text, cover + 1, F.length(text))
        return F.when(cover.isNotNull(), cover + _length_to(rest, _PARAGRAPH_START) + 2)

    return F.coalesce(
        *(_length_to(text, p) + 1 for p in START_PATTERNS),
        _length_to(text, _HEADING, end=True),
        once(_length_to(text, _COVER_END, end=True), after_cover),
        F.lit(0),
    )


def without_front_matter(text: Column) -> Column:
    """The paragraphs that aren't front matter: dockets and the like, or short and mostly in capitals."""

    def is_front(p: Column) -> Column:
        words = F.filter(F.split(p, "(?U)\\s+"), lambda w: w != "")
        capital = F.filter(
            words,
            lambda w: ((F.upper(w) == w) & (F.lower(w) != w)) | w.rlike(r"\A[^\p{L}]*\p{Lu}\p{Ll}*(?:[^\p{L}]+\p{Lu}\p{Ll}*)*[^\p{L}]*\z"),
        )
        return F.when(F.length(p) < 200, F.size(capital) * 2 > F.size(words)).otherwise(False) | p.rlike(_FRONT_PARAGRAPH)

    paragraphs = F.transform(F.split(text, "(?U)\\n\\s*\\n"), strip)
    return F.array_join(F.filter(paragraphs, lambda p: (p != "") & ~is_front(p)), " ")


def anchor(text: Column, most: int = 900, least: int = 100) -> Column:
    """A clean opening of at most ``most`` characters, for discovery; the raw suffix where less than ``least`` is left."""
    def clean(suffix: Column) -> Column:
        kept = strip(F.regexp_replace(without_front_matter(suffix), " +", " "))
        return once(kept, lambda c: F.when(F.length(c) < least, strip(F.regexp_replace(suffix, " +", " "))).otherwise(c))

    suffix = F.substring(text, substantive_start(text) + 1, F.length(text))
    return once(once(suffix, clean), lambda c: truncate_on_sentence(c, most))
