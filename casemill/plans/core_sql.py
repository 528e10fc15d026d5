"""SQL of the core's queries, for a check by another engine."""

from __future__ import annotations

from casemill.functions.text import SPACE
from casemill.functions.wordlists import (
    ARTIFACTS, COVER_ENDS, ENGLISH_SIGNS, ENGLISH_SIGNS_LONG, FRENCH_SIGNS, FRENCH_SIGNS_LONG, FRONT_MATTER, HEADINGS, LEXICON,
    START_PATTERNS, STATUTE_PATTERNS, STOP_WORDS, SURNAMES,
)

_WS = SPACE


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words))


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _count(text: str, term: str) -> str:
    return f"((length({text}) - length(replace({text}, '{term}', ''))) // {len(term)})"


def _slug(x: str, most: int = 50) -> str:
    kept = f"regexp_replace(replace(lower({x}), ' ', '-'), '[^a-z0-9._-]', '', 'g')"
    return f"coalesce(nullif(substr(trim(regexp_replace({kept}, '-+', '-', 'g'), '-'), 1, {most}), ''), 'unknown')"


_BODY = r"""CASE WHEN regexp_matches(s, '\bscc\b|supreme court') THEN 'scc'
      WHEN regexp_matches(s, '\bfca\b|federal court of appeal|caf\b') THEN 'fca'
      WHEN regexp_matches(s, '\bfct?\b|federal court') THEN 'fc'
      WHEN regexp_matches(s, '\bsst\b|social security|tss\b') THEN 'sst' ELSE 'unknown' END"""
_CLASSIFIED = f"""WITH c AS (SELECT *, {_BODY} AS body FROM (SELECT *,
      lower(concat(coalesce(citation, ''), ' ', coalesce(metadata_relpath, ''), ' ', coalesce(pdf_link, ''))) AS s FROM case_records))"""
_ORDER = "substr(sha256(concat('casemill', {key})), 1, 8), {key}"
_CHANGES = r"""
WITH h AS (SELECT snapshot_id, min(scope_id) AS scope_id, min(CAST(CASE
             WHEN regexp_matches(timestamp, '(Z|[+-]\d\d:\d\d)$') THEN timestamp ELSE timestamp || 'Z' END AS TIMESTAMPTZ)) AS ts
           FROM snapshots WHERE snapshot_id IN (SELECT snapshot_id FROM case_inventory) GROUP BY snapshot_id),
o AS (SELECT *, row_number() OVER (PARTITION BY scope_id ORDER BY ts, snapshot_id) AS seq FROM h),
k AS (SELECT snapshot_id, lower(regexp_replace(case_id, '^\s+|\s+$', '', 'g')) AS case_id, discovered_at,
             nullif(lower(regexp_replace(content_hash, '^\s+|\s+$', '', 'g')), '') AS hash FROM case_inventory),
v AS (SELECT snapshot_id, case_id, hash FROM k QUALIFY row_number() OVER (
        PARTITION BY snapshot_id, case_id ORDER BY discovered_at DESC, hash DESC NULLS LAST) = 1),
p AS (SELECT scope_id, seq, case_id, hash FROM v JOIN o USING (snapshot_id)),
c AS (SELECT coalesce(n.scope_id, b.scope_id) AS scope_id, coalesce(n.seq, b.seq + 1) AS seq,
             coalesce(n.case_id, b.case_id) AS case_id,
             CASE WHEN b.case_id IS NULL THEN 'added' WHEN n.case_id IS NULL THEN 'removed'
                  WHEN n.hash IS DISTINCT FROM b.hash THEN 'changed' END AS change_type
      FROM p n FULL JOIN p b ON n.scope_id = b.scope_id AND n.case_id = b.case_id AND n.seq = b.seq + 1),
f AS (SELECT o.snapshot_id, c.case_id, c.change_type FROM c JOIN o USING (scope_id, seq)
      WHERE change_type IS NOT NULL AND seq > 1)
"""


_NAMES = f"""SELECT id, regexp_replace(regexp_extract(regexp_replace(metadata_relpath, '/+$', ''), '[^/]*$'), '^(.+)\\.[^.]+$', '\\1') AS stem,
  CASE WHEN contains(lower(metadata_relpath), '/english/') OR ends_with(lower(metadata_relpath), '_en.pdf') THEN 'en'
       WHEN contains(lower(metadata_relpath), '/french/') OR ends_with(lower(metadata_relpath), '_fr.pdf') THEN 'fr' ELSE 'unknown' END AS path_lang,
  substr(coalesce(nullif(regexp_replace(regexp_replace({_strip("citation")}, '{_WS}+', '-', 'g'), '[^A-Za-z0-9-]', '', 'g'), ''),
    nullif(CASE WHEN len(string_split(file_stem, '_')) = 2 THEN string_split(file_stem, '_')[2]
                WHEN len(string_split(file_stem, '_')) > 2 THEN array_to_string(string_split(file_stem, '_')[2:-2], '_') END, ''), id), 1, 50) AS case_key,
  CASE WHEN regexp_full_match(trim(replace(replace(publication_date, '-', ''), '/', '')), '[0-9]{{8}}')
       THEN trim(replace(replace(publication_date, '-', ''), '/', '')) ELSE '99999999' END AS day,
  {_slug("source_name")} AS source_slug
FROM (SELECT DISTINCT * FROM case_records)"""
_WINDOW = "substr(text, 702, 199)"
_CUT = f"CASE WHEN length(regexp_extract({_WINDOW}, '(?s)^(.*[.!?])', 1)) > 0 THEN 701 + length(regexp_extract({_WINDOW}, '(?s)^(.*[.!?])', 1)) ELSE 900 END"
_TRUNCATED = f"SELECT doc_id, CASE WHEN length(text) <= 900 THEN text ELSE {_strip(f'substr(text, 1, {_CUT})')} END AS t FROM documents WHERE text IS NOT NULL"
_LETTERS = "a-zàâäæçèéêëïîôœùûüÿ"
_FRENCH = " + ".join(_count("t", s) for s in FRENCH_SIGNS)
_ENGLISH = " + ".join(_count("t", s) for s in ENGLISH_SIGNS)
_ARTIFACT_COUNT = " + ".join(_count("coalesce(content, '')", a) for a in ARTIFACTS)
_NOT_SPACE = _WS.replace("[", "[^", 1)
_CHUNKS = f"""WITH RECURSIVE k(doc_id, text, p, n) AS (
  SELECT doc_id, text, 0, 0 FROM documents WHERE length(text) > 0
  UNION ALL
  SELECT doc_id, text, p + CASE WHEN b = 0 THEN 1500 ELSE 1400 + b END, n + 1 FROM (
    SELECT *, length(regexp_replace(substr(text, p + 1401, 100), '{_NOT_SPACE}*$', '')) AS b FROM k) WHERE p + 1500 < length(text)),
e AS (SELECT *, coalesce(lead(p) OVER (PARTITION BY doc_id ORDER BY n), length(text)) AS q FROM k)
SELECT doc_id, n AS counter, p AS start, q AS "end", md5(substr(text, p + 1, q - p)) AS digest FROM e"""


def _blank(x: str) -> str:
    return f"coalesce({_strip(x)} = '', true)"


def _dated(x: str) -> str:
    return " OR ".join(f"try_strptime({x}, '{f}') IS NOT NULL" for f in ("%Y-%m-%d", "%Y-%m", "%Y/%m/%d", "%Y"))


_CHECKS = {
    "id": _blank("id"), "metadata_relpath": _blank("metadata_relpath"), "content": _blank("content"),
    "content_length": "coalesce(length(content), 0) < 1000",
    "artifacts": f"coalesce(length(content), 0) > 0 AND ({_ARTIFACT_COUNT}) >= 0.01::DOUBLE * length(content)",
    "citation": r"NOT coalesce(regexp_matches(citation, '(?i)\b(19|20)\d{2}\s+(SCC|FCA|FC|FCT|SST|SSTAD|SSTGDEI)\s+\d+\b'), false)",
    "publication_date": f"NOT coalesce({_dated(_strip('publication_date'))}, false)",
    "pdf_link": "coalesce(NOT regexp_matches(pdf_link, '^https?://'), false)",
    "web_link": "coalesce(NOT regexp_matches(web_link, '^https?://'), false)",
    "blob_name": "coalesce(metadata_relpath <> blob_name, true)",
}
_EXCEPTIONS = {
    "MISSING_PDF_LINK": "coalesce(pdf_link = '', true)", "MISSING_WEB_LINK": "coalesce(web_link = '', true)",
    "MISSING_CITATION": "coalesce(citation = '', true)", "MISSING_DATE": "coalesce(publication_date = '', true)",
    "SHORT_CONTENT": "coalesce(length(content), 0) < 1000", "ZERO_PAGES": "coalesce(page_count, 0) = 0",
}


def _failing(checks: dict[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in checks.items()) + "], lambda x: x IS NOT NULL)"


_NEAREST = """WITH q AS (SELECT vec_id AS query_id, embedding AS a, label AS want FROM embeddings WHERE vec_id % 100 = 0),
r AS (SELECT query_id, want, vec_id, label, row_number() OVER (PARTITION BY query_id
        ORDER BY round(list_cosine_similarity(a::DOUBLE[], embedding::DOUBLE[]), 10) DESC, vec_id) AS rank
      FROM q JOIN embeddings ON vec_id <> query_id QUALIFY rank <= 10)
"""


def _two(t: str, french: tuple[str, ...], english: tuple[str, ...]) -> str:
    f, e = (" + ".join(_count(t, x) for x in signs) for signs in (french, english))
    return f"CASE WHEN {t} = '' THEN 'en' WHEN ({f}) > 2 * ({e}) THEN 'fr' WHEN ({e}) > 2 * ({f}) THEN 'en' ELSE 'bi' END"


def _wide(pattern: str) -> str:
    """A pattern with classes that know all scripts."""
    out, inside, k = "", False, 0
    while k < len(pattern):
        two = pattern[k : k + 2]
        if two in (r"\s", r"\d", r"\w"):
            cls = {r"\s": _WS, r"\d": r"[\p{Nd}]", r"\w": r"[\p{L}\p{N}\p{M}_]"}[two]
            out += cls[1:-1] if inside else cls
            k += 2
            continue
        if two[0] == "\\":
            out += two
            k += 2
            continue
        inside = two[0] == "[" or inside and two[0] != "]"
        out += two[0]
        k += 1
    return out.replace("'", "''")


def _before(t: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '{pattern}') THEN length(regexp_extract({t}, '(?s)\\A(.*?)(?-s:{pattern})', 1)) END"


def _through(t: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '{pattern}') THEN length(regexp_extract({t}, '(?s)\\A(.*?(?-s:{pattern}))', 1)) END"


_CLEAN = "regexp_replace(regexp_replace(regexp_replace({t}, 'https?://\\S+', '', 'g'), 'www\\.\\S+', '', 'g'), '\\S+@\\S+', '', 'g')"
_PART = _wide(r"\n\s*\n\s*[A-Z\[]")
_SENTENCE = "regexp_extract(substr(x, 702, 199), '(?s)^(.*[.!?])', 1)"


def _anchors(rows: str) -> str:
    """CTEs that end in anchors (k, anchor); ``rows`` selects k and t."""
    starts = ", ".join(_before("t", _wide(p)) + " + 1" for p in START_PATTERNS)
    heading, cover = _wide(r"(?i)\n\s*(?:" + "|".join(HEADINGS) + r")\s*\n"), _wide("(?i)(?:" + "|".join(COVER_ENDS) + ")")
    front = _wide("(?i)(?:" + "|".join(FRONT_MATTER) + ")")
    return rf"""a0 AS ({rows}),
a1 AS (SELECT k, t, {_through("t", cover)} AS cover FROM a0),
a2 AS (SELECT k, t, cover, substr(t, cover + 1) AS rest FROM a1),
a3 AS (SELECT k, substr(t, coalesce({starts}, {_through("t", heading)}, cover + {_before("rest", _PART)} + 2, 0) + 1) AS suffix FROM a2),
a4 AS (SELECT k, suffix, list_filter(list_transform(string_split_regex(suffix, '{_wide(chr(92) + "n" + chr(92) + "s*" + chr(92) + "n")}'), lambda p: {_strip("p")}), lambda p: p <> '') AS ps FROM a3),
a5 AS (SELECT k, suffix, unnest(ps) AS p, unnest(range(len(ps))) AS i FROM a4),
a6 AS (SELECT *, list_filter(string_split_regex(p, '{_WS}+'), lambda w: w <> '') AS ws FROM a5),
a7 AS (SELECT k, string_agg(p, ' ' ORDER BY i) AS body FROM a6 WHERE NOT (regexp_full_match(p, '{front}') OR (length(p) < 200 AND 2 * len(list_filter(ws,
        lambda w: (upper(w) = w AND lower(w) <> w) OR regexp_full_match(w, '[^\p{{L}}]*\p{{Lu}}\p{{Ll}}*(?:[^\p{{L}}]+\p{{Lu}}\p{{Ll}}*)*[^\p{{L}}]*'))) > len(ws))) GROUP BY k),
a8 AS (SELECT a3.k, {_strip("regexp_replace(coalesce(body, ''), ' +', ' ', 'g')")} AS clean, {_strip("regexp_replace(suffix, ' +', ' ', 'g')")} AS raw FROM a3 LEFT JOIN a7 ON a3.k = a7.k),
a9 AS (SELECT k, CASE WHEN length(clean) < 100 THEN raw ELSE clean END AS x FROM a8),
anchors AS (SELECT k, CASE WHEN length(x) <= 900 THEN x ELSE {_strip(f"substr(x, 1, CASE WHEN length({_SENTENCE}) > 0 THEN 701 + length({_SENTENCE}) ELSE 900 END)")} END AS anchor FROM a9)
"""


def _keywords(rows: str) -> str:
    """CTEs that end in terms (k, keywords); ``rows`` selects k and t."""
    lexicon = ", ".join(f"('{t.replace(chr(39), chr(39) * 2)}', {w}::DOUBLE, {i})" for i, (t, w) in enumerate(LEXICON.items()))
    refs = ", ".join("regexp_extract_all(t, '(?i)" + p.replace("'", "''") + "')" for p in STATUTE_PATTERNS)
    return rf"""k0 AS (SELECT k, {_CLEAN.format(t="t")} AS t FROM ({rows})),
k1 AS (SELECT k, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '[{_LETTERS}][{_LETTERS}0-9]*')) AS w FROM k0),
k2 AS (SELECT k, unnest(w) AS word, unnest(range(len(w))) AS pos FROM k1),
k3 AS (SELECT k, word, count(*) AS n, min(pos) AS first FROM k2 WHERE length(word) >= 4 AND word NOT IN ({_list(STOP_WORDS | (SURNAMES - LEXICON.keys()))}) GROUP BY ALL HAVING count(*) >= 2),
refs AS (SELECT k, list_transform(flatten([{refs}]), lambda x: lower(x)) AS refs FROM k0),
lexicon(term, weight, i) AS (VALUES {lexicon}),
scored AS (SELECT k, word AS term, n * coalesce(weight, 1.0::DOUBLE) + CASE WHEN len(list_filter(refs, lambda r: contains(r, word))) > 0 THEN 10 ELSE 0 END AS score, 0 AS kind, first
           FROM k3 JOIN refs USING (k) LEFT JOIN lexicon ON term = word
           UNION ALL SELECT k, replace(term, ' ', '-'), ((length(lower(t)) - length(replace(lower(t), term, ''))) // length(term)) * weight, 1, i
           FROM k0, lexicon WHERE contains(term, ' ') AND contains(lower(t), term)),
best AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, kind, first) AS r FROM scored QUALIFY r <= 7),
terms AS (SELECT k0.k, coalesce(string_agg(term, ', ' ORDER BY r), 'none') AS keywords FROM k0 LEFT JOIN best ON k0.k = best.k GROUP BY k0.k)
"""


def _field(x: str) -> str:
    return f"translate(coalesce({x}, ''), '|][', '/)(')"


def _marker(n: str) -> str:
    return (
        f"('[DOC|MH' || printf('%05d', {n}) || '|' || upper({_field('language')}) || '|' || upper({_field('tribunal')}) || '|R' || tribunal_rank || '|' || "
        + f"{_field('publication_date')} || '|' || {_field('citation')} || '|' || {_field('file_stem')} || ']')"
    )


_RECORDS = "r AS (SELECT DISTINCT * FROM case_records WHERE length(content) > 0)"
_BODIES = f"""{_RECORDS},
c(id, content, p, n) AS (
  SELECT id, content, 0, 0 FROM r
  UNION ALL
  SELECT id, content, p + CASE WHEN b = 0 THEN 1500 ELSE 1400 + b END, n + 1 FROM (
    SELECT *, length(regexp_replace(substr(content, p + 1401, 100), '{_NOT_SPACE}*$', '')) AS b FROM c) WHERE p + 1500 < length(content)),
e AS (SELECT id, p, n, coalesce(lead(p) OVER (PARTITION BY id ORDER BY n), length(content)) AS q FROM c),
bodies AS (SELECT id, string_agg({_marker("n")} || chr(10) || chr(10) || substr(content, p + 1, q - p), chr(10) || chr(10) ORDER BY n) || chr(10) ||
             any_value({_marker("(SELECT max(n) + 1 FROM e y WHERE y.id = e.id)")}) AS body FROM e JOIN r USING (id) GROUP BY id)
"""
_FLAT = _strip("regexp_replace(anchor, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')")
_HEADER = " || chr(10) || ".join(
    f"'{k}: ' || coalesce(CAST({v} AS VARCHAR), '')"
    for k, v in {
        "DOC_CLASS": "'DOC'", "FORMAT_VERSION": "'2.2'", "GENERATED": "'2025-01-01T00:00:00'", "CONTENT_HASH": "substr(sha256(content), 1, 16)",
        "FILE_STEM": "file_stem", "LANG": "upper(language)", "TRIBUNAL": "upper(tribunal)", "TRIBUNAL_RANK": "tribunal_rank",
        "DECISION_DATE": "publication_date", "CITATION": "citation", "KEYWORDS": "keywords", "RETRIEVAL_ANCHOR": _FLAT, "PDF_LINK": "pdf_link",
        "WEB_LINK": "web_link", "BLOB_PATH": "metadata_relpath", "SOURCE_NAME": "source_name", "PAGE_COUNT": "page_count", "CONTENT_LENGTH": "length(content)",
    }.items()
)
_OF_RECORDS = "SELECT id AS k, content AS t FROM r"
_OF_DOCUMENTS = "SELECT doc_id AS k, text AS t FROM documents WHERE text IS NOT NULL"
_PRINTABLE = "length(regexp_replace(t, '[\\x00-\\x08\\x0e-\\x1b\\x7f-\\x{84}\\x{86}-\\x{9f}\\p{Cf}\\p{Co}]', '', 'g'))"
_CASE_KEY = f"""substr(coalesce(nullif(regexp_replace(regexp_replace({_strip("citation")}, '{_WS}+', '-', 'g'), '[^A-Za-z0-9-]', '', 'g'), ''),
    nullif(CASE WHEN len(string_split(file_stem, '_')) = 2 THEN string_split(file_stem, '_')[2]
                WHEN len(string_split(file_stem, '_')) > 2 THEN array_to_string(string_split(file_stem, '_')[2:-2], '_') END, ''), id), 1, 50)"""
_DAY = """CASE WHEN regexp_full_match(trim(replace(replace(publication_date, '-', ''), '/', '')), '[0-9]{8}')
       THEN trim(replace(replace(publication_date, '-', ''), '/', '')) ELSE '99999999' END"""
_FOLDER = "CASE WHEN lower(tribunal) IN ('scc', 'fca', 'fc', 'sst', 'unknown') THEN lower(tribunal) ELSE 'unknown' END"
_T = "coalesce(content, '')"
_GATES = [
    f"{_strip(_T)} <> ''", f"length({_T}) >= 100", f"(length({_T}) > 0 AND {_PRINTABLE.replace('(t,', f'({_T},')} >= 0.8::DOUBLE * length({_T}))",
    f"length({_T}) / greatest(page_count, 1) >= 200",
]
_PASSES = " AND ".join(_GATES)
_SCORE = " + ".join(f"({g})::INT" for g in _GATES)
_REFS = ", ".join("regexp_extract_all(text, '(?i)" + p.replace("'", "''") + "')" for p in STATUTE_PATTERNS)

SQL: dict[str, str] = {
    "p1_found": _CHANGES + "SELECT * FROM f",
    "p1_totals": _CHANGES + "SELECT snapshot_id, change_type, count(*) AS n FROM f GROUP BY ALL",
    "page_scan": """SELECT id, citation, publication_date FROM case_records WHERE content IS NOT NULL AND length(content) >= 100
        AND citation IS NOT NULL AND publication_date LIKE '201%'""",
    "page_blob_join": """SELECT r.id, r.blob_name, b.length AS blob_length FROM case_records r JOIN blobs b ON r.blob_name = b.name
        WHERE content IS NOT NULL AND length(content) >= 100 AND citation IS NOT NULL""",
    "missing_blobs": "SELECT DISTINCT blob_name FROM case_records r WHERE NOT EXISTS (SELECT 1 FROM blobs WHERE name = r.blob_name)",
    "extracted_records": "SELECT DISTINCT id FROM case_records WHERE id IN (SELECT case_id FROM extractions)",
    "case_assembly": """WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS x,
          unnest(range(1, len(string_split(text, chr(10) || chr(10))) + 1)) AS n FROM documents WHERE text IS NOT NULL),
        c AS (SELECT CAST(doc_id AS VARCHAR) AS case_id, coalesce(string_agg(x, chr(10) || chr(10) ORDER BY n) FILTER (x <> ''), '') AS content,
              CAST(count(*) AS INTEGER) AS page_count FROM p GROUP BY doc_id)
        SELECT case_id, page_count, length(content) AS content_length, substr(sha256(content), 1, 16) AS hash FROM c WHERE length(content) >= 1000""",
    "stratified_tribunal": _CLASSIFIED + f""" SELECT id, body, CASE body WHEN 'scc' THEN 1 WHEN 'fca' THEN 2 WHEN 'fc' THEN 3 WHEN 'sst' THEN 4 ELSE 5 END AS rank,
        row_number() OVER (PARTITION BY body ORDER BY {_ORDER.format(key="id")}) AS rn FROM (SELECT DISTINCT id, body FROM c) QUALIFY rn <= 5""",
    "stratified_year": f"""SELECT id, year, row_number() OVER (PARTITION BY year ORDER BY {_ORDER.format(key="id")}) AS rn
        FROM (SELECT DISTINCT id, coalesce(substr(publication_date, 1, 4), 'unknown') AS year FROM case_records) QUALIFY rn <= 3""",
    "stratified_tribunal_year": _CLASSIFIED + f""" SELECT id, body, year, row_number() OVER (PARTITION BY body, year ORDER BY {_ORDER.format(key="id")}) AS rn
        FROM (SELECT DISTINCT id, body, coalesce(substr(publication_date, 1, 4), 'unknown') AS year FROM c) QUALIFY rn <= 2""",
    "proportional_sample": _CLASSIFIED + f""", d AS (SELECT DISTINCT metadata_relpath, body FROM c),
        r AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY {_ORDER.format(key="metadata_relpath")}) AS rn,
              min(metadata_relpath) OVER (PARTITION BY body) AS head FROM d)
        SELECT metadata_relpath, body, rn FROM r WHERE rn <= ceil(100 / (SELECT count(DISTINCT body) FROM d)) ORDER BY head, rn LIMIT 100""",
    "yearly_inventory": """SELECT substr(publication_date, 1, 4) AS year, count(DISTINCT id) AS cases, count(*) AS n_rows FROM case_records
        WHERE publication_date IS NOT NULL AND publication_date <> '' GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
    "source_inventory": """SELECT source_name, count(DISTINCT id) AS cases, count(*) AS n_rows FROM case_records GROUP BY 1
        ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 30""",
    "content_presence": """SELECT source_name, count(*) AS n_rows, count(content) AS with_content,
        count(*) FILTER (length(content) > 1000) AS long_content FROM case_records GROUP BY 1""",
    "corpus_metrics": """SELECT lang, count(*) AS n_docs, coalesce(min(length(text)), 0) AS min_length, coalesce(max(length(text)), 0) AS max_length,
        CAST(coalesce(sum(length(text)) // count(text), 0) AS BIGINT) AS avg_length FROM documents GROUP BY 1""",
    "tribunal_distribution": _CLASSIFIED + " SELECT body, count(*) AS n FROM c GROUP BY 1",
    "group_distribution": _CLASSIFIED + " SELECT body || '_' || coalesce(substr(publication_date, 1, 4), 'unknown') AS group_key, count(*) AS n FROM c GROUP BY 1",
    "date_range": """SELECT lower(tribunal) AS court, min(publication_date) AS first, max(publication_date) AS last FROM case_records
        WHERE publication_date IS NOT NULL AND publication_date <> '' GROUP BY 1""",
    "recent_years": """SELECT substr(decision_date, 1, 4) AS year, count(*) AS n FROM case_inventory
        WHERE regexp_full_match(substr(decision_date, 1, 4), '[0-9]{4}') GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    "content_duplicates": """SELECT substr(sha256(text), 1, 16) AS hash, count(*) AS n, min(doc_id) AS first_id FROM documents
        WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "latest_extraction": """SELECT case_id, artifact_id, extraction_method, extraction_timestamp FROM extractions
        QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY extraction_timestamp DESC, artifact_id DESC, extraction_method) = 1""",
    "previous_snapshot": """WITH h AS (SELECT DISTINCT snapshot_id, scope_id, timestamp FROM snapshots),
        r AS (SELECT *, row_number() OVER (PARTITION BY scope_id ORDER BY timestamp DESC, snapshot_id DESC) AS r FROM h)
        SELECT a.snapshot_id, b.snapshot_id AS previous_id FROM r a LEFT JOIN r b
        ON a.scope_id = b.scope_id AND b.r = CASE WHEN a.r = 1 THEN 2 ELSE 1 END""",
    "last_delivery_status": _CHANGES + """, z AS (SELECT scope_id, max(seq) AS m FROM o GROUP BY 1),
        a AS (SELECT p.* FROM p JOIN z USING (scope_id) WHERE seq = m), b AS (SELECT p.* FROM p JOIN z USING (scope_id) WHERE seq = m - 1)
        SELECT coalesce(a.scope_id, b.scope_id) AS scope_id, CASE WHEN b.case_id IS NULL THEN 'new' WHEN a.case_id IS NULL THEN 'deleted'
          WHEN a.hash IS DISTINCT FROM b.hash THEN 'changed' ELSE 'unchanged' END AS status, count(*) AS n
        FROM a FULL JOIN b ON a.scope_id = b.scope_id AND a.case_id = b.case_id GROUP BY ALL""",
    "extraction_rollup": """SELECT CASE WHEN grouping(extraction_method) = 1 THEN 'all' ELSE extraction_method END AS method, count(*) AS runs,
        CAST(sum(char_count) AS BIGINT) AS chars, count(DISTINCT case_id) AS cases FROM extractions GROUP BY ROLLUP (extraction_method)""",
    "quality_sets": """SELECT grouping_id(extraction_method, language) AS level, extraction_method, language, count(*) AS runs,
        round(avg(quality_score), 6) AS mean_quality FROM extractions GROUP BY GROUPING SETS ((extraction_method), (language), ())""",
    "flag_counts": """WITH e AS (SELECT unnest(map_entries(quality_flags)) AS e FROM extractions)
        SELECT e.key AS flag, count(*) FILTER (e.value) AS passed, count(*) FILTER (NOT e.value) AS failed FROM e GROUP BY 1""",
    "coverage": """WITH r AS (SELECT DISTINCT id, lower(tribunal) AS court FROM case_records)
        SELECT court, count(*) AS n_cases, round(count(*) FILTER (id IN (SELECT case_id FROM extractions)) / count(*), 6) AS covered FROM r GROUP BY 1""",
    "freshness": """WITH d AS (SELECT source, date_diff('day', try_strptime(decision_date, '%Y-%m-%d')::DATE, ingested_at::DATE) AS days
          FROM documents WHERE regexp_full_match(decision_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}'))
        SELECT source, min(days) AS least, max(days) AS most, count(days) AS n FROM d GROUP BY 1""",
    "record_search": """SELECT DISTINCT id, tribunal_rank, publication_date FROM case_records WHERE lower(tribunal) IN ('scc', 'fca')
        AND lower(language) = 'en' AND publication_date BETWEEN '2005' AND '2020' ORDER BY tribunal_rank, publication_date DESC, id LIMIT 20""",
    "record_names": _NAMES,
    "file_names": f"""WITH b AS (SELECT DISTINCT id, {_slug("source_name")} || '_' || coalesce(substr(publication_date, 1, 4), 'unknown') AS base FROM case_records),
        n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY id) AS n FROM b)
        SELECT id, base || CASE WHEN n > 1 THEN '_v' || n ELSE '' END || '.txt' AS file_name FROM n""",
    "inventory_slugs": f"SELECT {_slug('title', 30)} AS slug, count(*) AS n FROM case_inventory GROUP BY 1",
    "sentence_truncation": f"SELECT doc_id, length(t) AS n, md5(t) AS digest FROM ({_TRUNCATED})",
    "top_terms": f"""WITH s AS (SELECT doc_id, regexp_split_to_array(lower(regexp_replace(regexp_replace(regexp_replace(text,
            'https?://\\S+', '', 'g'), 'www\\.\\S+', '', 'g'), '\\S+@\\S+', '', 'g')), '[^\\p{{L}}\\p{{N}}_]+') AS w FROM documents WHERE text IS NOT NULL),
        k AS (SELECT doc_id, list_filter(w, lambda x: regexp_full_match(x, '[{_LETTERS}][{_LETTERS}0-9]*')) AS w FROM s),
        t AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM k),
        c AS (SELECT doc_id, word, count(*) AS n, min(pos) AS first FROM t WHERE length(word) >= 4
              AND word NOT IN ({_list(STOP_WORDS | (SURNAMES - LEXICON.keys()))}) GROUP BY ALL)
        SELECT doc_id, word, CAST(n AS INTEGER) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS place FROM c WHERE n >= 2 QUALIFY place <= 7""",
    "discovery_anchor": f"WITH {_anchors(_OF_DOCUMENTS)} SELECT k AS doc_id, anchor FROM anchors",
    "document_keywords": f"WITH {_keywords(_OF_DOCUMENTS)} SELECT k AS doc_id, keywords FROM terms",
    "phrase_counts": "SELECT doc_id, phrase, CAST(n AS INTEGER) AS n FROM (" + " UNION ALL ".join(
        f"SELECT doc_id, '{_q}' AS phrase, {_count('lower(text)', _q)} AS n FROM documents"
        for _q in (p.replace("'", "''") for p in LEXICON if " " in p)) + ") WHERE n > 0",
    "page_bases": """SELECT CAST(doc_id AS VARCHAR) AS base, sum(len(string_split(text, chr(10) || chr(10))))::BIGINT AS n_pages FROM documents
        WHERE text IS NOT NULL GROUP BY 1""",
    "link_ids": r"""SELECT id, coalesce(nullif(regexp_extract(pdf_link, '/decisions/[a-z]{2}/([0-9]+)/', 1), ''),
        nullif(regexp_extract(metadata_relpath, '_([0-9]+)(?:_[a-z]{2})?\.pdf$', 1), '')) AS number FROM (SELECT DISTINCT * FROM case_records)""",
    "export_names": f"""WITH b AS (SELECT DISTINCT id, upper(coalesce(language, 'unknown')) || '_' || tribunal_rank || '-' || {_FOLDER} || '_' || {_DAY} || '_' ||
          {_slug(_CASE_KEY, 30)} || '_' || coalesce(nullif(regexp_extract(file_stem, '_([0-9]+)_[a-z]{{2}}$', 1), ''), {_slug("right(id, 12)", 12)}) AS base FROM case_records),
        n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY id) AS n FROM b)
        SELECT id, base || CASE WHEN n > 1 THEN '_v' || n ELSE '' END || '.ecl.txt' AS file_name FROM n""",
    "language_checks": f"""WITH d AS (SELECT doc_id, lang, {_two("lower(coalesce(text, ''))", FRENCH_SIGNS_LONG, ENGLISH_SIGNS_LONG)} AS found FROM documents)
        SELECT doc_id, found, found = 'bi' OR coalesce(lower(substr(trim(lang), 1, 2)) = found, false) AS consistent FROM d""",
    "hash_check": f"""SELECT DISTINCT id, substr(sha256(content), 1, 16) AS content_hash FROM case_records
        WHERE content IS NOT NULL AND sha256(content) <> sha256({_strip("content")})""",
    "extraction_choice": """WITH x AS (SELECT *, len(map_values(quality_flags)) > 0 AND len(list_filter(map_values(quality_flags), lambda v: NOT v)) = 0 AS passed,
          row_number() OVER (PARTITION BY case_id, extraction_method ORDER BY extraction_timestamp DESC, artifact_id DESC) AS n FROM extractions),
        a AS (SELECT * FROM x WHERE n = 1 AND extraction_method = 'text_layer'), b AS (SELECT * FROM x WHERE n = 1 AND extraction_method = 'ocr')
        SELECT coalesce(a.case_id, b.case_id) AS case_id, CASE WHEN a.passed OR b.case_id IS NULL THEN a.artifact_id ELSE b.artifact_id END AS artifact_id,
          CASE WHEN a.passed OR b.case_id IS NULL THEN 'text_layer' ELSE 'ocr' END AS extraction_method,
          CASE WHEN a.passed OR b.case_id IS NULL THEN a.passed ELSE b.passed END AS passed FROM a FULL JOIN b ON a.case_id = b.case_id""",
    "marked_records": f"WITH RECURSIVE {_BODIES} SELECT id, body AS document FROM bodies",
    "record_documents": f"""WITH RECURSIVE {_BODIES}, {_keywords(_OF_RECORDS)}, {_anchors(_OF_RECORDS)},
        d AS (SELECT id, body, {_HEADER} || chr(10) || chr(10) || body AS document FROM r JOIN bodies USING (id) JOIN terms ON terms.k = id JOIN anchors ON anchors.k = id)
        SELECT id, length(document) AS n_chars, md5(document) AS digest, CASE WHEN length(body) < 1000 THEN 'short_body' ELSE '' END AS errors FROM d""",
    "record_previews": f"""WITH {_RECORDS}, {_keywords(_OF_RECORDS)}, {_anchors(_OF_RECORDS)},
        d AS (SELECT id, {_HEADER} || chr(10) || chr(10) || array_to_string(string_split(content, chr(10))[1:20], chr(10)) || chr(10) || chr(10) ||
          '[... content continues ...]' AS p FROM r JOIN terms ON terms.k = id JOIN anchors ON anchors.k = id)
        SELECT id, length(p) AS n_chars, md5(p) AS digest FROM d""",
    "content_warnings": f"""WITH r AS (SELECT id, coalesce(content, '') AS t, greatest(page_count, 1) AS pages FROM (SELECT DISTINCT * FROM case_records))
        SELECT id, array_to_string(list_filter([CASE WHEN {_strip("t")} = '' THEN 'CRITICAL: Empty content' END,
          CASE WHEN length(t) < 100 THEN 'Short content: ' || length(t) || ' chars' END,
          CASE WHEN NOT (length(t) > 0 AND {_PRINTABLE} >= 0.8::DOUBLE * length(t)) THEN printf('Low readability: %.1f%%', {_PRINTABLE} / greatest(length(t), 1) * 100) END,
          CASE WHEN length(t) / pages < 200 THEN 'Sparse pages: ' || CAST(floor(length(t) / pages + 0.5) AS BIGINT) || ' chars/page (threshold: 200)' END],
          lambda x: x IS NOT NULL), '|') AS warnings FROM r""",
    "last_delivery_rows": _CHANGES + """SELECT snapshot_id, count(*) AS n_rows, count(DISTINCT case_id) AS n_cases FROM k
        WHERE snapshot_id IN (SELECT snapshot_id FROM o QUALIFY seq = max(seq) OVER (PARTITION BY scope_id)) GROUP BY 1""",
    "validated_search": f"""SELECT DISTINCT id, publication_date FROM case_records WHERE lower(tribunal) = 'sst' AND {_PASSES}
        ORDER BY publication_date DESC NULLS LAST, id LIMIT 20""",
    "review_list": f"""SELECT DISTINCT id, ({_SCORE}) / 4.0::DOUBLE AS score FROM case_records
        WHERE lower(substr(trim(language), 1, 2)) = 'en' AND NOT ({_PASSES})""",
    "run_metrics": """SELECT count(*) AS total_cases, count(*) FILTER (lower(substr(language, 1, 2)) = 'en') AS english_cases,
        count(*) FILTER (lower(substr(language, 1, 2)) = 'fr') AS french_cases, coalesce(min(length(content)), 0) AS min_length,
        coalesce(max(length(content)), 0) AS max_length, CAST(coalesce(sum(length(content)) // count(content), 0) AS BIGINT) AS avg_length,
        CAST(count(DISTINCT tribunal) AS INTEGER) AS n_bodies FROM case_records""",
    "vector_recall": _NEAREST + """, z AS (SELECT label, count(*) - 1 AS relevant FROM embeddings GROUP BY 1),
        h AS (SELECT query_id, want, CAST(count(*) FILTER (label = want) AS BIGINT) AS hits FROM r GROUP BY ALL)
        SELECT query_id, hits, relevant, CASE WHEN relevant > 0 THEN hits / relevant ELSE 0.0 END AS recall FROM h JOIN z ON want = label""",
    "statute_references": f"""WITH r AS (SELECT doc_id, list_sort(list_distinct(list_transform(flatten([{_REFS}]), lambda x: {_strip("lower(x)")}))) AS refs
        FROM documents WHERE text IS NOT NULL) SELECT doc_id, CAST(len(refs) AS INTEGER) AS n_refs, array_to_string(refs, '|') AS refs FROM r""",
    "document_chunks": _CHUNKS,
    "quality_gates": f"""WITH r AS (SELECT id, coalesce(content, '') AS t, page_count FROM (SELECT DISTINCT * FROM case_records)),
        g AS (SELECT id, {_strip("t")} <> '' AS non_empty, length(t) >= 100 AS min_length, length(t) > 0 AND length(regexp_replace(t,
          '[\\x00-\\x08\\x0e-\\x1b\\x7f-\\x{{84}}\\x{{86}}-\\x{{9f}}\\p{{Cf}}\\p{{Co}}]', '', 'g')) >= 0.8::DOUBLE * length(t) AS readable,
          length(t) / greatest(page_count, 1) >= 200 AS coverage FROM r)
        SELECT *, (non_empty::INT + min_length::INT + readable::INT + coverage::INT) / 4.0::DOUBLE AS score FROM g""",
    "language_by_signs": f"""WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents), c AS (SELECT doc_id, t, {_FRENCH} AS f, {_ENGLISH} AS e FROM d)
        SELECT doc_id, CASE WHEN t = '' THEN 'en' WHEN f > 2 * e THEN 'fr' WHEN e > 2 * f THEN 'en' ELSE 'bi' END AS found FROM c""",
    "record_checks": f"""WITH r AS (SELECT id, {_failing(_CHECKS)} AS f FROM (SELECT DISTINCT * FROM case_records))
        SELECT id, CAST(len(f) AS INTEGER) AS n_failed, array_to_string(f, '|') AS failed FROM r""",
    "manifest": f"""WITH r AS (SELECT * REPLACE (coalesce(content, '') AS content) FROM (SELECT DISTINCT * FROM case_records)),
        {_keywords(_OF_RECORDS)}, {_anchors(_OF_RECORDS)}
        SELECT id, citation, lower(tribunal) AS court, tribunal_rank, page_count, length(content) AS content_length, substr(sha256(content), 1, 16) AS content_hash,
          keywords, CASE WHEN length(anchor) > 100 THEN substr(anchor, 1, 100) || '...' ELSE anchor END AS anchor,
          array_to_string({_failing(_EXCEPTIONS)}, '|') AS exceptions
        FROM r JOIN terms ON terms.k = id JOIN anchors ON anchors.k = id""",
    "canonical_cases": f"""WITH p AS (SELECT doc_id, {_strip("x")} AS x, n FROM (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS x,
          unnest(range(len(string_split(text, chr(10) || chr(10))))) AS n FROM documents WHERE text IS NOT NULL)),
        c AS (SELECT CAST(doc_id AS VARCHAR) AS case_id, count(*) AS pages, coalesce(string_agg(CASE WHEN n = 0 THEN '' ELSE '[p.' || n || '] ' END || x,
          chr(10) || chr(10) ORDER BY CASE WHEN n = 0 THEN 999999 ELSE n END) FILTER (x <> ''), '') AS content FROM p GROUP BY doc_id)
        SELECT case_id, pages, md5(content) AS digest, case_id || '_' || {_two("lower(content)", FRENCH_SIGNS_LONG, ENGLISH_SIGNS_LONG)} || '_' ||
          substr(sha256(content), 1, 8) AS canonical_id FROM c""",
    "compact_markers": f"""WITH r AS (SELECT id, length(tribunal) AS nt, upper(language) AS l, upper(tribunal) AS t, tribunal_rank AS k,
          CASE WHEN regexp_full_match(trim(replace(replace(publication_date, '-', ''), '/', '')), '[0-9]{{8}}')
               THEN trim(replace(replace(publication_date, '-', ''), '/', '')) ELSE '99999999' END AS d,
          trim(coalesce(citation, '')) AS c, file_stem AS s FROM (SELECT DISTINCT * FROM case_records)),
        w AS (SELECT *, '[DOC|MH00000|' || coalesce(l, '') || '|' || t || '|R' || k || '|' || d || '|' || c || '|' || s || ']' AS m FROM r)
        SELECT id, CASE WHEN length(m) <= 160 THEN m END AS marker FROM w""",
    "vector_neighbours": _NEAREST + "SELECT query_id, vec_id, rank FROM r",
    "vector_precision": _NEAREST + "SELECT query_id, count(*) FILTER (label = want) AS hits, count(*) FILTER (label = want) / 10.0::DOUBLE AS precision FROM r GROUP BY 1",
}
