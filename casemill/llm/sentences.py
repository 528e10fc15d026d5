"""Sentence units of texts in any script, by statistics learnt from the texts themselves.

A first pass counts, over every text and apart for each language, the words that a
period follows, what comes after them and which words open paragraphs.  From these
counts log-likelihood ratios find abbreviations, titles that never end a sentence,
pairs that a period doesn't part, and words that open sentences; for scripts which
part sentences by a space, the phrases that end paragraphs.  A second pass decides
each place where a sentence could end by these tables.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.session import materialise

#: Frequent function words that tell the languages in Latin script apart.
FUNCTION_WORDS = {
    "en": "the of and to that for is with by at from which not are this had has be were their who".split(),
    "fr": "le les du et une dans pour sur par au aux est été avec ce cette ne pas sans ont sont qui leur".split(),
    "es": "el los las del una por con su fue más sin hasta según como pero son ha".split(),
    "de": "der die das und ist nicht ein eine den dem von zu mit auf für im wird bis keine hat sie".split(),
}
#: Words that only one of the languages has.
_LANGUAGE_OF = {w: l for l, ws in FUNCTION_WORDS.items() for w in ws if sum(w in o for o in FUNCTION_WORDS.values()) == 1}
_KNOWN = frozenset(_LANGUAGE_OF)
#: The most rows of learnt tables that are sent to the workers; a corpus with more is refused.
MAX_LEARNT = 3_000_000
#: Words with more characters are counted by a digest.
LONG_WORD = 40

BREAK = re.compile(r"\n\s*\n")
_WORD = re.compile(r"[^\W\d_]+")
_SCRIPTS = [
    ("th", re.compile("[฀-๿]")),
    ("ja", re.compile("[぀-ヿ]")),
    ("zh", re.compile("[㐀-鿿]")),
    ("hi", re.compile("[ऀ-ॿ]")),
    ("ar", re.compile("[؀-ۿ]")),
]
#: Places to decide: a run of final marks with the closing marks after it.
_MARK = re.compile(r"([.!?…。！？｡।॥؟۔]+)([\"'”’“»)\]」』）】]*)")
_OTHER_SCRIPT = re.compile("[\u0600-\u06ff\u0900-\u097f\u0e00-\u0e7f\u3040-\u30ff\u3400-\u9fff]")
_NEXT = re.compile(r"\s*(\S+)")
#: What may stand between a sentence's end and the first letter or figure of the next.
_FIRST = re.compile("[\"'“”„«»‘’([{¿¡*_\\-–— \xa0\u202f\n\r\t]*(.?)", re.S)
_OPENING = re.compile("[\"«“„「『(\\[（]")
_CLOSERS = {'"': '"', "«": "»", "“": "”", "„": "“”", "「": "」", "『": "』", "(": ")", "[": "]", "（": "）"}
_LABEL = re.compile(r"\s*(?:\[\w{1,5}\]|\(\w{1,5}\)|[¶§№]\s*\d+[.)]?|(?:\d{1,4}|[ivxlcIVXLC]{1,6}|[A-Za-z])[.)](?:\d+[.)]?)*)(?=\s)")
_QUOTES = re.compile(r"«[^«»]*»|“[^“”]*”|„[^„“”]*[“”]|「[^「」]*」|『[^『』]*』|\"[^\"]*\"")
_EDGE = "\"'“”„«»‘’()[]{}¿¡,;:?!…"


def language_of(text: str) -> str:
    """A rough language for the choice of statistics: by script, else by function words."""
    if not text.isascii() and _OTHER_SCRIPT.search(text):
        total = len(_WORD.findall(text))
        for name, letters in _SCRIPTS:
            n = len(letters.findall(text))
            if n and n * 3 >= total:
                return name
    hits = _KNOWN.intersection(text.split()) or _KNOWN.intersection(text.lower().split())
    if not hits:
        return "xx"
    found = [_LANGUAGE_OF[w] for w in hits]
    return max(found, key=lambda k: (found.count(k), k))


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """Places of the paragraphs: what stands between empty lines, without outer white space."""
    start = 0
    for m in BREAK.finditer(text):
        yield start, m.start()
        start = m.end()
    yield start, len(text)


def _short(word: str) -> str:
    """A word as it is, or the digest of one that is longer: every word counts, and no key is long."""
    return word if len(word) <= LONG_WORD else "\1" + blake2b(word.encode("utf-8", "replace"), digest_size=16).hexdigest()


@functools.lru_cache(maxsize=200_000)
def word_type(token: str) -> str:
    """A token in lower case without what encloses it and without its last period; figures as 0."""
    t = token.strip(_EDGE).lower()
    t = t[:-1] if t.endswith(".") else t
    return _short(re.sub(r"\d+", "0", t.strip(_EDGE)))


def phrase_type(phrase: str) -> str:
    return _short(re.sub(r"\d+", "0", re.sub(r"[A-Za-z]+", "a", phrase)))


def count_batch(texts: list[str | None]) -> Counter:
    """(lang, kind, a, b) counts. Kinds: w word, p word with a period and the word after it, f and e
    the first and the last word of a paragraph, m the mark that it ends with, s a phrase between spaces (b: 1 if it ends a paragraph)."""
    words: dict[str, Counter] = {}
    pairs: dict[str, Counter] = {}
    out: Counter = Counter()
    for text in texts:
        if not text:
            continue
        for start, end in paragraphs(text):
            part = text[start:end].strip()
            if not part:
                continue
            lang = language_of(part)
            tokens = part.split()
            if lang == "th":
                for k, x in enumerate(tokens):
                    out[lang, "s", phrase_type(x), "1" if k == len(tokens) - 1 else "0"] += 1
                continue
            label = _LABEL.match(part)
            body = part[label.end() :] if label else part
            words.setdefault(lang, Counter()).update(tokens)
            # what is said inside quotations would pass for the sentence around them
            said = any(q in body for q in "\"«“„「")
            outside = _QUOTES.sub(" ", body).split() if said else tokens[len(label.group().split()) if label else 0 :]
            stops = " ".join(outside).split(". ")
            pairs.setdefault(lang, Counter()).update(
                [(x[x.rfind(" ") + 1 :] + ".", y.split(" ", 1)[0]) for x, y in zip(stops, stops[1:], strict=False) if x and y and x[-1] != " "]
            )
            opening = body.split(None, 1)[:1]
            out[lang, "f", word_type(opening[0]) if opening else "", ""] += 1
            mark = _MARK.search(tokens[-1][-6:])
            if mark:
                out[lang, "m", mark.group(1)[-1], ""] += 1
            last = tokens[-1].strip(_EDGE).lower()
            out[lang, "e", last if len(last) <= LONG_WORD else word_type(last) + "." * last.endswith("."), ""] += 1
    for lang, found in words.items():
        for token, n in found.items():
            bare = token.strip(_EDGE)
            if not bare:
                continue
            case = "u" if bare[0].isupper() else "l" if bare[0].islower() else "o"
            out[lang, "w", word_type(token), case + ("." if bare.endswith(".") else "")] += n
    for lang, found in pairs.items():
        for (a, b), n in found.items():
            bare = b.lstrip(_EDGE)
            case = "l" if bare[:1].islower() else "d" if bare[:1].isdigit() else "u" if bare[:1].isupper() else "o"
            out[lang, "p", word_type(a), case + word_type(b)] += n
    return out


class Statistics(NamedTuple):
    """What the corpus says of each language's words; all sets hold (lang, word) or (lang, word, word)."""

    abbreviations: set
    titles: set
    starters: set
    collocations: set
    endings: set
    periods: set  # (lang, mark) where a period ends paragraphs


def log_likelihood(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Dunning's ratio for k1 of n1 against k2 of n2, positive where the first share is the greater."""

    def part(k: Column, n: Column, p: Column) -> Column:
        q = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.ln(q) + (n - k) * F.ln(1 - q)

    p1, p2, p = k1 / F.greatest(n1, F.lit(1)), k2 / F.greatest(n2, F.lit(1)), (k1 + k2) / F.greatest(n1 + n2, F.lit(1))
    ratio = 2 * (part(k1, n1, p1) + part(k2, n2, p2) - part(k1, n1, p) - part(k2, n2, p))
    return F.when(p1 > p2, ratio).otherwise(-ratio)


def corpus_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(lang, kind, a, b, n) over all texts: counted for each batch, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            keys = list(total)
            return pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k in keys], pa.string()) for i in range(4)), pa.array([total[k] for k in keys], pa.int64())],
                names=["lang", "kind", "a", "b", "n"],
            )

        for batch in batches:
            total.update(count_batch(batch.column(0).to_pylist()))
            if len(total) > 500_000:
                yield rows()
                total = Counter()
        yield rows()

    counted = texts.select(text).mapInArrow(count, "lang string, kind string, a string, b string, n bigint")
    return counted.groupBy("lang", "kind", "a", "b").agg(F.sum("n").alias("n"))


def learn(counts: DataFrame, significance: float = 7.88) -> Statistics:
    """The tables of the second pass; ``significance`` is the least log-likelihood ratio (p = 0.005)."""
    n = F.col("n")

    def total(kind: str, *conditions: Column) -> Column:
        where = F.col("kind") == kind
        for c in conditions:
            where &= c
        return F.sum(F.when(where, n).otherwise(0))

    after = F.substring("b", 1, 1)
    by_word = counts.where("kind IN ('w', 'p', 'f')").groupBy("lang", "a").agg(
        total("w", ~F.col("b").endswith(".")).alias("plain"),
        total("w", F.col("b").endswith(".")).alias("dotted"),
        total("w", F.col("b").startswith("l")).alias("lower"),
        total("w", F.col("b").startswith("u")).alias("upper"),
        total("f").alias("opens"),
        total("p").alias("goes_on"),
        total("p", after.isin("l", "d")).alias("low_after"),
    )
    # upper-case words after a word with a period, by the word after
    next_word = (
        counts.where(F.col("kind") == "p")
        .where(after == "u")
        .groupBy("lang", F.expr("substring(b, 2)").alias("a"))
        .agg(F.sum("n").alias("after_period"))
    )
    words = by_word.join(next_word, ["lang", "a"], "left").fillna(0, ["after_period"])
    # a word that is mostly written small, but in upper case at the start of paragraphs and after periods
    is_starter = (F.col("lower") >= 2) & (F.col("upper") >= 4) & (F.col("opens") + F.col("after_period") >= 3) & (
        F.col("upper") - F.col("opens") - F.col("after_period") <= 0.2 * F.col("upper")
    )
    words = materialise(words.withColumn("starter", is_starter))
    starters = words.where("starter AND a <> ''").select("lang", "a")
    follow = (
        counts.where(F.col("kind") == "p")
        .select("lang", "a", F.expr("substring(b, 2)").alias("next"), after.alias("case"), "n")
        .join(starters.select("lang", F.col("a").alias("next"), F.lit(1).alias("s")), ["lang", "next"], "left")
    )
    ends = counts.where("kind = 'e' AND a LIKE '%.'").select("lang", F.regexp_replace(F.regexp_replace("a", r"\.$", ""), r"\d+", "0").alias("a"), "n")
    ending = ends.groupBy("lang", "a").agg(F.sum("n").alias("closes"))
    typed = (
        follow.groupBy("lang", "a")
        .agg(
            F.sum("n").alias("goes_on"),
            F.sum(F.when(F.col("case").isin("l", "d"), n).otherwise(0)).alias("low"),
            F.sum(F.when((F.col("case") == "u") & F.col("s").isNotNull(), n).otherwise(0)).alias("start"),
        )
        .join(ending, ["lang", "a"], "left")
        .fillna(0, ["closes"])
        .join(words.select("lang", "a", "plain", "dotted"), ["lang", "a"])
    )
    whole = typed.groupBy("lang").agg(
        F.sum("goes_on").alias("all_on"), F.sum("low").alias("all_low"), F.sum("start").alias("all_start"), F.sum("closes").alias("all_closes")
    )
    judged = typed.join(whole, "lang").where("a <> '' AND a <> '0'")
    # goes on in lower case or with a figure more often than chance allows, and isn't often without its period
    is_abbreviation = (
        (log_likelihood(F.col("low"), F.col("goes_on"), F.col("all_low") - F.col("low"), F.col("all_on") - F.col("goes_on")) >= significance)
        & (F.col("low") >= 2)
        & (F.col("low") >= 0.05 * F.col("goes_on"))
        & ((F.col("plain") <= F.col("dotted")) | (F.length("a") <= 4) & (F.col("plain") <= 4 * F.col("dotted")))
    )
    # hardly ever before a sentence's first word or at a paragraph's end, where other words often are
    closing = F.col("start") + F.col("closes")
    is_title = (
        (closing <= 0.03 * (F.col("goes_on") + F.col("closes")))
        & (F.col("goes_on") - F.col("low") >= 3)
        & (F.col("plain") <= F.col("dotted"))
        & (
            log_likelihood(
                F.col("all_start") + F.col("all_closes") - closing,
                F.col("all_on") + F.col("all_closes") - F.col("goes_on") - F.col("closes"),
                closing,
                F.col("goes_on") + F.col("closes"),
            )
            >= significance
        )
    )
    judged = judged.select("lang", "a", F.coalesce(is_abbreviation, F.lit(False)).alias("abbr"), F.coalesce(is_title, F.lit(False)).alias("title"))
    # figures or short words with a period that a certain word in upper case follows, as in dates
    own = words.select("lang", F.col("a").alias("next"), F.col("upper"))
    figures = follow.where("a = '0' AND case = 'u' AND s IS NULL").groupBy("lang", "a", "next").agg(F.sum("n").alias("together"))
    figure_total = follow.where("a = '0'").groupBy("lang").agg(F.sum("n").alias("figures"))
    all_words = words.groupBy("lang").agg(F.sum(F.col("plain") + F.col("dotted")).alias("tokens"))
    collocations = (
        figures.join(own, ["lang", "next"]).join(figure_total, "lang").join(all_words, "lang")
        .where(F.col("together") >= 0.5 * F.col("upper"))
        .where(log_likelihood(F.col("together"), F.col("upper"), F.col("figures") - F.col("together"), F.col("tokens") - F.col("upper")) >= significance)
        .select("lang", "a", "next")
    )
    phrases = counts.where("kind = 's'").groupBy("lang", "a").agg(
        F.sum("n").alias("seen"), F.sum(F.when(F.col("b") == "1", n).otherwise(0)).alias("final")
    )
    phrase_totals = phrases.groupBy("lang").agg(F.sum("seen").alias("all_seen"), F.sum("final").alias("all_final"))
    ratio = log_likelihood(F.col("final"), F.col("seen"), F.col("all_final") - F.col("final"), F.col("all_seen") - F.col("seen"))
    endings = phrases.join(phrase_totals, "lang").where(
        (ratio > 0) | (ratio > -significance) & (F.col("final") >= 1) & (F.col("final") >= 0.1 * F.col("seen"))
    )
    # in a language whose paragraphs hardly ever end with a period, a period is part of an abbreviation
    marks = counts.where("kind = 'm'").groupBy("lang").agg(
        F.sum("n").alias("all_marks"), F.sum(F.when(F.col("a") == ".", n).otherwise(0)).alias("periods")
    ).where("periods >= 0.02 * all_marks")
    tables = (
        judged.where("abbr").select(F.lit("abbr").alias("t"), "lang", "a", F.lit("").alias("b"))
        .unionByName(judged.where("title").select(F.lit("title").alias("t"), "lang", "a", F.lit("").alias("b")))
        .unionByName(starters.select(F.lit("start").alias("t"), "lang", "a", F.lit("").alias("b")))
        .unionByName(collocations.select(F.lit("pair").alias("t"), "lang", "a", F.col("next").alias("b")))
        .unionByName(endings.select(F.lit("end").alias("t"), "lang", "a", F.lit("").alias("b")))
        .unionByName(marks.select(F.lit("period").alias("t"), "lang", F.lit(".").alias("a"), F.lit("").alias("b")))
    )
    rows = tables.limit(MAX_LEARNT + 1).collect()
    if len(rows) > MAX_LEARNT:
        raise ValueError(f"more than {MAX_LEARNT} learnt words: raise the significance")
    of = {t: {(r["lang"], r["a"]) for r in rows if r["t"] == t} for t in ("abbr", "title", "start", "end", "period")}
    return Statistics(of["abbr"], of["title"], of["start"], {(r["lang"], r["a"], r["b"]) for r in rows if r["t"] == "pair"}, of["end"], of["period"])


_LETTER_PERIOD = re.compile(r"(?:^|[^\w])([^\W\d_])$")
_BRACKET_OF = {"(": re.compile(r"[()]"), "[": re.compile(r"[\[\]]"), "（": re.compile("[（）]")}
_CASELESS = {"zh", "ja", "th", "hi", "ar"}


def _brackets(part: str, opener: str) -> dict[int, int]:
    """Where each bracket of a kind that is closed ends, by its place."""
    out: dict[int, int] = {}
    open_: list[int] = []
    for m in _BRACKET_OF[opener].finditer(part):
        if m.group() == opener:
            open_.append(m.start())
        elif open_:
            out[open_.pop()] = m.end()
    return out


def enclosed(part: str) -> tuple[list[int], list[int]]:
    """Starts and ends of the quotations and brackets that aren't inside another; one that isn't closed is none.

    The text is read once for each kind of mark, however many are never closed.
    """
    starts: list[int] = []
    ends: list[int] = []
    brackets: dict[str, dict[int, int]] = {}
    closers: dict[str, int] = {}  # the next place of each closing mark; the end of the text where there is none
    until = 0
    for m in _OPENING.finditer(part):
        at = m.start()
        if at < until:
            continue
        opener = m.group()
        if opener in "([（":
            if opener not in brackets:
                brackets[opener] = _brackets(part, opener)
            end = brackets[opener].get(at, -1)
        else:
            end = len(part)
            for c in _CLOSERS[opener]:
                if closers.get(c, -1) <= at:
                    found = part.find(c, at + 1)
                    closers[c] = found if found >= 0 else len(part)
                end = min(end, closers[c])
            end = end + 1 if end < len(part) else -1
        if end > 0:
            starts.append(at)
            ends.append(end)
            until = end
    return starts, ends


def _ends_at(part: str, mark: re.Match, lang: str, st: Statistics, inside: tuple[list[int], list[int]]) -> int | None:
    """Where the unit ends if this mark ends a sentence; ``part`` doesn't end with white space."""
    at, end = mark.start(), mark.end()
    dots, close = mark.group(1), mark.group(2)
    if end == len(part):
        return end
    # a mark inside a quotation or brackets ends nothing, unless their end follows at once
    k = bisect_right(inside[0], at) - 1
    shut = k >= 0 and at < inside[1][k]
    if shut and (inside[1][k] > end or not close):
        return None
    if dots[-1] in "。！？｡":
        return None if shut else end
    first_after = part[end]
    if not first_after.isspace():
        # a space left out after a sentence: a whole word before, and an opening after
        before = part[max(0, at - 3) : at]
        whole = len(before) == 3 and "." not in before and (before[-1].islower() or before[-1].isdigit() or before[-1] in ")]")
        return end if not shut and whole and not close and (first_after.isupper() or first_after in "«“„¿¡(") else None
    if shut and lang in _CASELESS:
        return None
    following = _NEXT.match(part, end).group(1)
    first = following.lstrip("\"'“”„«»‘’([{¿¡*_-–—")[:1]
    if not first and following[0] in "«„“\"¿¡([":
        first = _FIRST.match(part, end + 1).group(1)
    if first.islower() or following[0] in ",;:)]»”":
        return None
    if dots[-1] in "!?…؟।॥۔" or dots.endswith(".."):
        return end
    begin = at
    while begin and not part[begin - 1].isspace():
        begin -= 1
    if begin == at:
        return end
    raw = part[begin:at]
    word = word_type(raw + ".")
    after = word_type(following)
    if lang in _CASELESS and dots == "." and (lang, ".") not in st.periods:
        return None
    if (lang, word, after) in st.collocations or (lang, word) in st.titles:
        return None
    starts = (lang, after) in st.starters
    single = _LETTER_PERIOD.search(raw)
    if single and single.group(1).isupper():
        return end if starts else None
    if (lang, word) in st.abbreviations:
        # after an abbreviation a figure goes on; so does a word, where all are in upper case
        return None if first.isdigit() or not starts and part.isupper() else end
    return end


def units(text: str, st: Statistics) -> list[tuple[int, int]]:
    """(start, end) of the sentence units of a text."""
    out = []
    for start, stop in paragraphs(text):
        part = text[start:stop]
        left = len(part) - len(part.lstrip())
        part = part.strip()
        if not part:
            continue
        start += left
        lang = language_of(part)
        cuts = []
        if lang == "th":
            for m in re.finditer(r"\S+(?=\s)", part):
                if (lang, phrase_type(m.group())) in st.endings:
                    cuts.append(m.end())
        else:
            label = _LABEL.match(part)
            skip = label.end() if label else 0
            inside = enclosed(part)
            for m in _MARK.finditer(part, skip):
                end = _ends_at(part, m, lang, st, inside)
                if end is not None and end < len(part):
                    cuts.append(end)
        ends = [0, *cuts, len(part)]
        for a, b in zip(ends, ends[1:], strict=False):
            piece = part[a:b]
            bare = piece.strip()
            if bare:
                a += len(piece) - len(piece.lstrip())
                out.append((start + a, start + a + len(bare)))
    return out


def sentence_units(documents: DataFrame, st: Statistics, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start_char, end_char) of every sentence unit, in code points from 0, end exclusive.

    NULL, empty and blank texts give no rows; repeated rows each give theirs. A unit
    never crosses an empty line and always ends with its paragraph.
    """
    shared = documents.sparkSession.sparkContext.broadcast(st)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        st = shared.value
        for batch in batches:
            at, starts, ends = [], [], []
            for k, whole in enumerate(batch.column(1).to_pylist()):
                for a, b in units(whole or "", st):
                    at.append(k)
                    starts.append(a)
                    ends.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                names=[key, "start_char", "end_char"],
            )

    return documents.select(key, text).mapInArrow(
        cut, f"`{key}` {dict(documents.dtypes)[key]}, start_char int, end_char int"
    )


def split_corpus(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learns from all texts, then gives the sentence units of each."""
    counts = materialise(corpus_counts(documents, text))
    return sentence_units(documents, learn(counts), key, text)
