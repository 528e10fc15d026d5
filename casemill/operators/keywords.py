"""Weighted keywords of documents.

A document's words are counted where the document is, batch by batch: nothing but the
few best leaves its row, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from casemill.functions.wordlists import LEXICON, STATUTE_PATTERNS, STOP_WORDS, SURNAMES

_WORD = re.compile("[a-zàâäæçèéêëïîôœùûüÿ][a-zàâäæçèéêëïîôœùûüÿ0-9]*")
_TOKENS = re.compile(r"\w+")
# each pattern reads a run of characters once, however long
_LINKS = [re.compile(p, re.A) for p in (r"https?://\S+", r"www\.\S+", r"(?<!\S)\S[^\s@]*+@\S+")]
_STATUTES = [re.compile(p, re.I | re.A) for p in STATUTE_PATTERNS]
#: Words of the lexicon never are surnames.
_BARRED = STOP_WORDS | (SURNAMES - LEXICON.keys())
_PHRASES = [(p, w) for p, w in LEXICON.items() if " " in p]


def without_links(text: str) -> str:
    """A text without addresses of pages and mail."""
    for pattern in _LINKS:
        text = pattern.sub("", text)
    return text


def word_counts(clean: str) -> dict[str, int]:
    """How often each word of four or more letters stands in a text, in the order of their first places.

    A word has only letters of the two languages and figures; stop words and surnames
    are left out.
    """
    words = _TOKENS.findall(clean.lower())
    return Counter(w for w in words if len(w) >= 4 and w not in _BARRED and _WORD.fullmatch(w))


def best_terms(text: str, most: int) -> list[str]:
    """The best words and phrases of a text.

    A word counts from two occurrences on, times its weight in the lexicon, and ten
    more if a statute reference of the text contains it; a phrase counts occurrences
    times weight. Equal scores keep words before phrases, and the order in the text.
    """
    clean = without_links(text)
    refs = {m.lower() for p in _STATUTES for m in p.findall(clean)}
    scored = [
        (n * LEXICON.get(w, 1.0) + (10.0 if any(w in r for r in refs) else 0.0), w) for w, n in word_counts(clean).items() if n >= 2
    ]
    lower = clean.lower()
    scored += [(lower.count(p) * w, p.replace(" ", "-")) for p, w in _PHRASES if p in lower]
    scored.sort(key=lambda x: -x[0])
    return [term for _, term in scored[:most]]


def top_words(text: Column, most: int = 7) -> Column:
    """The most frequent words of a text that it has twice or more, as (word, n); ties in the order of their first places."""

    @F.arrow_udf("array<struct<word: string, n: int>>")
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            counted = word_counts(without_links(text or ""))
            best = sorted((w for w, n in counted.items() if n >= 2), key=lambda w: -counted[w])[:most]
            rows.append([{"word": w, "n": counted[w]} for w in best])
        return pa.array(rows, pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())])))

    return find(text)


def keywords_of(text: Column, most: int = 7) -> Column:
    """The keywords of a text, joined by ", "; "none" without any, and for NULL."""

    @F.arrow_udf("string")
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([", ".join(best_terms(x or "", most)) or "none" for x in texts.to_pylist()], pa.string())

    return find(text)
