"""Repair of text from scanned pages.

Scans are told from born-digital texts by their lines, which are short and break
anywhere.  Running heads and page numbers are found by place and form.  Everything
else is a noisy channel: the language model are the words and word pairs of the
born-digital texts, the channel are the confusions of characters that words of scans
show against it and born-digital words don't.  Confusions turn the scans' odd words
into candidates, and Viterbi picks the best candidates line by line.  Words that a
line's end cuts are told from compounds by how often either form occurs elsewhere.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.sentences import log_likelihood
from casemill.session import materialise

MAX_LINE, MIN_RUN_ON = 110, 0.4
#: What a line of a scan is; what the furniture's kinds are called.
BLANK, BODY, HEADER, PAGE_NUMBER = "-", "b", "h", "p"
KINDS = {HEADER: "header", PAGE_NUMBER: "page_number"}
#: Bits of the filter that tells the workers which words may have candidates; its size is fixed, and false hits cost only time.
FILTER_BITS = 1 << 23
#: How often a line must stand at the heads of pages to be a running head without the form of one.
LEAST_HEADS = 3
#: The most confusions that go to the workers; writing systems have far fewer, and more are an error.
MAX_CONFUSIONS = 100_000
#: Weight of word pairs against single words in the language model, and what an unseen word counts.
PAIR_WEIGHT, UNSEEN = 0.7, 0.05
_END = re.compile(r"[.!?:;。»”\"]\s*$")
_HEAD = re.compile(r"(?:19|20)\d\d\s+\S{2,6}\s+(?:n[o°]\.?\s+)?\d+", re.I)
_VERSUS = re.compile(r"\s[vc]\.\s", re.I)
_PAGE = re.compile(
    r"(?:p[a-z0-9]{1,2}[g9][ec]\s+\d+(?:\s*(?:of|de|sur|/)\s*\d+)?|p\.\s*\d+(?:\s*/\s*\d+)?|[-–—]\s*\d+\s*[-–—]|\d+\s*[|\[]\s*p\s*a\s*g\s*e|\d{1,4})",
    re.I,
)
_HYPHENS = "-¬\xad‐"
_STRIP = ".,;:()[]«»“”\"?!…’‘ \xa0"
#: Words that may be misread: labels of sections and the like, with brackets or mostly of figures, aren't among them.
_WORDLIKE = r"^(?=(?:.*\p{L}){2})[^()\[\]{}]+$"
_LETTER = re.compile(r"[^\W\d_]")
_LETTERS = re.compile(r"[^\W\d_]+")
_WORD_PLACES = re.compile(r"\S+")


def is_scan(lines: list[str]) -> bool:
    """Whether lines are short as on paper and mostly break where no sentence ends."""
    filled = [x for x in lines if x and not x.isspace()]
    if not filled or sum(len(x) > MAX_LINE for x in filled) * 20 > len(filled):
        return False
    long = [x for x in filled if len(x) >= 35]
    return bool(long) and sum(not _END.search(x) for x in long) >= MIN_RUN_ON * len(long)


def head_form(line: str) -> str:
    """The letters of a line in lower case: what a running head keeps from page to page, whatever its number."""
    return "".join(_LETTERS.findall(line.lower()))


def running_heads(lines: list[str], kinds: list[str] | str) -> frozenset[str]:
    """Forms of the short lines that stand first after an empty line or the start LEAST_HEADS times, and nowhere else as often.

    A heading such as "Reasons" that a text repeats has nothing before it on its page but
    stands above an empty line; a running head stands directly on the page's text.
    """
    top: Counter = Counter()
    for k in range(len(lines) - 1):
        line = lines[k]
        if kinds[k] == BODY and (k == 0 or kinds[k - 1] == BLANK) and kinds[k + 1] == BODY and len(line) < MAX_LINE and not _END.search(line):
            top[head_form(line)] += 1
    often = {f: c for f, c in top.items() if c >= LEAST_HEADS and len(f) >= 5}
    if not often:
        return frozenset()
    everywhere = Counter(head_form(x) for x in lines if len(x) < MAX_LINE)
    return frozenset(f for f, c in often.items() if 2 * c > everywhere[f])


def _is_head(line: str, heads: frozenset[str]) -> bool:
    """Whether a line is a running head, a few of whose characters may be misread."""
    form = head_form(line)
    return form in heads or any(abs(len(form) - len(h)) < 3 and SequenceMatcher(None, form, h, False).ratio() >= 0.9 for h in heads)


def layout(lines: list[str]) -> str:
    """For each line of a scan: BLANK, HEADER, PAGE_NUMBER or BODY.

    Heads stand first on a page, page numbers first or last; pages begin at the start
    and after an empty line, as paragraphs may too. A head is told by its form, names
    and a citation, or by standing at the head of one page after the other.
    """
    kinds = [BLANK if not x or x.isspace() else BODY for x in lines]
    n = len(lines)
    heads = running_heads(lines, kinds)
    for k in range(n):
        if kinds[k] == BLANK:
            continue
        text = lines[k].strip()
        first = k == 0 or kinds[k - 1] != BODY
        last = k + 1 == n or not lines[k + 1].strip() or (k + 2 < n and bool(_HEAD.search(lines[k + 1])) and bool(_VERSUS.search(lines[k + 1])))
        if first and len(text) < MAX_LINE and (_HEAD.search(text) and _VERSUS.search(text) or heads and _is_head(text, heads)):
            kinds[k] = HEADER
        elif (first or last) and _PAGE.fullmatch(text):
            kinds[k] = PAGE_NUMBER
    return "".join(kinds)


def bare(token: str) -> str:
    return token.strip(_STRIP).lower()


class Token(NamedTuple):
    word: str
    line: int  # index of the line where it starts
    split: int  # how many of its characters stand there; 0 if it isn't cut


def tokens_of(lines: list[str], kinds: str) -> list[Token]:
    """The words of the body; one that a line's end may cut comes joined, without the hyphen."""
    out: list[Token] = []
    carry: tuple[str, int] | None = None
    for k, line in enumerate(lines):
        if kinds[k] != BODY:
            continue
        words = line.split()
        for i, raw in enumerate(words):
            if carry is not None:
                left, at = carry
                carry = None
                joined = bare(left + raw)
                out.append(Token(joined, at, max(1, len(left.lstrip(_STRIP)))))
                continue
            if i == len(words) - 1 and len(raw) > 1 and raw[-1] in _HYPHENS and _LETTER.search(raw[:-1]):
                carry = (raw[:-1], k)
                continue
            word = bare(raw)
            if word:
                out.append(Token(word, k, 0))
    return out


def cut_ends(lines: list[str], kinds: str) -> list[tuple[int, str, str, str]]:
    """(line index, left, right, hyphen) of each body line that ends in a hyphen; left is its last word, right the next."""
    out = []
    body = [k for k in range(len(lines)) if kinds[k] == BODY]
    for k, following in zip(body, [*body[1:], None], strict=True):
        line = lines[k].rstrip()
        if len(line) > 1 and line[-1] in _HYPHENS and following is not None:
            left, right = line[:-1].split()[-1:], lines[following].split()[:1]
            if left and right and _LETTER.search(left[0]) and _LETTER.match(right[0]):
                out.append((k, left[0].strip(_STRIP).lower(), bare(right[0]), line[-1]))
    return out


def shape(word: str) -> str:
    """Figures don't make words of their own."""
    return re.sub(r"\d+", "0", word) if not _LETTER.search(word) else word


def corpus_words(records: DataFrame, scans: DataFrame) -> DataFrame:
    """(kind, a, b, n) over all records: w words and p word pairs of born-digital texts, s words of scans,
    j words of scans that a line's end may cut."""
    schema = "kind string, a string, b string, n bigint"

    def counts(rows: list[tuple]) -> pa.RecordBatch:
        return _rows(rows, (pa.string(), pa.string(), pa.string(), pa.int64()), ["kind", "a", "b", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, raw_pairs, words, pairs = (Counter() for _ in range(4))
            for content in batch.column(0).to_pylist():
                if not is_scan(content.split("\n")):
                    own = content.lower().split()
                    raw.update(own)
                    raw_pairs.update(zip(own, own[1:], strict=False))
            # what differs by enclosing marks or figures only is one word: told once for each form
            form = {x: shape(bare(x)) for x in raw}
            for x, n in raw.items():
                words[form[x]] += n
            for (x, y), n in raw_pairs.items():
                pairs[form[x], form[y]] += n
            del words[""]
            yield counts([("w", a, "", n) for a, n in words.items()] + [("p", a, b, n) for (a, b), n in pairs.items() if a and b])

    def count_scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scanned, cut = Counter(), Counter()
            for content, kinds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for t in tokens_of(content.split("\n"), kinds):
                    (cut if t.split else scanned)[t.word] += 1
            yield counts([("s", a, "", n) for a, n in scanned.items()] + [("j", a, "", n) for a, n in cut.items()])

    counted = records.where("content IS NOT NULL").select("content").mapInArrow(count, schema)
    counted = counted.unionByName(scans.select("content", "kinds").mapInArrow(count_scans, schema))
    return counted.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> DataFrame:
    """(word, clean, scanned, cut): how often a word stands in born-digital texts, in scans, and cut in scans."""
    n = F.col("n")

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, n).otherwise(0))

    return counts.where("kind <> 'p'").groupBy(F.col("a").alias("word")).agg(of("w").alias("clean"), of("s").alias("scanned"), of("j").alias("cut"))


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, clean, scanned, frame, block): each word with a gap of one or two characters at every place.

    ``frame`` is a 64-bit key of what stands before and after the gap, by polynomial
    sums from either end, so that a word of n characters makes 2 n rows of fixed size.
    """
    before, after = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    for batch in batches:
        words = batch.column(0).to_pylist()
        joined = "".join(words)
        sizes = np.array([len(w) for w in words], np.int64)
        ends = sizes.cumsum()
        of = np.repeat(np.arange(len(words)), sizes)
        at = np.arange(len(joined)) - (ends - sizes)[of]
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        longest = int(sizes.max(initial=0))
        with np.errstate(over="ignore"):
            left = np.full(longest + 1, before).cumprod()
            right = np.full(longest + 1, after).cumprod()
            prefix = np.concatenate([[np.uint64(0)], (chars * left[at]).cumsum()])
            suffix = np.concatenate([[np.uint64(0)], (chars * right[sizes[of] - 1 - at]).cumsum()])
            letters = list(joined)
            rows, blocks = [], []
            frames = []
            for k in (1, 2):
                g = np.flatnonzero(at + k <= sizes[of])
                head = prefix[g] - prefix[(ends - sizes)[of[g]]]
                tail = suffix[ends[of[g]]] - suffix[g + k]
                key = (head ^ (head >> np.uint64(31))) * before + (tail ^ (tail >> np.uint64(29))) * after
                rows.append(of[g])
                frames.append((key ^ (key >> np.uint64(32))).view(np.int64))
                blocks += [letters[x] for x in g.tolist()] if k == 1 else [joined[x : x + 2] for x in g.tolist()]
        own = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays(
            [*(c.take(own) for c in batch.columns), pa.array(np.concatenate(frames)), pa.array(blocks, pa.string())],
            names=[*batch.schema.names, "frame", "block"],
        )


def learn_confusions(words: DataFrame, least_clean: int = 4, significance: float = 10.83) -> dict[str, list[tuple[str, float]]]:
    """Read character(s) -> [(true character(s), log probability)].

    Words of scans and frequent born-digital words that differ in one place, by one or
    two characters on either side, vote for a confusion; it is kept if scans show it
    more than born-digital texts do, by log-likelihood. The result is bounded by the
    pairs of characters that writing systems have; MAX_CONFUSIONS checks it.
    """
    letters = words.where(F.col("word").rlike(_WORDLIKE) & (F.length("word") >= 3) & ((F.col("scanned") > 0) | (F.col("clean") >= least_clean)))
    split = letters.select("word", "clean", "scanned").mapInArrow(_frames, "word string, clean bigint, scanned bigint, frame bigint, block string")
    odd = split.where("scanned > 0").select("frame", F.col("word").alias("w"), F.col("clean").alias("wc"), F.col("scanned").alias("ws"), F.col("block").alias("s"))
    known = split.where(F.col("clean") >= least_clean).select("frame", F.col("word").alias("c"), F.col("clean").alias("cc"), F.col("block").alias("t"))
    pairs = odd.join(known, "frame").where("s <> t AND cc >= 10 * wc + 4 AND ws <= 0.2 * cc + 1")
    # the same difference is seen in wider frames too: only the narrowest stays
    pairs = pairs.where(
        "NOT (length(s) > 1 AND length(t) > 1 AND (substring(s, 1, 1) = substring(t, 1, 1) OR right(s, 1) = right(t, 1)))"
        " AND NOT (length(s) <> length(t) AND (substring(s, 1, 1) = substring(t, 1, 1) OR right(s, 1) = right(t, 1)))"
        " AND t RLIKE '^[\\\\p{L}]+$'"
    )
    votes = pairs.groupBy("s", "t", "w").agg(F.max("ws").alias("ws"), F.max("wc").alias("wc"), F.max("cc").alias("cc")).groupBy("s", "t").agg(
        F.sum("ws").alias("k1"), F.sum("wc").alias("k2"), F.sum("cc").alias("seen"), F.count(F.lit(1)).alias("types")
    )
    totals = words.agg(F.sum("scanned").alias("scanned"), F.sum("clean").alias("clean")).collect()[0]
    total, n2 = totals["scanned"] or 1, totals["clean"] or 1
    ratio = log_likelihood(F.col("k1"), F.lit(total), F.col("k2"), F.greatest(F.lit(n2), F.col("k2") + 1))
    kept = votes.where((ratio >= significance) & (F.col("types") >= 3)).limit(MAX_CONFUSIONS + 1).collect()
    if len(kept) > MAX_CONFUSIONS:
        raise ValueError(f"more than {MAX_CONFUSIONS} confusions: raise the significance")
    out: dict[str, list[tuple[str, float]]] = {}
    for r in kept:
        out.setdefault(r["s"], []).append((r["t"], math.log(min(0.2, max(r["k1"] / total, 1e-7)))))
    return out


def variants(word: str, confusions: dict[str, list[tuple[str, float]]], most: int = 2) -> dict[str, float]:
    """What a word may be with up to ``most`` confusions undone, each with its log probability."""
    found = {word: 0.0}
    for _ in range(most):
        for w, p in list(found.items()):
            for i in range(len(w)):
                for k in (1, 2):
                    for t, q in confusions.get(w[i : i + k], ()) if i + k <= len(w) else ():
                        x = w[:i] + t + w[i + k :]
                        if p + q > found.get(x, -math.inf):
                            found[x] = p + q
    del found[word]
    return found


def candidates(words: DataFrame, confusions: dict[str, list[tuple[str, float]]], least_clean: int = 4) -> DataFrame:
    """(w, found): odd words of scans, with the frequent words that confusions may have made them of, as (c, logp).

    A confusion changes a word's length by one at most, so that a word which is longer
    than the longest frequent one by more than two has no candidate.
    """
    n = F.col("scanned") + F.col("cut")
    frequent = words.where(F.col("clean") >= least_clean)
    longest = frequent.agg(F.max(F.length("word"))).collect()[0][0] or 0
    odd = words.where((n > 0) & F.col("word").rlike(_WORDLIKE) & (F.length("word") <= longest + 2) & (F.col("clean") <= 3 + 0.1 * n)).select("word")

    def vary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1_000):
                rows = [(w, c, p) for w in batch.column(0).slice(start, 1_000).to_pylist() for c, p in variants(w, confusions).items()]
                yield _rows(rows, (pa.string(), pa.string(), pa.float64()), ["w", "c", "logp"])

    known = frequent.select(F.col("word").alias("c"))
    met = odd.mapInArrow(vary, "w string, c string, logp double").join(known, "c")
    return met.groupBy("w").agg(F.sort_array(F.collect_list(F.struct("c", "logp"))).alias("found"))


def _scan_rows(records: DataFrame) -> DataFrame:
    """(row, id, content, kinds) of scans alone: what each line is, by KINDS; ``row`` tells records of one id apart."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = []
            for content in batch.column(1).to_pylist():
                lines = content.split("\n")
                kinds.append(layout(lines) if is_scan(lines) else None)
            own = pa.RecordBatch.from_arrays([*batch.columns, pa.array(kinds, pa.string())], names=["id", "content", "kinds"])
            yield own.filter(own.column(2).is_valid())

    scans = records.where("content IS NOT NULL").select("id", "content").mapInArrow(keep, "id string, content string, kinds string")
    return scans.select(F.xxhash64("id", "content").alias("row"), "id", "content", "kinds")


def furniture(scans: DataFrame) -> DataFrame:
    """(id, line_no, kind): running heads and page numbers; lines count from 1."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, k + 1, KINDS[kind])
                for i, kinds in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for k, kind in enumerate(kinds)
                if kind in KINDS
            ]
            yield _rows(rows, (pa.string(), pa.int32(), pa.string()), ["id", "line_no", "kind"])

    return scans.select("id", "kinds").mapInArrow(find, "id string, line_no int, kind string")


def _rows(rows: list[tuple], types: tuple, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def broken_lines(scans: DataFrame, words: DataFrame, confusions: dict[str, list[tuple[str, float]]]) -> DataFrame:
    """(row, id, line_no, joined): lines at whose end a word is cut only because the line ends.

    The word in one piece must be commoner elsewhere than the compound with a hyphen.
    Neither being known, as when it is misread too, its variants are looked up; still
    neither, it is cut unless both parts are words by themselves. Hyphens that only a
    line's end makes (¬, soft hyphen) always mark a cut.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, i, content, kinds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k, left, right, mark in cut_ends(content.split("\n"), kinds):
                    forms = [(left + right, "joined", 0.0), (left + "-" + right, "compound", 0.0), (left, "left", 0.0), (right, "right", 0.0)]
                    forms += [(x, "joined", p) for x, p in variants(left + right, confusions, 1).items()]
                    forms += [(x, "compound", p) for x, p in variants(left + "-" + right, confusions, 1).items()]
                    rows += [(row, i, k + 1, mark == "-", left + right, x, form, p) for x, form, p in forms]
            yield _rows(
                rows,
                (pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.float64()),
                ["row", "id", "line_no", "open", "whole", "word", "form", "logp"],
            )

    forms = scans.mapInArrow(find, "row bigint, id string, line_no int, open boolean, whole string, word string, form string, logp double")
    weight = F.coalesce(F.col("clean") + F.col("scanned"), F.lit(0)) * F.exp("logp")

    def of(form: str) -> Column:
        return F.max(F.when(F.col("form") == form, weight).otherwise(0.0))

    judged = forms.join(words.select("word", "clean", "scanned"), "word", "left").groupBy("row", "id", "line_no", "open", "whole").agg(
        of("joined").alias("joined"), of("compound").alias("compound"), of("left").alias("left"), of("right").alias("right")
    )
    cut = (
        F.when(~F.col("open"), True)
        .when((F.col("joined") > 0) | (F.col("compound") > 0), F.col("joined") >= F.col("compound"))
        .otherwise((F.col("left") < 3) | (F.col("right") < 3))
    )
    return judged.where(cut).select("row", "id", "line_no", F.col("whole").alias("joined"))


def _word_filter(cands: DataFrame) -> np.ndarray:
    """A bit for the hash of every word that has candidates; its size doesn't depend on their number."""
    hashed = cands.select(F.pmod(F.crc32("w"), F.lit(FILTER_BITS)).alias("h"))
    rows = hashed.groupBy(F.expr("CAST(h DIV 32 AS INT)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(h % 32 AS INT)))").alias("bits")).collect()
    words = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in rows:
        words[r["at"]] = r["bits"]
    return np.unpackbits(words.view(np.uint8), bitorder="little")


def _with_candidates(scans: DataFrame, cands: DataFrame) -> DataFrame:
    """The scans that have odd words, with the candidates of all of them: (row, id, content, kinds, odd).

    The words of every scan that the filter lets through are joined to the candidates,
    so that their number has no bound and no word is left for a later pass.
    """
    shared = scans.sparkSession.sparkContext.broadcast(np.packbits(_word_filter(cands)))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likely = np.unpackbits(shared.value).tobytes()
        for batch in batches:
            rows = []
            for row, content, kinds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = {t.word for t in tokens_of(content.split("\n"), kinds)}
                rows += [(row, w) for w in own if likely[crc32(w.encode()) % FILTER_BITS]]
            yield _rows(rows, (pa.int64(), pa.string()), ["row", "w"])

    own = scans.select("row", "content", "kinds").mapInArrow(words, "row bigint, w string")
    odd = own.join(cands, "w").groupBy("row").agg(F.collect_list(F.struct("w", "found")).alias("odd"))
    return scans.join(odd, "row")


def _lattice(scans: DataFrame) -> DataFrame:
    """Edges of the word lattices: (row, id, line, pos, a, b, logp, split, word).

    Only edges at odd words are given; ``logp`` is the channel's for the right word b.
    """

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                rows = []
                for row, i, content, kinds, odd in zip(*(c.to_pylist() for c in batch.slice(start, 500).columns), strict=True):
                    cands = {o["w"]: [(f["c"], f["logp"]) for f in o["found"]] for o in odd}
                    tokens = tokens_of(content.split("\n"), kinds)
                    states = [[(shape(t.word), 0.0), *cands.get(t.word, ())] for t in tokens]
                    for k, t in enumerate(tokens):
                        before = states[k - 1] if k else [("", 0.0)]
                        if len(states[k]) == 1 and len(before) == 1:
                            continue
                        # positions count within the record: a run of odd words is one lattice, also over a line's end
                        rows += [(row, i, t.line, k, a, b, p, t.split, t.word) for a, _ in before for b, p in states[k]]
                yield _rows(
                    rows,
                    (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.string()),
                    ["row", "id", "line", "pos", "a", "b", "logp", "split", "word"],
                )

    kinds = "row bigint, id string, line int, pos int, a string, b string, logp double, split int, word string"
    return scans.select("row", "id", "content", "kinds", "odd").mapInArrow(edges, kinds)


def best_path(edges: list[tuple[int, str, str, float]]) -> dict[int, str]:
    """Viterbi over edges (position, left word, right word, weight): the word at each position.

    Positions that follow each other share states; a gap begins anew.
    """
    at: dict[int, list[tuple[str, str, float]]] = {}
    for pos, a, b, w in edges:
        at.setdefault(pos, []).append((a, b, w))
    chosen: dict[int, str] = {}
    run: list[tuple[int, dict[str, tuple[float, str]]]] = []

    def close() -> None:
        if not run:
            return
        word = max(run[-1][1], key=lambda x: (run[-1][1][x][0], x))
        for pos, table in reversed(run):
            chosen[pos] = word
            word = table[word][1]
        run.clear()

    for pos in sorted(at):
        if run and run[-1][0] != pos - 1:
            close()
        before = run[-1][1] if run else None
        table: dict[str, tuple[float, str]] = {}
        for a, b, w in at[pos]:
            score = w + (before[a][0] if before and a in before else 0.0)
            if b not in table or score > table[b][0]:
                table[b] = (score, a)
        run.append((pos, table))
    close()
    return chosen


def corrections(scans: DataFrame, counts: DataFrame, words: DataFrame, confusions: dict[str, list[tuple[str, float]]]) -> DataFrame:
    """(row, id, line_no, pos, split, at, word, correction): words of the body read wrongly.

    ``pos`` is the word's number in the record's body, ``at`` the place in the word
    where the two differ.
    """
    total = max(1, words.agg(F.sum("clean")).collect()[0][0] or 0)
    singles = words.where("clean > 0").select(F.col("word").alias("x"), "clean")
    pairs = counts.where("kind = 'p'").select("a", "b", F.col("n").alias("n_ab"))
    edges = materialise(_lattice(_with_candidates(scans, materialise(candidates(words, confusions)))))
    model = F.log(
        PAIR_WEIGHT * F.coalesce("n_ab", F.lit(0)) / F.coalesce("n_a", F.lit(1))
        + (1 - PAIR_WEIGHT) * (F.coalesce("n_b", F.lit(0)) + UNSEEN) / F.lit(float(total))
    )
    # each two words are looked up once, however many places they stand at
    known = (
        edges.select("a", "b").distinct()
        .join(pairs, ["a", "b"], "left")
        .join(singles.select(F.col("x").alias("a"), F.col("clean").alias("n_a")), "a", "left")
        .join(singles.select(F.col("x").alias("b"), F.col("clean").alias("n_b")), "b", "left")
        .select("a", "b", model.alias("model"))
    )
    weighted = (
        edges.join(known, ["a", "b"])
        .select("row", "id", F.struct("pos", "a", "b", (F.col("model") + F.col("logp")).alias("weight"), "line", "split", "word").alias("e"))
        .groupBy("row", "id")
        .agg(F.sort_array(F.collect_list("e")).alias("edges"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, i, edges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                path = best_path([(e["pos"], e["a"], e["b"], e["weight"]) for e in edges])
                told = {e["pos"]: e for e in edges}
                for pos, word in path.items():
                    e = told[pos]
                    if word != shape(e["word"]):
                        same = next((k for k, (x, y) in enumerate(zip(word, e["word"], strict=False)) if x != y), min(len(word), len(e["word"])))
                        rows.append((row, i, e["line"] + 1, pos, e["split"], same, e["word"], word))
            yield _rows(
                rows,
                (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()),
                ["row", "id", "line_no", "pos", "split", "at", "word", "correction"],
            )

    return weighted.mapInArrow(decode, "row bigint, id string, line_no int, pos int, split int, at int, word string, correction string")


class ScanRepair(NamedTuple):
    scans: DataFrame
    furniture: DataFrame
    broken: DataFrame
    corrections: DataFrame


def repair(records: DataFrame) -> ScanRepair:
    """Finds what is wrong with the scans among ``records`` (id, content).

    NULL, empty and blank contents and born-digital texts give no rows. Without any
    born-digital text there is no language model, and nothing counts as misread.
    """
    rows = records.select("id", "content")
    scans = materialise(_scan_rows(rows))
    counts = materialise(corpus_words(rows, scans))
    words = materialise(vocabulary(counts))
    confusions = learn_confusions(words)
    return ScanRepair(scans, furniture(scans), broken_lines(scans, words, confusions), corrections(scans, counts, words, confusions))


def _next_body(scans: DataFrame) -> DataFrame:
    """(row, id, line_no, next_no): the body line after each body line."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, i, kinds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = [k + 1 for k, kind in enumerate(kinds) if kind == BODY]
                rows += [(row, i, a, b) for a, b in zip(body, body[1:], strict=False)]
            yield _rows(rows, (pa.int64(), pa.string(), pa.int32(), pa.int32()), ["row", "id", "line_no", "next_no"])

    return scans.select("row", "id", "kinds").mapInArrow(find, "row bigint, id string, line_no int, next_no int")


def flawed_lines(found: ScanRepair) -> DataFrame:
    """(id, line_no, kind): header, page_number, broken and misread lines."""
    wrong = found.corrections
    # the wrong character of a cut word may stand on the line after
    here = wrong.where("split = 0 OR at < split").select("id", "line_no")
    after = wrong.where("split > 0 AND at >= split").join(_next_body(found.scans), ["row", "id", "line_no"]).select("id", F.col("next_no").alias("line_no"))
    return (
        found.furniture.unionByName(found.broken.select("id", "line_no", F.lit("broken").alias("kind")))
        .unionByName(here.unionByName(after).withColumn("kind", F.lit("misread")))
        .distinct()
    )


def repaired_text(found: ScanRepair) -> DataFrame:
    """(id, text): each scan as continuous paragraphs, one a line, without furniture, cuts and misread words.

    A paragraph ends at an empty line or before an indented one, unless a page ends
    there in the middle of a sentence.
    """
    fixes = found.corrections.groupBy("row", "id").agg(F.collect_list(F.struct("pos", "correction")).alias("fixes"))
    cuts = found.broken.groupBy("row", "id").agg(F.collect_set("line_no").alias("cuts"))
    rows = found.scans.join(fixes, ["row", "id"], "left").join(cuts, ["row", "id"], "left").select("id", "content", "kinds", "fixes", "cuts")

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for content, kinds, fixes, cuts in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                texts.append(_mended(content, kinds, {f["pos"]: f["correction"] for f in fixes or ()}, set(cuts or ())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return rows.mapInArrow(mend, "id string, text string")


def _corrected(raw: str, right: str | None) -> str:
    """A word as it stands, with its marks, letter case and all, but for the correction."""
    if right is None:
        return raw
    core = raw.strip(_STRIP)
    return raw.replace(core, right[:1].upper() + right[1:] if core[:1].isupper() else right)


def _mended(content: str, kinds: str, fixes: dict[int, str], cuts: set[int]) -> str:
    """``fixes`` has corrections by the word's number in the body, as tokens_of counts; ``cuts`` the lines that cut a word."""
    lines = content.split("\n")
    paragraphs: list[str] = []
    text: list[str] = []
    page_end, pos = False, 0
    carry: tuple[str, str, int] | None = None  # what stands before the word, its first half, the line's number

    def close() -> None:
        nonlocal carry
        if carry is not None:
            text.append(carry[0] + carry[1])
            carry = ("", "", -1)  # its second half begins the next paragraph
        paragraphs.append("".join(text))
        text.clear()

    for k, line in enumerate(lines):
        if kinds[k] in KINDS:
            page_end = True
            continue
        ends = carry is None and bool(text) and _END.search(text[-1]) is not None
        if (text or carry) and (kinds[k] == BLANK or line[:2].isspace()) and not (page_end and not ends):
            # an empty line after a page's last may part a sentence: what follows decides
            if kinds[k] == BLANK and not ends:
                continue
            close()
        if kinds[k] == BLANK:
            continue
        page_end = False
        words = list(_WORD_PLACES.finditer(line))
        for i, m in enumerate(words):
            raw = m.group()
            gap = "" if not text else line[words[i - 1].end() : m.start()] if i else " "
            if carry is not None:
                before, left, at = carry
                carry = None
                # what a cut parts, and a compound parted at its hyphen, goes on without a blank
                text.append(before + (_corrected(left[:-1] + raw, fixes.get(pos)) if at in cuts else left + raw))
                pos += 1
            elif i == len(words) - 1 and len(raw) > 1 and raw[-1] in _HYPHENS and _LETTER.search(raw[:-1]):
                carry = (gap, raw, k + 1)
            else:
                text.append(gap + _corrected(raw, fixes.get(pos) if bare(raw) else None))
                pos += bool(bare(raw))
    if text or carry:
        close()
    return "\n".join(p for p in paragraphs if p)
