"""Lines of two language versions of one decision that translate each other.

Versions are joined by court, year and number.  A first pass pairs lines that share
figures and names with each other more than with any other line, and counts which
words stand in paired lines together: by log-likelihood these counts give a lexicon.
A second pass scores every two lines of a pair of versions by how much of either the
other covers, and spans of two neighbouring lines against one by what the second adds
to the first.  The assignment of greatest weight is solved over lines and spans at
once, in which a line may stay alone at no cost: every line can take one partner and,
as a span, that partner's neighbour.  Lines still alone are then offered what a line
elsewhere has beyond its translation, for spans whose lines don't stand together.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.sentences import language_of, log_likelihood
from casemill.session import materialise

#: The most entries of a lexicon that is sent to the workers; a corpus with more is refused.
MAX_LEXICON = 2_000_000
#: Least score of two lines, and least part of a lone line that another's surplus covers.
LEAST_SCORE, LEAST_SURPLUS = 0.5, 0.55
#: Lines that are scored against as many at once, and lines of a group that is solved with a matrix.
BLOCK, MAX_GROUP = 128, 400
#: Pairs of words up to which two texts' links are held as a matrix.
DENSE_LINKS = 1_000_000
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:-[^\W\d_]+)*")
#: A blank between the figures of one number, as French writes thousands.
_THOUSANDS = re.compile("(?<=\\d)[ \u00a0\u2009\u202f](?=\\d{3}(?!\\d))")


def line_words(line: str) -> list[str]:
    """Words in lower case; figures without separators, marked by #; words that begin in upper case inside a line marked by ^."""
    line = _THOUSANDS.sub("", line.replace("’", "'"))
    out = []
    for m in _TOKEN.finditer(line):
        x = m.group()
        if x[0].isdigit():
            out.append("#" + (x.replace(",", "").replace(".", "").lstrip("0") or "0"))
        elif x[0].isupper() and len(x) > 1 and m.start() > 0:
            out.append("^" + x.lower())
        else:
            out.append(x.lower())
    return out


def units_of(content: str) -> list[tuple[int, list[str]]]:
    """(line number, words) of each line that isn't blank."""
    return [(n, line_words(x)) for n, x in enumerate(content.split("\n"), 1) if x and not x.isspace()]


def version_pairs(records: DataFrame, first: str = "en", second: str = "fr") -> DataFrame:
    """(id_1, content_1, id_2, content_2): every two versions of a decision in the two languages.

    The language is read from the text, not from the label. The key is the tribunal in
    lower case with the year and the last number of the citation; records without a
    year and another number, or without content, have no version.
    """
    years = F.regexp_extract("citation", r"(?<!\d)((?:19|20)\d\d)(?!\d)", 1)
    number = F.regexp_extract("citation", r"(\d+)\D*$", 1)
    keyed = records.where("content IS NOT NULL").select(
        "id",
        "content",
        F.lower("tribunal").alias("court"),
        years.alias("year"),
        number.alias("number"),
        F.regexp_count("citation", F.lit(r"\d+")).alias("figures"),
    ).where("year <> '' AND number <> '' AND figures > 1")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pa.array([language_of(x) for x in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, langs], names=[*batch.schema.names, "lang"])

    kinds = ", ".join(f"{n} {k}" for n, k in keyed.dtypes)
    marked = keyed.withColumn("number", F.regexp_replace("number", "^0+(?=.)", "")).mapInArrow(mark, f"{kinds}, lang string")
    key = ["court", "year", "number"]
    # one exchange of all versions by key, which both sides of the join read
    marked = marked.where(F.col("lang").isin(first, second)).repartition(*key)
    a = marked.where(F.col("lang") == first).select(*key, F.col("id").alias("id_1"), F.col("content").alias("content_1"))
    b = marked.where(F.col("lang") == second).select(*key, F.col("id").alias("id_2"), F.col("content").alias("content_2"))
    return a.join(b, key).select("id_1", "content_1", "id_2", "content_2")


def anchored(one: list[list[str]], two: list[list[str]]) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """Lines that share more figures and names with each other than with any other line,
    and the lines of either side that have none at all."""

    def marks(lines: list[list[str]]) -> list[set[str]]:
        return [{x.lstrip("^") for x in words if x[0] in "#^"} for words in lines]

    a, b = marks(one), marks(two)
    df = Counter(x for own in (a, b) for s in own for x in s)
    at: dict[str, list[int]] = {}
    for j, s in enumerate(b):
        for x in s:
            at.setdefault(x, []).append(j)
    # the best of each line of either side, by blocks of lines: (score, line of the other side)
    right: list[tuple[float, int]] = []
    best, down = np.zeros(len(b)), np.full(len(b), -1)
    for start in range(0, len(a), BLOCK):
        own = a[start : start + BLOCK]
        score = np.zeros((len(own), len(b)))
        for i, s in enumerate(own):
            for x in s:
                if x in at:
                    score[i, at[x]] += 1 / df[x]
        if score.size:
            right += zip(score.max(axis=1).tolist(), score.argmax(axis=1).tolist(), strict=True)
            top = score.max(axis=0)
            better = top > best
            best[better], down[better] = top[better], score.argmax(axis=0)[better] + start
    out = [(i, j) for i, (top, j) in enumerate(right) if top > 0 and down[j] == i]
    return out, [i for i, s in enumerate(a) if not s], [j for j, s in enumerate(b) if not s]


class Lexicon(NamedTuple):
    """translations: word of the first language -> words of the second; weights of either side's words."""

    translations: dict[str, set[str]]
    weight_1: dict[str, float]
    weight_2: dict[str, float]
    default: float


def cooccurrences(pairs: DataFrame) -> DataFrame:
    """(a, b, n): in how many paired lines two words stand together; with b or a empty, a word alone; both empty, all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left: dict[str, int] = {}
            right: dict[str, int] = {}
            codes, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for one, two in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a = [w for _, w in units_of(one)]
                b = [w for _, w in units_of(two)]
                ia = [np.array(sorted({left.setdefault(x, len(left) + 1) for x in w if x[0] not in "#^"} | {0})) for w in a]
                ib = [np.array(sorted({right.setdefault(x, len(right) + 1) for x in w if x[0] not in "#^"} | {0})) for w in b]
                pairs, plain_a, plain_b = anchored(a, b)
                found = [(ia[i][:, None] * 4_294_967_296 + ib[j][None, :]).ravel() for i, j in pairs]
                codes += found
                times += [np.ones(len(x), np.int64) for x in found]
                if plain_a and plain_b:
                    # every line with every line: two words meet as often as the product of their lines
                    wa, na = np.unique(np.concatenate([ia[i] for i in plain_a]), return_counts=True)
                    wb, nb = np.unique(np.concatenate([ib[j] for j in plain_b]), return_counts=True)
                    codes.append((wa[:, None] * 4_294_967_296 + wb[None, :]).ravel())
                    times.append((na[:, None] * nb[None, :]).ravel())
            values, of = np.unique(np.concatenate(codes), return_inverse=True)
            n = np.bincount(of, np.concatenate(times), len(values)).astype(np.int64)
            names_a, names_b = pa.array(["", *left]), pa.array(["", *right])
            yield pa.RecordBatch.from_arrays(
                [names_a.take(pa.array(values >> 32)), names_b.take(pa.array(values & 4_294_967_295)), pa.array(n, pa.int64())],
                names=["a", "b", "n"],
            )

    return pairs.mapInArrow(count, "a string, b string, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def induce_lexicon(counts: DataFrame, significance: float = 15.0, least_dice: float = 0.3) -> Lexicon:
    """Words that stand together in paired lines more than chance allows.

    ``significance`` is the least log-likelihood ratio; ``least_dice`` is the least
    share of the lines of both words in which they stand together.
    """
    counts = materialise(counts)
    total = counts.where("a = '' AND b = ''").select("n").collect()
    n_all = int(total[0]["n"]) if total else 0
    n_a = counts.where("a <> '' AND b = ''").select("a", F.col("n").alias("n_a"))
    n_b = counts.where("a = '' AND b <> ''").select("b", F.col("n").alias("n_b"))
    both = counts.where("a <> '' AND b <> '' AND n > 1").join(n_a, "a").join(n_b, "b")
    ratio = log_likelihood(F.col("n"), F.col("n_a"), F.col("n_b") - F.col("n"), F.lit(n_all) - F.col("n_a"))
    kept = both.where((ratio >= significance) & (2 * F.col("n") >= least_dice * (F.col("n_a") + F.col("n_b"))))
    rows = kept.select("a", "b").limit(MAX_LEXICON + 1).collect()
    if len(rows) > MAX_LEXICON:
        raise ValueError(f"more than {MAX_LEXICON} entries: raise the significance")
    translations: dict[str, set[str]] = {}
    for r in rows:
        translations.setdefault(r["a"], set()).add(r["b"])
    top = math.log(max(n_all, 2))

    def weights(table: DataFrame, word: str, n: str) -> dict[str, float]:
        known = table.where(F.col(n) > 1).limit(MAX_LEXICON + 1).collect()
        if len(known) > MAX_LEXICON:
            raise ValueError(f"more than {MAX_LEXICON} words")
        return {r[word]: max(0.1, top - math.log(r[n])) for r in known}

    return Lexicon(translations, weights(n_a, "a", "n_a"), weights(n_b, "b", "n_b"), top)


_NONE: frozenset = frozenset()


class _Side(NamedTuple):
    """Lines as ids of their words, the weight of each word and of each line, and for each word those of the other side that go with it."""

    lines: list[np.ndarray]
    weight: np.ndarray
    full: np.ndarray
    links: list[list[int]]
    dense: np.ndarray | None  # the links as a matrix, where both sides have few words


def _sides(one: list[list[str]], two: list[list[str]], lex: Lexicon) -> tuple[_Side, _Side]:
    va: dict[str, int] = {}
    vb: dict[str, int] = {}
    ia = [np.array(sorted({va.setdefault(x, len(va)) for x in w}), np.int64) for w in one]
    ib = [np.array(sorted({vb.setdefault(x, len(vb)) for x in w}), np.int64) for w in two]
    bare: dict[str, list[int]] = {}
    for x, k in vb.items():
        bare.setdefault(x.lstrip("^"), []).append(k)
    to_b: list[list[int]] = [[] for _ in va]
    to_a: list[list[int]] = [[] for _ in vb]
    for x, k in va.items():
        y = x.lstrip("^")
        found = lex.translations.get(y, _NONE) & bare.keys()
        if y in bare:
            found = found | {y}
        for t in found:
            to_b[k] += bare[t]
            for j in bare[t]:
                to_a[j].append(k)
    # figures and names weigh the most: they are seldom translated
    wa = np.array([lex.default if x[0] in "#^" else lex.weight_1.get(x, lex.default / 2) for x in va], np.float32)
    wb = np.array([lex.default if x[0] in "#^" else lex.weight_2.get(x, lex.default / 2) for x in vb], np.float32)
    dense = None
    if len(va) * len(vb) <= DENSE_LINKS:
        dense = np.zeros((len(va), len(vb)), np.float32)
        pairs = [(k, j) for k, js in enumerate(to_b) for j in js]
        if pairs:
            dense[tuple(np.array(pairs).T)] = 1
    return tuple(
        _Side(lines, w, np.array([max(w[x].sum(), 1e-6) for x in lines], np.float32), links, d)
        for lines, w, links, d in ((ia, wa, to_b, dense), (ib, wb, to_a, None if dense is None else dense.T))
    )


def _incidence(sets: list[np.ndarray], size: int) -> np.ndarray:
    out = np.zeros((len(sets), size), np.float32)
    for k, x in enumerate(sets):
        out[k, x] = 1
    return out


def _reach(lines: list[np.ndarray], incidence: np.ndarray, side: _Side, size: int) -> np.ndarray:
    """For each line the words of the other side that go with any of its own."""
    if side.dense is not None:
        return (incidence @ side.dense > 0).astype(np.float32)
    return _incidence([_linked(x, side.links) for x in lines], size)


def _linked(words: np.ndarray, links: list[list[int]]) -> np.ndarray:
    return np.array([y for x in words.tolist() for y in links[x]], np.int64)


def _uncovered(words: np.ndarray, other: np.ndarray, links: list[list[int]]) -> np.ndarray:
    """The words that go with none of the other side's."""
    covered = {y for x in other.tolist() for y in links[x]}
    return np.array([x for x in words.tolist() if x not in covered], np.int64)


def _scores(one: _Side, two: _Side) -> tuple[np.ndarray, ...]:
    """Pairs of lines that score above the least: (line of one, line of two, score, part of one, part of two).

    The lines are scored in blocks of BLOCK by BLOCK, so that texts of any length fit.
    """
    out = []
    for j in range(0, len(two.lines), BLOCK):
        theirs = two.lines[j : j + BLOCK]
        b = _incidence(theirs, len(two.weight))
        reach_b = _reach(theirs, b, two, len(one.weight))
        for i in range(0, len(one.lines), BLOCK):
            ours = one.lines[i : i + BLOCK]
            a = _incidence(ours, len(one.weight))
            reach_a = _reach(ours, a, one, len(two.weight))
            covered_a, covered_b = (a * one.weight) @ reach_b.T, reach_a @ (b * two.weight).T
            full_a, full_b = one.full[i : i + BLOCK, None], two.full[None, j : j + BLOCK]
            part_a, part_b = covered_a / full_a, covered_b / full_b
            both = (covered_a + covered_b) / (full_a + full_b)
            # a line that another covers as part of more is as good as whole
            score = np.maximum(both, 0.5 * both + 0.5 * np.maximum(part_a * (part_a > 0.7), part_b * (part_b > 0.7)))
            place = np.arange(i, i + len(ours))[:, None] / len(one.lines) - np.arange(j, j + len(theirs))[None, :] / len(two.lines)
            score = score + 0.02 * (1 - np.abs(place))
            r, c = np.nonzero(score > LEAST_SCORE)
            out.append((r + i, c + j, score[r, c], part_a[r, c], part_b[r, c]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def assign(rows: np.ndarray, columns: np.ndarray, gain: np.ndarray) -> list[tuple[int, int]]:
    """The assignment of greatest total gain among the given pairs; who isn't paired gains nothing.

    Each group of lines that pairs connect is solved by itself; most have one line on
    either side. A group of more than MAX_GROUP lines, as of lines that are repeated
    over and over, is solved over its own pairs, without a matrix.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    pairs = list(zip(rows.tolist(), columns.tolist(), gain.tolist(), strict=True))
    for i, j, _ in pairs:
        # columns are told from rows by their sign
        for x in (i, -1 - j):
            parent.setdefault(x, x)
        parent[root(i)] = root(-1 - j)
    groups: dict[int, list[tuple[int, int, float]]] = {}
    for p in pairs:
        groups.setdefault(root(p[0]), []).append(p)
    out = []
    for own in groups.values():
        r, c = sorted({i for i, _, _ in own}), sorted({j for _, j, _ in own})
        if len(r) == 1 or len(c) == 1:
            out.append(max(own, key=lambda p: (p[2], -p[0], -p[1]))[:2])
        elif len(r) + len(c) > MAX_GROUP:
            out += sparse_hungarian(own)
        else:
            part = np.zeros((len(r), len(c)))
            at_r, at_c = {x: k for k, x in enumerate(r)}, {x: k for k, x in enumerate(c)}
            for i, j, g in own:
                part[at_r[i], at_c[j]] = g
            out += [(r[i], c[j]) for i, j in hungarian(part)]
    return out


def hungarian(gain: np.ndarray) -> list[tuple[int, int]]:
    """Maximum-weight assignment by shortest augmenting paths; pairs without gain stay alone."""
    n, m = gain.shape
    if n > m:
        return [(i, j) for j, i in hungarian(gain.T)]
    cost = gain.max() - gain
    u, v = np.zeros(n), np.zeros(m + 1)
    owner = np.full(m + 1, -1)  # column m is the root of each search
    for i in range(n):
        owner[m] = i
        column, least, way, used = m, np.full(m, np.inf), np.full(m, m), np.zeros(m + 1, bool)
        while owner[column] >= 0:
            used[column] = True
            row = owner[column]
            reduced = cost[row] - u[row] - v[:m]
            open_ = ~used[:m]
            better = open_ & (reduced < least)
            least[better], way[better] = reduced[better], column
            following = int(np.where(open_, least, np.inf).argmin())
            delta = least[following]
            u[owner[used]] += delta
            v[used] -= delta
            least[open_] -= delta
            column = following
        while column != m:
            owner[column] = owner[way[column]]
            column = way[column]
    return [(int(owner[j]), j) for j in range(m) if owner[j] >= 0 and gain[owner[j], j] > 0]


def sparse_hungarian(pairs: list[tuple[int, int, float]]) -> list[tuple[int, int]]:
    """What ``hungarian`` finds, over a list of (row, column, gain): each row also has a column of its own without gain."""
    most = max(g for _, _, g in pairs)
    edges: dict[int, dict[int, float]] = {}
    for i, j, g in sorted(pairs):
        own = edges.setdefault(i, {-1 - i: most})
        own[j] = min(most - g, own.get(j, most))
    u, v = dict.fromkeys(edges, 0.0), {j: 0.0 for own in edges.values() for j in own}
    owner: dict[int, int] = {}
    taken: dict[int, int] = {}
    for start in edges:
        row, so_far = start, 0.0
        least: dict[int, float] = {}
        way: dict[int, int] = {}
        used: dict[int, float] = {}
        heap: list[tuple[float, int]] = []
        while True:
            for j, cost in edges[row].items():
                reduced = so_far + cost - u[row] - v[j]
                if j not in used and reduced < least.get(j, np.inf):
                    least[j], way[j] = reduced, row
                    heappush(heap, (reduced, j))
            so_far, column = heappop(heap)
            while column in used:
                so_far, column = heappop(heap)
            if column not in owner:
                break
            used[column] = so_far
            row = owner[column]
        u[start] += so_far
        for j, d in used.items():
            u[owner[j]] += so_far - d
            v[j] -= so_far - d
        while True:
            row = way[column]
            owner[column] = row
            before, taken[row] = taken.get(row), column
            if row == start:
                break
            column = before
    return [(i, j) for i, j in sorted(taken.items()) if j >= 0 and edges[i][j] < most]


def align(one: str, two: str, lex: Lexicon) -> list[tuple[int, int]]:
    """Line numbers of the two texts that translate each other."""
    ua, ub = units_of(one), units_of(two)
    if not ua or not ub:
        return []
    a, b = _sides([w for _, w in ua], [w for _, w in ub], lex)
    rows, columns, score, part_a, part_b = _scores(a, b)
    # lines and second places of spans: a line's second place has its number plus the number of lines
    n, m = len(ua), len(ub)
    over_b, over_a = _spans(a, b, rows, columns, score, part_b), _spans(b, a, columns, rows, score, part_a)
    second = [(x, m + j, g) for x, j, _, g in over_b] + [(n + i, y, g) for y, i, _, g in over_a]
    more = tuple(np.array(c) for c in zip(*second, strict=True)) if second else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    solved = assign(*(np.concatenate(c) for c in zip((rows, columns, score - LEAST_SCORE), more, strict=True)))
    pairs = [(i, j) for i, j in solved if i < n and j < m]
    parts = {(i, j): (x, y) for i, j, x, y in zip(rows.tolist(), columns.tolist(), part_a.tolist(), part_b.tolist(), strict=True)}
    # a second place counts only where the first is its neighbour's
    first_b, first_a = {j: i for i, j in pairs}, dict(pairs)
    with_b, with_a = {(x, j): i for x, j, i, _ in over_b}, {(y, i): j for y, i, j, _ in over_a}
    spans = [(i, j - m) for i, j in solved if i < n and j >= m and first_b.get(j - m) == with_b[i, j - m]]
    spans += [(i - n, j) for i, j in solved if i >= n and first_a.get(i - n) == with_a[j, i - n]]
    out = set(pairs) | set(spans)
    left, right = {i for i, _ in out}, {j for _, j in out}
    out |= set(_surplus(a, b, pairs, {(i, j): parts[i, j][1] for i, j in pairs}, left))
    out |= {(i, j) for j, i in _surplus(b, a, [(j, i) for i, j in pairs], {(j, i): parts[i, j][0] for i, j in pairs}, right)}
    return [(ua[i][0], ub[j][0]) for i, j in sorted(out)]


def _spans(one: _Side, two: _Side, rows: np.ndarray, columns: np.ndarray, score: np.ndarray, part: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(line, line of two, its neighbour, gain): what a line adds to its neighbour in a span against one line of ``two``.

    ``part`` is how much of the second side's line the first's covers; the neighbour is
    the best line for it. A span gains what its second line has in the words that the
    first leaves uncovered, above LEAST_SURPLUS.
    """
    order = np.lexsort((rows, -score, columns))
    best = order[np.flatnonzero(np.diff(columns[order], prepend=-1))]
    out = []
    for k in best[part[best] < 0.85].tolist():
        i, j = int(rows[k]), int(columns[k])
        rest = _uncovered(two.lines[j], one.lines[i], one.links)
        reach = np.zeros(len(one.weight), bool)
        reach[_linked(rest, two.links)] = True
        for x in (i - 1, i + 1):
            if 0 <= x < len(one.lines):
                own = one.lines[x]
                cover = float((one.weight[own] * reach[own]).sum() / one.full[x]) + 0.05
                if cover > LEAST_SURPLUS:
                    out.append((x, j, i, cover - LEAST_SURPLUS))
    return out


def _surplus(
    one: _Side, two: _Side, pairs: list[tuple[int, int]], part: dict[tuple[int, int], float], taken: set[int]
) -> list[tuple[int, int]]:
    """Lone lines of the first side that belong to a line of the second which has more than its partner says."""
    alone = sorted(set(range(len(one.lines))) - taken)
    spare = [(i, j) for i, j in pairs if part[i, j] < 0.85]
    found = []
    for s in range(0, len(spare), BLOCK):
        own = spare[s : s + BLOCK]
        rest = [_uncovered(two.lines[j], one.lines[i], one.links) for i, j in own]
        reach = _incidence([_linked(x, two.links) for x in rest], len(one.weight))
        for k in range(0, len(alone), BLOCK):
            lines = alone[k : k + BLOCK]
            cover = (_incidence([one.lines[x] for x in lines], len(one.weight)) * one.weight) @ reach.T / one.full[lines][:, None]
            cover = cover + np.array([[0.05 * (abs(x - i) == 1) for i, _ in own] for x in lines], np.float32)
            r, c = np.nonzero(cover > LEAST_SURPLUS)
            found.append((np.array(lines)[r], c + s, cover[r, c] - LEAST_SURPLUS))
    if not found:
        return []
    return [(i, spare[c][1]) for i, c in assign(*(np.concatenate(x) for x in zip(*found, strict=True)))]


def aligned_lines(records: DataFrame) -> DataFrame:
    """(id_a, id_b, line_a, line_b): lines that translate each other, the smaller id first.

    ``records`` has id, content, tribunal and citation. Line numbers count from 1,
    empty lines included. Versions without lines in common, NULL and blank contents
    give no rows; rows are distinct, also where records repeat.
    """
    pairs = materialise(version_pairs(records))
    lexicon = records.sparkSession.sparkContext.broadcast(induce_lexicon(cooccurrences(pairs)))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        for batch in batches:
            rows = []
            for id_1, one, id_2, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = align(one, two, lex)
                rows += [(id_1, id_2, i, j) if id_1 <= id_2 else (id_2, id_1, j, i) for i, j in found]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int32()), strict=True)],
                names=["id_a", "id_b", "line_a", "line_b"],
            )

    return pairs.mapInArrow(solve, "id_a string, id_b string, line_a int, line_b int").distinct()
