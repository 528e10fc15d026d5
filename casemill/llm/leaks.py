"""Evaluation items inside training text.

The items form a BM25 inverted index with block maxima, small enough to be at every
worker: up to MAX_ITEMS items are one pass over the corpus, and how many texts hold
their words is counted in one pass before.  Every passage of every text is a query.
What a passage could score at most, and that it needs a run of words from an item,
prune nearly all of them at once; the rest run block-max WAND against the index, with
one cursor for each word's list and the items' own thresholds, and what they retrieve
is aligned word by word with the whole text.

The threshold proves that nothing is missed.  A stretch of n words with at most n / 10
edits has n // 10 pieces of ten words side by side, at least as many as edits, so that
one of them holds at most one edit (a shorter stretch has none), and five words in a
row without any.  The piece lies inside one passage, which so scores at least the
item's poorest ten words without their best one.  ``piece_of`` has the lengths for
other shares and edits.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE, STRIDE = 16, 4
#: Postings of a block of a list, whose greatest score is known.
BLOCK = 64
#: Items of one index, and words whose texts are counted, in one pass over the corpus; more make more passes.
MAX_ITEMS, MAX_WORDS = 100_000, 2_000_000
K1, B = 1.2, 0.75
_WORDS = re.compile(r"[^\W_]+")
_MARKS = re.compile("[\u0300-\u036f]+")
_FOREIGN = re.compile(r"[^\W_\x00-\x7f]")
_APART = str.maketrans({chr(c): " " for c in range(128) if not chr(c).isalnum()})


def words_of(text: str) -> list[str]:
    """Words without case, accents, punctuation and spacing."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
        if _FOREIGN.search(text):
            return _WORDS.findall(text.lower())
        # what isn't ASCII now is no letter or figure: it parts words
        text = text.encode("ascii", "replace").decode()
    return text.lower().translate(_APART).split()


def piece_of(length: int, share: float, edits: float) -> tuple[int, int, int]:
    """(size, lacks, run): what every leaked stretch of an item of ``length`` words has.

    That is ``size`` words in a row of which at most ``lacks`` are edited, and among
    them ``run`` words in a row without an edit.
    """
    if not 0 <= edits <= 0.5:
        raise ValueError(f"edits must lie between 0 and 0.5, not {edits}")
    need = max(1, math.ceil(length * share))
    most = min(PIECE, int(1 / edits + 1e-9)) if edits else PIECE
    if length * edits + 1e-9 < 1:
        return min(need, most), 0, min(need, most)
    if need <= most // 2:
        return need, 0, need
    return min(need, most), 1, most // 2


def _run_keys(ids: np.ndarray, run: int) -> np.ndarray:
    """A key of each ``run`` words in a row."""
    n = max(0, len(ids) - run + 1)
    wide, keys = ids.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(run):
        keys = (keys ^ wide[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


class ItemIndex:
    """Inverted index of the items. df: in how many of the n_texts texts a word stands.

    Items are numbered in the order of their thresholds, so that the lists of postings
    are in that order too.
    """

    def __init__(self, items: list[tuple[int, list[str]]], df: dict[str, int], n_texts: int, share: float, edits: float = 0.1):
        own = [(i, w) for i, w in items if w]
        words = sorted({x for _, w in own for x in w})
        self.term = {x: k for k, x in enumerate(words)}
        mean = np.mean([len(w) for _, w in own] or [1])
        # words of most texts say nothing about a leak
        idf = {x: max(0.0, math.log((n_texts - df.get(x, 0) + 0.5) / (df.get(x, 0) + 0.5))) for x in words}
        scored = []
        for i, w in own:
            tf = Counter(w)
            norm = K1 * (1 - B + B * len(w) / mean)
            score = {x: idf[x] * c * (K1 + 1) / (c + norm) for x, c in tf.items()}
            piece = piece_of(len(w), share, edits)
            size, lacks, _ = piece
            least = min(self._poorest(score, set(w[a : a + size]), lacks) for a in range(max(1, len(w) - size + 1)))
            scored.append((least, i, w, score, piece))
        scored.sort(key=lambda x: (x[0], x[1]))
        self.items = [(i, w) for _, i, w, _, _ in scored]
        self.least = [x[0] - 1e-3 for x in scored]
        self.piece = [x[4] for x in scored]
        #: Items of words that say nothing: no score keeps them out, their runs of words alone decide.
        self.free = bisect_right(self.least, 0.0)
        # a passage holds a piece with at most one word added, wherever the piece begins
        self.window = max((size for size, _, _ in self.piece), default=1) + 1 + STRIDE - 1
        self.ids = [np.array([self.term[x] for x in w], np.int32) for _, w in self.items]
        runs: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, (x, (_, _, run)) in enumerate(zip(self.ids, self.piece, strict=True)):
            runs.setdefault(run, []).append((np.unique(_run_keys(x, run)), k))
        #: for each length of a run: bits of the keys' hashes, the keys in order, and the items that have them
        self.runs: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray]] = {}
        for run, found in runs.items():
            keys = np.concatenate([x for x, _ in found])
            owners = np.repeat(np.array([k for _, k in found], np.int32), [len(x) for x, _ in found])
            order = np.argsort(keys, kind="stable")
            bits = max(20, int(np.ceil(np.log2(16 * len(keys) + 1))))
            seen = np.zeros(1 << bits, bool)
            seen[keys >> np.uint64(64 - bits)] = True
            self.runs[run] = bits, seen, keys[order], owners[order]
        postings: list[list[tuple[int, float]]] = [[] for _ in words]
        for k, (_, _, _, score, _) in enumerate(scored):
            for x, c in score.items():
                if c > 0 and k >= self.free:
                    postings[self.term[x]].append((k, c))
        self.docs = [[k for k, _ in p] for p in postings]
        self.scores = [[c for _, c in p] for p in postings]
        self.block_max = [[max(c[a : a + BLOCK]) for a in range(0, len(c), BLOCK)] for c in self.scores]
        self.most = np.array([max(m, default=0.0) for m in self.block_max] or [0.0])
        self.threshold = min(self.least, default=math.inf)

    @staticmethod
    def _poorest(score: dict[str, float], words: set[str], lacks: int) -> float:
        values = [score[x] for x in words]
        return sum(values) - (max(values) if lacks and len(values) > 1 else 0)

    def retrieve(self, terms: np.ndarray) -> list[int]:
        """Items that score at least their own threshold for a passage, by block-max WAND.

        Each term has a cursor in its list. The pivot is the first item which the lists
        up to it could lift over its threshold, by their maxima; as thresholds rise with
        the items' numbers, no item before it can pass. If the maxima of the blocks that
        hold the pivot can't lift it, all cursors go on past the nearest block's end;
        else the pivot is scored, once all cursors before it have reached it.
        """
        docs, scores, blocks, least = self.docs, self.scores, self.block_max, self.least
        cursors = [[docs[t][0], 0, t] for t in terms.tolist() if docs[t]]
        most = dict(zip(terms.tolist(), self.most[terms].tolist(), strict=True))
        out = list(range(self.free))
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (item, _, t) in enumerate(cursors):
                bound += most[t]
                if bound >= least[item]:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # the block of each list that would hold the item
            shallow, ends = 0.0, math.inf
            for _, at, t in cursors[: pivot + 1]:
                block = at // BLOCK
                own = docs[t]
                while (block + 1) * BLOCK < len(own) and own[(block + 1) * BLOCK - 1] < item:
                    block += 1
                shallow += blocks[t][block]
                ends = min(ends, own[min((block + 1) * BLOCK, len(own)) - 1])
            if shallow < least[item]:
                goal = max(item, ends) + 1
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1][0])
                goal = max(goal, item + 1)
            elif cursors[0][0] == item:
                if sum(scores[t][at] for _, at, t in cursors[: pivot + 1]) >= least[item]:
                    out.append(item)
                goal = item + 1
            else:
                goal = item
            for c in cursors[: pivot + 1]:
                c[1] = bisect_left(docs[c[2]], goal, c[1])
                c[0] = docs[c[2]][c[1]] if c[1] < len(docs[c[2]]) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def candidates(self, words: list[str]) -> set[int]:
        ids = np.fromiter((self.term.get(x, -1) for x in words), np.int32, len(words))
        starts = np.arange(0, max(1, len(ids) - self.window + STRIDE), STRIDE)
        ends = np.minimum(starts + self.window, len(ids))
        owners = self._with_run(ids, starts, ends)
        if not owners:
            return set()
        likely = np.zeros(len(starts), bool)
        likely[list(owners)] = True
        # a sum over a long text in single precision would be off by more than a word's score
        bound = np.concatenate([[0.0], np.where(ids >= 0, self.most[ids], 0).cumsum(dtype=np.float64)])
        likely &= bound[ends] - bound[starts] >= self.threshold
        found: set[int] = set()
        present = np.zeros(len(self.term), np.int8)
        for k in np.flatnonzero(likely).tolist():
            if owners[k] <= found:
                continue
            s, e = starts[k], ends[k]
            terms = np.unique(ids[s:e])
            terms = terms[terms >= 0]
            if self.most[terms].sum() < self.threshold:
                continue
            present[terms] = 1
            for item in self.retrieve(terms):
                if item in owners[k] and item not in found and self.has_piece(item, present):
                    found.add(item)
            present[terms] = 0
        return found

    def _with_run(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[int, set[int]]:
        """The passages that hold as long a run of an item's words as a piece of it has at least, with these items."""
        out: dict[int, set[int]] = {}
        for run, (bits, seen, known, items) in self.runs.items():
            keys = _run_keys(ids, run)
            for at in np.flatnonzero(seen[keys >> np.uint64(64 - bits)]).tolist():
                low, high = np.searchsorted(known, keys[at], "left"), np.searchsorted(known, keys[at], "right")
                if low < high:
                    own = items[low:high].tolist()
                    # passages that begin at the run or before it and end after it
                    first, last = np.searchsorted(ends, at + run), np.searchsorted(starts, at, "right")
                    for k in range(first, last):
                        out.setdefault(k, set()).update(own)
        return out

    def has_piece(self, item: int, present: np.ndarray) -> bool:
        """Whether, of some piece of the item, the passage lacks at most as many words as the piece may lack."""
        own = np.concatenate([[0], present[self.ids[item]].cumsum()])
        size, lacks, _ = self.piece[item]
        return len(own) > size and bool((own[size:] - own[:-size]).max() >= size - lacks)


def holds(words: list[str], item: list[str], share: float, edits: float) -> bool:
    """Whether ``words`` hold a stretch of at least ``share`` of the item, in order.

    Of the stretch's words at most ``edits`` may be replaced, dropped or added. The
    places where the text may run along the item come from shared runs of four words; around each of
    them the two are aligned.
    """
    need = max(1, math.ceil(len(item) * share))
    n = min(4, piece_of(len(item), share, edits)[2])
    runs: dict[tuple[str, ...], list[int]] = {}
    for k in range(len(item) - n + 1):
        runs.setdefault(tuple(item[k : k + n]), []).append(k)
    places = sorted({(p - k) // 8 for p in range(len(words) - n + 1) for k in runs.get(tuple(words[p : p + n]), ())})
    slack = 8 + int(len(item) * edits) + 8
    around = (words[max(0, 8 * d - slack) : 8 * d + len(item) + slack] for d in places)
    return any(_enough(near, item, need, edits) and _aligned(near, item, need, edits) for near in around)


def _enough(words: list[str], item: list[str], need: int, edits: float) -> bool:
    """Whether the words, in any order, lack few enough of some stretch of the item."""
    present = set(words)
    lacked = np.concatenate([[0], np.cumsum([x not in present for x in item])]) - edits * np.arange(len(item) + 1)
    return bool((lacked[need:] <= np.maximum.accumulate(lacked[: len(item) + 1 - need]) + 1e-9).any())


def _aligned(words: list[str], item: list[str], need: int, edits: float) -> bool:
    """Whether some stretch of the item, from any of its words on, is few enough edits away from some of the words."""
    vocabulary: dict[str, int] = {}
    a = np.array([vocabulary.setdefault(x, len(vocabulary)) for x in item])
    b = np.array([vocabulary.setdefault(x, len(vocabulary)) for x in words])
    # cost[s, j]: the least edits between the item's words from s on and some words that end before j
    cost = np.zeros((max(0, len(a) - need + 1), len(b) + 1), np.int32)
    ramp = np.arange(len(b) + 1, dtype=np.int32)
    for i in range(len(a)):
        begun = cost[: i + 1]
        step = begun + 1
        np.minimum(step[:, 1:], begun[:, :-1] + (b != a[i]), out=step[:, 1:])
        begun[:] = np.minimum.accumulate(step - ramp, axis=1) + ramp
        if i + 1 >= need:
            long = begun[: i + 2 - need]
            if (long.min(axis=1) <= (i + 1 - np.arange(len(long))) * edits + 1e-9).any():
                return True
    return False


def text_frequencies(texts: DataFrame, vocabulary: set[str], max_words: int = MAX_WORDS) -> dict[str, int]:
    """In how many texts each word of the vocabulary stands; under "" the number of texts."""
    words = sorted(vocabulary)
    out: dict[str, int] = {}
    for start in range(0, max(1, len(words)), max_words):
        shared = texts.sparkSession.sparkContext.broadcast(frozenset(words[start : start + max_words]))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known, found = shared.value, Counter()
            for batch in batches:
                found[""] += batch.num_rows
                for whole in batch.column(1).to_pylist():
                    found.update(known.intersection(words_of(whole)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
            )

        counted = texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        out |= {r["word"]: r["n"] for r in counted.collect()}
    return out


def leaked_items(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    share: float = 0.5,
    edits: float = 0.1,
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """(key, item_id): texts that hold at least ``share`` of an item's words in one stretch.

    At most ``edits`` of the stretch's words are replaced, dropped or added; case,
    accents, punctuation and spacing don't count. NULL and blank texts, and items
    without a word, give no rows; an item that repeats counts once, a text that
    repeats gives its rows each time. No items or no texts: no rows. Items, which a
    test set has few of, are held by the driver.
    """
    schema = f"`{key}` {dict(documents.dtypes)[key]}, item_id bigint"
    rows = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    own = sorted((r["item_id"], words_of(r["text"])) for r in rows.collect())
    texts = documents.where(F.col(text).isNotNull()).select(key, text)
    df = text_frequencies(texts, {x for _, w in own for x in w})
    n_texts = df.pop("", 0)

    def passes(start: int) -> DataFrame:
        index = ItemIndex(own[start : start + max_items], df, n_texts, share, edits)
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for batch in batches:
                at, found = [], []
                for k, whole in enumerate(batch.column(1).to_pylist()):
                    words = words_of(whole)
                    for c in sorted(ix.candidates(words)):
                        if holds(words, ix.items[c][1], share, edits):
                            at.append(k)
                            found.append(ix.items[c][0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int32())), pa.array(found, pa.int64())], names=[key, "item_id"]
                )

        return texts.mapInArrow(scan, schema)

    return reduce(DataFrame.unionByName, [passes(k) for k in range(0, max(1, len(own)), max_items)])
