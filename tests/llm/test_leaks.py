import random

import pytest

from casemill.llm import leaks as K

VOCABULARY = [f"w{k}" for k in range(400)]
COMMON = ["the", "of", "and", "in"]


def sentence(rng, n):
    return [rng.choice(VOCABULARY if rng.random() < 0.7 else COMMON) for _ in range(n)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(text, item):
    """Whether some half of the item is within a tenth of edits of some stretch of the text."""
    n = -(-len(item) // 2)
    for size in range(n, len(item) + 1):
        most = int(size * 0.1)
        for a in range(len(item) - size + 1):
            part = item[a : a + size]
            for s in range(len(text)):
                if s + size - most > len(text):
                    break
                if any(distance(part, text[s : s + size + d]) <= most for d in range(-most, most + 1)):
                    return True
    return False


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    items = [(k, sentence(rng, rng.choice([34, 36, 40]))) for k in range(12)]
    texts = []
    for k in range(40):
        item = items[k % 12][1]
        share = rng.choice([0.3, 0.45, 0.55, 0.7, 1.0])
        part = list(item[: int(len(item) * share)] if k % 2 else item[-int(len(item) * share) :])
        for _ in range(rng.choice([0, 1, 2, 3, 6])):
            at = rng.randrange(len(part))
            act = rng.randrange(3)
            if act == 0:
                part[at] = "zzz"
            elif act == 1:
                part.insert(at, "yyy")
            elif len(part) > 1:
                del part[at]
        texts.append(sentence(rng, rng.randrange(30)) + part + sentence(rng, rng.randrange(30)))
    return items, texts


def test_against_brute_force(spark, case):
    items, texts = case
    marks = [" ", ", ", " — ", "\n", ". "]
    docs = [(k, "".join(w.upper() + marks[(k + i) % 5] if i % 3 else w + marks[i % 5] for i, w in enumerate(t)), "x") for k, t in enumerate(texts)]
    docs += [(98, None, "x"), (99, "", "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    table = spark.createDataFrame([(i, " ".join(w), "en") for i, w in items] + [(7, " ".join(items[7][1]), "en"), (50, None, "en"), (51, "--", "en")], "item_id bigint, text string, lang string")
    got = {tuple(r) for r in K.leaked_items(df, table).collect()}
    near = {(k, i) for k, t in enumerate(texts) for i, w in items if len(set(t) & set(w)) >= 10 and K.holds(t, w, 0.5, 0.1)}
    assert got == near and len(got) > 10
    assert {tuple(r) for r in K.leaked_items(df, table, max_items=5).collect()} == got
    for k, i in sorted((k, k % 12) for k in range(0, 40, 4)):
        assert brute(texts[k], items[i][1]) == ((k, i) in got), (k, i)


def edited(part, places, act):
    out = []
    for k, w in enumerate(part):
        if k not in places:
            out.append(w)
        elif act == "replace":
            out.append(f"zzz{k}")
        elif act == "add":
            out += [f"zzz{k}", w]
    return out


@pytest.mark.parametrize("act", ["replace", "add", "drop"])
def test_half_items_with_edits_in_the_worst_places(spark, act):
    rng = random.Random(11)
    items = [(k, sentence(rng, n)) for k, n in enumerate([19, 39, 40, 52, 60, 84])]
    texts, want = [], set()
    for i, item in items:
        n = -(-len(item) // 2)
        e = n // 10
        even = {round((k + 1) * (n + 1) / (e + 1)) - 1 for k in range(e)}
        middle = set(range((n - e) // 2, (n - e) // 2 + e))
        for places in (even, middle):
            texts.append(sentence(rng, 5) + edited(item[len(item) - n :], places, act) + sentence(rng, 5))
            want.add((len(texts) - 1, i))
            # brute force is slow on longer items
            assert len(item) > 40 or brute(texts[-1], item)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")
    assert {tuple(r) for r in K.leaked_items(docs, table).collect()} == want


def test_every_placement_of_edits_is_retrieved():
    rng = random.Random(12)
    for length, share, edits in [(40, 0.5, 0.1), (60, 0.5, 0.1), (84, 0.5, 0.1), (14, 0.5, 0.1), (9, 0.5, 0.1), (30, 0.2, 0.25), (40, 0.5, 0.0)]:
        item = sentence(rng, length)
        index = K.ItemIndex([(0, item), (1, sentence(rng, 50))], {}, 100, share, edits)
        need = -(-int(length * share * 10) // 10)
        for _ in range(300):
            n = rng.randrange(need, length + 1)
            a = rng.randrange(length - n + 1)
            places = set(rng.sample(range(n), int(n * edits + 1e-9)))
            text = sentence(rng, rng.randrange(12)) + edited(item[a : a + n], places, rng.choice(["replace", "add", "drop"])) + sentence(rng, rng.randrange(12))
            assert 0 in {index.items[c][0] for c in index.candidates(text)} and K.holds(text, item, share, edits)


def test_a_longer_exact_part_elsewhere_hides_nothing():
    item = [f"w{k}" for k in range(60)]
    other = edited(item[30:], {5, 15, 25}, "replace")
    text = item[:26] + ["zzz"] * 20 + other
    assert not K.holds(item[:26], item, 0.5, 0.1) and K.holds(other, item, 0.5, 0.1) and K.holds(text, item, 0.5, 0.1)


def test_accents_and_case_dont_count():
    assert K.words_of("Été  d’ÉTÉ, l'été!") == ["ete", "d", "ete", "l", "ete"]
    assert K.words_of("naïve 中文 é") == ["naive", "中文", "e"]


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert K.leaked_items(docs, items).count() == 0
    assert K.leaked_items(spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string"), items.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 3, 64])
def test_wand_retrieves_what_scoring_all_items_would(monkeypatch, block):
    import numpy as np

    monkeypatch.setattr(K, "BLOCK", block)
    rng = random.Random(13)
    items = [(k, sentence(rng, rng.randrange(6, 60))) for k in range(150)]
    df = {w: rng.randrange(60) for w in VOCABULARY} | {w: 80 for w in COMMON}
    index = K.ItemIndex(items, df, 100, 0.5)
    hits = 0
    for _ in range(300):
        part = rng.choice(items)[1]
        words = part[: rng.randrange(4, 20)] + sentence(rng, rng.randrange(12))
        terms = np.unique([index.term[w] for w in words if w in index.term])
        score = np.zeros(len(items))
        for t in terms:
            for k, c in zip(index.docs[t], index.scores[t], strict=True):
                score[k] += c
        want = np.flatnonzero(score >= np.array(index.least)).tolist()
        assert sorted(index.retrieve(terms)) == want
        hits += len(want)
    assert hits > 100


def test_words_are_counted_in_several_passes(spark):
    texts = spark.createDataFrame([(1, "a b c"), (2, "b c d"), (3, "")], "doc_id bigint, text string")
    assert K.text_frequencies(texts, {"a", "b", "d", "x"}, max_words=1) == {"": 3, "a": 1, "b": 2, "d": 1}
