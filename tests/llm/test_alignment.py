import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casemill.llm import alignment as A

EN = ["The appeal of {n} is dismissed.", "Mr. {n} worked for {m} until March {d}, 2004.", "I disagree.", "The cheque No. {d} for $1,2{d}.50 was cashed by {n}."]
FR = ["L'appel de {n} est rejeté.", "M. {n} a travaillé pour {m} jusqu'au {d} mars 2004.", "Je ne suis pas d'accord.", "Le chèque no {d} de 1 2{d},50 $ a été encaissé par {n}."]
NAMES = ["Torbex", "Galmesk", "Ostdale", "Linvane", "Quernour", "Vellier"]
SCHEMA = "id string, content string, tribunal string, citation string"


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(0, 10_000))
def test_assignment_is_the_best(n, m, seed):
    score = np.random.default_rng(seed).random((n, m)).round(2)
    rows, columns = np.nonzero(score > 0.3)
    got = sum(score[i, j] - 0.3 for i, j in A.assign(rows, columns, score[rows, columns] - 0.3))
    best = max(
        sum(score[i, j] - 0.3 for i, j in zip(rows, columns, strict=True))
        for k in range(min(n, m) + 1)
        for rows in itertools.combinations(range(n), k)
        for columns in itertools.permutations(range(m), k)
    )
    assert abs(got - best) < 1e-6


def versions(k):
    name, other = NAMES[k % 6], NAMES[(k + 1) % 6]
    en, fr = [], []
    for t in range(4):
        v = {"n": name if t % 2 else other, "m": other, "d": 10 + (k * 7 + t) % 19}
        en.append(EN[t].format(**v))
        fr.append(FR[t].format(**v))
    return en, fr


def test_pairs_with_merges_omissions_and_reordering(spark):
    rows, want = [], set()
    for k in range(30):
        en, fr = versions(k)
        a, b = f"a{k:02d}", f"b{k:02d}"
        text_en = "\n".join([en[0], "", en[1], en[2], en[3]])
        # the first two change places, in half of the texts the third is joined to the last; every third text lacks the second
        joined = fr[3].removesuffix(".") + " ; " + fr[2][0].lower() + fr[2][1:]
        last = [joined] if k % 2 else [fr[3], fr[2]]
        lines = [fr[1], fr[0], *last] if k % 3 else [fr[0], *last]
        rows += [(a, text_en, "SST", f"2010 SST {k}"), (b, "\n".join(lines), "sst", f"2010 TSS no {k}")]
        place = {x: i for i, x in enumerate(lines, 1)}
        want |= {(a, b, 1, place[fr[0]]), (a, b, 4, place[last[-1]]), (a, b, 5, place[last[0]])}
        want |= {(a, b, 3, place[fr[1]])} if k % 3 else set()
    rows += [("z1", None, "sst", "2010 SST 1"), ("z2", "The end of it is here with the others.", "sst", None), ("z3", "", "fc", "2010 FC 1")]
    got = {tuple(r) for r in A.aligned_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.95


def test_figures_are_the_same_in_both_languages():
    assert set(A.line_words("paid $1,234.50 on May 1, 2004")) & set(A.line_words("a versé 1\xa0234,50 $ le 1er mai 2004")) == {"#123450", "#1", "#2004"}


def test_nothing_to_align(spark):
    assert A.aligned_lines(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("dense", [0, 1_000_000])
def test_long_texts_with_repeated_lines(monkeypatch, dense):
    monkeypatch.setattr(A, "DENSE_LINKS", dense)
    lex = A.Lexicon({"appeal": {"appel"}, "dismissed": {"rejeté"}}, {}, {}, 5.0)
    en = "\n".join(f"The appeal {k} is dismissed." if k % 2 else "The appeal is dismissed." for k in range(900))
    fr = "\n".join(f"L'appel {k} est rejeté." if k % 2 else "L'appel est rejeté." for k in range(900))
    got = A.align(en, fr, lex)
    assert {(k + 1, k + 1) for k in range(1, 900, 2)} <= set(got) and len(got) >= 900


def test_large_groups_keep_the_optimum():
    # a chain of more than 400 lines, in which the heaviest pairs take both partners of two lighter ones
    rows = np.array([x for k in range(300) for x in ([k, k] if k else [k])])
    columns = np.array([x for k in range(300) for x in ([k - 1, k] if k else [k])])
    gain = np.array([0.3 if i == j else (0.4 if i % 2 else 0.1) for i, j in zip(rows, columns)])
    assert sorted(A.assign(rows, columns, gain)) == [(k, k) for k in range(300)]
    rng = np.random.default_rng(3)
    for _ in range(30):
        part = rng.random((rng.integers(2, 9), rng.integers(2, 9)))
        part[rng.random(part.shape) < 0.5] = 0
        r, c = np.nonzero(part)
        if len(r):
            best = sum(part[i, j] for i, j in A.hungarian(part))
            found = A.sparse_hungarian([(int(i), int(j), float(part[i, j])) for i, j in zip(r, c)])
            assert len({i for i, _ in found}) == len({j for _, j in found}) == len(found)
            assert abs(sum(part[i, j] for i, j in found) - best) < 1e-9


def all_pairs():
    one, two = [["a", "b"], ["a"], ["#3", "c"]], [["x"], ["x", "y"], ["#3", "z"]]
    pairs, plain_a, plain_b = A.anchored(one, two)
    assert pairs == [(2, 2)] and plain_a == [0, 1] and plain_b == [0, 1]
    text_1, text_2 = "a b\na\n3 c", "x\nx y\n3 z"
    want = {}
    for i, j in [*pairs, *((i, j) for i in plain_a for j in plain_b)]:
        for x in {"", *(w for w in one[i] if w[0] != "#")}:
            for y in {"", *(w for w in two[j] if w[0] != "#")}:
                want[x, y] = want.get((x, y), 0) + 1
    return text_1, text_2, want


def test_lines_without_marks_meet_as_all_pairs_would(spark):
    text_1, text_2, want = all_pairs()
    df = spark.createDataFrame([("1", text_1, "2", text_2)], "id_1 string, content_1 string, id_2 string, content_2 string")
    assert {(r.a, r.b): r.n for r in A.cooccurrences(df).collect()} == want


def test_anchors_by_blocks(monkeypatch):
    lines = [[f"#{k}", f"#{k // 3}x"] for k in range(50)]
    whole = A.anchored(lines, lines[::-1])
    monkeypatch.setattr(A, "BLOCK", 7)
    assert A.anchored(lines, lines[::-1]) == whole and len(whole[0]) == 50
