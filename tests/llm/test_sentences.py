import pytest

from casemill.llm import sentences as S

STATS = S.Statistics(
    abbreviations={("en", "inc"), ("en", "s"), ("en", "no"), ("de", "ca")},
    titles={("en", "mr"), ("en", "v")},
    starters={("en", "the"), ("en", "in")},
    collocations={("de", "0", "mai")},
    endings={("th", "ๆ"), ("th", "พยาน")},
    periods={("en", "."), ("fr", "."), ("de", "."), ("es", "."), ("ar", "."), ("xx", ".")},
)
CASES = [
    "The test is clear.|Mr. Torbex v. Galmesk Inc. was heard with the others under s. 12(b).|That is all.",
    "It was for Galmesk Inc.|The end of it is here.",
    "[1] The rate of 3.5 was not met?!|What is left, then, for the rest?",
    "“I left at 5 p.m. I told no one,” said the man.|(See s. 12 of the Act.)|The next one is with the first.",
    "The one had been seen.The other was not\nseen at all.",
    "Le membre a écrit : « Voir la loi. C'est clair. » puis a fermé le dossier.|Sans dépens.",
    "El testigo del caso declaró: «Salí a las 5. No avisé.»|El Sr no trabajó hasta el fin.",
    "Am 5. Mai ist der Brief nicht gekommen, ca. 20 Tage.|Das ist nicht der Fall.",
    "证人说：“我五点离开。我没有告诉任何人。”然后签了字。|失业率为2.3%，高于去年。|是吗？",
    "พยาน|นายจ้าง ใด ๆ|พยาน",
    "धारा डॉ. शोरन ने कहा।|क्या वह था?|हाँ।",
    "3. J. R. Torbex is the member with the file.",
    "HEADING WITHOUT A MARK",
]


@pytest.mark.parametrize("case", CASES)
def test_units(case):
    text, want = "", []
    for part in case.split("|"):
        if text:
            text += "" if text[-1] in "。？" or text.endswith("seen.") else " "
        want.append((len(text), len(text) + len(part)))
        text += part
    if "seen.The" in case:
        cut = case.index("The other")
        want = [(0, cut), (cut, len(case))]
    assert S.units(text, STATS) == want


def test_units_end_with_paragraphs():
    text = " \n \nOne of the\nlines goes on\n \t\n2. and stops with the\r\n\r\nLast one is for the rest. \n\n"
    assert [text[a:b] for a, b in S.units(text, STATS)] == ["One of the\nlines goes on", "2. and stops with the", "Last one is for the rest."]


def test_learning_and_empty_texts(spark):
    lines = [
        "The firm Torbex Inc. asked in the end for the benefits of {n} weeks. In the end Mr. {n} left. The clerk of Linvane Inc. wrote to Mr. {n}. {n} said so in the office.",
        "{n} was in the office for weeks. The clerk of Torbex Inc. asked for it. In that week Mr. {n} saw that Linvane Inc. left the office. In the end the firm wrote to {n}.",
    ]
    rows = [(k, "\n\n".join(lines[k % 2].format(n=n) for n in ("Ostdale", "Quernour", "Vellier")), "en", 0) for k in range(60)]
    rows += [(100, None, None, 0), (101, "", None, 0), (102, " \n\xa0", None, 0), (103, "x" * 50_000, None, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, start_char int")
    st = S.learn(S.corpus_counts(df))
    assert ("en", "mr") in st.titles and ("en", "inc") in st.abbreviations
    got = {}
    for r in S.split_corpus(df).collect():
        got.setdefault(r.doc_id, []).append((r.start_char, r.end_char))
    assert len(got[0]) == 12 and got[103] == [(0, 50_000)] and not got.keys() & {100, 101, 102}


def test_nothing_to_split(spark):
    assert S.split_corpus(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_unclosed_marks_take_one_pass():
    import time

    for text in ("(" * 100_000, "“" * 100_000, "«(" * 50_000 + ")", "„“" * 50_000, "[" * 50_000 + "]" * 50_000):
        began = time.time()
        S.enclosed(text)
        assert time.time() - began < 1
    assert S.enclosed("a (b [c) d] (e") == ([2], [8])
    assert S.enclosed("“a «b” c» (d (e)) (f") == ([0, 10], [6, 17])


def test_long_words_count():
    word = "x" * 50
    counts = S.count_batch([f"It was {word}. no more of {word} here."])
    assert S.word_type(word) == S.word_type(word + ".") != S.word_type(word + "y") and len(S.word_type(word)) == 33
    assert counts["en", "p", S.word_type(word), "lno"] == 1 and counts["en", "w", S.word_type(word), "l"] == 1
