import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casemill.functions import text as T
from casemill.functions import wordlists as W
from casemill.operators import chunks, keywords

DOCS = "/root/testdata/sf0.001/documents.parquet"
COVER = "COURT\n\nDocket: A-12-34\n\nCORAM: ROY J.A.\n\nBETWEEN:\n\n[1] The claimant left. 😀 She says no more of it here.\n\n[2] Next."


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(DOCS).where("text IS NOT NULL").select("doc_id", "text")
    more = [(-1, COVER), (-2, "Intro\n\nIssues\n\nThe issue is this. " + "word " * 60), (-3, "x" * 3200), (-4, ""), (-5, "a b\n" * 700),
            (-6, "REASONS FOR JUDGMENT\n\nThe reasons begin in this place, with many words. " + "so it goes " * 20)]
    return rows.unionByName(spark.createDataFrame(more, "doc_id bigint, text string")).cache()


def cuts(t, every=1500, back=100):
    out, pos = [], 0
    while pos + every < len(t):
        end = pos + every
        part = t[end - back : end]
        at = max((k for k, c in enumerate(part) if c.isspace()), default=None)
        pos = end if at is None else end - back + at + 1
        out.append(pos)
    return out


def test_chunk_cuts_and_round_trip(spark, texts):
    got = {r.doc_id: r.c for r in texts.select("doc_id", T.chunk_cuts(F.col("text")).alias("c")).collect()}
    for r in texts.collect():
        assert (got[r.doc_id] or []) == (cuts(r.text) if r.text else [])
    parts = chunks.chunk_table(texts, "doc_id", "text").orderBy("doc_id", "counter").collect()
    joined = Counter()
    for p in parts:
        joined[p.doc_id] = (joined[p.doc_id] or "") + p.chunk
    assert all(joined[r.doc_id] == r.text for r in texts.collect() if r.text)


def test_cuts_need_room():
    with pytest.raises(ValueError):
        T.chunk_cuts(F.col("x"), 100, 100)


def truncated(t, most=900):
    if len(t) <= most:
        return t
    cut = next((i + 1 for i in range(most - 1, most - 200, -1) if t[i] in ".!?"), most)
    return t[:cut].strip()


def test_truncation(texts):
    for r in texts.select("text", T.truncate_on_sentence(F.col("text"), 900).alias("t")).collect():
        assert r.t == truncated(r.text)


def test_anchor_starts_at_the_reasons(texts):
    got = {r.doc_id: r for r in texts.select("doc_id", "text", T.anchor(F.col("text")).alias("a"), T.substantive_start(F.col("text")).alias("s")).collect()}
    assert got[-1].text[got[-1].s :].startswith("\n[1]") or got[-1].text[got[-1].s :].startswith("[1]")
    assert "CORAM" not in got[-1].a and "[1] The claimant" in got[-1].a
    assert got[-2].a.startswith("The issue is this.")
    assert got[-6].a.startswith("The reasons begin")
    assert all(len(r.a) <= 900 for r in got.values())


def test_keywords_against_brute_force(texts):
    extra = "Employment insurance benefits, benefits. section 52 of the EI Act! Misconduct and misconduct, Near near near.\nsee www.x.ca/benefits"
    from pyspark.sql import functions as F

    df = texts.where("doc_id < 40").unionByName(texts.sparkSession.createDataFrame([(-9, extra)], "doc_id bigint, text string"))
    for r in df.where("text <> ''").select("text", keywords.keywords_of(F.col("text")).alias("keywords")).collect():
        t = re.sub(r"\S+@\S+", "", re.sub(r"www\.\S+", "", re.sub(r"https?://\S+", "", r.text)))
        refs = {m.lower().strip() for p in W.STATUTE_PATTERNS for m in re.findall(p, t, re.I)}
        letters = "a-zàâäæçèéêëïîôœùûüÿ"
        words = [w for w in re.split(r"[\W]+", t.lower()) if re.fullmatch(f"[{letters}][{letters}0-9]*", w)]
        kept = [w for w in words if len(w) >= 4 and w not in W.STOP_WORDS and (w in W.LEXICON or w not in W.SURNAMES)]
        scored = [(w, n * W.LEXICON.get(w, 1.0) + (10 if any(w in x for x in refs) else 0)) for w, n in Counter(kept).items() if n > 1]
        scored += [(p.replace(" ", "-"), t.lower().count(p) * w) for p, w in W.LEXICON.items() if " " in p and p in t.lower()]
        scored.sort(key=lambda x: -x[1])
        assert r.keywords == (", ".join(w for w, _ in scored[:7]) or "none")


@pytest.mark.parametrize(
    ("hint", "body"),
    [("2007 SCC 22", "scc"), ("scc_2007", "unknown"), ("décaf", "fca"), ("FCT 12", "fc"), ("/fc/", "fc"), ("2011 TSS 8", "sst"), (None, "unknown")],
)
def test_tribunal(spark, hint, body):
    df = spark.createDataFrame([(hint,)], "h string")
    assert df.select(T.tribunal_of(F.col("h")).alias("b")).first().b == body


def test_names(spark):
    df = spark.createDataFrame([("x_PAGES_10", "a/b/scc_2007-SCC-22_9_en.pdf", " 2007 SCC  22 ", "2024-01-05", "Été & Co.")], "p string, f string, c string, d string, n string")
    r = df.select(
        T.page_number(F.col("p")).alias("n"), T.without_page_suffix(F.col("p")).alias("b"), T.file_stem(F.col("f")).alias("s"), T.path_language(F.col("f")).alias("l"),
        T.case_key(F.col("c"), F.lit("a_b_c"), F.lit("i")).alias("k"), T.case_key(F.lit(None).cast("string"), F.lit("a_b_c_d"), F.lit("i")).alias("k2"),
        T.compact_date(F.col("d")).alias("d"), T.slug(F.col("n")).alias("g"), T.slug(F.lit(None).cast("string")).alias("g2"),
    ).first()
    assert tuple(r) == (10, "x", "scc_2007-SCC-22_9_en", "en", "2007-SCC-22", "b_c", "20240105", "t-co.", "unknown")


def test_export_names_and_link_ids(spark):
    rows = [("en", "SCC", 1, "2007-05-01", "2007 SCC 22", "scc_2007-SCC-22_34996_en", "abcdefghijklmnop"), (None, "board", 5, None, None, "x", "id Ü/9")]
    df = spark.createDataFrame(rows, "l string, t string, k int, d string, c string, s string, i string")
    got = [r.n for r in df.select(T.export_name(*(F.col(x) for x in "ltkdcsi")).alias("n")).collect()]
    assert got == ["EN_1-scc_20070501_2007-scc-22_34996", "UNKNOWN_5-unknown_99999999_id-9_id-9"]
    links = [("https://x/decisions/en/12345/1/document.do", "a_9.pdf"), (None, "case_12345_en.pdf"), ("https://x/1", "b/2001_0042.pdf"), (None, None)]
    df = spark.createDataFrame(links, "l string, p string")
    assert [r.n for r in df.select(T.link_id(df.l, df.p).alias("n")).collect()] == ["12345", "12345", "0042", None]
