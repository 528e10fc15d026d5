import random

from hypothesis import given, settings
from hypothesis import strategies as st

from casemill.llm import tokens

PIECES = ["a", "don't", " ", "  ", "\n", "\n\n ", "\xa0", "\x1c", "。", "一二三", "😀", "3.14", "'re", "'", "été", "\t", "ﬁ", "́"]


def mixed(rng, n):
    return "".join(rng.choice(PIECES) for _ in range(n))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'r e.\n\xa0\x1c\x85é中。😀1"), max_size=400), st.integers(1, 40))
def test_pieces_have_the_tokens_of_the_whole(text, size):
    parts = tokens.independent_pieces(text, size)
    assert "".join(parts) == text
    assert [i for p in parts for i in tokens.encode(p)] == list(tokens.encode(text))


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=200))
def test_round_trip(text):
    assert tokens.decode(list(map(int, tokens.encode(text)))) == text


def test_same_ids_as_another_library():
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    rng = random.Random(1)
    for _ in range(50):
        text = mixed(rng, 60) + "<|endoftext|>"
        assert list(tokens.encode(text)) == other.encode(text, add_special_tokens=False).ids


def test_corpus_ids_of_long_texts(spark):
    rng = random.Random(2)
    texts = [None, "", " ", "x" * 3000, "  \n " * 500, "中文" * 900, mixed(rng, 3000), "we're " * 700, "'" * 700 + "re " * 300, "a\n\n\n" * 600]
    rows = [(k, t, "clash", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, piece_no int")
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(df, chunk_chars=257, overlap=64).collect()}
    for k, t in enumerate(texts):
        assert got[k] == [int(i) for i in tokens.encode(t)], k


def test_counts_and_budget(spark):
    rng = random.Random(3)
    long = mixed(rng, 900)
    rows = [("1", "s", long, 9), ("1", "s", long, 9), ("2", None, None, 9), ("3", "t", "", 9), ("4", "t", "one two", 9)]
    df = spark.createDataFrame(rows, "id string, source string, content string, n_tokens int")
    counted = tokens.token_counts(df, chunk_chars=100)
    n = len(tokens.encode(long))
    assert sorted((r.id, r.n_tokens) for r in counted.collect()) == [("1", n), ("1", n), ("2", 0), ("3", 0), ("4", 2)]
    budget = {(r.level, r.source): (r.n_records, r.n_tokens) for r in tokens.token_budget(counted, ["source"]).collect()}
    assert budget[("source", "s")] == (2, 2 * n) and budget[("source", None)] == (1, 0) and budget[("all", None)] == (5, 2 * n + 2)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert tokens.encode_corpus(df).count() == 0
    assert tokens.token_counts(spark.createDataFrame([], "id string, content string")).count() == 0
    budget = tokens.token_budget(spark.createDataFrame([], "source string, n_tokens bigint"), ["source"])
    assert budget.count() == 0 and budget.columns == ["level", "source", "n_records", "n_tokens", "tokens_per_record"]


def test_repeated_and_missing_keys_keep_their_rows(spark):
    rng = random.Random(4)
    one, two = mixed(rng, 700), mixed(rng, 800)
    rows = [(1, one), (1, two), (1, one), (None, one), (2, "short"), (2, "short"), (2, None)]
    got = tokens.encode_corpus(spark.createDataFrame(rows, "doc_id bigint, text string"), chunk_chars=257, overlap=64).collect()
    want = [(k, [int(i) for i in tokens.encode(t)]) for k, t in rows]
    assert sorted(map(repr, ((r.doc_id, r.ids) for r in got))) == sorted(map(repr, want))


def test_row_digests_tell_where_nulls_stand(spark):
    from casemill.sources.tables import row_digest

    rows = spark.createDataFrame([("a", "x", None), ("a", None, "x"), ("a", "x", None)], "id string, b string, c string")
    assert rows.select(*row_digest(rows)).distinct().count() == 2
