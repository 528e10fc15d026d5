from pyspark.sql import functions as F

from casemill.llm import repeated_lines as R
from casemill.llm import target_sample as S
from casemill.llm.records import distinct_records, site_of

LINE = "This decision may be published by the Portal"
SCHEMA = "id string, source_name string, tribunal string, content string, record string, drop int"


def rows():
    out = [(f"a{k}", " Site ", "x", f"» {LINE.upper()}  {k} |\nOwn text of record number {k} in words {'abcdefghij'[k]}", "r", 1) for k in range(4)]
    out += [(f"b{k}", None, "SST", None, "r", 1) for k in range(97)]
    out += [(f"c{k}", None, "sst", f"{LINE}\nshort\n{LINE}!", "r", 1) for k in range(3)]
    return [*out, out[0]]


def keyed(df):
    return R.keyed_records(df, site_of(F.col("source_name"), F.col("tribunal")))


def test_repeated_lines(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    k = keyed(df)
    lines = R.excessive(R.line_state(k))
    got = sorted((r.id, r.line_no) for r in R.lines_in(k, lines).collect())
    # of 100 records of sst three have the line: just the three per cent
    assert got == [(f"a{i}", 1) for i in range(4)] + [(f"c{i}", n) for i in range(3) for n in (1, 3)]
    clean = {r.id: r.content for r in R.without_lines(df, R.lines_in(k, lines)).collect()}
    assert clean["a1"].startswith("Own text") and clean["c0"] == "short" and clean["b1"] is None and len(clean) == 104


def test_deltas_add_up(spark):
    df = spark.createDataFrame(rows(), SCHEMA).distinct()
    old, new = keyed(df.where("id < 'b5'")), keyed(df.where("id >= 'b5'"))
    merged = R.merge_state(R.line_state(old), R.line_state(new))
    whole = R.line_state(keyed(df))
    assert sorted(map(tuple, merged.counts.collect())) == sorted(map(tuple, whole.counts.collect()))
    changed = R.crossings(R.excessive(R.line_state(old)), R.excessive(merged))
    assert [(r.site, r.is_excessive) for r in changed.collect()] == [("sst", True)]


def tables(spark, df, folder, bounds):
    out = R.LineTables(spark, str(folder))
    for low, high in zip(bounds, bounds[1:], strict=False):
        out.add(keyed(df.where((F.col("id") >= low) & (F.col("id") < high))))
    return out


def test_any_deltas_give_the_same_lines(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(rows(), SCHEMA)
    want = [(f"a{i}", 1) for i in range(4)] + [(f"c{i}", n) for i in range(3) for n in (1, 3)]
    for k, bounds in enumerate((["a", "z"], ["a", "b", "b5", "c1", "c2", "z"], ["a", "z", "z"], ["c", "d", "e"])):
        got = tables(spark, df, tmp_path / str(k), bounds)
        assert sorted((r.id, r.line_no) for r in got.found().collect()) == [x for x in want if bounds[0] <= x[0] < bounds[-1]]
    # three records of c alone are over the threshold; ninety-seven more of their site still leave three per cent, and one more doesn't
    more = df.unionByName(spark.createDataFrame([("b99", None, "sst", "x", "r", 1)], SCHEMA))
    got = tables(spark, more, tmp_path / "m", ["c", "d"])
    got.add(keyed(more.where("id < 'c'")))
    assert {r.id for r in got.found().collect()} == {f"a{i}" for i in range(4)}
    assert got.rebuilt().count() == 3
    # a record that comes again doesn't count again, and salted keys give what sent lines give
    got.add(keyed(more.where("id >= 'b'")))
    assert got.rebuilt().count() == 0 and got._last("sizes").where("site = 'sst'").first().n_site == 101
    monkeypatch.setattr(R, "MAX_SENT", 0)
    got = tables(spark, df, tmp_path / "s", ["a", "b5", "z"])
    assert sorted((r.id, r.line_no) for r in got.found().collect()) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert R.lines_in(keyed(df), R.excessive(R.line_state(keyed(df)))).count() == 0


TARGETS = "target_id bigint, tribunal string, language string, year_from int, year_to int, target_share double, min_rows bigint"
RECORDS = "id string, tribunal string, language string, publication_date string, target_id int, year_from int"


def records(spark):
    rows = [(f"r{k}", "SST" if k % 3 else "fc", [" EN-CA", "fr", None][k % 7 % 3], f"{2000 + k % 20}-01-01" if k % 11 else "n.d.", 5, 5) for k in range(900)]
    return spark.createDataFrame(rows, RECORDS)


def test_sample_follows_targets(spark):
    targets = [(1, "sst", "en", 2000, 2019, 0.5, 2), (2, "sst", "fr", 2000, 2019, 0.3, 2), (3, "fc", "en", 2000, 2019, 0.2, 2),
               (4, "scc", "en", 2000, 2019, 0.0, 7), (5, "fc", "fr", 2000, 2019, None, 12)]
    df, goals = records(spark), spark.createDataFrame(targets, TARGETS)
    out = S.target_sample(df, goals, 100)
    report = {r.target_id: r for r in out.report.collect()}
    taken = {r.target_id: r["count"] for r in out.sample.groupBy("target_id").count().collect()}
    assert report[4].available == 0 and report[4].gap == 7 and report[1].needed == 50
    assert taken == {k: r.sampled for k, r in report.items() if r.sampled}
    assert taken[5] == 12 and all(taken[k] >= min(report[k].needed, report[k].available) for k in (1, 2, 3))
    assert out.sample.select("id").distinct().count() == out.sample.count()
    again = S.target_sample(df.repartition(5), goals, 100)
    assert sorted(map(tuple, again.sample.collect())) == sorted(map(tuple, out.sample.collect()))


def test_sample_of_nothing(spark):
    none = spark.createDataFrame([], RECORDS)
    goals = spark.createDataFrame([(1, "sst", "en", 2000, 2019, 0.5, 2)], TARGETS)
    out = S.target_sample(none, goals, 0)
    assert out.sample.count() == 0 and out.report.first().gap == 2
    assert S.target_sample(records(spark), goals.limit(0), 10).sample.count() == 0


def test_raking_meets_margins():
    import numpy as np

    have, want = np.array([50, 10, 20, 40]), np.array([10.0, 10, 10, 10])
    margins = [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])]
    fitted = S.rake(have, want, margins)
    for m in margins:
        assert np.allclose(np.bincount(m, fitted), np.bincount(m, want))


def test_rows_are_told_apart_by_all_columns(spark):
    df = spark.createDataFrame([("1", "x", {"a": True}), ("1", "x", {"a": False}), ("1", "x", {"a": True})], "id string, content string, m map<string,boolean>")
    assert distinct_records(df, "id").count() == 2 and distinct_records(df, "id", "content").count() == 2


def test_a_hot_cell_is_divided_until_it_is_small(spark, monkeypatch):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("sst").alias("tribunal"), F.lit("en").alias("language"), F.lit("2001").alias("publication_date"))
    goals = spark.createDataFrame([(1, "sst", "en", 2000, 2019, 1.0, 2)], TARGETS)
    want = sorted(r.id for r in S.target_sample(rows, goals, 7_001).sample.collect())
    assert len(want) == 7_001
    for most, parts in ((50, 1_024), (1, 3)):
        monkeypatch.setattr(S, "MAX_SORTED", most)
        monkeypatch.setattr(S, "PARTS", parts)
        assert sorted(r.id for r in S.target_sample(rows, goals, 7_001).sample.collect()) == want
