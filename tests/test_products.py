import csv
import json
from datetime import datetime

from pyspark.sql import functions as F

from casemill.operators import cases, chunks, documents, sampling
from casemill.operators.retrieval import merge, nearest
from casemill.plans import corpus
from casemill.sources import sinks
from casemill.sources.tables import read_artifact
from casemill.streaming.feed import stream_changes


def test_pages_join_in_order_of_number(spark):
    pages = [("a_pages_10", "ten"), ("a_pages_2", "two"), ("a", "zero"), ("a_PAGES_3", None), ("b_pages_1", "")]
    got = {r.case_id: r for r in cases.assemble_cases(spark.createDataFrame(pages, "page_id string, content string")).collect()}
    assert got["a"].content == "zero\n\ntwo\n\nten" and got["a"].page_count == 4
    assert got["b"].content == "" and got["b"].page_count == 1


def test_compare(spark):
    b = spark.createDataFrame([("1", "x"), ("2", None), ("3", None), ("4", "y")], "k string, h string")
    a = spark.createDataFrame([("1", "z"), ("2", None), ("3", "q"), ("5", "n")], "k string, h string")
    assert {r.k: r.status for r in cases.compare(b, a, ["k"], "h").collect()} == {
        "1": "changed", "2": "unchanged", "3": "changed", "4": "deleted", "5": "new",
    }


def test_samples_dont_depend_on_partitions(spark):
    rows = spark.range(400).select(F.format_string("k%d", "id").alias("k"), (F.col("id") % 3).cast("string").alias("g"))
    one = sampling.proportional(rows.repartition(1), "g", "k", 20, "s").collect()
    many = sampling.proportional(rows.repartition(7), "g", "k", 20, "s").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) == 20


def test_markers_are_sequential_and_removable(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/case_records.parquet").distinct()
    texts = {r.id: r.content for r in rows.collect()}
    for r in chunks.marked_documents(rows, every=300, back=50).collect():
        parts = r.document.split("[DOC|MH")
        assert [int(p[:5]) for p in parts[1:]] == list(range(len(parts) - 1))
        bodies = [p[p.index("]") + 1 :] for p in parts[1:-1]]
        inner = [b.removeprefix("\n\n").removesuffix("\n\n") for b in bodies[:-1]]
        assert "".join(inner) + bodies[-1].removeprefix("\n\n").removesuffix("\n") == texts[r.id]


def test_nearest_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    m = rng.normal(size=(60, 8)).round(2)
    m[5] = 0
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(m)], "vec_id bigint, embedding array<double>").repartition(5)
    got = {}
    for r in nearest(rows, rows.where("vec_id < 3"), k=4).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    u = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    for q in range(3):
        s = np.round(u @ u[q], 10)
        want = sorted((k for k in range(60) if k != q), key=lambda k: (-s[k], k))[:4]
        assert [got[q][k] for k in range(1, 5)] == want


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("en", "en/a.txt", "A\nB"), ("fr", "fr/b.txt", 'é "q"')], "lang string, rel_path string, document string")
    sinks.export_files(docs, str(tmp_path / "files"))
    assert (tmp_path / "files/en/a.txt").read_text() == "A\nB"
    sinks.write_documents(docs, str(tmp_path / "docs"), ["lang"])
    assert spark.read.parquet(str(tmp_path / "docs")).where("lang = 'fr'").count() == 1
    sinks.write_manifest(docs.select("rel_path", "lang"), str(tmp_path / "manifest"), ["rel_path"])
    lines = [row for p in sorted((tmp_path / "manifest").glob("*.csv")) for row in csv.reader(p.open())]
    assert ["en/a.txt", "en"] in lines and lines[0] == ["rel_path", "lang"]
    sinks.write_metrics(docs.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "metrics"))
    assert json.loads(next((tmp_path / "metrics").glob("*.txt")).read_text()) == {"n": 2}


def test_change_feed(spark, tmp_path):
    path, heads, schema = str(tmp_path / "in"), str(tmp_path / "heads"), "case_id string, content_hash string, discovered_at string"

    def deliver(scope, day, rows):
        at = datetime(2025, 1, day)
        return sinks.create_snapshot(spark.createDataFrame([(*r, at.isoformat()) for r in rows], schema), path, heads, scope, at)

    def follow():
        stream_changes(spark, path, heads, str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(120)
        rows = spark.read.schema("scope_id string, case_id string, status string, snapshot_id string").parquet(str(tmp_path / "out"))
        return {(r.snapshot_id, r.scope_id, r.case_id, r.status) for r in rows.collect()}

    # three deliveries of one scope and one of another are waiting, not in order
    c = deliver("x", 3, [("a", "2"), ("d", None)])
    deliver("x", 1, [("A ", "1"), ("b", "1")])
    b = deliver("x", 2, [("a", "2"), ("c", None)])
    deliver("y", 2, [("a", "9"), ("b", "1")])
    want = {(b, "x", "a", "changed"), (b, "x", "b", "deleted"), (b, "x", "c", "new"), (c, "x", "c", "deleted"), (c, "x", "d", "new")}
    assert follow() == want
    d = deliver("y", 4, [("b", "1"), ("d", "1")])
    assert follow() == want | {(d, "y", "a", "deleted"), (d, "y", "d", "new")}
    assert spark.read.parquet(heads).where("scope_id = 'x'").agg(F.sum("total_cases")).first()[0] == 6


def test_appends_and_reads_of_artifacts(spark, tmp_path):
    rows = spark.createDataFrame([("a", "one.txt"), ("b", "two.txt"), ("b", "two.txt")], "artifact_id string, text_blob_path string")
    sinks.append_new(rows.where("artifact_id = 'a'"), str(tmp_path / "t"), ["artifact_id"])
    sinks.append_new(rows, str(tmp_path / "t"), ["artifact_id"])
    table = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(r.artifact_id for r in table.collect()) == ["a", "b"]
    (tmp_path / "two.txt").write_text("text")
    assert bytes(read_artifact(table, "b", str(tmp_path)).first().content) == b"text"
    assert read_artifact(table, "none", str(tmp_path)).count() == 0


def test_numbers_within_hot_groups(spark):
    rows = spark.range(3_000).select((F.col("id") * 7 % 3_000).alias("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") < 2_900, "hot").otherwise("b").alias("g"))
    got = {}
    for r in sampling.numbered(rows, "g", "id").collect():
        got.setdefault(r.g, []).append((r.id, r.n))
    assert sum(map(len, got.values())) == 3_000
    for own in got.values():
        assert [n for _, n in sorted(own)] == list(range(1, len(own) + 1))


def test_choice_between_extractions(spark):
    runs = [("1", "p", "text_layer", {"a": True}, "2024-01-02"), ("1", "q", "ocr", {"a": True}, "2024-01-03"), ("2", "p", "text_layer", {"a": False}, "2024-01-01"),
            ("2", "q", "ocr", {"a": False}, "2024-01-01"), ("3", "p", "text_layer", None, "2024-01-01"), ("4", "q", "ocr", {}, "2024-01-01"),
            ("5", "p", "text_layer", {"a": True}, "2024-01-01"), ("5", "r", "text_layer", {"a": None}, "2024-01-02")]
    df = spark.createDataFrame(runs, "case_id string, artifact_id string, extraction_method string, quality_flags map<string,boolean>, extraction_timestamp string")
    got = {r.case_id: (r.artifact_id, r.passed) for r in documents.choose_extraction(df).collect()}
    assert got == {"1": ("p", True), "2": ("q", False), "3": ("p", False), "4": ("q", False), "5": ("r", False)}


def test_best_rows_keep_ties_by_key():
    import numpy as np

    rng = np.random.default_rng(3)
    scores, keys = rng.integers(0, 4, (3, 200)).astype(float), rng.permutation(200)
    best, found = np.full((3, 5), -np.inf), np.zeros((3, 5), np.int64)
    for a in range(0, 200, 40):
        merge(best, found, scores[:, a : a + 40], keys[a : a + 40])
    for i in range(3):
        assert found[i].tolist() == sorted(range(200), key=lambda k: (-scores[i][keys.tolist().index(k)], k))[:5]


def test_corpus_run(spark, tmp_path):
    """Two cases whose names collide get files of their own; everything else is read from the documents made once."""
    tables = tmp_path / "tables"
    text = "The claimant appealed. " * 80
    rows = [(k, "2020 SST 1", "2020-01-01", "sst", 4, lang, text + k, f"d/{k}.pdf", None, None, "S", f"d/{k}.pdf", 1000, "x_2020_7_en", 2)
            for k, lang in (("a", "en"), ("b", "en"), ("c", "fr"), ("b", "en"))]
    rows.append((*rows[1][:6], text, *rows[1][7:]))
    names = "id string, citation string, publication_date string, tribunal string, tribunal_rank int, language string, content string, metadata_relpath string, pdf_link string, web_link string, source_name string, blob_name string, blob_size bigint, file_stem string, page_count int"
    spark.createDataFrame(rows, names).write.parquet(str(tables / "case_records.parquet"))
    spark.createDataFrame([(f"d/{k}.pdf", 9) for k in "abc"], "name string, length bigint").write.parquet(str(tables / "blobs.parquet"))
    settings = corpus.Settings(str(tables), str(tmp_path / "out"), files=str(tmp_path / "files"))
    assert corpus.run(spark, settings) == {"documents": 3, "manifest": 3}
    files = sorted(str(p.relative_to(tmp_path / "files")) for p in (tmp_path / "files").rglob("*.txt"))
    stem = "4-sst_20200101_2020-sst-1_7"
    assert files == [f"en/sst/EN_{stem}.ecl.txt", f"en/sst/EN_{stem}_v2.ecl.txt", f"fr/sst/FR_{stem}.ecl.txt"]
    assert (tmp_path / "files" / files[1]).read_text().rstrip().endswith("x_2020_7_en]")
    made = spark.read.parquet(str(tmp_path / "out/documents"))
    assert made.where("id = 'b'").first().content_length == len(text) + 1 and spark.read.parquet(str(tmp_path / "out/sample")).count() == 1
    assert "KEYWORDS: claimant" in made.first().document and corpus.preview(spark, settings).endswith("[... content continues ...]")
    assert corpus.preflight(spark, corpus.Settings(str(tmp_path), "/proc/none")) == {
        "case_records_readable": False, "blobs_readable": False, "columns_present": False, "output_writable": False,
    }
