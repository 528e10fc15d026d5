from casemill.llm import scans as S

BODY = ["the commission told the claimant that the appeal was filed on time and that", "the hearing of a member would proceed by telephone from the office in the well-known north",
        "because the parties asked for more time to prepare their final submissions on"]


def scanned(*lines):
    return "\n".join(lines)


def corpus():
    rows = [(f"d{k}", " ".join(BODY) + ".\n" + "A second sentence on a self-employed person follows here, and it is long enough to stand alone as a line of text.") for k in range(40)]
    words = ["thc commission", "the cornmission", "the appea1 was", "the clairnant of", "wou1d proceed", "the hcaring in", "the officc and", "their fina1 part", "the partics now", "more tirne to", "the mernber and"]
    for k in range(33):
        wrong = words[k % len(words)]
        rows.append((f"s{k}", scanned(
            "Torbex v. Galmesk  2010 SST 7", BODY[0], BODY[1], f"and {wrong} was heard by the member in the northern office at that time by tele-",
            "phone as the parties had asked for more time before the hearing of the well-", "known person who worked as a self-", "employed carpenter for the claimant in the town of the office and of the appeal",
            "- 1 -", "", "TORBEX V. GALMESK  2010 SST 7", BODY[2], BODY[1], "the appeal is dismissed.", "2")))
    return rows


def test_flaws_of_scans(spark):
    rows = corpus() + [("n", None), ("e", ""), ("b", " \n ")]
    found = S.repair(spark.createDataFrame(rows, "id string, content string"))
    got = {(r.line_no, r.kind) for r in S.flawed_lines(found).where("id = 's3'").collect()}
    assert got == {(1, "header"), (10, "header"), (8, "page_number"), (14, "page_number"), (4, "broken"), (4, "misread")}
    ids = {r.id for r in S.flawed_lines(found).select("id").distinct().collect()}
    assert ids == {f"s{k}" for k in range(33)}
    text = S.repaired_text(found).where("id = 's3'").first().text
    assert "by telephone as" in text and "self-employed carpenter" in text and "well-known person" in text
    assert "clairnant" not in text and "claimant of was heard" in text and "SST 7" not in text


def test_nothing_to_repair(spark):
    found = S.repair(spark.createDataFrame([], "id string, content string"))
    assert S.flawed_lines(found).count() == 0 and S.repaired_text(found).count() == 0


def test_best_path_weighs_both_neighbours():
    edges = [(3, "a", "x", -1.0), (3, "a", "y", -0.5), (4, "x", "b", -0.1), (4, "y", "b", -2.0), (9, "p", "q", -1.0)]
    assert S.best_path(edges) == {3: "x", 4: "b", 9: "q"}


def test_variants_undo_two_confusions():
    confusions = {"1": [("l", -1.0)], "rn": [("m", -2.0)]}
    assert S.variants("rna1l", confusions) == {"mall": -3.0, "ma1l": -2.0, "rnall": -1.0}


def test_running_heads_without_a_citation():
    body = ["the claimant asked the commission for more time to file the", "appeal and the commission refused to give it because of the", "delay which was long and had no good reason behind it at"]
    for heads in (
        ["ANNUAL REPORT OF THE BOARD"] * 8,
        [f"CHAPTER 3  EVIDENCE  {k}" for k in range(8)],
        [f"{k} Rapport annuel de la Commission" for k in range(8)],
        ["Office of the Registrar", "Offlce of the Registrar", *["Office of the Registrar"] * 6],
    ):
        lines = [x for h in heads for x in (h, *body, "")]
        kinds = S.layout(lines)
        assert [k for k, kind in enumerate(kinds) if kind == S.HEADER] == list(range(0, 40, 5)), heads[0]
    # headings stand above an empty line, and what ends a sentence is text
    names = ["Torbex", "Galmesk", "Ostmesk", "Brentok", "Lurvia", "Pandry"]
    lines = [x for n in names for x in ("Reasons", "", f"{n} said that {body[0]}", *body, "")]
    assert S.HEADER not in S.layout(lines)
    lines = [x for n in names for x in ("The appeal is dismissed.", f"{n} said that {body[0]}", *body, "")]
    assert S.HEADER not in S.layout(lines)


def test_gaps_of_words_meet_where_the_rest_is_equal():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"word": ["commission", "cornmission", "été", "a" * 300], "clean": [9, 0, 5, 4], "scanned": [0, 1, 0, 0]})
    got = next(S._frames(iter([batch]))).to_pylist()
    by = {(r["word"], r["block"], r["frame"]) for r in got}
    shared = {(a[1], b[1]) for a in by for b in by if a[0] == "commission" and b[0] == "cornmission" and a[2] == b[2]}
    assert shared == {("m", "rn")}
    assert sum(r["word"] == "a" * 300 for r in got) == 599


def test_corrections_change_their_own_place_only():
    content = "the form was here and the forrn\nwas there, but a well-\nknown man and a tele-\nphone rang"
    assert S._mended(content, S.layout(content.split("\n")), {6: "form"}, {3}) == "the form was here and the form was there, but a well-known man and a telephone rang"
    assert S._mended(content, S.layout(content.split("\n")), {1: "farm"}, set()) == "the farm was here and the forrn was there, but a well-known man and a tele-phone rang"


def test_neighbours_are_corrected_together(spark):
    rows = corpus()
    rows += [(f"t{k}", rows[40][1].replace(BODY[2], "because thc clairnant asked for more time to prepare their final submissions on")) for k in range(3)]
    found = S.repair(spark.createDataFrame(rows, "id string, content string"))
    got = {(r.word, r.correction) for r in found.corrections.where("id = 't1'").collect()}
    assert {("thc", "the"), ("clairnant", "claimant")} <= got
