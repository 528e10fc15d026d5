import numpy as np
import pytest

from casemill.llm import language as L
from casemill.llm.sentences import language_of

LINES = {
    "en": "The claimant worked for the employer until {} and asked the Commission for benefits",
    "fr": "Le prestataire a travaillé chez son employeur jusqu'en {} et a demandé des prestations",
    "es": "El demandante trabajó para el empleador hasta {} y pidió el pago a la Comisión",
    "de": "Der Antragsteller arbeitete bis {} und die Kommission lehnte die Zahlung ab",
    "zh": "申请人在{}年之前一直为雇主工作，委员会拒绝了这笔款项。",
    "ar": "عمل المدعي في المصنع حتى {} ورفضت اللجنة دفع المبلغ",
}


def texts(start, n):
    return [(LINES[l].format(1990 + (start + k) % 40) + " " + LINES[l].format(k)[k % 9 : 60], l) for l in LINES for k in range(n)]


@pytest.fixture(scope="module")
def net():
    wrong = [(LINES["fr"].format(k), "en") for k in range(6)]
    return L.train(texts(0, 40) + wrong, rounds=240)


def test_held_out_accuracy(net):
    held = [(x[: 20 + k % 60], l) for k, (x, l) in enumerate(texts(17, 25))]
    p = L.line_probabilities(net.net, [x for x, _ in held])
    right = np.mean([net.languages[k] == l for k, (_, l) in zip(p.argmax(axis=1), held, strict=True)])
    assert right > 0.95


def test_gradients():
    net = L.Network(*(w.astype(np.float64) for w in L.new_network(1, 6)))
    rng = np.random.default_rng(1)
    steps, labels = rng.integers(0, 256, (3, 2, L.STRIDE)), np.array([1, 4])

    def loss():
        p, _ = L._forward(net, steps)
        return -np.log(p[:, np.arange(2), labels]).mean()

    p, state = L._forward(net, steps)
    g = L._backward(net, steps, p, labels, state)
    for w, gw in zip(net, g, strict=True):
        for at in [np.unravel_index(int(np.abs(gw).argmax()), gw.shape), tuple(0 for _ in gw.shape)]:
            old, eps = w[at], 1e-3
            w[at] = old + eps
            up = loss()
            w[at] = old - eps
            down = loss()
            w[at] = old
            assert abs((up - down) / (2 * eps) - gw[at]) < 2e-4


def test_batched_and_plain_network_agree(net):
    lines = [LINES["en"], LINES["zh"] * 30, "x", LINES["fr"][:33]]
    got = L.line_probabilities(net.net, lines)
    raw = lines[3].encode()
    raw = raw.ljust(-(-len(raw) // L.STRIDE) * L.STRIDE, b" ")
    steps = np.frombuffer(raw, np.uint8).astype(int).reshape(-1, 1, L.STRIDE)
    p, _ = L._forward(net.net, steps)
    assert np.allclose(p.mean(axis=(0, 1)), got[3], atol=1e-3)


def test_stretches_and_labels(spark, net):
    en, fr, ar = (LINES[l].format(2001) for l in ("en", "fr", "ar"))
    rows = [
        ("ok", "eng", f"{en}\n{en}"), ("wrong", " FR", f"\n{en}\n\n{en}\n"), ("none", None, fr), ("bi", "bi", fr), ("mixed", "en", f"{en}\n\n{fr}\n2001\n{fr}\n{ar}"),
        ("quote", "en", f"{en} “{fr}” in the end\n{en}"), ("null", None, None), ("blank", None, " \n "), ("ok", "eng", f"{en}\n{en}"),
    ]
    df = spark.createDataFrame(rows, "id string, language string, content string")
    got = {tuple(r) for r in L.mislabelled(L.record_languages(df, net, label="language")).collect()}
    assert got == {("wrong", 2, 4, "en"), ("none", 1, 1, "fr"), ("bi", 1, 1, "fr"), ("mixed", 1, 1, "en"), ("mixed", 3, 5, "fr"), ("mixed", 6, 6, "ar")}


def test_no_labels(spark):
    df = spark.createDataFrame([], "text string, label string")
    assert L.training_sample(df) == []
    assert L.record_languages(spark.createDataFrame([], "id string, content string"), L.train([])).count() == 0


def test_labels(spark):
    said = [" EN-ca", "fra", "bi", "und", "", None, "Japanese", "it", "xx", "THA"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(said)], "k int, label string")
    got = [r.l for r in df.select("k", L.label_language(df.label).alias("l")).orderBy("k").collect()]
    assert got == ["en", "fr", None, None, None, None, "ja", "it", None, "th"]


TABLES = "/root/testdata/sf0.01"
ITALIAN = [
    "Il ricorrente ha lavorato nella fabbrica fino alla primavera e poi ha chiesto l'indennità alla commissione del lavoro.",
    "Il giudice ha respinto la domanda perché non c'erano abbastanza settimane di lavoro assicurato negli ultimi due anni.",
    "La signora sostiene che il datore di lavoro non le ha mai consegnato il certificato e che nessuno le rispondeva al telefono.",
    "Dopo l'udienza gli avvocati hanno presentato altri documenti, fra cui gli stipendi degli ultimi sei mesi e due lettere.",
]


@pytest.fixture(scope="module")
def corpus_model(spark):
    rows = spark.read.parquet(f"{TABLES}/documents.parquet").selectExpr("text", "lang AS label")
    records = spark.read.parquet(f"{TABLES}/case_records.parquet").selectExpr("content AS text", "language AS label")
    return L.train(L.training_sample(rows.unionByName(records)))


def test_languages_come_from_the_labels(spark, corpus_model):
    """Held out are texts of larger tables that the smaller ones, whose sample trained the network, don't have."""
    assert {"en", "fr", "es", "de", "zh", "ar", "ja", "th", "hi"} <= set(corpus_model.languages)
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr("doc_id AS id", "text AS content", "lang")
    rows = rows.join(spark.read.parquet(f"{TABLES}/documents.parquet").selectExpr("text AS content"), "content", "left_anti")
    found = L.record_languages(rows.where("length(content) > 200 AND id % 10 = 3"), corpus_model, label="lang").where("said IS NOT NULL")
    first = found.groupBy("id", "said").agg({"lang": "mode"}).toDF("id", "said", "lang").collect()
    # labels are wrong now and then: only those count that script or function words bear out
    texts = {r.id: r.content for r in rows.where("id % 10 = 3 AND content IS NOT NULL").collect()}
    for lang in ("en", "fr", "es", "de", "zh", "ar", "ja", "th", "hi"):
        own = [r.lang == lang for r in first if r.said == lang == language_of(texts[r.id])]
        assert len(own) > 5 and np.mean(own) > 0.95, (lang, np.mean(own))


def test_an_unknown_language_isnt_sure(spark, corpus_model):
    df = spark.createDataFrame([("it", "\n".join(ITALIAN))], "id string, content string")
    got = L.record_languages(df, corpus_model).collect()
    assert {r.lang for r in got} == {L.UNKNOWN} and all(r.confidence < L.LEAST_SURE for r in got)
