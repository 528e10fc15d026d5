"""Languages of records and of the stretches of mixed records.

A small bidirectional gated recurrent network reads a line as bytes, STRIDE bytes a
step, and gives every position a distribution over the languages.  Which languages
there are is read from the labels of a bounded sample; on its lines the network is
trained with numpy, by backpropagation through time, and lines whose labels it
contradicts after a third and after two thirds of the rounds are left out of the rest.
The positions are pooled to lines; over the lines of a record a Viterbi path with a
price for each change of language gives its stretches.  A network must choose among
the languages it knows: how much of a stretch's runs of bytes the training lines of
its language have, against lines held out, tells a language that it doesn't know.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of languages in labels, before any region. Other labels of two letters stand for themselves.
SPELLINGS = {
    "en": "en", "eng": "en", "english": "en", "anglais": "en",
    "fr": "fr", "fra": "fr", "fre": "fr", "french": "fr", "français": "fr", "francais": "fr",
    "es": "es", "spa": "es", "spanish": "es", "español": "es", "espanol": "es", "espagnol": "es",
    "de": "de", "deu": "de", "ger": "de", "german": "de", "deutsch": "de", "allemand": "de",
    "zh": "zh", "zho": "zh", "chi": "zh", "chinese": "zh", "cn": "zh", "chinois": "zh",
    "ar": "ar", "ara": "ar", "arabic": "ar", "arabe": "ar",
    "ja": "ja", "jpn": "ja", "jp": "ja", "japanese": "ja", "japonais": "ja",
    "th": "th", "tha": "th", "thai": "th",
    "hi": "hi", "hin": "hi", "hindi": "hi",
}
#: Labels that name no language: several, undetermined, none.
NO_LANGUAGE = ("bi", "mu", "na", "no", "nn", "un", "xx", "zz")
#: What the language of a stretch is called that none of the known ones fits.
UNKNOWN = "und"
#: A language is learnt from so many labelled texts on, as labels may be wrong.
LEAST_TEXTS = 10
#: Bits of the table of a language's runs of four bytes; a confidence below LEAST_SURE is no known language's.
GRAM_BITS, LEAST_SURE = 20, 0.3
#: A stretch with fewer such runs than this can't tell that its language isn't known.
LEAST_RUNS = 400
STRIDE, HIDDEN = 4, 16
#: Bytes of a line that the network reads at once; longer lines are read in so many windows.
WINDOW_BYTES = 512
#: Bounds of the training sample: labelled texts for each language, and lines of each.
TEXTS_PER_LANGUAGE, LINES_PER_TEXT = 400, 6
SWITCH = 4.5
_QUOTED = re.compile(r"«[^«»]*»|“[^“”]*”|„[^„“”]*[“”]|\"[^\"]*\"|「[^「」]*」")
_WORDS = re.compile(r"[^\W\d_]+")


def label_language(label: Column) -> Column:
    """The language that a label names in any spelling; NULL where it names none."""
    stem = F.coalesce(F.regexp_extract(F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+\z", "")), r"^(\p{L}+)", 1), F.lit(""))
    table = F.create_map(*(F.lit(x) for pair in SPELLINGS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, stem), F.when(stem.rlike("^[a-z]{2}$") & ~stem.isin(*NO_LANGUAGE), stem))


class Network(NamedTuple):
    """Weights for the two directions (rows 0 and 1) and of the output."""

    inputs: np.ndarray  # 2, STRIDE, 256, 3 * HIDDEN: what each byte of a step adds to the gates
    bias: np.ndarray  # 2, 3 * HIDDEN
    recurrent: np.ndarray  # 2, HIDDEN, 3 * HIDDEN
    out: np.ndarray  # 2 * HIDDEN, languages
    out_bias: np.ndarray  # languages


class Model(NamedTuple):
    """A network with the languages of its output; for each the runs of bytes of its lines, and how many of them held-out texts have."""

    net: Network
    languages: tuple[str, ...]
    familiar: np.ndarray  # languages, 2 ** GRAM_BITS / 8
    least: np.ndarray  # languages


def new_network(seed: int, n: int) -> Network:
    rng = np.random.default_rng(seed)
    gates = 3 * HIDDEN
    return Network(
        rng.normal(0, 0.3, (2, STRIDE, 256, gates)).astype(np.float32),
        np.zeros((2, gates), np.float32),
        rng.normal(0, HIDDEN**-0.5, (2, HIDDEN, gates)).astype(np.float32),
        rng.normal(0, 0.3, (2 * HIDDEN, n)).astype(np.float32),
        np.zeros(n, np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _forward(net: Network, steps: np.ndarray) -> tuple[np.ndarray, list]:
    """Probabilities (T, B, languages) for steps (T, B, STRIDE) of equal length, and what training needs."""
    T, B, _ = steps.shape
    kept, hidden = [], np.zeros((2, T, B, HIDDEN), np.float32)
    for d in range(2):
        x = net.bias[d] + sum(net.inputs[d, k][steps[:, :, k]] for k in range(STRIDE))
        h, rows = np.zeros((B, HIDDEN), np.float32), []
        for t in range(T) if d == 0 else range(T - 1, -1, -1):
            z_r = _sigmoid(x[t, :, : 2 * HIDDEN] + h @ net.recurrent[d][:, : 2 * HIDDEN])
            z, r = z_r[:, :HIDDEN], z_r[:, HIDDEN:]
            inner = h @ net.recurrent[d][:, 2 * HIDDEN :]
            c = np.tanh(x[t, :, 2 * HIDDEN :] + r * inner)
            rows.append((t, h, z, r, c, inner))
            h = z * h + (1 - z) * c
            hidden[d, t] = h
        kept.append(rows)
    both = np.concatenate([hidden[0], hidden[1]], axis=2)
    logits = both @ net.out + net.out_bias
    p = np.exp(logits - logits.max(axis=2, keepdims=True))
    return p / p.sum(axis=2, keepdims=True), [kept, both]


def _backward(net: Network, steps: np.ndarray, p: np.ndarray, labels: np.ndarray, state: list) -> Network:
    """Gradients of the mean cross-entropy of all positions, backwards through time."""
    T, B, n = p.shape
    kept, both = state
    d_logits = p.copy()
    d_logits[:, np.arange(B), labels] -= 1
    d_logits /= T * B
    flat = d_logits.reshape(-1, n)
    g = Network(*(np.zeros_like(w) for w in net))
    g.out[:] = both.reshape(-1, 2 * HIDDEN).T @ flat
    g.out_bias[:] = flat.sum(axis=0)
    d_both = d_logits @ net.out.T
    for d in range(2):
        u = net.recurrent[d]
        d_x = np.zeros((T, B, 3 * HIDDEN), np.float32)
        carry = np.zeros((B, HIDDEN), np.float32)
        for t, h, z, r, c, inner in reversed(kept[d]):
            dh = d_both[t, :, d * HIDDEN : (d + 1) * HIDDEN] + carry
            dz = dh * (h - c) * z * (1 - z)
            dc = dh * (1 - z) * (1 - c * c)
            dr = dc * inner * r * (1 - r)
            d_x[t] = np.concatenate([dz, dr, dc], axis=1)
            into = np.concatenate([dz, dr, dc * r], axis=1)
            g.recurrent[d] += h.T @ into
            carry = dh * z + into @ u.T
        flat_x = d_x.reshape(-1, 3 * HIDDEN)
        g.bias[d] += flat_x.sum(axis=0)
        for k in range(STRIDE):
            # rows of equal bytes are added up through a one-hot product
            one = np.zeros((256, T * B), np.float32)
            one[steps[:, :, k].ravel(), np.arange(T * B)] = 1
            g.inputs[d, k] += one @ flat_x
    return g


def train(lines: list[tuple[str, str]], seed: int = 5, rounds: int = 500, batch: int = 96, length: int = 96) -> Model:
    """Trains on (text, language) lines with Adam; the languages are drawn equally often.

    After a third and after two thirds of the rounds, lines that the network gives
    another language with certainty are dropped: their labels are taken to be wrong.
    One line in ten is held out; training ends early where their loss falls no more.
    """
    rng = np.random.default_rng(seed)
    languages = tuple(sorted({lang for _, lang in lines}))
    net = new_network(seed, max(1, len(languages)))
    if not languages:
        return Model(net, (UNKNOWN,), np.zeros((1, (1 << GRAM_BITS) // 8), np.uint8), np.zeros(1))
    own = [[x for x, l in lines if l == lang] for lang in languages]
    held = [(x, k) for k, pool in enumerate(own) for x in pool[::10]]
    pools = [[x for i, x in enumerate(pool) if i % 10] or pool for pool in own]
    m, v = Network(*(np.zeros_like(w) for w in net)), Network(*(np.zeros_like(w) for w in net))
    losses: list[float] = []
    for step in range(1, rounds + 1):
        if step in (rounds // 3, 2 * rounds // 3):
            for k, pool in enumerate(pools):
                right = line_probabilities(net, pool)[:, k] > 0.2
                if right.sum() >= 5:
                    pools[k] = [x for x, r in zip(pool, right, strict=True) if r]
            p = line_probabilities(net, [x for x, _ in held])
            held = [x for x, q in zip(held, p, strict=True) if q[x[1]] > 0.2] or held
        if step > 2 * rounds // 3 and step % 50 == 0:
            p = line_probabilities(net, [x for x, _ in held])
            losses.append(float(-np.log(np.maximum(p[np.arange(len(held)), [k for _, k in held]], 1e-9)).mean()))
            if len(losses) > 2 and losses[-1] > 0.99 * min(losses[:-2]):
                break
        labels = rng.integers(len(languages), size=batch)
        size = int(rng.choice([24, 48, length]))
        steps = np.zeros((size // STRIDE, batch, STRIDE), np.int64)
        for b, k in enumerate(labels):
            text = pools[k][rng.integers(len(pools[k]))]
            if rng.random() < 0.1:
                text = text.upper()
            raw = text.encode()
            start = int(rng.integers(max(1, len(raw) - size + 1)))
            part = np.frombuffer(raw[start : start + size].ljust(size, b" "), np.uint8)
            steps[:, b] = part.reshape(-1, STRIDE)
        p, state = _forward(net, steps)
        g = _backward(net, steps, p, labels, state)
        rate = 0.02 * (0.1 ** (step / rounds))
        for w, gw, mw, vw in zip(net, g, m, v, strict=True):
            mw += 0.1 * (gw - mw)
            vw += 0.01 * (gw * gw - vw)
            w -= rate * (mw / (1 - 0.9**step)) / (np.sqrt(vw / (1 - 0.99**step)) + 1e-7)
    familiar = np.zeros((len(languages), 1 << GRAM_BITS), bool)
    for k, pool in enumerate(pools):
        grams, _ = _grams(pool)
        familiar[k, grams] = True
    known, size = familiarity(familiar, [x for x, _ in held], np.array([k for _, k in held]))
    least = np.ones(len(languages))
    for k in range(len(languages)):
        mine = np.array([j == k for _, j in held]) & (size > 0)
        if mine.any():
            least[k] = np.quantile(known[mine] / size[mine], 0.05)
    return Model(net, languages, np.packbits(familiar, axis=1), least)


def _grams(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each four bytes in a row of the lines in lower case, and the lines that they stand in."""
    raw = [x.lower().encode("utf-8", "replace") for x in lines]
    joined = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    sizes = np.array([len(x) for x in raw], np.int64)
    if len(joined) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    code = joined[:-3] | joined[1:-2] << np.uint32(8) | joined[2:-1] << np.uint32(16) | joined[3:] << np.uint32(24)
    owner = np.repeat(np.arange(len(lines)), sizes)
    whole = owner[:-3] == owner[3:]
    return (code[whole] * np.uint32(2_654_435_761)) >> np.uint32(32 - GRAM_BITS), owner[:-3][whole]


def familiarity(familiar: np.ndarray, lines: list[str], lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each line, how many runs of four bytes the lines of its language have, and how many runs it has."""
    grams, owner = _grams(lines)
    if not len(lines):
        return np.zeros(0), np.zeros(0)
    hit = familiar[lang[owner], grams]
    return np.bincount(owner, hit, len(lines)), np.bincount(owner, minlength=len(lines)).astype(float)


def line_probabilities(net: Network, lines: list[str], pair: list[list[np.ndarray]] | None = None) -> np.ndarray:
    """(lines, languages): the mean over all positions of each line; even for an empty line.

    Lines go through the network sorted by length, so that a step works on those that
    still have bytes and nothing is padded.
    """
    n = len(net.out_bias)
    out = np.full((len(lines), n), 1 / n, np.float64)
    owner, pieces = [], []
    for k, line in enumerate(lines):
        raw = line.encode("utf-8", "replace")
        for a in range(0, len(raw), WINDOW_BYTES):
            owner.append(k)
            pieces.append(raw[a : a + WINDOW_BYTES])
    if not pieces:
        return out
    pair = pair or pair_tables(net)
    n_steps = np.array([-(-len(x) // STRIDE) for x in pieces])
    order = np.argsort(-n_steps, kind="stable")
    total, weight = np.zeros((len(lines), n)), np.zeros(len(lines))
    start = 0
    while start < len(order):
        T = int(n_steps[order[start]])
        chosen = order[start : start + max(64, 120_000 // T)]
        start += len(chosen)
        raw = b"".join(pieces[k].ljust(T * STRIDE, b" ") for k in chosen)
        steps = np.frombuffer(raw, "<u2").reshape(len(chosen), T, STRIDE // 2).transpose(1, 0, 2)
        alive = np.searchsorted(-n_steps[chosen], -np.arange(T), "left")
        hidden = np.zeros((T, len(chosen), 2 * HIDDEN), np.float32)
        for d in range(2):
            uzr, uc = np.ascontiguousarray(net.recurrent[d][:, : 2 * HIDDEN]), np.ascontiguousarray(net.recurrent[d][:, 2 * HIDDEN :])
            h = np.zeros((len(chosen), HIDDEN), np.float32)
            for t in range(T) if d == 0 else range(T - 1, -1, -1):
                b = alive[t]
                own = h[:b]
                x = pair[d][0][steps[t, :b, 0]]
                for k in range(1, STRIDE // 2):
                    x += pair[d][k][steps[t, :b, k]]
                # the gates' tables and weights are halved, so that tanh gives the logistic function
                zr = np.tanh(x[:, : 2 * HIDDEN] + own @ uzr * np.float32(0.5))
                c = own @ uc
                c *= zr[:, HIDDEN:] * np.float32(0.5) + np.float32(0.5)
                c += x[:, 2 * HIDDEN :]
                np.tanh(c, out=c)
                own -= c
                own *= zr[:, :HIDDEN] * np.float32(0.5) + np.float32(0.5)
                own += c
                hidden[t, :b, d * HIDDEN : (d + 1) * HIDDEN] = own
        logits = hidden.reshape(-1, 2 * HIDDEN) @ net.out + net.out_bias
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        p = logits.reshape(T, len(chosen), n)
        p *= (np.arange(len(chosen))[None, :] < alive[:, None])[:, :, None]
        owners = np.array([owner[k] for k in chosen])
        np.add.at(total, owners, p.sum(axis=0))
        np.add.at(weight, owners, n_steps[chosen])
    some = weight > 0
    out[some] = total[some] / weight[some, None]
    return out


def pair_tables(net: Network) -> list[list[np.ndarray]]:
    """For either direction the inputs by two bytes at once, with the bias; the gates' part halved."""
    scale = np.concatenate([np.full(2 * HIDDEN, 0.5), np.ones(HIDDEN)]).astype(np.float32)
    out = []
    for d in range(2):
        tables = []
        for k in range(0, STRIDE, 2):
            low, high = net.inputs[d, k], net.inputs[d, k + 1]
            both = (high[:, None, :] + low[None, :, :]).reshape(65_536, -1)  # little-endian: the second byte is the high one
            tables.append(((both + (net.bias[d] if k == 0 else 0)) * scale).astype(np.float32))
        out.append(tables)
    return out


def readable(line: str) -> str:
    """A line without quotations, unless there is little else; figures count for nothing."""
    bare = _QUOTED.sub(" ", line) if any(q in line for q in "«“„\"「") else line
    if bare is not line and len(bare) * 3 < len(line):
        bare = line
    return bare.strip()


def telling(line: str) -> int:
    """Letters of a line that tell its language: those of words that don't begin in upper case, as names do.

    In scripts without spaces a letter says as much as two.
    """
    n = sum(len(w) for w in _WORDS.findall(line) if not w[0].isupper())
    return 2 * n if any(x > "\u2fff" for x in line) else n


def stretches(p: np.ndarray, letters: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each line: the best path, where a change costs ``switch``.

    A line speaks for itself by its telling letters, of which those beyond 60 add
    nothing; where no line has any, by all alike.
    """
    if not letters.any():
        letters = np.ones(len(letters))
    evidence = np.log(np.maximum(p, 1e-4)) * (np.minimum(letters, 60) / 15)[:, None]
    n = evidence.shape[1]
    score, back = evidence[0].copy(), np.zeros((len(p), n), np.int8)
    for t in range(1, len(p)):
        best = int(score.argmax())
        moved = score[best] - switch
        back[t] = np.where(score >= moved, np.arange(n), best)
        score = np.maximum(score, moved) + evidence[t]
    path = np.zeros(len(p), np.int8)
    path[-1] = int(score.argmax())
    for t in range(len(p) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def training_sample(labelled: DataFrame, texts_per_language: int = TEXTS_PER_LANGUAGE, seed: int = 3) -> list[tuple[str, str]]:
    """At most TEXTS_PER_LANGUAGE * LINES_PER_TEXT lines (text, language) for each language with LEAST_TEXTS texts.

    ``labelled`` has text and label. Distinct texts are drawn by hash, at the rate that
    each language needs: a text that is there a million times counts once, and only
    the texts drawn are shuffled.
    """
    rows = labelled.where("text IS NOT NULL").select("text", label_language(F.col("label")).alias("lang")).where("lang IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect() if r["n"] >= LEAST_TEXTS}
    if not sizes:
        return []
    rate = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, int(1_200_000 * texts_per_language / n))))
    drawn = rows.where(F.pmod("h", F.lit(1_000_000)) < F.try_element_at(rate, F.col("lang")))
    long_enough = F.shuffle(F.filter(F.split("text", "\n"), lambda x: F.length(x) >= 20), F.lit(seed))
    # the bound of what comes to the driver: so many lines of a text, and so much of a line
    lines = F.transform(F.slice(long_enough, 1, LINES_PER_TEXT), lambda x: F.substring(x, 1, 2_000))
    sample = drawn.select("lang", "h", lines.alias("lines")).dropDuplicates(["lang", "h"]).limit(2 * texts_per_language * len(sizes))
    return sorted({(readable(line)[:600], r["lang"]) for r in sample.collect() for line in r["lines"]})


def record_languages(records: DataFrame, model: Model, key: str = "id", text: str = "content", label: str | None = None) -> DataFrame:
    """(key, line_from, line_to, lang, confidence, n_langs[, said]): the stretches of every record.

    Lines count from 1 over the text split at line feeds. A stretch goes from its first
    to its last non-blank line; confidence is the mean probability of its language over
    its letters, less where the stretch has fewer of the language's runs of bytes than
    other texts of it have. A stretch that fits none of the known languages is "und".
    NULL and blank texts give no rows; repeated rows each give theirs. With ``label``,
    said is the language that the record's label names.
    """
    shared = records.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        pair, familiar = pair_tables(model.net), np.unpackbits(model.familiar, axis=1).view(bool)
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                yield _judge(whole.slice(start, 2_000), model, pair, familiar, key)

    said = [label_language(F.col(label)).alias("said")] if label else []
    kinds = f"`{key}` {dict(records.dtypes)[key]}, line_from int, line_to int, lang string, confidence double, n_langs int"
    return records.select(key, text, *said).mapInArrow(judge, kinds + (", said string" if label else ""))


def _known_path(path, ids, p, top, letters, known, size, model):
    """The path without short stretches that don't fit their language, and the confidence of a stretch.

    What is too short to tell a language that isn't known goes with the longer of the
    stretches around it.
    """

    def sure_of(a: int, b: int, lang: int) -> float:
        part = ids[a:b]
        weight = letters[part] + 1e-3
        confidence = float((p[part, lang] * weight).sum() / weight.sum())
        # lines that the path gave this language against their own word say nothing of its runs of bytes
        part = part[top[part] == lang]
        runs = size[part].sum()
        return confidence * min(1.0, known[part].sum() / runs / model.least[lang]) ** 6 if runs else confidence

    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(ids)]
    if len(cuts) > 2:
        path = path.copy()
        lengths = [int(size[ids[a:b]].sum()) for a, b in zip(cuts, cuts[1:], strict=False)]
        old = path.copy()
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if lengths[k] < LEAST_RUNS and sure_of(a, b, int(old[a])) < LEAST_SURE:
                around = [x for x in (k - 1, k + 1) if 0 <= x < len(lengths)]
                path[a:b] = old[cuts[max(around, key=lambda x: (lengths[x], -x))]]
    return path, sure_of


def _judge(batch: pa.RecordBatch, model: Model, pair: list[list[np.ndarray]], familiar: np.ndarray, key: str) -> pa.RecordBatch:
    index: dict[str, int] = {}
    docs = []
    for content in batch.column(1).to_pylist():
        own = [(no, index.setdefault(readable(x), len(index))) for no, x in enumerate((content or "").split("\n"), 1) if x and not x.isspace()]
        docs.append(own)
    lines = list(index)
    p = line_probabilities(model.net, lines, pair)
    letters = np.array([telling(x) for x in lines] or [0])
    top = p.argmax(axis=1) if len(lines) else np.zeros(0, int)
    known, size = familiarity(familiar, lines, top)
    at, froms, tos, langs, sure, many = [], [], [], [], [], []
    for k, own in enumerate(docs):
        if not own:
            continue
        ids = np.array([i for _, i in own])
        path = np.full(len(ids), top[ids[0]]) if (top[ids] == top[ids[0]]).all() else stretches(p[ids], letters[ids])
        path, sure_of = _known_path(path, ids, p, top, letters, known, size, model)
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(ids)]
        found = len(set(path.tolist()))
        for a, b in zip(cuts, cuts[1:], strict=False):
            confidence = sure_of(a, b, int(path[a]))
            at.append(k)
            froms.append(own[a][0])
            tos.append(own[b - 1][0])
            langs.append(model.languages[int(path[a])] if confidence >= LEAST_SURE else UNKNOWN)
            sure.append(confidence)
            many.append(found)
    places = pa.array(at, pa.int32())
    said = {"said": batch.column(2).take(places)} if batch.num_columns > 2 else {}
    return pa.RecordBatch.from_pydict(
        {
            key: batch.column(0).take(places),
            "line_from": pa.array(froms, pa.int32()),
            "line_to": pa.array(tos, pa.int32()),
            "lang": pa.array(langs, pa.string()),
            "confidence": pa.array(sure, pa.float64()),
            "n_langs": pa.array(many, pa.int32()),
            **said,
        }
    )


def mislabelled(found: DataFrame, key: str = "id") -> DataFrame:
    """(key, line_from, line_to, lang): stretches of mixed records, and records whose label is missing or wrong.

    ``found`` is what record_languages gives with a label; rows come out once.
    """
    wrong = found.where((F.col("n_langs") > 1) | ~F.col("lang").eqNullSafe(F.col("said")))
    return wrong.select(key, "line_from", "line_to", "lang").distinct()
