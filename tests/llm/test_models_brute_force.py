"""The trained models against plain loops over dictionaries, on corpora small enough for them."""

import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidepool.llm import langid, quality
from tests.llm.conftest import prose

M = 0xFFFFFFFF


def _adds(into, key, value):
    into[key] = into.get(key, 0.0) + value


def _float32(features):
    """Features travel as single floats."""
    return {k: float(np.float32(v)) for k, v in features.items()}


# -- quality: hashed n-grams, logistic regression, Platt ----------------------

def _quality_bucket(h, kind):
    x = (h * 0x9E3779B1 + (kind * 0x85EBCA6B & M)) & M
    return (((x ^ (x >> 15)) * 0x2C1B3C6D) & M) >> 14


def _quality_features(text):
    words = [zlib.crc32(w.lower().encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    kinds = [[(w, 1) for w in words], [((a * 0x01000193 + b) & M, 2) for a, b in zip(words, words[1:])]]
    for size in (3, 4):
        grams = []
        for at in range(len(text) - size + 1):
            h = 0
            for c in text[at:at + size]:
                h = ((h ^ ord(c)) * 0x01000193) & M
                h ^= h >> 15
            grams.append((h, size + 1))
        kinds.append(grams)
    out = {}
    for grams in kinds:
        for h, kind in grams:
            _adds(out, _quality_bucket(h, kind), 20.0 / len(grams))
    return out


def _sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(rows, labels, steps=150, rate=0.05, l2=1e-5):
    """Full-batch logistic regression with Adam, classes weighted equally; rows are dictionaries."""
    of = {y: labels.count(y) for y in (0, 1)}
    w, m, v = {}, {}, {}
    b = mb = vb = 0.0
    for step in range(1, steps + 1):
        grad, gb = {k: l2 * x for k, x in w.items()}, 0.0
        for x, y in zip(rows, labels):
            g = 0.5 / of[y] * (_sigmoid(b + sum(w.get(k, 0.0) * s for k, s in x.items())) - y)
            gb += g
            for k, s in x.items():
                _adds(grad, k, g * s)
        fix = math.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for k, g in grad.items():
            m[k] = 0.9 * m.get(k, 0.0) + 0.1 * g
            v[k] = 0.999 * v.get(k, 0.0) + 0.001 * g * g
            w[k] = w.get(k, 0.0) - rate * fix * m[k] / (math.sqrt(v[k]) + 1e-8)
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        b -= rate * fix * mb / (math.sqrt(vb) + 1e-8)
    return w, b


def _quality_corpus():
    """Good prose and noisy texts with some words of the other kind, in several scripts."""
    rows = []
    for i in range(24):
        good = i % 2 == 0
        text = prose(i, 14) if good else " ".join(f"#{x}$ 買う日本語 {x}" for x in prose(i, 5).split())
        rows.append((i, text + (" #tag$" if i % 6 == 0 else " the end"), int(good)))
    return rows


def test_quality_model_equals_plain_loops(spark):
    corpus = _quality_corpus()
    docs = spark.createDataFrame([r[:2] for r in corpus], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in corpus], "doc_id long, quality int")
    model = quality.train_quality(docs, labels)
    draws = {r["doc_id"]: r["d"] for r in docs.select("doc_id", F.xxhash64(F.lit("draw"), "doc_id").alias("d")).collect()}
    rows = sorted(corpus, key=lambda r: (draws[r[0]], r[2]))
    features = [_float32(_quality_features(r[1])) for r in rows]
    learn = [i for i in range(len(rows)) if i % 5 != 4]
    check = [i for i in range(len(rows)) if i % 5 == 4]
    assert {rows[i][2] for i in learn} == {rows[i][2] for i in check} == {0, 1}
    w, b = _logistic([features[i] for i in learn], [rows[i][2] for i in learn])
    assert abs(model.bias - b) < 1e-6
    dense = np.zeros(quality.BUCKETS)
    dense[list(w)] = list(w.values())
    assert np.allclose(model.weights, dense, atol=1e-5)
    # the score of a text is the sum over its n-grams, by the same weights
    for r, x in zip(rows, features):
        raw = b + sum(w.get(k, 0.0) * s for k, s in x.items())
        assert abs(model.raw(quality.Text.of(r[1])) - raw) < 1e-4
        assert abs(model.probability(quality.Text.of(r[1])) - _sigmoid(model.slope * raw + model.shift)) < 1e-4
    # no nearby curve fits the rows kept out of training better
    score = [b + sum(w.get(k, 0.0) * s for k, s in features[i].items()) for i in check]
    label = [rows[i][2] for i in check]
    share = {y: sum(r[2] == y for r in rows) / label.count(y) for y in (0, 1)}
    total = {y: share[y] * label.count(y) for y in (0, 1)}
    target = {1: (total[1] + 1) / (total[1] + 2), 0: 1 / (total[0] + 2)}

    def loss(slope, shift):
        out = 0.0
        for s, y in zip(score, label):
            p = _sigmoid(slope * s + shift)
            out -= share[y] * (target[y] * math.log(p) + (1 - target[y]) * math.log(1 - p))
        return out

    best = loss(model.slope, model.shift)
    for factor in (0.5, 0.9, 0.99, 1.0, 1.01, 1.1, 2.0):
        for move in (-1.0, -0.1, -0.01, 0.0, 0.01, 0.1, 1.0):
            assert best <= loss(model.slope * factor, model.shift + move) + 1e-9


def test_character_grams_are_code_points():
    japanese = quality.Text.of("日本語日本語")
    sizes = [total for _, total in japanese.grams()]
    assert sizes == [1, 4, 3]  # one word, 3-grams, 4-grams
    assert [len(set(b.tolist())) for b, _ in japanese.grams()] == [1, 3, 3]


# -- languages: TF-IDF, FTRL with elastic net, temperature --------------------

def _language_features(text):
    out = {}
    text = text.lower()
    for size in (1, 2, 3):
        total = len(text) - size + 1
        for at in range(total):
            h = 0x9E37 * size
            for c in text[at:at + size]:
                h = ((h ^ ord(c)) * 0x01000193) & M
                h ^= h >> 15
            _adds(out, ((h * 0x2C1B3C6D) & M) >> 16, 30.0 / total)
    return out


def _softmax(z):
    top = max(z)
    e = [math.exp(x - top) for x in z]
    return [x / sum(e) for x in e]


def _ftrl(rows, labels, classes, epochs=4, alpha=0.5, beta=1.0, l1=2e-4, l2=1e-4):
    """FTRL-proximal, coordinate by coordinate; feature -1 is the bias, without the first penalty."""
    z, n = {}, {}

    def weight(k, c):
        least = 0.0 if k == -1 else l1
        at = z.get((k, c), 0.0)
        if abs(at) <= least:
            return 0.0
        return -(at - math.copysign(least, at)) / ((beta + math.sqrt(n.get((k, c), 0.0))) / alpha + l2)

    for _ in range(epochs):
        for x, y in zip(rows, labels):
            x = {**x, -1: 1.0}
            w = {(k, c): weight(k, c) for k in x for c in range(classes)}
            p = _softmax([sum(w[k, c] * s for k, s in x.items()) for c in range(classes)])
            each = len(labels) / (classes * labels.count(y))
            for k, s in x.items():
                for c in range(classes):
                    g = each * (p[c] - (c == y)) * s
                    before = n.get((k, c), 0.0)
                    sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / alpha
                    _adds(z, (k, c), g - sigma * w[k, c])
                    n[k, c] = before + g * g
    return {at: weight(*at) for at in z}


def test_language_model_equals_plain_loops(spark):
    letters = {"de": "äöüß" + "einchdt" * 2, "en": "thewaofi" * 2, "ru": "привет мир"}
    corpus = [(i, " ".join("".join(letters[lang][(i * 7 + j * 3 + k * k) % len(letters[lang])] for k in range(2 + (i + j) % 4))
                           for j in range(9)), lang) for i, lang in enumerate(["de", "en", "ru", "en"] * 9)]
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string")
    model = langid.train_languages(docs)
    assert model.languages == ["de", "en", "ru"]
    draws = {r["doc_id"]: r["d"] for r in docs.select("doc_id", F.xxhash64(F.lit("draw"), "text", "doc_id").alias("d")).collect()}
    rows = sorted((r for r in corpus if zlib.crc32(str(r[0]).encode()) % 4 != 2), key=lambda r: (draws[r[0]], r[2]))
    features = [_language_features(r[1]) for r in rows]
    df = {}
    for x in features:
        for k in x:
            _adds(df, k, 1)
    idf = {k: math.log((1 + len(rows)) / (1 + d)) + 1 for k, d in df.items()}
    scaled = [{k: float(np.float32(s)) * idf[k] for k, s in x.items()} for x in features]
    label = [model.languages.index(r[2]) for r in rows]
    learn = [i for i in range(len(rows)) if i % 5 != 4]
    assert {label[i] for i in learn} == {0, 1, 2}
    w = _ftrl([scaled[i] for i in learn], [label[i] for i in learn], 3)
    assert np.allclose(model.bias, [w[-1, c] for c in range(3)], atol=1e-6)
    dense = np.zeros((langid.BUCKETS, 3))
    for (k, c), x in w.items():
        if k >= 0:
            dense[k, c] = x * idf[k]
    assert np.allclose(model.weights, dense, atol=1e-5)
    logits = [[w[-1, c] + sum(w.get((k, c), 0.0) * s for k, s in scaled[i].items()) for c in range(3)] for i in range(len(rows))]
    for r, z in zip(rows, logits):
        p = _softmax([x / model.temperature for x in z])
        assert model.predict(r[1])[0] == model.languages[p.index(max(p))]
        assert abs(model.predict(r[1])[1] - max(p)) < 1e-3

    def loss(t):
        ps = [_softmax([x / t for x in logits[i]]) for i in range(len(rows)) if i % 5 == 4]
        ys = [label[i] for i in range(len(rows)) if i % 5 == 4]
        return (-sum(math.log(max(p[y], 1e-12)) for p, y in zip(ps, ys))
                - sum(math.log(max(1 - max(p), 1e-12)) for p in ps) / len(ps))

    best = min(np.exp(np.linspace(np.log(0.05), np.log(20), 300)), key=loss)
    assert loss(model.temperature) <= loss(best) + 1e-4  # the search ends 1e-4 from the best log temperature
