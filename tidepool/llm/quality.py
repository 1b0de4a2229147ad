"""Quality rules and a calibrated n-gram classifier.

Base figures of every text come from exact passes over its words and lines.
The classifier is a logistic regression on hashed word n-grams (1 and 2
words) and character n-grams (3 and 4 code points); a feature is an n-gram's share
of the text's n-grams of its kind, so a score is the mean weight of the
text's n-grams per kind and needs no sparse vectors.  It learns from a bounded
sample of labelled rows, is calibrated (Platt) on labelled rows kept out of
training, and is applied in Arrow batches against a fixed threshold.

Scale: scoring reads each text once where it lies, with no exchange; the
sample is bounded by ``TRAIN_PER_CLASS`` labelled rows and is the only thing
broadcast or collected.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\f\r"
MIN_WORDS = 20
WINDOW_WORDS = 8
MAX_REPEAT_PERCENT = 30

BUCKETS = 1 << 18
THRESHOLD = 0.5
TRAIN_PER_CLASS = 1500  # the classifier learns from at most so many labelled rows of each class
_STEPS, _RATE, _L2 = 150, 0.5, 1e-5
_SCALE = 20.0
_CHUNK = 1 << 20


def repeated_words(ids: np.ndarray, size: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``size`` words that stand twice or more in the text."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        h = np.zeros(n, np.uint64)
        for j in range(size):
            h = h * np.uint64(0x100000001B3) + mixed[j:j + n]
    order = np.sort(h)
    if not (order[1:] == order[:-1]).any():
        return 0
    # equal windows exactly: name windows of doubled length by their halves' names
    names, width = ids.astype(np.int64), 1
    while width < size:
        step = min(width, size - width)
        left, right = names[:len(names) - step], names[step:]
        _, names = np.unique(left * (int(names.max()) + 1) + right, return_inverse=True)
        width += step
    counts = np.bincount(names)
    starts = np.flatnonzero(counts[names] > 1)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + size, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


@dataclass
class Text:
    """One text's words, as the figures and the features need them."""

    text: str
    raw: bytes
    ids: np.ndarray
    unique: list[bytes]

    @classmethod
    def of(cls, text: str | None) -> Text:
        text = text or ""
        raw = text.encode("utf-8")
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in raw.split()), np.int64)
        return cls(text, raw, ids, list(seen))

    def figures(self) -> tuple[int, int, int, int, int]:
        """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
        raw = self.raw
        chars = len(self.text) - (len(raw) - len(raw.translate(None, SPACES)))
        symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        return len(self.ids), chars, symbols, len(lines) - len(set(lines)), repeated_words(self.ids)

    def grams(self):
        """Hash buckets of the n-grams, one array per kind and chunk, with the kind's total."""
        with np.errstate(over="ignore"):
            words = np.fromiter((zlib.crc32(w.lower()) for w in self.unique), np.uint32, len(self.unique))[self.ids]
            yield _bucket(words, 1), len(words)
            if len(words) > 1:
                yield _bucket(words[:-1] * np.uint32(0x01000193) + words[1:], 2), len(words) - 1
            codes = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
            for size in (3, 4):
                total = len(codes) - size + 1
                for at in range(0, max(total, 0), _CHUNK):
                    part = codes[at:at + _CHUNK + size - 1]
                    n = len(part) - size + 1
                    h = np.zeros(n, np.uint32)
                    for j in range(size):
                        h = (h ^ part[j:j + n]) * np.uint32(0x01000193)
                        h ^= h >> np.uint32(15)
                    yield _bucket(h, size + 1), total


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    x = h * np.uint32(0x9E3779B1) + np.uint32(kind * 0x85EBCA6B & 0xFFFFFFFF)
    return ((x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 18)


@dataclass
class QualityModel:
    weights: np.ndarray | None  # per bucket; None: nothing to learn from, every text passes
    bias: float = 0.0
    slope: float = 1.0  # Platt calibration of the raw score
    shift: float = 0.0

    def raw(self, text: Text) -> float:
        if self.weights is None:
            return 0.0
        z = self.bias
        for bucket, total in text.grams():
            if len(bucket):
                z += _SCALE * float(self.weights[bucket].sum()) / total
        return z

    def probability(self, text: Text) -> float:
        if self.weights is None:
            return 1.0
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.raw(text) + self.shift, -30, 30))))


def _features(batches):
    """Sparse features of labelled texts: buckets and shares, as packed arrays."""
    for b in batches:
        index, value = [], []
        for t in b.column("t").to_pylist():
            text = Text.of(t)
            kept, share = [np.zeros(0, np.int64)], [np.zeros(0)]
            for bucket, total in text.grams():
                u, n = np.unique(bucket, return_counts=True)
                kept.append(u.astype(np.int64))
                share.append(_SCALE * n / total)
            u, inverse = np.unique(np.concatenate(kept), return_inverse=True)
            index.append(u.astype(np.int32).tobytes())
            value.append(np.bincount(inverse, np.concatenate(share), len(u)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("label"), b.column("draw"), pa.array(index, pa.binary()),
                                          pa.array(value, pa.binary())], names=["label", "draw", "index", "value"])


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", per_class: int = TRAIN_PER_CLASS) -> QualityModel:
    """Learn from at most ``per_class`` labelled rows of each class, chosen by a hash of the id.

    Labels other than 0 and 1, labels of ids without a document and repeated
    labels are left out before the choice.  With fewer than two classes there
    is nothing to learn and every text passes.
    """
    key = F.col(id_col)
    labels = labels.select(key.alias("__id"), F.col(label_col).alias("label"), F.xxhash64(F.lit("draw"), key).alias("draw"))
    labels = labels.where(F.col("label").isin(0, 1) & F.col("__id").isNotNull()).distinct()
    labels = materialize(labels.join(docs.select(key.alias("__id")).distinct(), "__id", "left_semi"), "quality-labels")
    share = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    sample = None
    for c in (0, 1):
        part = labels.where(F.col("label") == c).orderBy("draw", "__id").limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    # at most 2 * per_class rows of three numbers: bounded whatever the input
    rows = (docs.select(key.alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .join(F.broadcast(sample), "__id").select(F.col("label").cast("int").alias("label"), "draw", "t")
            .distinct()  # repeated rows teach once
            .mapInArrow(_features, "label int, draw long, index binary, value binary").toPandas())
    if rows["label"].nunique() < 2:
        return QualityModel(None)
    rows = rows.sort_values(["draw", "label"], kind="stable").reset_index(drop=True)
    index = [np.frombuffer(x, np.int32) for x in rows["index"]]
    value = [np.frombuffer(x, np.float32) for x in rows["value"]]
    label = rows["label"].to_numpy(np.float64)
    train = np.arange(len(rows)) % 5 != 4
    if len(set(label[train])) < 2 or len(set(label[~train])) < 2:
        train[:] = True
    weights, bias = _fit(index, value, label, train)
    score = np.array([bias + float(weights[i] @ v) for i, v in zip(index, value)])
    kept = train if train.all() else ~train
    # calibration rows stand for all labelled rows of their class
    stand = np.array([share.get(int(y), 1) / max(1, (label[kept] == y).sum()) for y in label[kept]])
    slope, shift = _platt(score[kept], label[kept], stand)
    return QualityModel(weights.astype(np.float32), bias, slope, shift)


def _fit(index, value, label, train) -> tuple[np.ndarray, float]:
    """Full-batch logistic regression, classes weighted equally, Adam steps."""
    rows = np.flatnonzero(train)
    at = np.concatenate([index[i] for i in rows]).astype(np.int64)
    x = np.concatenate([value[i] for i in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), [len(index[i]) for i in rows])
    y = label[rows]
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, b = np.zeros(BUCKETS), 0.0
    m, v, mb, vb = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    for step in range(1, _STEPS + 1):
        z = np.bincount(row, x * w[at], len(rows)) + b
        g = each * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gw, gb = np.bincount(at, g[row] * x, BUCKETS) + _L2 * w, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        w -= _RATE * 0.1 * fix * m / (np.sqrt(v) + 1e-8)
        b -= _RATE * 0.1 * fix * mb / (np.sqrt(vb) + 1e-8)
    return w, float(b)


def _platt(score, label, stand) -> tuple[float, float]:
    """Slope and shift of the logistic curve through held-out scores (Newton steps, damped)."""
    scale = max(1e-9, float(np.abs(score).mean()))
    s = score / scale
    a, c = 1.0, 0.0
    # soft targets keep the curve finite when the classes are apart
    pos, neg = stand[label == 1].sum(), stand[label == 0].sum()
    t = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * s + c, -30, 30)))
        g = np.array([(stand * (p - t) * s).sum(), (stand * (p - t)).sum()])
        q = stand * np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(q * s * s).sum(), (q * s).sum()], [(q * s).sum(), q.sum()]]) + np.eye(2) * 1e-6 * stand.sum()
        d = np.clip(np.linalg.solve(h, g), -2, 2)
        a, c = a - d[0], c - d[1]
        if np.abs(d).max() < 1e-9:
            break
    return float(a / scale), float(c)


def judge_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: the id, the base figures, ``base_failed``, ``score``, ``kept``.

    ``base_failed`` is fewer than 20 words, or more than 30% of the words in
    repeated 8-word windows; ``score`` is the calibrated probability of good
    quality; ``kept`` is ``score >= threshold`` where the base rules pass.  A
    null text has no words.  Repeated rows are judged alike.
    """
    sc = docs.sparkSession.sparkContext
    shipped = sc.broadcast(model)  # BUCKETS weights, whatever the input
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for b in batches:
            out = []
            for t in b.column("t").to_pylist():
                text = Text.of(t)
                out.append((*text.figures(), shipped.value.probability(text)))
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.float64())],
                names=["id", *names, "score"])

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, {', '.join(f'{n} long' for n in names)}, score double")
            .select(F.col("id").alias(id_col), *names, failed.alias("base_failed"), "score",
                    (~failed & (F.col("score") >= threshold)).alias("kept")))
