"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are TF-IDF values of hashed character n-grams (1 to 3 characters of
the lower-cased text): an n-gram's share of the text's n-grams of its length,
times its inverse document frequency over all documents that may be learned
from.  The weights are trained with follow-the-regularised-leader and an
elastic net (most stay exactly 0); a temperature fitted on some rows kept out
of training calibrates the probabilities.

Training starts on a bounded sample of every language, in several epochs on the
driver.  All other learnable rows then train once, where they lie: each task
goes on from the start, and the tasks' states are averaged by their rows
(parameter mixing).  No language and no row is left out.

Scale: document frequencies are counted over all learnable documents, one
array per task summed by bucket; so are the changes of the training state; a
prediction reads its text once where it lies.  State and weights take
``BUCKETS`` numbers a language in every task.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import unused

BUCKETS = 1 << 16
SIZES = (1, 2, 3)
TRAIN_PER_CLASS = 400  # training starts on at most so many documents of each language; the others follow in the tasks
START_ROWS = 1 << 14  # and on about so many in all, at least one of each language
UNKNOWN = "und"
_EPOCHS, _ALPHA, _BETA, _L1, _L2 = 4, 0.5, 1.0, 2e-4, 1e-4
_MOST = 16.0  # a row of a rare language weighs no more in a task, so that no single step freezes its n-grams
_SCALE = 30.0
_CHUNK = 1 << 18
_LETTER = regex.compile(r"\p{L}")


def _grams(text: str):
    """(buckets, n-grams of this size in the text), by size and chunk."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for size in SIZES:
        total = len(codes) - size + 1
        for at in range(0, max(total, 0), _CHUNK):
            part = codes[at:at + _CHUNK + size - 1]
            n = len(part) - size + 1
            h = np.full(n, 0x9E37 * size, np.uint32)
            for j in range(size):
                h = (h ^ part[j:j + n]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            yield (h * np.uint32(0x2C1B3C6D)) >> np.uint32(16), total


@dataclass
class LanguageModel:
    languages: list[str]  # code point order
    weights: np.ndarray  # BUCKETS x languages, already times inverse document frequency
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        z = self.bias.astype(np.float64).copy()
        for bucket, total in _grams(text):
            z += self.weights[bucket].sum(axis=0, dtype=np.float64) * (_SCALE / total)
        return z

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or _LETTER.search(text) is None:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(text) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(min(1.0, p[best]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _frequencies(batches):
    """Document frequency of every bucket in one task (null language), and its documents by language (bucket -1)."""
    df, docs = np.zeros(BUCKETS, np.int64), Counter()
    for b in batches:
        docs.update(b.column("lang").to_pylist())
        for t in b.column("t").to_pylist():
            seen = np.zeros(BUCKETS, bool)
            for bucket, _ in _grams(t):
                seen[bucket] = True
            df += seen
    if docs:
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] * len(at) + list(docs), pa.string()), pa.array([*at.tolist(), *[-1] * len(docs)], pa.int32()),
             pa.array([*df[at].tolist(), *docs.values()], pa.int64())], names=["lang", "bucket", "df"])


def _features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams, ascending, and their values before inverse document frequency."""
    kept, share = [np.zeros(0, np.int64)], [np.zeros(0)]
    for bucket, total in _grams(text):
        u, n = np.unique(bucket, return_counts=True)
        kept.append(u.astype(np.int64))
        share.append(_SCALE * n / total)
    at, inverse = np.unique(np.concatenate(kept), return_inverse=True)
    return at, np.bincount(inverse, np.concatenate(share), len(at)).astype(np.float32)


def _sparse(batches):
    for b in batches:
        index, value = [], []
        for t in b.column("t").to_pylist():
            u, x = _features(t)
            index.append(u.astype(np.int32).tobytes())
            value.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("draw"), pa.array(index, pa.binary()),
                                          pa.array(value, pa.binary())], names=["lang", "draw", "index", "value"])


class Ftrl:
    """Per-coordinate FTRL-proximal with L1 and L2; bucket ``BUCKETS`` is the bias, unpenalised."""

    def __init__(self, classes: int):
        self.z = np.zeros((BUCKETS + 1, classes))
        self.n = np.zeros((BUCKETS + 1, classes))
        self.l1 = np.full((BUCKETS + 1, 1), _L1)
        self.l1[BUCKETS] = 0.0

    def copy(self) -> Ftrl:
        other = Ftrl(self.z.shape[1])
        other.z, other.n = self.z.copy(), self.n.copy()
        return other

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= self.l1[at], 0.0,
                        -(z - np.sign(z) * self.l1[at]) / ((_BETA + np.sqrt(self.n[at])) / _ALPHA + _L2))

    def learn(self, index: np.ndarray, value: np.ndarray, label: int, each: float) -> None:
        at, x = np.append(index, BUCKETS), np.append(value, 1.0)[:, None]
        w = self.weights(at)
        p = _softmax((w * x).sum(axis=0))
        p[label] -= 1.0
        g = each * p * x
        n = self.n[at]
        after = n + g * g
        self.z[at] += g - (np.sqrt(after) - np.sqrt(n)) / _ALPHA * w
        self.n[at] = after


def _ftrl(index: list, value: list, label: np.ndarray, classes: int) -> Ftrl:
    state = Ftrl(classes)
    count = np.maximum(1, np.bincount(label, minlength=classes))
    each = len(label) / (classes * count)  # languages weigh the same
    for _ in range(_EPOCHS):
        for i in range(len(label)):
            state.learn(index[i], value[i], label[i], each[label[i]])
    return state


def _learn_on(shipped):
    """Goes on from the shipped state with the rows of one task; its changes, times its rows (their number: bucket -1)."""
    def run(batches):
        start, idf, number, each = shipped.value
        state, rows = None, 0
        for b in batches:
            state = state or start.copy()
            for lang, t in zip(b.column("lang").to_pylist(), b.column("t").to_pylist()):
                at, x = _features(t)
                state.learn(at, x * idf[at], number[lang], each[number[lang]])
            rows += b.num_rows
        if not rows:
            return
        dz, dn = (state.z - start.z) * rows, (state.n - start.n) * rows
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([0], pa.int32()), pa.array([float(rows)]),
                                          pa.array([0.0])], names=["bucket", "class", "dz", "dn"])
        for k in range(dz.shape[1]):
            at = np.flatnonzero((dz[:, k] != 0) | (dn[:, k] != 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(np.full(len(at), k, np.int32)), pa.array(dz[at, k]), pa.array(dn[at, k])],
                names=["bucket", "class", "dz", "dn"])
    return run


def _mix_in(state: Ftrl, rest: DataFrame, idf: np.ndarray, number: dict[str, int], each: np.ndarray) -> None:
    """Adds the mean change of all tasks that go on from ``state``; ``BUCKETS`` rows a language reach the driver."""
    shipped = rest.sparkSession.sparkContext.broadcast((state, idf, number, each))
    moved = (rest.mapInArrow(_learn_on(shipped), "bucket int, class int, dz double, dn double")
             .groupBy("bucket", "class").agg(F.sum("dz").alias("dz"), F.sum("dn").alias("dn")).toPandas())
    if moved.empty:
        return
    rows = moved.loc[moved["bucket"] == -1, "dz"].sum()
    moved = moved[moved["bucket"] >= 0]
    at = moved["bucket"].to_numpy(), moved["class"].to_numpy()
    state.z[at] += moved["dz"].to_numpy() / rows
    state.n[at] += moved["dn"].to_numpy() / rows


def _temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """Golden-section search of the temperature with the least log loss."""
    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        # an imagined wrong row keeps the temperature off 0 when every row is right
        return float(-np.log(np.maximum(p[np.arange(len(label)), label], 1e-12)).sum()
                     - np.log(np.maximum(1 - p.max(axis=1), 1e-12)).mean())

    lo, hi, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    while hi - lo > 1e-4:
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.encode(id_col.cast("string"), "utf-8")), F.lit(4)) == 2, F.lit(False))


def train_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_class: int = TRAIN_PER_CLASS) -> LanguageModel:
    """Learn from the text and language of rows that are not held out.

    Rows with a null language or a text without a letter teach nothing; every
    other row does, and every language of theirs is learned.  Training starts on
    at most ``per_class`` rows of a language, those with the smallest hashes of
    text and id, and goes on with all other rows, each once (see above; repeats
    of a row of the start count once).  How the rows are dealt into tasks has a
    small part in the weights.
    """
    rows = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
                      ).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"),
                               F.xxhash64(F.lit("draw"), F.col(text_col), F.col(id_col)).alias("draw"))
    # BUCKETS rows and one per language reach the driver
    df_rows = (rows.select("lang", "t").mapInArrow(_frequencies, "lang string, bucket int, df long")
               .groupBy("lang", "bucket").agg(F.sum("df").alias("df")).toPandas())
    counts = df_rows[df_rows["bucket"] == -1]
    if counts.empty:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    # a bound on the hash picks each language's sample without moving any text
    per_class = max(1, min(per_class, START_ROWS // len(counts)))
    bounded = rows.join(F.broadcast(_sample_bounds(rows, per_class, dict(zip(counts["lang"], counts["df"])))), "lang")
    picked = bounded.where(F.col("draw") <= F.col("bound")).select("lang", "draw", "t")
    picked = picked.dropDuplicates(["lang", "draw"])  # repeated rows share a draw
    sample = picked.mapInArrow(_sparse, "lang string, draw long, index binary, value binary").toPandas()
    sample = sample.sort_values(["draw", "lang"], kind="stable").reset_index(drop=True)
    languages = sorted(sample["lang"].unique())

    df = np.zeros(BUCKETS)
    known = df_rows[df_rows["bucket"] >= 0]
    df[known["bucket"].to_numpy()] = known["df"].to_numpy()
    docs_n = float(counts["df"].sum())
    idf = np.log((1 + docs_n) / (1 + df)) + 1.0

    index = [np.frombuffer(x, np.int32).astype(np.int64) for x in sample["index"]]
    value = [np.frombuffer(x, np.float32) * idf[i] for x, i in zip(sample["value"], index)]
    label = pd.Categorical(sample["lang"], categories=languages).codes.astype(np.int64)
    train = np.arange(len(label)) % 5 != 4
    train = np.flatnonzero(train | ~np.isin(label, label[train]))  # every language is trained
    state = _ftrl([index[i] for i in train], [value[i] for i in train], label[train], len(languages))
    if docs_n > len(label):
        number = {lang: k for k, lang in enumerate(languages)}
        count = counts.set_index("lang")["df"].reindex(languages).to_numpy(float)
        _mix_in(state, bounded.where(F.col("draw") > F.col("bound")).select("lang", "t"), idf, number,
                np.minimum(_MOST, docs_n / (len(languages) * count)))
    w = state.weights(np.arange(BUCKETS + 1))
    w, bias = w[:BUCKETS], w[BUCKETS]
    check = np.setdiff1d(np.arange(len(label)), train)
    check = check if len(check) else train
    logits = np.array([bias + value[i] @ w[index[i]] for i in check])
    return LanguageModel(languages, (w * idf[:, None]).astype(np.float32), bias, _temperature(logits, label[check]))


def _sample_bounds(rows: DataFrame, per_class: int, counts: dict | None = None) -> DataFrame:
    """Per language the hash value below which its ``per_class`` first distinct draws lie.

    Hashes are uniform, so a language's row count gives a loose bound with some
    more rows below it (six standard deviations and ten); only those rows are
    moved and ranked, so no task holds more, however large the language.
    Repeated rows share a draw and count once.  A language of many repeats may
    have fewer draws below the bound than it should: its bound is raised 16-fold
    until there are enough or all its rows lie below.
    """
    if counts is None:
        counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    some_more = per_class + 6 * per_class**0.5 + 10
    share = {lang: some_more / int(n) for lang, n in counts.items()}
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    bounds = {}
    while share:
        loose = rows.sparkSession.createDataFrame(
            [(lang, min((1 << 63) - 1, int(s * 2.0**64) - (1 << 63))) for lang, s in share.items()], "lang string, loose long")
        ranked = (rows.select("lang", "draw").join(F.broadcast(loose), "lang").where(F.col("draw") <= F.col("loose"))
                  .select("lang", "draw").distinct().withColumn("nth", nth).where(F.col("nth") <= per_class)
                  .groupBy("lang").agg(F.max("draw").alias("bound"), F.count("*").alias("n")).collect())  # one row per language
        bounds |= {r["lang"]: r["bound"] for r in ranked if r["n"] == per_class or share[r["lang"]] >= 1}
        share = {lang: 16 * s for lang, s in share.items() if lang not in bounds and s < 1}
    return rows.sparkSession.createDataFrame(list(bounds.items()), "lang string, bound long")


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``held_out``, ``lang_pred`` and ``score``.

    ``lang_pred`` is a learned language, or ``und`` with score 0 for a text
    that is null or has no letter (or if nothing could be learned); ``score``
    is the calibrated probability of the prediction.  Only the text decides.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages weights
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = [shipped.value.predict(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("held_out"), pa.array([x[0] for x in out], pa.string()),
                 pa.array([x[1] for x in out], pa.float64())], names=["id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, held_out boolean, lang_pred string, score double")
            .withColumnRenamed("id", id_col))


def keep_known(docs: DataFrame, model: LanguageModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose language is known with a score of at least ``least``; columns as given."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shipped.value.predict(t)[1] for t in texts], dtype="float64")

    name = unused(docs, "score")
    return docs.withColumn(name, score(F.col(text_col))).where(F.col(name) >= least).drop(name)
