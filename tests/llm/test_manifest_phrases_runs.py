import hashlib
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.llm import merkle, periodic_runs, phrase_dedup, queries

from .conftest import SCHEMA, edge_rows, prose


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def with_sizes(rows):
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


# -- op11 ---------------------------------------------------------------------

def brute_manifest(rows, fanout=2, tamper=lambda row: row):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r):
        return H(*map(field, (r[0], r[3], r[2], r[4], r[1])))

    def tree(hs):
        """(root, the siblings before and after each leaf on its way)"""
        paths, at, level = [[] for _ in hs], list(range(len(hs))), hs
        while len(level) > 1:
            for i in range(len(hs)):
                first = at[i] // fanout * fanout
                run, own = level[first:first + fanout], at[i] - first
                paths[i].append(("".join(run[:own]), "".join(run[own + 1:])))
                at[i] //= fanout
            level = [H(*level[k:k + fanout]) for k in range(0, len(level), fanout)]
        return level[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[g] = tree([leaf(r) for r in groups[g]])
    root, tops = tree([subs[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for r, path in zip(groups[g], subs[g][1]):
            steps, now = path + top, leaf(tamper(r))
            for a, b in steps:
                now = H(a, now, b)
            out.append((r[0], leaf(r), subs[g][0], root, H(*[a + b for a, b in steps]), now, now == root))
    return out


def tampered(r):
    if r[0] is None or r[4] is None or zlib.crc32(str(r[0]).encode()) % 7:
        return r
    return (*r[:4], r[4] + 1)


def key(row):
    return tuple((x is None, x) for x in row)


def tamper():
    picked = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 7 == 0
    return {"n_chars": F.when(picked, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest_equals_brute_force_on_edge_rows(spark, edge, fanout):
    got = merkle.manifest(edge, fanout=fanout, tampered=tamper()).drop("path").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_manifest(with_sizes(edge_rows()), fanout, tampered), key=key)


@pytest.mark.parametrize("n", [1, 3, 17, 300])
def test_manifest_of_any_size(spark, n):
    rows = [(i * 3, f"text {i}", ["en", None, "de", "en"][i % 4 if n > 3 else 0], "s", i) for i in range(n)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), tampered=tamper()).drop("path").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_manifest(rows, 2, tampered), key=key)


def test_manifest_notices_every_change_and_only_those(spark):
    rows = [(i, prose(i, 5), "en", None, i) for i in range(70)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest(docs, tampered={"text": F.when(F.col("doc_id") == 33, F.lit("other")).otherwise(F.col("text"))})
    assert [r["doc_id"] for r in got.where(~F.col("verified")).collect()] == [33]
    assert merkle.manifest(docs).where(~F.col("verified")).count() == 0


def test_manifest_of_identical_rows_and_empty_tables(spark, empty):
    rows = [(7, "same", "en", "a", 4)] * 40 + [(8, "x", "en", "a", 1)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).drop("path").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_manifest(rows), key=key)
    assert merkle.manifest(empty).count() == 0


# -- op12 ---------------------------------------------------------------------

def brute_phrases(rows, size=13):
    owner, split = {}, [(r[0], (r[1] or "").encode().split()) for r in rows]
    for i, words in split:
        for a in range(len(words) - size + 1):
            w = tuple(words[a:a + size])
            if i is not None:
                owner[w] = min(owner.get(w, i), i)
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for a in range(len(words) - size + 1):
            least = owner.get(tuple(words[a:a + size]))
            if least is not None and (i is None or least < i):
                gone[a:a + size] = [True] * size
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((i, len(words), sum(gone), kept))
    return out


def phrases(df, **options):
    out = phrase_dedup.dedup_phrases(df, **options)
    return sorted(((r["doc_id"], r["n_words"], sum(s["length"] for s in r["removed"]), r["kept"]) for r in out.collect()), key=key)


def random_corpus(seed, docs=60, words=8):
    """Few words and shared passages, so that windows recur, overlap and repeat inside a text."""
    r = random.Random(seed)
    shared = [[r.choice("abcdefgh"[:words]) for _ in range(r.randint(10, 40))] for _ in range(6)]
    rows = []
    for i in range(docs):
        out = []
        while len(out) < r.randint(0, 90):
            out += r.choice(shared)[r.randint(0, 8):] if r.random() < 0.4 else [r.choice("abcdefghijklmnop") for _ in range(r.randint(1, 15))]
        rows.append((r.choice([i, i, i, i // 2, None]), " ".join(out), "en", "s", len(out)))
    return rows


@pytest.mark.parametrize("options", [{}, {"max_bits": 1 << 10}, {"shard_bytes": 200, "shares": 4}])
def test_phrases_equal_brute_force(spark, options):
    for seed in (1, 2):
        rows = random_corpus(seed)
        assert phrases(spark.createDataFrame(rows, SCHEMA), **options) == sorted(brute_phrases(rows), key=key)


def test_phrases_on_edge_rows(spark, edge, empty):
    assert phrases(edge) == sorted(brute_phrases(edge_rows()), key=key)
    assert phrases(empty) == []


def test_a_third_of_all_rows_equal_goes_to_several_shards(spark):
    same = [(5, prose(9, 50), "en", "s", 0)] * 40
    rows = [(3, prose(9, 50)[20:], "en", "s", 0), *same] + [(10 + i, prose(50 + i, 40), "en", "s", 0) for i in range(80)]
    got = phrases(spark.createDataFrame(rows, SCHEMA), shard_bytes=500, shares=8)
    assert got == sorted(brute_phrases(rows), key=key)


def test_anchors_in_very_many_documents_equal_brute_force(spark):
    # heavy anchors stand in at least 64 texts and are salted; every share needs the owners of all others
    r = random.Random(5)
    common = [prose(300 + k, 30).split() for k in range(4)]
    rows = []
    for i in r.sample(range(1000), 260):
        words = [w for _ in range(r.randint(1, 3)) for w in r.choice(common)[r.randint(0, 12):r.randint(20, 30)] + prose(2000 + i, 3).split()]
        rows.append((i if r.random() < 0.95 else None, " ".join(words), "en", "s", 0))
    rows += rows[:20]
    for shares in (4, 16):
        assert phrases(spark.createDataFrame(rows, SCHEMA), shares=shares) == sorted(brute_phrases(rows), key=key)


@pytest.mark.parametrize("arrow", ["true", "false"])
def test_a_bitmap_comes_to_the_driver_without_a_row_for_each_word(spark, arrow):
    bits, setting = 1 << 24, "spark.sql.execution.arrow.pyspark.enabled"
    anchors = spark.range(300_000, numPartitions=4).select(F.xxhash64("id").alias("anchor"))
    want = np.zeros(bits, np.bool_)
    want[[r["anchor"] & (bits - 1) for r in anchors.collect()]] = True
    before = spark.conf.get(setting)
    spark.conf.set(setting, arrow)
    tracemalloc.start()
    try:
        bitmap = phrase_dedup.anchor_bitmap(anchors, bits)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set(setting, before)
    assert peak < 10 * bits // 8
    assert (np.unpackbits(bitmap.words.view(np.uint8), bitorder="little").view(np.bool_) == want).all()
    empty = phrase_dedup.anchor_bitmap(anchors.where("false"), 1 << 16)
    assert not empty.holds(np.arange(1 << 16, dtype=np.uint64)).any()


def test_spans_are_the_removed_words(spark):
    passage = prose(3, 20)
    rows = [(1, passage, "en", "s", 0), (2, f"x y {passage} z {passage}", "en", "s", 0)]
    got = {r["doc_id"]: r["removed"] for r in phrase_dedup.dedup_phrases(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: [], 2: [(2, 20), (23, 20)]}


# -- op13 ---------------------------------------------------------------------

def brute_runs(s, least=12):
    n, out = len(s), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and s[j] == s[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q):
                t = s[i:i + size]
                if not any(t[r:] == t[:size - r] for r in range(1, q)):
                    out.append((i, size, q))
            i = max(i, j) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(0, 7), st.sampled_from([2, 5, 12]))
def test_runs_equal_brute_force(s, shape, least):
    if s and shape:
        p = 1 + len(s) // (2 + shape)
        s = [s[i % p] for i in range(len(s))]
    want = brute_runs(s, least)
    assert periodic_runs.runs_of(s, least) == want
    words = [b"%d" % x for x in s]
    assert periodic_runs.batch_runs([words[:3], words, [], words + words], least) == [
        brute_runs(words[:3], least), want, [], brute_runs(words + words, least)]


def test_long_runs_and_lone_repeats():
    r = random.Random(5)
    far = [r.randrange(10**6) for _ in range(40)]
    s = far + [r.randrange(10**6) for _ in range(500)] + far  # repeats too far apart for a run
    assert periodic_runs.runs_of(s) == periodic_runs.batch_runs([[b"%d" % x for x in s]])[0] == []
    p = [r.randrange(10**6) for _ in range(300)]
    assert periodic_runs.runs_of(p * 5 + p[:7]) == [(0, 1507, 300)]


def test_find_runs_on_edge_rows(spark, edge, empty):
    got = periodic_runs.find_runs(edge).collect()
    want = []
    for r in edge_rows():
        words = (r[1] or "").encode().split()
        runs = brute_runs(words) if len(words) < 2000 else periodic_runs.runs_of(words)
        gone = {i for a, size, q in runs for i in range(a + q, a + size)}
        want.append((r[0], runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    rows = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got]
    assert sorted(rows, key=lambda r: (r[0] is None, r[0], r[2])) == sorted(want, key=lambda r: (r[0] is None, r[0], r[2]))
    assert periodic_runs.find_runs(empty).count() == 0


def test_registered_runs_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.length("text") < 2500).collect()
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    planted = 0
    for d in docs:
        words = (d["text"] or "").encode().split()
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(words)
        if n and h % 10 == 0:
            a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        gone = {i for a, size, q in runs for i in range(a + q, a + size)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        planted += bool(runs)
        r = got[d["doc_id"]]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == H("".join(f"{a},{size},{q}\n" for a, size, q in runs))
        assert r["collapsed_sha256"] == H(b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    assert planted > 5
