"""Mixing, SimHash near-dedup and sharding against brute force, and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.llm import decontaminate, mixing, sharding, simhash
from tidepool.llm.common import read
from tests.conftest import SF01, SF001
from tests.llm.conftest import edge_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- mixing ---------------------------------------------------------------

def brute_targets(sizes):
    """By shares in rounds, as the definition says."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(order, [5, 2, 1] * len(order)))
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        per = left / sum(weight[s] for s in free)
        over = {s for s in free if per * weight[s] > 2 * sizes[s]}
        if not over:
            out.update({s: per * weight[s] for s in free})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= 2.0 * sizes[s]
        free -= over
    return out


def check_mix(rows, plan):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = brute_targets(dict(sizes))
    by_source = defaultdict(list)
    for r in plan.collect():
        by_source[r["source_size"], round(r["target"], 3)].append(r)
        assert 0 <= r["copies"] <= 2
    assert sum(map(len, by_source.values())) == len(rows)
    groups = defaultdict(float), defaultdict(int)
    for s, n in sizes.items():
        groups[0][n, round(want[s], 3)] += want[s]
        groups[1][n, round(want[s], 3)] += 1
    for k, docs in by_source.items():
        taken = sum(r["copies"] * r["size"] for r in docs)
        assert abs(taken - groups[0][k]) <= groups[1][k] * max(r["size"] for r in docs) + 1e-6
    assert set(by_source) == set(groups[0])


def test_mix_edges(edge, empty):
    rows = [(r[0], r[1], r[3]) for r in edge_rows()]
    plan = mixing.plan_mix(edge)
    check_mix(rows, plan)
    assert Counter((r["doc_id"], r["size"]) for r in plan.collect()) == Counter((i, len(WORD.findall(t or ""))) for i, t, _ in rows)
    mixed = mixing.mix(edge)
    assert mixed.columns == edge.columns
    copies = Counter()
    for r in plan.collect():
        copies[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == +copies
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mix_levels_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * r.randint(1, 30)), r.choices(["a", "b", "c", None], [8, 2, 1, 1])[0]) for i in range(700)]
    rows += [(7, "w w", "a")] * 9  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (mixing.plan_mix(d) for d in (docs.repartition(3), docs.repartition(11)))
    check_mix(rows, one)
    assert Counter(map(tuple, one.drop("copy").collect())) == Counter(map(tuple, two.drop("copy").collect()))
    assert "Python" not in one._jdf.queryExecution().executedPlan().toString()


def test_mix_is_unbiased(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "a" if i < 20 else "b") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(1)
    got = defaultdict(list)
    for seed in range(12):
        for r in mixing.plan_mix(docs, seed=seed).collect():
            got[r["doc_id"]].append((r["copies"], r["target"] / r["source_size"]))
    # each document's expected copies are its source's share
    bias = [np.mean([c - w for c, w in x]) for x in got.values()]
    assert abs(np.mean(bias)) < 0.05 and np.mean(np.abs(bias)) < 0.2


# -- SimHash --------------------------------------------------------------

def brute_fingerprint(text):
    words = [w for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=3):
    """Smallest member of each value's component."""
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= bits and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_fingerprints_edges(edge, empty):
    rows = edge_rows()
    out = simhash.near_duplicates(edge).collect()
    fp = {r[0]: brute_fingerprint(r[1]) for r in rows}
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    comp, least = brute_components(set(fp.values())), {}
    for i, f in fp.items():
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    for r in out:
        assert r["fp"] & (2**64 - 1) == fp[r["doc_id"]]
        assert r["component_id"] == least.get(comp[fp[r["doc_id"]]])
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one_each(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(least.values()))
    assert kept.count() == len(set(comp.values()))


def flips(value, n, r):
    for b in r.sample(range(64), n):
        value ^= 1 << b
    return value


@pytest.mark.parametrize("crowd, hot_rows", [(simhash.CROWD, simhash.HOT_ROWS), (2, simhash.HOT_ROWS), (simhash.CROWD, 1), (2, 1)])
def test_links_against_all_pairs(spark, crowd, hot_rows):
    r = random.Random(11)
    centres = [r.getrandbits(64) for _ in range(8)]
    values = {flips(c, r.randint(0, 4), r) for c in centres for _ in range(60)}  # dense groups
    chain = [r.getrandbits(64)]
    for _ in range(40):
        chain.append(flips(chain[-1], 3, r))  # links of exactly three bits, a long way
    values |= set(chain) | {r.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1, 7, 2**63, 1 << 31, 0xF}
    values |= {(r.getrandbits(32) << 32) | 0xABCD1234 for _ in range(500)}  # a template family: one segment is equal
    want = brute_components(values)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    got = simhash.link_fingerprints(spark.createDataFrame(signed, "fp long"), crowd=crowd, hot_rows=hot_rows).collect()
    assert len(got) == len(values)
    parts, other = defaultdict(set), defaultdict(set)
    for x in got:
        parts[x["root"]].add(x["fp"] & (2**64 - 1))
    for v, root in want.items():
        other[root].add(v)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, other.values()))


def test_hot_buckets_get_the_same_hub(spark):
    r = random.Random(12)
    low = [(r.getrandbits(31) << 32) | 77 for _ in range(700)]  # over a third of all in the buckets of one segment
    fps = spark.createDataFrame([(x,) for x in set(low) | {r.getrandbits(63) for _ in range(900)}], "fp long")
    hot = simhash._hot_buckets(fps, 1)
    assert hot.count() == 32  # the segment's variants
    assert simhash._hot_buckets(fps, simhash.HOT_ROWS).isEmpty()
    split, plain = simhash._members(fps, 1), simhash._members(fps, simhash.HOT_ROWS)
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty() and plain.count() >= 32 * 700


def test_components_of_paths_and_stars(spark):
    r = random.Random(2)
    names = r.sample(range(10**6), 120)
    edges = list(zip(names[:60], names[1:60])) + [(names[60], x) for x in names[61:100]] + [(names[100], names[100])]
    got = {x["node"]: x["root"] for x in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[x] for x in names[:60]} == {min(names[:60])}
    assert {got[x] for x in names[60:100]} == {min(names[60:100])} and len(got) == 100
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- sharding -------------------------------------------------------------

def check_shards(rows, out, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shard_edges(edge, empty):
    rows = [(r[0], r[1]) for r in edge_rows()]
    check_shards(rows, sharding.assign_shards(edge).collect(), 24)
    assert sharding.assign_shards(empty).count() == 0 and sharding.shuffle_into_shards(empty).count() == 0
    out = sharding.shuffle_into_shards(edge)
    assert sorted(out.columns) == sorted(edge.columns)
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(rows)
    assert len({(r["shard"], r["slot"]) for r in out.collect()}) == len(rows)


def test_shard_several_parts_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 50)
    monkeypatch.setattr(sharding, "RANGE_ROWS", 16)
    rows = [(i % 900, f"text {i % 900}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = sharding.assign_shards(docs.repartition(3), shards=7).collect()
    two = sharding.assign_shards(docs.repartition(8), shards=7).collect()
    check_shards(rows, one, 7)
    key = ("doc_id", "shard", "slot")
    assert Counter(tuple(r[k] for k in key) for r in one) == Counter(tuple(r[k] for k in key) for r in two)
    # a shuffle: neither shard nor slot follows the id
    ids = [r["doc_id"] for r in sorted(one, key=lambda r: (r["shard"], r["slot"]))]
    assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.15


def test_communication_matrix():
    parts, shards = [5, 0, 17, 400, 78], [84, 84, 83, 83, 83, 83]
    total = np.zeros((5, 6))
    for seed in range(300):
        m = sharding.communication_matrix(parts, shards, seed)
        assert m.sum(axis=1).tolist() == parts and m.sum(axis=0).tolist() == shards and (m >= 0).all()
        total += m
    assert np.abs(total / 300 - np.outer(parts, shards) / 500).max() < 1.5


@pytest.mark.parametrize("good,bad,draws", [(10**9, 2 * 10**9, 3 * 10**6), (5, 4 * 10**9, 10**9), (10**10, 7, 10**10)])
def test_hypergeometric_of_large_urns(good, bad, draws):
    rng = np.random.default_rng(4)
    x = [sharding._hypergeometric(rng, good, bad, draws) for _ in range(60)]
    n = good + bad
    mean = draws * good / n
    sd = (draws * good / n * bad / n * (n - draws) / (n - 1)) ** 0.5
    assert all(max(0, draws - bad) <= v <= min(good, draws) for v in x)
    assert abs(np.mean(x) - mean) <= 5 * sd / 60**0.5 + 1e-9
    assert len(x) < 2 or abs(np.std(x) - sd) <= 0.4 * sd + 0.6


# -- pipeline -------------------------------------------------------------

def test_pipeline_stages_take_effect(spark):
    docs = read(spark, SF01, "documents")
    odd = spark.createDataFrame([(10**6, None, "en", "src0", None), (10**6 + 1, "1 2 3", "en", "src0", 5),
                                 (10**6 + 2, "", None, None, 0)], docs.schema)
    docs = docs.unionByName(odd)
    known = corpus_pipeline.language_id(spark, docs, SF01)
    assert known.columns == docs.columns
    gone = {r["doc_id"] for r in docs.join(known, "doc_id", "left_anti").collect()}
    assert gone >= {10**6, 10**6 + 1, 10**6 + 2} and len(gone) < 0.01 * 1000 + 3

    known = known.cache()
    single = corpus_pipeline.near_dedup(spark, known, SF01)
    rows = known.select("doc_id", "text").collect()
    fp = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    comp, least = brute_components(set(fp.values())), {}
    for i, f in fp.items():
        least[comp[f]] = min(i, least.get(comp[f], i))
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(least.values()) and single.columns == docs.columns

    single = single.cache()
    clean = corpus_pipeline.decontamination(spark, single, SF01)
    items = [decontaminate.normalise(r["text"]) for r in read(spark, SF01, "benchmark").collect()]
    leaked = {r["doc_id"] for r in single.collect() if any(x in decontaminate.normalise(r["text"]) for x in items)}
    left = {r["doc_id"] for r in clean.collect()}
    assert leaked and not leaked & left and clean.columns == docs.columns
    assert len(single.collect()) - len(left) == len(leaked)  # these data hold exact passages only

    clean = clean.cache()
    mixed = corpus_pipeline.source_mixing(spark, clean, SF01)
    words = {r["doc_id"]: len(WORD.findall(r["text"])) for r in clean.collect()}
    taken = sum(words[r["doc_id"]] for r in mixed.collect())
    assert mixed.columns == docs.columns and abs(taken / sum(words.values()) - 1.5) < 0.05

    mixed = mixed.cache()
    out = corpus_pipeline.shard(spark, mixed, SF01)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(r["doc_id"] for r in mixed.collect())


def test_pipeline_runs_and_reruns_agree(spark):
    one, two = (corpus_pipeline.run(spark, SF001).collect() for _ in range(2))
    assert one and Counter(map(tuple, one)) == Counter(map(tuple, two))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "decontamination", "source_mixing", "sharding"]


def test_pipeline_on_an_empty_table(spark):
    docs = read(spark, SF001, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.count() == 0


@pytest.mark.parametrize("spread", ["mix", "shards"])
def test_equal_rows_carry_no_arrays(spark, spread):
    rows = [(1, "one text", "a", f"x{i}") for i in range(300)] + [(i, f"text {i}", "a", "y") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra string").repartition(5)
    if spread == "mix":
        out, copies = mixing.mix(docs), Counter()
        for r in mixing.plan_mix(docs).collect():
            copies[r["doc_id"]] += r["copies"]
        assert Counter(r["doc_id"] for r in out.collect()) == +copies
    else:
        out = sharding.shuffle_into_shards(docs, shards=7)
        got = out.collect()
        assert Counter((r["doc_id"], r["text"], r["source"], r["extra"]) for r in got) == Counter(rows)
        assert len({(r["shard"], r["slot"]) for r in got}) == len(rows)
    # the places or copies of a group of equal rows never stand in one row
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__places" not in plan and "map_from_entries" not in plan
