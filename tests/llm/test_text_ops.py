"""Line dedup, URL filters, token counts, decontamination and secret scans against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidepool.llm import decontaminate, line_dedup, secret_ledger, token_count, url_filter
from tidepool.llm.perfect_hash import LineIndex, PerfectHash
from tests.llm.conftest import edge_rows, prose

SPACES = " \t\n\x0b\f\r"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


# -- line dedup -----------------------------------------------------------

def brute_lines(rows):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = ascii_lower(line.strip(SPACES))
            if len(key) >= 20 and doc_id is not None:
                holders[key].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if not (len(h := holders.get(ascii_lower(x.strip(SPACES)), ())) >= 3 and doc_id != max(h))]
        out.append((doc_id, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return Counter(out)


def test_line_dedup_edges(edge, empty):
    got = line_dedup.dedup_lines(edge).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert Counter(map(tuple, got)) == brute_lines([(r[0], r[1]) for r in edge_rows()])
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_hot_line_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 16)
    monkeypatch.setattr(line_dedup, "HOT_LINES", 8)
    r = random.Random(5)
    common = [f"a rather common line number {i}" for i in range(60)]
    rows = [(i, "\n".join(["the hottest line of them all", *r.choices(common, k=3), f"a line of document {i} alone"]))
            for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert Counter(map(tuple, got)) == brute_lines(rows)


@given(st.sets(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1)), max_size=400))
@settings(max_examples=40, deadline=None)
def test_perfect_hash_is_minimal(keys):
    h = np.array(sorted(keys), dtype=np.uint64).reshape(-1, 2)
    index = PerfectHash.build(h[:, 0].copy(), h[:, 1].copy()).index(h[:, 0].copy(), h[:, 1].copy())
    assert sorted(index.tolist()) == list(range(len(keys)))


def test_line_index_round_trip_and_strangers():
    r = np.random.default_rng(1)
    h = r.integers(-2**63, 2**63 - 1, (5000, 2))
    n, keep = r.integers(1, 100, 5000), r.integers(-9, 10**12, 5000)
    index = LineIndex.from_bytes(LineIndex.build(h[:, 0].copy(), h[:, 1].copy(), n, keep).to_bytes())
    count, keeper = index.probe(h[:, 0].copy(), h[:, 1].copy())
    assert (count == n).all() and (keeper == keep).all()
    other = r.integers(-2**63, 2**63 - 1, (5000, 2))
    assert (index.probe(other[:, 0].copy(), other[:, 1].copy())[0] == 0).all()
    assert (np.bitwise_count(index.mph.words).sum()) == 5000


# -- URL filters ----------------------------------------------------------

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("a.b.c.example.org", "", "allow"), ("x.com", "/fr/", "block")]
URLS = [None, "", "no scheme", "://", "http://", "http://ORG", "http://ORG/", "http://www.Example.org/es/x?y://z", "http://example.org/es",
        "http://example.org/en/123#f", "http://example.org/en/213", "http://notexample.org/es/1", "http://a.b.c.example.org", "http://x.com/fr/",
        "http://y.x.com/fr/q", "http://.com/fr/", "http://com./fr/", "http://a..com/de/", "ftp://k.com/de/" + "p" * 5000, "x://" + "a." * 3000 + "com/fr/1",
        "http://k.com?/fr/", "http://k.com#/fr/", "ÄÖ://ÜBER.Com/fr/é", "line\nbreak://k.com/de/\n", "http://k.com:80/fr/", "http://k.com/fr/"]


def brute_url(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = ascii_lower(host)
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit)[3:] if fit else (None, "allow")
    return host, path, rule, verdict


def test_url_rules(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS)] + [(25, URLS[25], "clash", "clash"), (None, URLS[6], "a", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, digest string")
    got = url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict", "digest").collect()
    want = [(r[0], *brute_url(r[1], RULES), r[3]) for r in rows]
    assert Counter(map(tuple, got)) == Counter(want)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    none = url_filter.judge_urls(pages, rules.limit(0), default="block")
    assert {(r["rule"], r["verdict"]) for r in none.collect()} == {(None, "block")}


def test_url_filter_runs_without_python(spark):
    pages = spark.createDataFrame([(1, "http://a.com/fr/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    plan = url_filter.judge_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# -- token counts ---------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    with open(VOCABULARY, "rb") as f:
        return token_count.PieceCounter(f.read())


def test_token_counts_edges(edge, empty, library):
    got = token_count.count_tokens(edge, VOCABULARY).collect()
    want = [(r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "", add_special_tokens=False).ids), n > 512)
            for r in edge_rows()]
    assert Counter(map(tuple, got)) == Counter(want)
    assert token_count.count_tokens(empty, VOCABULARY).count() == 0


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_token_counts_match_the_library(library, counter, text):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_where_unicode_versions_differ(library, counter):
    for cp in (0x558, 0x58B, 0x88F, 0xC5C, 0x208F, 0xA7CE, 0x107BB, 0x10940, 0x3FC3F):
        text = f"a{chr(cp)}1{chr(cp)} {chr(cp)}. "
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_memory_is_bounded(counter, monkeypatch):
    monkeypatch.setattr(token_count, "REMEMBERED", 50)
    memory = token_count._Memory(counter.count_piece)
    for i in range(500):
        assert memory[f" w{i}"] == counter.count_piece(f" w{i}")
    assert len(memory) <= 50


# -- decontamination ------------------------------------------------------

def edit_best(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@given(st.text("abc", min_size=1, max_size=70), st.text("abcd", max_size=80))
@settings(max_examples=150, deadline=None)
def test_myers_is_the_edit_distance(pattern, text):
    bits = {}
    for i, ch in enumerate(pattern):
        bits[ch] = bits.get(ch, 0) | 1 << i
    assert decontaminate.myers_best(bits, len(pattern), text) == edit_best(pattern, text)


def edited(text, edits, seed):
    r, chars = random.Random(seed), list(text)
    for _ in range(edits):
        i, how = r.randrange(len(chars)), r.randrange(3)
        if how == 0:
            chars[i] = "q"
        elif how == 1:
            chars.insert(i, "q")
        else:
            del chars[i]
    return "".join(chars)


def test_leaks_against_all_distances(spark):
    items = [(i, prose(900 + i, 12)) for i in range(6)] + [(6, None), (7, ""), (8, "short"), (9, prose(900, 12).upper())]
    docs = [(i, f"{prose(500 + i, 20)} {edited(items[i % 6][1], i % 9, i)}  {prose(700 + i, 15)}") for i in range(36)]
    docs += [(100, None), (101, ""), (102, items[0][1].replace(" ", " \n ")), (102, items[0][1]), (103, items[1][1][:30])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, item_id string, leak string")
    got = decontaminate.find_leaks(df, bench).collect()
    want = Counter()
    for d, t in docs:
        for i, item in items:
            item = decontaminate.normalise(item)
            if len(item) >= 20:
                best = edit_best(item, decontaminate.normalise(t))
                if best <= int(0.08 * len(item)):
                    want[(d, i, best, len(item))] += 1
    assert Counter((r["doc_id"], r["item_id"], r["distance"], r["item_chars"]) for r in got) == want
    assert any(r["distance"] > 2 for r in got)
    kept = decontaminate.drop_contaminated(df, bench)
    leaked = {d for d, *_ in want}
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in docs if d not in leaked)
    assert decontaminate.find_leaks(df, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(df.limit(0), bench).count() == 0


def test_leaks_in_several_blocks(spark, monkeypatch):
    items = [(i, prose(900 + i, 12)) for i in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, f"x {t} y") for i, t in items], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    got = decontaminate.find_leaks(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in got) == [(i, i, 0) for i in range(9)]
    assert decontaminate.drop_contaminated(docs, bench).count() == 0


# -- secret scans ---------------------------------------------------------

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def brute_spans(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{z}" for a, _, k, z in sorted(out))


def scan(df, ledger, **more):
    out = secret_ledger.scan_versions(df, ledger, **more)
    return Counter((r[0], r[1]) for r in out.select("doc_id", secret_ledger.spans_text(F.col("spans"))).collect())


def test_secret_spans_edges(edge, empty, tmp_path):
    got = scan(edge, f"{tmp_path}/ledger")
    assert got == Counter((r[0], brute_spans(r[1] or "")) for r in edge_rows())
    assert any(s for _, s in got)
    assert scan(empty, f"{tmp_path}/none") == Counter()


def test_ledger_scans_only_unseen_blobs_and_rule_versions(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    first = [(1, "token = abcdefgh1"), (2, "token = abcdefgh1"), (3, "nothing")]
    second = [(1, "token = abcdefgh1"), (3, "secret: abcdefgh2 " + "a" * 32), (4, "nothing"), (4, "nothing")]

    def docs(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    def scans():
        return Counter((r["blob"], r["kind"], r["version"]) for r in spark.read.parquet(f"{ledger}/scans").collect())

    def addresses(rows):
        return {hashlib.sha256(t.encode()).hexdigest() for _, t in rows}

    assert scan(docs(first), ledger) == Counter((i, brute_spans(t)) for i, t in first)
    assert {b for b, *_ in scans()} == addresses(first)
    assert scan(docs(second), ledger) == Counter((i, brute_spans(t)) for i, t in second)
    assert set(scans().values()) == {1} and {b for b, *_ in scans()} == addresses(first + second)
    # a raised version: that rule alone, over the blobs given
    raised = [("assign", 2, r"(nothing)", 0, 1), *secret_ledger.RULES[1:]]
    got = scan(docs(second), ledger, rules=raised)
    assert got[(4, "assign:0:7")] == 2
    assert {b for b, k, v in scans() if v == 2} == addresses(second) and set(scans().values()) == {1}
    # every path of every version, by the first rules
    history = secret_ledger.findings_by_path(spark, ledger).collect()
    assert len(history) == len(first) + 2 * len(second)
    assert {r["path"] for r in history if r["spans"]} == {"1", "2", "3"}


def test_lost_run_leaves_no_half_result(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    docs = spark.createDataFrame([(1, "token = abcdefgh1")], "doc_id long, text string")
    blob = hashlib.sha256(b"token = abcdefgh1").hexdigest()
    spark.createDataFrame([(blob, "assign", 1, 5, 9, "lost")], secret_ledger._FINDINGS).write.parquet(f"{ledger}/findings")
    assert scan(docs, ledger) == Counter({(1, "assign:0:17"): 1})


def test_short_items_are_found(spark):
    items = [(1, "Blue Whale"), (2, "cat"), (3, "seventeen letters"), (4, " "), (5, "東京"), (6, "c++")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, "the  blue\nwhale, it sings"), (2, "concatenate"), (3, "a CAT."), (4, "xx seventeen leters yy"), (5, "私は東京都に"),
            (6, "blue whales"), (7, "in c++, say"), (8, None), (9, "cat")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.find_leaks(df, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in got if r["whole_word"] is not False) == [
        (1, 1, 0), (3, 2, 0), (4, 3, 1), (5, 5, 0), (7, 6, 0), (9, 2, 0)]
    assert sorted((r["doc_id"], r["item_id"]) for r in got if r["whole_word"] is False) == [(2, 2), (6, 1)]
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(df, bench).collect()) == [2, 6, 8]
    assert decontaminate.find_leaks(df, bench, min_chars=20).count() == 0


def test_line_index_knows_its_own_keys_only():
    r = np.random.default_rng(2)
    h = r.integers(-2**63, 2**63 - 1, (64, 2))
    index = LineIndex.from_bytes(LineIndex.build(h[:, 0].copy(), h[:, 1].copy(), np.full(64, 9), np.arange(64)).to_bytes())
    # strangers with the upper half of a key's second hash, which the fingerprint was before
    h2 = (np.repeat(h[:, 1], 200) & ~np.int64(2**32 - 1)) | r.integers(0, 2**32, 64 * 200)
    h1 = r.integers(-2**63, 2**63 - 1, 64 * 200)
    assert (index.probe(h1, h2)[0] == 0).all()
    assert (index.probe(np.repeat(h[:, 0], 200), h2)[0] == 0).all()
    assert (index.probe(h1, np.repeat(h[:, 1], 200))[0] == 0).all()
