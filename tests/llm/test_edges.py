"""Clashing names, short items, lost runs and hot groups of equal rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepool.llm import common, decontaminate, mixing, secret_ledger, sharding, simhash, url_filter

from .conftest import edge_rows, prose

INTERNAL = ["r_verdict", "__verdict", "__key", "__key2", "__copy", "__copies", "__again", "__r1", "__r2", "__shard", "__slot",
            "__leaks", "__score"]


def clashing(df):
    return df.select("*", *[F.lit(f"mine {c}").alias(c) for c in INTERNAL])


def untouched(df):
    return all(r[c] == f"mine {c}" for r in df.collect() for c in INTERNAL)


def test_internal_names_of_the_input_stay(spark):
    docs = clashing(spark.createDataFrame([(i, prose(i, 30), "en", "ab"[i % 2]) for i in range(20)],
                                          "doc_id long, text string, lang string, source string"))
    items = spark.createDataFrame([(1, prose(3, 30))], "item_id long, text string")
    for out in (mixing.mix(docs), sharding.shuffle_into_shards(docs), simhash.keep_one_each(docs),
                decontaminate.drop_contaminated(docs, items)):
        assert out.count() > 0 and untouched(out)
    pages = clashing(spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string"))
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    out = url_filter.judge_urls(pages, rules)
    assert untouched(out) and out.first()["verdict"] == "block"


def best_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return min(row)


@pytest.mark.parametrize("cut", [False, True])
def test_items_of_every_length_are_found_by_one_rule(spark, cut):
    r = random.Random(4)
    texts = [" ".join("".join(r.choices("abcdefg", k=r.randint(1, 6))) for _ in range(25)) for _ in range(6)]
    items = []
    for n in range(1, 41):
        t = r.choice(texts)
        a = r.randrange(len(t) - n) if cut else next(i for i in range(len(t) - n) if t[i] != " " and t[i + n - 1] != " ")
        items.append((f"item {n}", t[a:a + n].strip() or "b"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id string, text string"))
    want = set()
    for i, t in enumerate(texts):
        for name, item in items:
            item = decontaminate.normalise(item)
            d = best_distance(item, t)
            if d <= int(0.08 * len(item)):
                places = [k for k in range(len(t)) if t.startswith(item, k)]
                whole = any((k == 0 or t[k - 1] == " " or item[0] == " ") and
                            (k + len(item) == len(t) or t[k + len(item)] == " ") for k in places)
                want.add((i, name, d, len(item), whole if d == 0 else None))
    assert {tuple(r) for r in got.collect()} == want


def test_short_exact_items_inside_words_are_reported_and_filtered_by_choice(spark):
    docs = spark.createDataFrame([(1, "xabc def ghijklm")], "doc_id long, text string")
    items = spark.createDataFrame([(12, "abc def ghij"), (13, "abc def ghijk")], "item_id long, text string")
    got = {r["item_id"]: r["whole_word"] for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {12: False, 13: False}
    assert decontaminate.drop_contaminated(docs, items).count() == 0
    short = items.where(F.col("item_id") == 12)
    assert decontaminate.drop_contaminated(docs, short).count() == 1
    assert decontaminate.drop_contaminated(docs, short, word_chars=0).count() == 0


def test_items_on_edge_rows(spark, edge, empty):
    items = [(1, prose(1, 60)), (1, prose(1, 60)), (None, "é" * 40), (2, ""), (3, None), (4, prose(4, 20000)[500:700]),
             (5, "日本語")]
    items = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(map(tuple, decontaminate.find_leaks(edge, items).select("doc_id", "item_id", "distance").collect()))
    base = decontaminate.normalise(prose(1, 60))
    for i, text, *_ in edge_rows():
        assert (got[(i, 1, 0)] > 0) == (base in decontaminate.normalise(text)), i
    assert got[(4, 1, 0)] == 4 and got[(14, 4, 0)] == 1 and got[(13, 5, 0)] == 1 and got[(11, None, 0)] == 1
    assert decontaminate.find_leaks(empty, items).count() == 0


def test_history_lists_only_completed_runs(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "password=abcdefgh1")], "doc_id long, text string")
    ledger = f"{tmp_path}/ledger"
    with monkeypatch.context() as m:
        m.setattr(secret_ledger, "_scan", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            secret_ledger.scan_versions(docs, ledger)
    assert secret_ledger.scan_versions(docs, ledger).count() == 1
    assert secret_ledger.findings_by_path(spark, ledger, secret_ledger.RULES).count() == 1


def test_numbers_of_equal_rows_in_two_steps(spark):
    rows = [(7, 7, f"x{i}") for i in range(3000)] + [(i, 0, "y") for i in range(100, 1600)] + [(5, 5, "z")] * 3
    df = spark.createDataFrame(rows, "a long, b long, `__salt` string").repartition(9)
    out = common.numbered_copies(common.materialize(df, "t"), ["a", "b"], "copy", shares=16).collect()
    numbers = {}
    for r in out:
        numbers.setdefault((r["a"], r["b"]), []).append(r["copy"])
    assert Counter(r["__salt"] for r in out) == Counter(x for _, _, x in rows)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in numbers.values()) and len(numbers[(7, 7)]) == 3000
