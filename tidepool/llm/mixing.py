"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source wants the same number of copies,
``target / source size``.  The whole part is given; the fractions are rounded
together: two documents pair up and move mass (words times fraction) from one
to the other, at random and without bias, until one fraction is 0 or 1; the
other goes on.  A pair's expected mass never changes, so a source's taken
words differ from its target by less than its one last document.

The pairs form a reduction tree: each level deals the open documents of a
source into random groups of about ``FAN_IN``, folds each group (in a SQL
``aggregate``) to at most one open document, and writes the settled ones.
Documents only move once per level they reach, a source of any size spreads
over its groups, and a level shrinks the open rows ``FAN_IN`` times.  Only
built-in functions are used; random numbers are hashes of the seed, the level
and the document, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, numbered_copies, row_key, unit_interval, unused, word_count

# Weights of the sources in code point order, and the budgets.
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0

FAN_IN = 64
SEED = 20240229

_DOC = "struct<h:bigint,key:bigint,key2:bigint,copy:int,size:bigint,p:double>"
_STATE = f"struct<open:{_DOC},done:array<struct<key:bigint,key2:bigint,copy:int,take:int>>>"


def source_targets(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
                   most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in code point order, null last, take the weights in turn and share
    ``total_share`` of all sizes; a target stops at ``most`` times its
    source's size and the excess is shared anew by weight.  In order of cap
    per unit of weight the capped sources come first, so one pass of running
    sums finds them: a source is capped if its cap per weight is not above the
    level that the sources from it on would share.
    """
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    # one row per source from here on
    sources = (sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
               .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                  (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
               .withColumn("cap", F.lit(float(most)) * F.col("source_size")))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, rest = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    budget = F.lit(float(total_share)) * F.sum("source_size").over(Window.partitionBy())
    left = budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    return (sources.withColumn("level", left / F.sum("weight").over(rest)).withColumn("order", F.row_number().over(by_cap))
            .withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
            .withColumn("share", F.min(F.when(~F.col("capped"), F.struct("order", "level"))).over(Window.partitionBy())["level"])
            .select("source", "source_size", "rows",
                    F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("share")).alias("target")))


def _pivot(acc: Column, x: Column, seed: int, level: int) -> Column:
    """One step of the fold: pair the open document with the next one."""
    a = acc["open"]
    mass_a, mass_b = a["size"] * a["p"], x["size"] * x["p"]
    room_a, room_b = a["size"] * (1.0 - a["p"]), x["size"] * (1.0 - x["p"])
    to_a, to_b = F.least(room_a, mass_b), F.least(mass_a, room_b)
    draw = unit_interval(F.xxhash64(F.lit(seed), F.lit(level), a["h"], x["h"], a["copy"], x["copy"]))

    def doc(d: Column, p: Column) -> Column:
        return F.struct(d["h"].alias("h"), d["key"].alias("key"), d["key2"].alias("key2"), d["copy"].alias("copy"),
                        d["size"].alias("size"), p.alias("p"))

    def settle(d: Column, take: int, still: Column, p: Column) -> Column:
        done = F.struct(d["key"].alias("key"), d["key2"].alias("key2"), d["copy"].alias("copy"), F.lit(take).alias("take"))
        return F.struct(doc(still, p).alias("open"), F.concat(acc["done"], F.array(done)).alias("done"))

    gives = draw * (to_a + to_b) < to_b  # mass moves from b to a
    first = F.struct(x.alias("open"), acc["done"].alias("done"))
    return (F.when(a.isNull(), first)
            .when(gives & (room_a <= mass_b), settle(a, 1, x, F.greatest(F.lit(0.0), x["p"] - to_a / x["size"])))
            .when(gives, settle(x, 0, a, F.least(F.lit(1.0), a["p"] + to_a / a["size"])))
            .when(mass_a <= room_b, settle(a, 0, x, F.least(F.lit(1.0), x["p"] + to_b / x["size"])))
            .otherwise(settle(x, 1, a, F.greatest(F.lit(0.0), a["p"] - to_b / a["size"]))))


def _fold_level(open_docs: DataFrame, level: int, levels: int, seed: int) -> DataFrame:
    """One level of the tree: settled documents with ``take``, open ones with a new ``p``."""
    last = level == levels - 1
    groups = F.lit(1) if last else F.greatest(F.lit(1), F.ceil(F.col("n") / float(FAN_IN ** (level + 1)))).cast("long")
    dealt = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "h", "copy"), groups)
    folded = (open_docs.groupBy("bin", "n", dealt.alias("deal"))
              .agg(F.sort_array(F.collect_list(F.struct("h", "key", "key2", "copy", "size", "p"))).alias("docs"))
              .withColumn("state", F.aggregate(
                  F.col("docs").cast(f"array<{_DOC}>"),
                  F.struct(F.lit(None).cast(_DOC).alias("open"),
                           F.array().cast("array<struct<key:bigint,key2:bigint,copy:int,take:int>>").alias("done")).cast(_STATE),
                  lambda acc, x: _pivot(acc, x, seed, level))))
    still = F.col("state.open")
    if last:  # the one document of a source that is left rounds by itself
        draw = unit_interval(F.xxhash64(F.lit(seed), F.lit(level + 1), still["h"]))
        still_done = F.array(F.struct(still["key"].alias("key"), still["key2"].alias("key2"), still["copy"].alias("copy"),
                                      (draw < still["p"]).cast("int").alias("take")))
        return folded.select(F.explode(F.concat("state.done", still_done)).alias("d")).select("d.*")
    rows = F.concat(
        F.transform("state.done", lambda d: F.struct(
            F.lit(None).cast("bigint").alias("h"), d["key"].alias("key"), d["key2"].alias("key2"), d["copy"].alias("copy"),
            F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("double").alias("p"), d["take"].alias("take"))),
        F.array(F.struct(still["h"].alias("h"), still["key"].alias("key"), still["key2"].alias("key2"),
                         still["copy"].alias("copy"), still["size"].alias("size"), still["p"].alias("p"),
                         F.lit(None).cast("int").alias("take"))))
    return folded.select("bin", "n", F.explode(rows).alias("d")).select("bin", "n", "d.*")


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most: float = MOST_COPIES,
             seed: int = SEED) -> DataFrame:
    """One row per input row: id, ``key``, ``key2``, ``copy`` (its number among equal rows),
    ``size`` (words), ``source_size``, ``target`` (the source's) and ``copies``.

    A null text has size 0 and gets the whole part of its copies; a null
    source is a source of its own.  Rows equal in id, text and source are told
    apart by ``copy`` only, so each of them is drawn for itself.  A source
    whose sizes are all 0 has target 0.
    """
    k1, k2 = row_key(F.col(id_col), F.col(text_col), F.col(source_col))
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                       k1.alias("key"), k2.alias("key2"))
    slim = materialize(numbered_copies(materialize(slim, "mix-rows"), ["key", "key2"], "copy"), "mix-sizes")

    targets = source_targets(slim, weights, total_share, most)
    targets = materialize(targets.withColumn("bin", F.xxhash64(F.lit(seed), F.col("source").isNull(), "source")), "mix-targets")
    want = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = (slim.withColumn("bin", F.xxhash64(F.lit(seed), F.col("source").isNull(), "source"))
              .join(targets.select("bin", "source_size", "target", F.col("rows").alias("n")), "bin")
              .withColumn("want", F.least(want, F.lit(float(most))))
              .withColumn("whole", F.floor("want").cast("int"))
              .withColumn("p", F.col("want") - F.col("whole")))

    most_rows = targets.agg(F.max("rows")).first()[0] or 0
    levels = 1
    while FAN_IN ** levels < most_rows:
        levels += 1
    open_docs = (wanted.where((F.col("p") > 0) & (F.col("size") > 0))
                 .select("bin", "n", F.xxhash64(F.lit(seed), "key", "key2").alias("h"), "key", "key2", "copy", "size", "p"))
    settled = []
    for level in range(levels):
        out = _fold_level(open_docs, level, levels, seed)
        if level < levels - 1:
            out = materialize(out, f"mix-level-{level}")
            settled.append(out.where(F.col("take").isNotNull()).select("key", "key2", "copy", "take"))
            open_docs = out.where(F.col("take").isNull()).drop("take")
        else:
            settled.append(out.select("key", "key2", "copy", "take"))
    taken = reduce(DataFrame.unionByName, settled)
    return (wanted.join(taken, ["key", "key2", "copy"], "left")
            .select(F.col("id").alias(id_col), "key", "key2", "copy", "size", "source_size", "target",
                    (F.col("whole") + F.coalesce("take", F.lit(0))).alias("copies")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixture itself: every input row as often as its copies say, columns as given."""
    plan = materialize(plan_mix(docs, id_col, text_col, source_col, **options).select("key", "key2", "copy", "copies"), "mix-plan")
    # equal rows meet their copies by their number, one to one
    key, key2, copy, copies, again = (unused(docs, c) for c in ("key", "key2", "copy", "copies", "again"))
    per_row = plan.select(*[F.col(c).alias(n) for c, n in (("key", key), ("key2", key2), ("copy", copy), ("copies", copies))])
    k1, k2 = row_key(F.col(id_col), F.col(text_col), F.col(source_col))
    numbered = numbered_copies(docs.withColumns({key: k1, key2: k2}), [key, key2], copy, counted=per_row)
    return (numbered.join(per_row.where(F.col(copies) > 0), [key, key2, copy])
            .withColumn(again, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*docs.columns))
