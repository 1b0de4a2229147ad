"""Secret scans with an incremental ledger of blobs, in built-in functions only.

A blob is the SHA-256 of a text.  The ledger (a folder of Parquet tables)
keeps three append-only tables:

* ``versions``: which path held which blob, for every version ever given;
* ``findings``: spans per blob and rule version;
* ``scans``: the (blob, rule version) pairs whose findings are complete.

A run addresses the new versions, takes the blobs with a pair that no earlier
run has scanned, scans each such blob once for its unseen rule versions, and
joins the findings of all runs back to every path.  ``scans`` is written last
and findings count only for runs that reached it, so a lost run leaves no
half result: its pairs are simply unseen.

Scale: one row per blob and pair travels without text; the text of each blob
comes from one representative version chosen by (blob, row key), so the
copies of a hot blob spread evenly and are scanned once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import row_key, rows

# The patterns, in the order in which spans of one start are listed:
# (kind, version, pattern, group whose length counts, its least length).  Hex and
# access runs carry the least length in the pattern, as a run is taken whole.
RULES = [
    ("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", 1, r"[0-9a-f]{32,}", 0, 32),
]

_VERSIONS = "path string, r1 long, blob string, run string"
_FINDINGS = "blob string, kind string, version int, start long, stop long, run string"
_SCANS = "blob string, kind string, version int, run string"
_SPANS = "array<struct<start:bigint,kind:string,stop:bigint>>"


def _table(spark: SparkSession, ledger: str, name: str, schema: str) -> DataFrame:
    """A ledger table, empty where no run has written it yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{name}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return rows(spark, [], schema)
    return spark.read.schema(schema).parquet(f"{ledger}/{name}")


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Per match: characters before it since the last one, its own, and the counted ones."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    return F.arrays_zip(F.transform(F.split(text, pattern), F.char_length).alias("gap"),
                        F.transform(whole, F.char_length).alias("size"),
                        F.transform(counted, F.char_length).alias("counted"))


def _scan(todo: DataFrame, rules: list[tuple]) -> DataFrame:
    """Findings over (blob, t, todo): leftmost non-overlapping matches, short ones dropped.

    Positions are running sums of the lengths of the matches and of the text
    between them, in code points.
    """
    t = F.col("t")
    per_rule = [F.struct(F.lit(kind).alias("kind"), F.lit(version).alias("version"), F.lit(least).alias("least"),
                         F.when(F.array_contains("todo", kind) & t.rlike(pattern), _matches(t, pattern, group)).alias("x"))
                for kind, version, pattern, group, least in rules]
    hits = (todo.select("blob", F.explode(F.array(*per_rule)).alias("rule"))
            .select("blob", "rule.kind", "rule.version", "rule.least", F.posexplode("rule.x").alias("i", "x"))
            .select("blob", "kind", "version", "least", "i", "x.*")
            .dropDuplicates(["blob", "kind", "i"]))
    up_to_here = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return (hits.withColumn("stop", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(up_to_here))
            .where(F.col("counted") >= F.col("least"))
            .select("blob", "kind", "version", (F.col("stop") - F.col("size")).cast("long").alias("start"),
                    F.col("stop").cast("long").alias("stop")))


def findings_by_path(spark: SparkSession, ledger: str, rules: list[tuple] | None = None,
                     run: str | None = None) -> DataFrame:
    """Every (path, blob) version in the ledger, or one run's, with its ``spans``."""
    rules = RULES if rules is None else rules
    order = rows(spark, [(r[0], r[1], i) for i, r in enumerate(rules)], "kind string, version int, order int")
    done = _table(spark, ledger, "scans", _SCANS).distinct()
    spans = (_table(spark, ledger, "findings", _FINDINGS).join(order, ["kind", "version"])
             .join(done, ["blob", "kind", "version", "run"], "left_semi")
             .select("blob", "start", "order", "kind", "stop").distinct()
             .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "order", "kind", "stop"))).alias("s"))
             .select("blob", F.transform("s", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"),
                                                                 x["stop"].alias("stop"))).cast(_SPANS).alias("spans")))
    versions = _table(spark, ledger, "versions", _VERSIONS)
    if run is not None:
        versions = versions.where(F.col("run") == run)
    return (versions.select("path", "blob").join(spans, "blob", "left")
            .select("path", "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")))


def scan_versions(versions: DataFrame, ledger: str, path_col: str = "doc_id", text_col: str = "text",
                  rules: list[tuple] | None = None) -> DataFrame:
    """Scan what the ledger has not seen; return the given rows with their findings.

    One row per input row: the path, its ``blob`` and ``spans``, an array of
    (start, kind, stop) by start, then kind as listed in ``rules``; positions
    are code points, ``stop`` is exclusive.  A null text is an empty blob.
    Null paths and repeated rows are rows like any other; copies of a text
    share one scan.  ``ledger`` is a folder that all executors reach; a rule
    whose version is raised is scanned again over all blobs given.
    """
    spark = versions.sparkSession
    rules = RULES if rules is None else rules
    run = uuid.uuid4().hex
    texts = versions.select(F.col(path_col).cast("string").alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    texts = texts.select("path", "t", row_key(F.col("path"), F.col("t"))[0].alias("r1"), F.sha2("t", 256).alias("blob"))
    # the run's versions are listed in a folder of its own; they count once the run is complete
    listed = texts.select("path", "r1", "blob", F.lit(run).alias("run"))
    listed.write.parquet(f"{ledger}/started/{run}")
    mine = spark.read.schema(listed.schema).parquet(f"{ledger}/started/{run}")

    # blobs with unseen (blob, rule version) pairs, with the kinds still to scan
    current = rows(spark, [(r[0], r[1]) for r in rules], "kind string, version int")
    seen = (_table(spark, ledger, "scans", _SCANS).join(current, ["kind", "version"], "left_semi")
            .groupBy("blob").agg(F.collect_set("kind").alias("seen")))
    kinds = F.array(*[F.lit(r[0]) for r in rules]).cast("array<string>")
    unseen = (mine.groupBy("blob").agg(F.min("r1").alias("r1")).join(seen, "blob", "left")
              .select("blob", "r1", F.array_except(kinds, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
              .where(F.size("todo") > 0))
    if rules:
        found = _scan(texts.join(unseen, ["blob", "r1"]), rules)
        found.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{ledger}/findings")
        (unseen.select("blob", F.explode("todo").alias("kind")).join(current, "kind")
         .select("blob", "kind", "version", F.lit(run).alias("run"))
         .write.mode("append").parquet(f"{ledger}/scans"))
    mine.write.mode("append").parquet(f"{ledger}/versions")
    path_type = versions.schema[path_col].dataType
    return findings_by_path(spark, ledger, rules, run).select(F.col("path").cast(path_type).alias(path_col), "blob", "spans")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
