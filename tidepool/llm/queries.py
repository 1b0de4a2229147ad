"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (decontaminate, langid, line_dedup, merkle, mixing, periodic_runs, phrase_dedup, quality, secret_ledger, sharding,
               simhash, token_count, url_filter)
from .common import read, rows

# The url rules of op2 (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
VOCABULARY = "byte_bpe_50k.json"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rows(spark, URL_RULES, "host string, path string, verdict string")).drop("url")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_ledger.scan_versions(read(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))
    spans = secret_ledger.spans_text(F.col("spans"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    return out.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                      count("hex").alias("n_hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train_quality(docs, read(spark, sf_dir, "labels"))
    return quality.judge_quality(docs, model)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train_languages(docs))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign_shards(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 7 == 0
    altered = F.when(picked, F.col("n_chars") + 1).otherwise(F.col("n_chars"))  # a null stays
    return merkle.manifest(read(spark, sf_dir, "documents"), tampered={"n_chars": altered}).drop("path")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrase_dedup.dedup_phrases(read(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, span: n + span["length"])
    return out.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find_runs(read(spark, sf_dir, "documents"), rewrite=periodic_runs.plant_period)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                                 r["period"].alias("period"))))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n"))))
    return (out.withColumn("best", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
                    F.floor(-F.col("best.less") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
                    F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_url_filters": op2_url_filters,
    "op3_token_counts": op3_token_counts,
    "op4_decontamination": op4_decontamination,
    "op5_secret_scans": op5_secret_scans,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_simhash": op8_simhash,
    "op9_language_id": op9_language_id,
    "op10_sharding": op10_sharding,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_FIELD = "coalesce(strlen(({0})::VARCHAR) || ':' || ({0})::VARCHAR, '-')"

ORACLE_SQL = {
    "op1_line_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
        k AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM l),
        shared AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
                   GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        j AS (SELECT rid, k.doc_id, line, i, keeper IS NOT NULL AND keeper IS DISTINCT FROM k.doc_id AS gone
              FROM k LEFT JOIN shared USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM j GROUP BY rid, doc_id""",
    "op2_url_filters": f"""
        WITH p AS (SELECT row_number() OVER () AS rid, page_id,
                          {_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
                          coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        r(r_host, r_path, r_verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
        m AS (SELECT rid, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
                     arg_max(r_verdict, length(r_host || r_path)) AS r_verdict
              FROM p, r WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY rid)
        SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (rid)""",
    "op5_secret_scans": """
        WITH a(pat) AS (VALUES ('([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)')),
        d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        x AS (SELECT rid, doc_id, 0 AS ord, 'assign' AS kind, 8 AS least, regexp_split_to_array(t, pat) AS gaps,
                     regexp_extract_all(t, pat) AS ms, regexp_extract_all(t, pat, 2) AS cs
              FROM d, a
              UNION ALL
              SELECT rid, doc_id, 1, 'access', 16, regexp_split_to_array(t, 'AKIA[A-Z0-9]+'),
                     regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM d
              UNION ALL
              SELECT rid, doc_id, 2, 'hex', 32, regexp_split_to_array(t, '[0-9a-f]+'),
                     regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') FROM d),
        u AS (SELECT rid, ord, kind, least, unnest(ms) AS m, unnest(cs) AS c, unnest(gaps[1:len(ms)]) AS g,
                     generate_subscripts(ms, 1) AS i FROM x),
        s AS (SELECT rid, ord, kind, least, length(c) AS n, length(m) AS size,
                     sum(length(g) + length(m)) OVER (PARTITION BY rid, ord ORDER BY i) AS stop FROM u),
        f AS (SELECT rid, count(*) FILTER (ord = 0) AS a, count(*) FILTER (ord = 1) AS k, count(*) FILTER (ord = 2) AS h,
                     string_agg(kind || ':' || (stop - size)::BIGINT || ':' || stop::BIGINT, ',' ORDER BY stop - size, ord) AS spans
              FROM s WHERE n >= least GROUP BY rid)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
               sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN f USING (rid)""",
    "op11_merkle_manifest": f"""
        WITH RECURSIVE rows_ AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '-') AS g,
                   {_FIELD.format("doc_id")} || {_FIELD.format("source")} || {_FIELD.format("lang")} AS head,
                   {_FIELD.format("n_chars")} AS size_, {_FIELD.format("text")} AS tail,
                   {_FIELD.format("n_chars + 1")} AS size_1,
                   (list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                        lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc_
            FROM documents),
        leaves AS (
            SELECT rid, doc_id, g, sha256(head || size_ || tail) AS leaf,
                   CASE WHEN xor(crc_, 4294967295) % 7 = 0 THEN sha256(head || size_1 || tail) ELSE sha256(head || size_ || tail) END AS now
            FROM rows_),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY g) AS n FROM leaves),
        up AS (
            SELECT g, 0 AS lvl, pos, leaf AS h, n FROM placed
            UNION ALL
            SELECT g, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM up WHERE n > 1
            GROUP BY g, lvl, pos // 2, n),
        subroots AS (SELECT g, h, lvl AS height, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
        top_ AS (
            SELECT 0 AS lvl, pos, h, n FROM subroots
            UNION ALL
            SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM top_ WHERE n > 1
            GROUP BY lvl, pos // 2, n),
        folded AS (
            SELECT rid, g, pos, now, '' AS sibs, 0 AS lvl, n FROM placed
            UNION ALL
            SELECT f.rid, f.g, f.pos // 2,
                   CASE WHEN f.pos % 2 = 0 THEN sha256(f.now || coalesce(u.h, '')) ELSE sha256(u.h || f.now) END,
                   f.sibs || coalesce(u.h, ''), f.lvl + 1, (f.n + 1) // 2
            FROM folded f LEFT JOIN up u ON u.g = f.g AND u.lvl = f.lvl AND u.pos = xor(f.pos, 1) WHERE f.n > 1),
        folded_top AS (
            SELECT f.rid, s.pos, f.now, f.sibs, 0 AS lvl, s.n FROM folded f JOIN subroots s USING (g) WHERE f.n = 1
            UNION ALL
            SELECT f.rid, f.pos // 2,
                   CASE WHEN f.pos % 2 = 0 THEN sha256(f.now || coalesce(u.h, '')) ELSE sha256(u.h || f.now) END,
                   f.sibs || coalesce(u.h, ''), f.lvl + 1, (f.n + 1) // 2
            FROM folded_top f LEFT JOIN top_ u ON u.lvl = f.lvl AND u.pos = xor(f.pos, 1) WHERE f.n > 1)
        SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(f.sibs) AS proof_sha256, f.now AS folded_root, f.now = r.h AS verified
        FROM placed p JOIN subroots s USING (g) JOIN folded_top f ON f.rid = p.rid AND f.n = 1 CROSS JOIN (SELECT h FROM top_ WHERE n = 1) r""",
    "op12_substring_dedup": """
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        w AS (SELECT rid, doc_id, unnest(range(len(ws) - 12)) AS i0, ws FROM d WHERE len(ws) >= 13),
        k AS (SELECT rid, doc_id, i0, array_to_string(ws[i0 + 1:i0 + 13], ' ') AS key FROM w),
        owner AS (SELECT key, min(doc_id) AS least FROM k GROUP BY key),
        gone AS (SELECT DISTINCT rid, i0 + unnest(range(13)) AS i FROM k JOIN owner USING (key)
                 WHERE least IS NOT NULL AND (doc_id IS NULL OR least < doc_id)),
        x AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM d),
        y AS (SELECT x.rid, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY x.i) FILTER (gone.i IS NULL) AS kept
              FROM x LEFT JOIN gone ON gone.rid = x.rid AND gone.i = x.i GROUP BY x.rid)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN y USING (rid)""",
}
