"""The original example programs as runnable Spark jobs over files.

    python -m tidepool.jobs word-count --input lines.txt [--output out]
    python -m tidepool.jobs word-count-stream --input lines/ --output out
    python -m tidepool.jobs avg-profit --input sales/ --output out
    python -m tidepool.jobs split      --input numbers/ --output out
    python -m tidepool.jobs cab        --input trips/ --output out
    python -m tidepool.jobs bank       --input txns/ --alarmed a.txt --lost l.txt --output out
    python -m tidepool.jobs stock      --input ticks/ --output out [--threshold 5]

Batch jobs read a file or folder once.  ``bank`` and ``stock`` are streaming
jobs over a folder of text files (every new file is new input): they process
what is there (``availableNow``) and write hourly bucket folders, keeping
their progress in ``<output>/_checkpoint*`` so a rerun continues where the
last one stopped.  Lines are ordered by file and position for the rolling
jobs; the streaming jobs use event time (the line's timestamp) with the
transaction/tick order as tie-breaker.
"""

from __future__ import annotations

import argparse
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import session as S
from .functions import render
from .functions.parse import (ALARMED_LINE, CAB_LINE, LOST_CARD_LINE, SALE_LINE, TICK_LINE, TXN_LINE,
                              parse_lines)
from .operators import aggregates, rolling, rules, split, text, windows
from .sinks.files import write_csv, write_text
from .streaming.operators import stream_city_changes, stream_rolling
from .streaming.parts import fan_out
from .streaming.runners import late_rows, use_rocksdb_state
from .streaming.stateful import PreviousWindowDelta, WindowReport


# Files that one micro-batch of a streaming job takes.
FILES_PER_TRIGGER = 1000


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a ``seq`` that follows file and line order of this read."""
    return spark.read.text(path).withColumn("seq", F.monotonically_increasing_id())


def word_count_job(spark: SparkSession, input_path: str, output: str | None = None) -> DataFrame:
    counts = text.word_count(spark.read.text(input_path).withColumnRenamed("value", "line"), "line", "N")
    if output:
        write_csv(counts, output, sep=" ", line_sep="\n")
    return counts


def word_count_stream_job(spark: SparkSession, input_dir: str, output: str,
                          files_per_trigger: int = FILES_PER_TRIGGER):
    """Running count per line starting with "N", one updated ``(line,count)``
    per input line (keyed state).  Files are taken in modification-time
    order; inside a file equal lines are interchangeable, so no line index is
    needed."""
    S.configure(spark)
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(input_dir) \
        .where(F.startswith(F.col("value"), F.lit("N"))) \
        .select(F.col("value").alias("word"),
                F.col("_metadata.file_modification_time").alias("seq"),
                F.lit(1).cast("bigint").alias("one"))
    counts = stream_rolling(lines, ["word"], ["seq"], "one", strict=False)
    writer = (counts.select(F.format_string("(%s,%d)", "word", "running_count").alias("value"))
              .writeStream.format("text").outputMode("append")
              .option("checkpointLocation", f"{output}/_checkpoint").trigger(availableNow=True))
    query = writer.start(output)
    query.awaitTermination()
    return query


def avg_profit_job(spark: SparkSession, input_path: str, output: str | None = None) -> DataFrame:
    sales = parse_lines(_numbered_lines(spark, input_path), SALE_LINE, keep=["seq"])
    out = rolling.rolling_avg(sales, ["month"], ["seq"], "profit").orderBy("seq")
    if output:
        write_text(out.select("month", "running_avg"), output)
    return out


def split_job(spark: SparkSession, input_path: str, output: str | None = None) -> dict[str, DataFrame]:
    nums = _numbered_lines(spark, input_path).select("seq", F.col("value").cast("int").alias("value"))
    outs = {"even": split.split_even(nums, "value", keep=["seq"]).orderBy("seq").drop("seq"),
            "odd": split.split_odd(nums, "value", keep=["seq"]).orderBy("seq").drop("seq")}
    if output:
        for name, df in outs.items():
            write_text(df, f"{output}/{name}", wrap=None)
    return outs


def cab_job(spark: SparkSession, input_path: str, output: str | None = None) -> dict[str, DataFrame]:
    trips = parse_lines(_numbered_lines(spark, input_path), CAB_LINE, keep=["seq"])
    ongoing = aggregates.ongoing(trips, "ongoing", "yes", {"passengers": "int"})
    outs = {
        "trips_by_destination": rolling.rolling_count(ongoing, ["destination"], ["seq"], "trips")
        .select("seq", "destination", "trips").orderBy("seq"),
        "avg_passengers_by_pickup": rolling.rolling_avg(ongoing, ["pickup"], ["seq"], "passengers",
                                                        "avg_passengers")
        .select("seq", "pickup", "avg_passengers").orderBy("seq"),
    }
    if output:
        for name, df in outs.items():
            write_text(df.drop("seq"), f"{output}/{name}")
    return outs


def bank_job(spark: SparkSession, input_dir: str, alarmed_path: str, lost_path: str, output: str,
             window: str = "10 seconds", threshold: int = 10, lateness: str = "0 seconds",
             files_per_trigger: int = FILES_PER_TRIGGER):
    """Four fraud rules over a transaction feed, as alert lines below ``rules=.../batch=N/`` in hourly buckets.

    The member lists are files or folders of lines and are read again for every
    micro-batch, so lines added while the job runs count from the next one on.  Each batch is
    written once, also when it is repeated.  Returns the number of transactions that came too late for the
    windowed rules (a warning names it); the lists are checked for these as well."""
    S.configure(spark)
    use_rocksdb_state(spark)
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(input_dir)
    parsed = parse_lines(raw, TXN_LINE, keep=["value"])
    txns = parsed.withColumn("evt", F.to_timestamp("txn_ts", "yyyy-MM-dd HH:mm:ss")).withWatermark("evt", lateness)
    cols = ["customer_id", "value"]

    def member_alerts(batch: DataFrame) -> DataFrame:
        def members(path: str, fields) -> DataFrame:
            return parse_lines(batch.sparkSession.read.text(path), fields)

        hits = rules.flag_members_many(batch, [
            ("customer_id", members(alarmed_path, ALARMED_LINE), "customer_id", rules.RULE_ALARMED),
            ("card_id", members(lost_path, LOST_CARD_LINE), "card_id", rules.RULE_LOST_CARD)], cols)
        lines = [F.when(F.col("rule") == rule, render.alert_line(rule, *cols)) for rule in (rules.RULE_ALARMED, rules.RULE_LOST_CARD)]
        return hits.select(F.coalesce(*lines).alias("value"))

    busy = windows.tumbling(txns, "evt", window, ["customer_id"], {
        "n": F.count(F.lit(1)), "first_line": windows.first_by("value", ["evt", "txn_id"])}) \
        .where(F.col("n") > threshold) \
        .select(render.alert_line(rules.RULE_EXCESSIVE, "customer_id", "first_line", "n").alias("value"))
    moves = stream_city_changes(txns, "customer_id", "evt", window, "city", ["evt", "txn_id"],
                                ["value"], 2) \
        .select(render.alert_line(rules.RULE_CITY_CHANGE, "customer_id", "value").alias("value"))
    fan_out(parsed, {"rules=members": member_alerts}, output, file_format="text", checkpoint="_checkpoint-members")
    late = fan_out(rules.union_alerts(busy, moves), {"rules=windows": lambda batch: batch}, output, file_format="text",
                   checkpoint="_checkpoint-windows")
    if late:
        warnings.warn(f"bank: {late} transactions came later than the watermark delay of {lateness}", stacklevel=2)
    return late


_TICK_ORDER = ["ts", "line_key"]
_FMT = "dd/MM/yyyy:HH:mm:ss"


def stock_job(spark: SparkSession, input_dir: str, output: str, threshold: float = 5.0,
              symbol: str = "XYZ", files_per_trigger: int = FILES_PER_TRIGGER):
    """Per-minute report and 5-minute large-change alerts over a tick feed
    (two sinks from one source, each with its own checkpoint).

    Returns the number of window rows that came too late for their window, over both sinks (a warning names it)."""
    S.configure(spark)
    use_rocksdb_state(spark)
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(input_dir)
    ticks = parse_lines(raw, TICK_LINE, keep=["value"]) \
        .withColumn("ts", F.to_timestamp(F.concat_ws(" ", "date", "time"), "dd/MM/yyyy HH:mm:ss")) \
        .withColumn("line_key", F.xxhash64("value")).withColumn("symbol", F.lit(symbol)) \
        .withWatermark("ts", "0 seconds")
    stats = windows.tumbling(ticks, "ts", "1 minute", ["symbol"], {
        "max_price": F.greatest(F.max("price"), F.lit(0.0)), "min_price": F.min("price"),
        "max_volume": F.greatest(F.max("volume"), F.lit(0)), "min_volume": F.min("volume"),
        "first_ts": F.min("ts"), "last_ts": F.max("ts")})
    report_cols = ["symbol", "window_start", "window_end", "max_price", "min_price", "max_volume",
                   "min_volume", "first_ts", "last_ts"]
    report_schema = ("symbol string, window_start timestamp, window_end timestamp, max_price double, "
                     "min_price double, max_volume int, min_volume int, first_ts timestamp, "
                     "last_ts timestamp, max_price_change double, max_volume_change double")
    report = stats.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=WindowReport(report_cols), outputStructType=report_schema,
        outputMode="Append", timeMode="None")
    report_lines = report.select(
        render.window_report(F.date_format("first_ts", _FMT), F.date_format("last_ts", _FMT),
                             "max_price", "min_price", "max_price_change", "max_volume", "min_volume",
                             "max_volume_change").alias("value"), "window_start")

    arg_key = F.struct((-F.col("price")).alias("neg"), *[F.col(c) for c in _TICK_ORDER])
    per5 = windows.tumbling(ticks, "ts", "5 minutes", ["symbol"], {
        "cur_max": F.greatest(F.max("price"), F.lit(0.0)), "max_ts": F.min_by("ts", arg_key)})
    delta_schema = ("symbol string, window_start timestamp, window_end timestamp, prev_max double, "
                    "cur_max double, pct_change double, max_ts timestamp")
    deltas = per5.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=PreviousWindowDelta("symbol", threshold), outputStructType=delta_schema,
        outputMode="Append", timeMode="None")
    delta_lines = deltas.select(
        render.delta_alert("pct_change", "prev_max", "cur_max", F.date_format("max_ts", _FMT))
        .alias("value"), "window_start")

    late = 0
    for name, df in (("report", report_lines), ("alerts", delta_lines)):
        writer = (df.withColumn("bucket", F.date_format("window_start", "yyyy-MM-dd--HH"))
                  .drop("window_start").writeStream.format("text").partitionBy("bucket")
                  .outputMode("append").option("checkpointLocation", f"{output}/_checkpoint_{name}")
                  .trigger(availableNow=True))
        late += late_rows(spark, writer, f"{output}/{name}")
    if late:
        warnings.warn(f"stock: {late} rows came after their window was closed", stacklevel=2)
    return late


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="python -m tidepool.jobs")
    p.add_argument("job", choices=["word-count", "word-count-stream", "avg-profit", "split", "cab",
                                   "bank", "stock"])
    p.add_argument("--input", required=True)
    p.add_argument("--output")
    p.add_argument("--alarmed")
    p.add_argument("--lost")
    p.add_argument("--threshold", type=float, default=None)
    p.add_argument("--window", default="10 seconds")
    p.add_argument("--files-per-trigger", type=int, default=FILES_PER_TRIGGER)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tidepool-{a.job}").getOrCreate()
    if a.job == "word-count":
        df = word_count_job(spark, a.input, a.output)
        if not a.output:
            df.show(truncate=False)
    elif a.job == "word-count-stream":
        word_count_stream_job(spark, a.input, a.output, a.files_per_trigger)
    elif a.job == "avg-profit":
        avg_profit_job(spark, a.input, a.output)
    elif a.job == "split":
        split_job(spark, a.input, a.output)
    elif a.job == "cab":
        cab_job(spark, a.input, a.output)
    elif a.job == "bank":
        bank_job(spark, a.input, a.alarmed, a.lost, a.output, a.window,
                 int(a.threshold) if a.threshold is not None else 10,
                 files_per_trigger=a.files_per_trigger)
    else:
        stock_job(spark, a.input, a.output, a.threshold if a.threshold is not None else 5.0,
                  files_per_trigger=a.files_per_trigger)


if __name__ == "__main__":
    main()
