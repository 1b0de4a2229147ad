"""Running totals with one key holding a third of the rows: the plain
per-key window against the chunked scan (same results, timed).

usage: python scripts/skew_check.py N_ROWS
"""
import os
import sys, time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import Window, functions as F
from tidepool.session import build_session
from tidepool.operators.ordered import running_totals
spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "8g"})
n = int(sys.argv[1])
df = spark.range(n).select(
    F.col("id"),
    F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("k"),
    ((F.col("id") * 7919) % n).alias("t"),
    (F.col("id") % 100).alias("v"))
def run(label, f):
    t = time.time(); out = f(); out.write.format("noop").mode("overwrite").save(); dt = time.time() - t
    print(label, round(dt, 2)); return dt
w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
for i in range(2):
    run("plain_window", lambda: df.select("*", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c")))
    run("chunked", lambda: running_totals(df, ["k"], ["t", "id"], sums={"s": F.col("v")}, count_name="c"))
# equality on a sample of keys (whole result, compared by anti-join counts)
a = df.select("*", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c"))
b = running_totals(df, ["k"], ["t", "id"], sums={"s": F.col("v")}, count_name="c")
print("mismatches", a.exceptAll(b.select(*a.columns)).count())
