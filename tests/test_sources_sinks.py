"""Sources (memory rows, CSV folders, JSON, text) and sinks (text, CSV, buckets, messages)."""

import glob
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions import json as J
from tidepool.functions.parse import SALE_LINE, parse_lines
from tidepool.functions.time import instant_to_ntz, millis_to_ts, ntz_to_instant, parse_ts
from tidepool.sinks import files as K
from tidepool.sources import files as SRC
from tidepool.sources import memory


def test_memory_rows_three_schema_styles(spark):
    data = [("Jacket", 99.99), ("Boots", 129.0)]
    assert memory.rows(spark, data).columns == ["_1", "_2"]
    assert memory.rows(spark, data, ["product", "price"]).dtypes == [("product", "string"),
                                                                    ("price", "double")]
    st = T.StructType([T.StructField("product", T.StringType()), T.StructField("price", T.DoubleType())])
    df = memory.register(memory.rows(spark, data, st), "products")
    assert spark.table("products").count() == 2


def test_csv_folder_skips_each_header(spark, scratch):
    folder = f"{scratch}/csv"
    os.makedirs(folder)
    for i in range(2):
        with open(f"{folder}/part{i}.csv", "w") as f:
            f.write("seller_id,product,quantity,product_price,sales_date\n")
            f.write(f"LNK,Toothbrush,{22 + i},3.99,2021-07-01\n")
    schema = "seller_id string, product string, quantity int, product_price double, sales_date date"
    df = SRC.csv_table(spark, folder, schema)
    assert sorted(r["quantity"] for r in df.collect()) == [22, 23]
    assert df.schema["sales_date"].dataType == T.DateType()


def test_json_decode_permissive_and_failfast(spark):
    raw = spark.createDataFrame([('{"id": 1, "name": "a", "score": 3}',), ("not json",)], "value string")
    schema = "id int, name string, score int"
    got = J.decode(raw, schema).collect()
    assert got[0]["score"] == 3 and got[1]["id"] is None
    try:
        J.decode(raw, schema, mode="FAILFAST").collect()
        raise AssertionError("FAILFAST should fail on a bad record")
    except Exception as e:  # noqa: BLE001
        assert "FAILFAST" in str(e) or "MALFORMED" in str(e).upper()


def test_messages_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "id int, name string, score double")
    msgs = J.to_messages(df, key_col="id")
    row = msgs.first()
    assert row["key"] == "1" and json.loads(row["value"]) == {"id": 1, "name": "a", "score": 2.5}
    back = J.decode(msgs, df.schema).first()
    assert (back["id"], back["name"], back["score"]) == (1, "a", 2.5)


def test_schemaless_document_fields(spark):
    doc = '{"user": {"lang": "en", "followers": 12}, "text": "hi"}'
    df = spark.createDataFrame([(doc,), ("{bad",)], "value string")
    got = df.select(F.variant_get(J.parse_document("value"), "$.user.lang", "string").alias("lang"),
                    J.json_field("value", "$.user.followers", "int").alias("f")).collect()
    assert (got[0]["lang"], got[0]["f"]) == ("en", 12) and got[1]["lang"] is None


def test_documents_by_path_by_field_and_their_schema(spark):
    rows = [(1, '{"b": {"x": 1.5}, "a": [1, "two", null]}'), (2, "{bad"), (3, None), (4, "7"), (5, '{"a": [], "c": "t"}'),
            (6, '["p", {"q": 2}]')]
    docs = spark.createDataFrame(rows, "id int, value string").select("id", J.parse_document("value").alias("doc"))
    paths = docs.select("id", J.document_field("doc", "$.a[0]", "int").alias("n"), J.document_field("doc", "$.a[1]", "int").alias("bad"),
                        J.document_field("doc", "$.b.x", "double").alias("x")).orderBy("id").collect()
    assert [tuple(r) for r in paths] == [(1, 1, None, 1.5)] + [(i, None, None, None) for i in range(2, 7)]
    fields = J.explode_document(docs, "doc", ["id"]).orderBy("id", "pos").collect()
    assert [tuple(r) for r in fields if r["pos"] is not None] == [
        (1, 0, "a", '[1,"two",null]'), (1, 1, "b", '{"x":1.5}'), (5, 0, "a", "[]"), (5, 1, "c", '"t"'),
        (6, 0, None, '"p"'), (6, 1, None, '{"q":2}')]
    schema = docs.where("id in (1, 5)").agg(J.document_schema("doc").alias("s")).first()["s"]
    assert schema == "OBJECT<a: ARRAY<VARIANT>, b: OBJECT<x: DECIMAL(2,1)>, c: STRING>"


def test_time_helpers_are_zone_free(spark):
    df = spark.createDataFrame([(1_700_000_000_123,)], "ms long")
    row = df.select(millis_to_ts("ms").alias("t")).select(
        instant_to_ntz("t").alias("n")).select("n", ntz_to_instant("n").alias("i"),
                                               parse_ts(F.lit("06/10/2010 08:00:58"),
                                                        "dd/MM/yyyy HH:mm:ss").alias("p")).first()
    assert str(row["n"]) == "2023-11-14 22:13:20.123000"
    assert row["p"].minute == 0 and row["p"].second == 58


def _read_parts(folder):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{folder}/part-*")))


def test_text_csv_and_bucketed_sinks(spark, scratch):
    lines = spark.createDataFrame([("01-06-2018,June,Category5,Bat,12",)], "value string")
    parsed = parse_lines(lines, SALE_LINE)
    K.write_text(parsed.select("month", "profit"), f"{scratch}/text")
    assert _read_parts(f"{scratch}/text") == "(June,12)\n"
    K.write_csv(parsed.select("month", "profit"), f"{scratch}/csv", sep=" ")
    assert _read_parts(f"{scratch}/csv") == "June 12\n"
    stamped = parsed.withColumn("t", F.to_timestamp(F.lit("2024-02-26 23:10:00")))
    K.write_bucketed(stamped, f"{scratch}/b", fmt="json", time_col="t")
    assert os.path.isdir(f"{scratch}/b/bucket=2024-02-26--23")


def test_kafka_shaped_rows_decode_with_metadata(spark):
    """Rows shaped like the Kafka source (binary value, int partition, long
    offset) decode to typed columns plus bigint partition/offset."""
    from tidepool.sources.kafka import decode_messages

    raw = spark.createDataFrame(
        [(bytearray(b'{"id": 1, "name": "ann", "score": 7}'), 0, 10),
         (bytearray(b'{"id": 2, "name": "bob", "score": 3}'), 1, 4)],
        "value binary, partition int, offset long")
    out = decode_messages(raw, "id int, name string, score int")
    assert out.dtypes == [("partition", "bigint"), ("offset", "bigint"), ("id", "int"),
                          ("name", "string"), ("score", "int")]
    assert sorted((r["name"], r["score"], r["offset"]) for r in out.collect()) == [
        ("ann", 7, 10), ("bob", 3, 4)]
