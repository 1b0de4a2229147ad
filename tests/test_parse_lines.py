"""The ``ms,amount`` line and keying a raw line by one of its fields."""

from tidepool.functions.parse import AMOUNT_LINE, key_by_field, parse_lines


def test_amount_line(spark):
    lines = spark.createDataFrame([("1528997543000,25",), ("1528997544000,-3",)], "value string")
    assert sorted(tuple(r) for r in parse_lines(lines, AMOUNT_LINE).collect()) == [(1528997543000, 25), (1528997544000, -3)]


def test_key_by_third_field(spark):
    lines = spark.createDataFrame([("a,b,c,d",), ("1,2,3",)], "value string")
    assert sorted(r["k"] for r in key_by_field(lines, 2, "k").collect()) == ["3", "c"]
