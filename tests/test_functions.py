import pytest
from pyspark.sql import functions as F

from tessera.functions.strings import column_correction, java_split_space, scala_list_string


@pytest.mark.parametrize("text,expected", [
    ("a  b", ["a", "", "b"]),
    (" a b", ["", "a", "b"]),
    ("a b  ", ["a", "b"]),
    ("", [""]),
    ("   ", []),
    ("a", ["a"]),
    ("a\tb c", ["a\tb", "c"]),
])
def test_java_split_space(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(java_split_space(F.col("s")).alias("w")).first().w == expected


@pytest.mark.parametrize("line,expected", [
    ("1,a_b,3", "1,a b,3"),
    ("1,a_b,,", "1,a b"),
    (",a_b,c", "a b,c"),
    (",,c_d", "c_d"),
    ("x,_,", "x, "),
    ("1,a_b_c,d_e", "1,a b c,d_e"),
])
def test_column_correction(spark, line, expected):
    df = spark.createDataFrame([(line,)], "s string")
    assert df.select(column_correction(F.col("s")).alias("v")).first().v == expected


@pytest.mark.parametrize("line", ["a", "", "a,", ","])
def test_column_correction_rejects_short_lines(spark, line):
    df = spark.createDataFrame([(line,)], "s string")
    with pytest.raises(Exception):
        df.select(column_correction(F.col("s"))).collect()


def test_scala_list_string(spark):
    df = spark.createDataFrame([(["a", "b"], [])], "x array<string>, y array<string>")
    r = df.select(scala_list_string(F.col("x")).alias("a"), scala_list_string(F.col("y")).alias("b")).first()
    assert (r.a, r.b) == ("List(a, b)", "List()")


@pytest.mark.parametrize("text,expected", [
    ("a\nb", ["a", "b"]),
    ("a\n", ["a"]),
    ("a\n\n", ["a", ""]),
    ("a\r\nb\rc", ["a", "b", "c"]),
    ("", []),
    ("\n", [""]),
])
def test_text_lines_like_a_text_scan(spark, text, expected):
    from tessera.functions.strings import text_lines
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(text_lines(F.col("s")).alias("l")).first().l == expected
