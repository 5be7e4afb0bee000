"""Java-style splitting, word count and the mobile-number pattern."""

from pyspark.sql import functions as F

from lakeloom.functions.text import java_split, phone_prefix, valid_mobile
from lakeloom.operators.text import word_count, words


def test_java_split_rules(spark):
    # Java String.split(" ") semantics (FIXTURES E).
    cases = {"a b": ["a", "b"], "a  b  ": ["a", "", "b"], " a": ["", "a"], "": [""], "   ": []}
    df = spark.createDataFrame([(k,) for k in cases], "l string")
    got = {r.l: r.w for r in df.select("l", java_split("l").alias("w")).collect()}
    assert got == cases


def test_java_split_other_separator(spark):
    df = spark.createDataFrame([("a,b,,",), (",x",), ("a,,\r",)], "l string")
    got = [r.w for r in df.select(java_split("l", ",").alias("w")).collect()]
    assert got == [["a", "b"], ["", "x"], ["a", "", "\r"]]


def test_word_count_lines_and_words(spark):
    df = spark.createDataFrame([("a b\nb  c ",), ("",), (None,), ("x\r\ny\n",)], "text string")
    got = {r.word: r.cnt for r in word_count(df).collect()}
    assert got == {"a": 1, "b": 2, "": 1, "c": 1, "x": 1, "y": 1}
    assert words(df).count() == 7


def test_mobile_pattern(spark):
    df = spark.createDataFrame([("13012345678",), ("15,12345678",), ("15412345678",),
                                ("1991234567",), ("19812345678",), ("13812345678\n",)], "p string")
    got = [r.ok for r in df.select(valid_mobile("p").alias("ok")).collect()]
    assert got == [True, False, False, False, True, False]  # whole-string match
    assert df.select(phone_prefix("p").alias("x")).first().x == "1301234"
    # substring start 0 behaves as 1
    assert df.select(F.substring("p", 0, 7).alias("x")).first().x == "1301234"
