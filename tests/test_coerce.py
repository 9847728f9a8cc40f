import math
import random

from pyspark.sql import functions as F

from borelake.functions.coerce import clean_long, clean_text, double_of, long_of, parse_number, text_of, with_stripped
from pyspark.sql import types as T

HARD = [
    None, "", " ", "None", " null ", "NaN", "nan", "-nan", "NAN", "n/a", "1", " 12.5 ", "\t7\n", "1_000", "1__0",
    "_1", "1_", "1d", "1.5f", "1D", "12F", ".5", "5.", ".", "-", "+", "+3", "--3", "1e3", "1E-3", "1e", "e5",
    "1e+_5", "1_0.2_5e1_0", "inf", "-Infinity", "+INF", "infinite", "0x10", "0x1p3", "1 2", "1,000", "1e400",
    " 3.25 ", "　8　", "deep", "12abc", "1.2.3", "００", "٣.١", "𝟗", "\x1c9\x1f", "-0", "1_.5", "1._5",
]


def python_number(value):
    if value is None or value.strip().lower() in ("", "none", "null", "nan"):
        return None
    try:
        number = float(value.strip())
    except ValueError:
        return None
    return None if math.isnan(number) else number


def python_text(value):
    if value is None:
        return None
    text = value.strip()
    return None if text.lower() in ("", "none", "null", "nan") else text


def values():
    rng = random.Random(7)
    made = ["".join(rng.choice("0123456789._eE+- \tdfinax") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    return HARD + made


def test_numbers_and_text_read_as_python_reads_them(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values())], "i int, v string")
    two = with_stripped(df, ["v"])
    got = two.select(
        "i", "v", parse_number(F.col("v")).alias("n"), clean_text(F.col("v")).alias("t"),
        double_of(two, "v").alias("n2"), text_of(two, "v").alias("t2"),
    ).collect()
    for row in got:
        assert row["n"] == row["n2"] == python_number(row["v"]), repr(row["v"])
        assert row["t"] == row["t2"] == python_text(row["v"]), repr(row["v"])


def test_nan_number_is_missing_and_never_reaches_a_key(spark):
    df = spark.createDataFrame([(float("nan"),), (7.9,), (-7.9,), (1e300,), (float("inf"),)], "x double")
    got = df.select(double_of(df, "x").alias("d"), long_of(df, "x").alias("k")).collect()
    assert [r["d"] for r in got] == [None, 7.9, -7.9, 1e300, math.inf]
    assert [r["k"] for r in got] == [None, 7, -7, None, None]


def test_absent_column_is_a_typed_null(spark):
    df = spark.range(1)
    out = df.select(text_of(df, "a").alias("a"), double_of(df, "b").alias("b"), long_of(df, "c").alias("c"))
    assert out.dtypes == [("a", "string"), ("b", "double"), ("c", "bigint")]


def test_long_from_text(spark):
    df = spark.createDataFrame([("12.9",), ("null",), ("9007199254740993",)], "v string")
    got = df.select(clean_long(F.col("v"), T.StringType()).alias("k")).collect()
    assert [r["k"] for r in got] == [12, None, 9007199254740992]
