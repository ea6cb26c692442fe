from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from planlens.functions import casts


def cast_all(spark, cast, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    cleaned = df.select("i", casts.clean_text(F.col("x")).alias("x"))
    return [r.y for r in cleaned.select("i", cast(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_text(spark):
    assert cast_all(spark, lambda c: c, [" a b ", "", "   ", None, "\tx"]) == [
        "a b", None, None, None, "\tx",
    ]


def test_lenient_date(spark):
    day = date(2025, 4, 1)
    expected = {
        "2025-04-01": day, " 2025-04-01 ": day, "2025-4-1": day, "2025/04/01": day,
        "2025-04-01 10:00:00": day, "2025-04-01T10:00:00": day,
        "2025": None, "2025-4": None, "2025-02-30": None, "20250401": None, "abc": None,
        "": None, "2025-04-01 junk": None, "2025-04-01Tjunk": None, "12025-04-01": None,
        "2025-04/01": None, "2025-xx-01": None, "2025-004-01": None,
    }
    assert cast_all(spark, casts.lenient_date, list(expected)) == list(expected.values())


def test_lenient_int(spark):
    expected = {
        "31": 31, "31.0": 31, "31.5": 32, "-2.5": -3, "1e2": 100, "+31": 31, ".5": 1,
        "0.49999999999": 0, "2147483647": 2147483647, "2147483648": None, "1e400": None,
        "abc": None, "": None, "1,000": None, "31d": None,
    }
    assert cast_all(spark, casts.lenient_int, list(expected)) == list(expected.values())


def test_lenient_money(spark):
    expected = {
        "12.345": Decimal("12.35"), "-12.345": Decimal("-12.35"), "1e2": Decimal("100.00"),
        "12.344": Decimal("12.34"), "$5": None, "": None, "99999999999999999": None,
    }
    assert cast_all(spark, casts.lenient_money, list(expected)) == list(expected.values())


@pytest.mark.parametrize("cast,text", [
    (casts.strict_date, "oops"), (casts.strict_date, "2025"), (casts.strict_date, "2025-02-30"),
    (casts.strict_int, "oops"), (casts.strict_int, "2147483648"), (casts.strict_money, "$5"),
])
def test_strict_casts_fail_the_job(spark, cast, text):
    with pytest.raises(PySparkException):
        cast_all(spark, cast, [text])


def test_strict_casts_read_good_text(spark):
    assert cast_all(spark, casts.strict_date, ["2025-04-01", None]) == [date(2025, 4, 1), None]
    assert cast_all(spark, casts.strict_int, ["31.7", ""]) == [32, None]
    assert cast_all(spark, casts.strict_money, ["1.005", None]) == [Decimal("1.01"), None]


def test_ratio_is_null_on_an_empty_base_and_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 32), (1, 3), (5, 0), (5, None), (-1, 32)], "n int, d int")
    values = [r[0] for r in df.select(casts.ratio(F.col("n"), F.col("d"))).collect()]
    assert values == [Decimal("0.0313"), Decimal("0.3333"), None, None, Decimal("-0.0313")]
