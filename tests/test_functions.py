import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillstar.functions import age_group, full_years, padded_id, percent, ratio, rounded, row_hash, whole_year_age


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value, expected", [(0.125, 0.13), (-0.125, -0.13), (2.5, 2.5), (0.0, 0.0), (None, None)])
def test_rounding_is_half_up_away_from_zero(spark, value, expected):
    assert one(spark, rounded(F.lit(value).cast("double"))) == expected


def test_division_by_zero_is_null(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, percent(F.lit(1), F.lit(0))) is None
    assert one(spark, percent(F.lit(1), F.lit(3))) == 33.33


def test_age_counts_blocks_of_365_days(spark):
    assert one(spark, whole_year_age(F.lit(dt.date(2000, 1, 1)), F.lit(dt.date(2000, 12, 31)))) == 1
    assert one(spark, whole_year_age(F.lit(dt.date(2000, 1, 2)), F.lit(dt.date(2000, 1, 1)))) == -1


def test_full_years_wait_for_the_anniversary(spark):
    start = F.lit(dt.date(2000, 2, 29))
    assert one(spark, full_years(start, F.lit(dt.date(2001, 2, 28)))) == 0
    assert one(spark, full_years(start, F.lit(dt.date(2001, 3, 1)))) == 1


def test_age_groups_are_right_closed(spark):
    ages = spark.createDataFrame([(0,), (1,), (25,), (26,), (65,), (66,), (100,), (101,), (None,)], "age int")
    got = dict(ages.select("age", age_group("age").alias("g")).collect())
    assert got == {0: "nan", 1: "18-25", 25: "18-25", 26: "26-35", 65: "56-65", 66: "65+", 100: "65+", 101: "nan",
                   None: "nan"}


def test_row_hash_tells_where_a_value_is_missing(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert len({h for (h,) in rows(df.select(row_hash(["x", "y"])))}) == 2


def test_padded_ids_never_lose_digits(spark):
    assert one(spark, padded_id("C", F.lit(7), 3)) == "C007"
    assert one(spark, padded_id("C", F.lit(123456), 3)) == "C123456"
