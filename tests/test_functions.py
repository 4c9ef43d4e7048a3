import datetime as dt
import hashlib
import itertools
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartloom.functions import (
    better_tier,
    classify_tier,
    date_spine,
    days_between,
    exact_avg,
    from_cents,
    or_zero,
    surrogate_key,
    to_cents,
    to_int,
    to_money,
    to_timestamp,
    version_key,
)
from cartloom.functions.keys import NULL_PART
from cartloom.functions.tiers import LOWEST_TIER, TIERS


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}").select(expression.alias("r")).collect()
    return [row["r"] for row in rows]


def test_volume_tiers(spark):
    values = [None, 0, 19, 20, 99, 100, 499, 500, 10**9]
    expected = ["bronze"] * 3 + ["silver"] * 2 + ["gold"] * 2 + ["platinum"] * 2
    assert column(spark, values, "bigint", classify_tier("v")) == expected
    assert column(spark, values, "bigint", classify_tier("v", "no such type")) == expected


def test_revenue_tiers(spark):
    values = [Decimal(v) for v in ("999.99", "1000", "4999.99", "5000", "9999.99", "10000")] + [None]
    expected = ["bronze", "silver", "silver", "gold", "gold", "platinum", "bronze"]
    assert column(spark, values, "decimal(20,2)", classify_tier("v", "revenue")) == expected


def test_own_thresholds(spark):
    assert column(spark, [1, 2, 3, 4], "int", classify_tier("v", thresholds=(4, 3, 2))) == [
        "bronze", "silver", "gold", "platinum",
    ]
    with pytest.raises(ValueError):
        classify_tier("v", thresholds=(4, 3))


def test_better_tier(spark):
    ranked = [*TIERS, LOWEST_TIER]
    pairs = list(itertools.product(ranked, ranked))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", better_tier("a", "b").alias("r"))
    for a, b, r in rows.collect():
        assert r == min(a, b, key=ranked.index)


def test_surrogate_key(spark):
    rows = [(1, dt.date(2018, 1, 2), "x"), (None, None, "")]
    df = spark.createDataFrame(rows, "a bigint, b date, c string")
    keys = [r[0] for r in df.select(surrogate_key("a", F.col("b"), "c")).collect()]
    texts = ["1-2018-01-02-x", f"{NULL_PART}-{NULL_PART}-"]
    assert keys == [hashlib.md5(text.encode()).hexdigest() for text in texts]


def test_version_key(spark):
    df = spark.createDataFrame([("s", dt.date(2018, 1, 2))], "k string, at date")
    expected = hashlib.md5(b"s|2018-01-02").hexdigest()
    assert df.select(version_key("k", "at")).first()[0] == expected


def test_days_between(spark):
    df = spark.createDataFrame([(dt.date(2018, 3, 1), dt.date(2018, 2, 27))], "a date, b date")
    row = df.select(days_between("a", "b").alias("d"), days_between("b", "a").alias("e")).first()
    assert (row["d"], row["e"]) == (2, -2)


def test_date_spine_excludes_its_end(spark):
    days = [r[0] for r in date_spine(spark, "2016-02-27", dt.date(2016, 3, 2)).collect()]
    assert days == [dt.date(2016, 2, 27) + dt.timedelta(n) for n in range(4)]
    assert date_spine(spark, "2016-01-01", "2016-01-01").count() == 0
    assert date_spine(spark, "2016-01-02", "2016-01-01").count() == 0


def test_casts(spark):
    assert column(spark, ["2017-10-02 10:56:33", "2017-10-02", None], "string", to_timestamp("v")) == [
        dt.datetime(2017, 10, 2, 10, 56, 33), dt.datetime(2017, 10, 2), None,
    ]
    assert column(spark, ["12.0", "3", None], "string", to_int("v")) == [12, 3, None]
    assert column(spark, [2.5, 3.5, -0.4], "double", to_int("v")) == [2, 4, 0]
    money = column(spark, [0.004, 0.005, 1.005, 58.9, None], "double", to_money("v"))
    assert money == [Decimal(v) for v in ("0.00", "0.01", "1.01", "58.90")] + [None]


@pytest.mark.parametrize(
    ("value", "cast"), [("yesterday", to_timestamp), ("a dozen", to_int), ("123456789", to_money), ("", to_money)]
)
def test_bad_input_raises(spark, value, cast):
    with pytest.raises(PySparkException):
        column(spark, [value], "string", cast("v"))


def test_or_zero(spark):
    assert column(spark, [None, 3], "int", or_zero("v")) == [0, 3]


def test_exact_avg(spark):
    values = [Decimal("10.00"), Decimal("10.01"), Decimal("0.01"), None]
    (mean,) = column(spark, values, "decimal(10,2)", exact_avg(F.sum("v"), F.count("v")))
    assert mean == (Decimal("20.02") / 3).quantize(Decimal(10) ** -16, ROUND_HALF_UP)
    (none,) = column(spark, [], "decimal(10,2)", exact_avg(F.sum("v"), F.nullif(F.count("v"), F.lit(0))))
    assert none is None


def test_cents(spark):
    values = [Decimal("0.00"), Decimal("-1.15"), Decimal("99999999.99"), None]
    assert column(spark, values, "decimal(10,2)", to_cents("v")) == [0, -115, 9999999999, None]
    assert column(spark, [1.15, 0.29, 4.35], "double", to_cents("v")) == [115, 29, 435]
    assert column(spark, [10**18 + 1, -5, None], "bigint", from_cents("v")) == [
        Decimal("10000000000000000.01"), Decimal("-0.05"), None,
    ]
