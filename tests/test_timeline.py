import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartloom.operators import dense_timeline, expand_days, rolling_sum, running_sum

DAY = dt.timedelta(1)


def brute_force(starts, amounts, windows, first, last):
    spent = defaultdict(int)
    for key, day, amount in amounts:
        spent[key, day] += amount
    rows = []
    for key, start in starts:
        day = opening = max(start, first)
        while day <= last:
            def total(back, key=key, day=day, opening=opening):
                since = opening if back is None else max(opening, day - (back - 1) * DAY)
                return sum(spent[key, since + n * DAY] for n in range((day - since).days + 1))

            rows.append((key, start, day, total(None), *[total(n) for n in windows]))
            day += DAY
    return sorted(rows)


def run(spark, starts, amounts, windows, first, last):
    df = dense_timeline(
        spark.createDataFrame(starts, "k string, start date"),
        spark.createDataFrame(amounts, "k string, day date, amount bigint"),
        key="k",
        start="start",
        day="day",
        measures={"spent": "amount"},
        windows=windows,
        first=first,
        last=last,
    )
    assert df.columns == ["k", "start", "date", "spent_total", *[f"spent_{n}d" for n in windows]]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    first, last = dt.date(2016, 2, 10), dt.date(2016, 4, 20)

    def any_day():
        return first + rng.randint(-20, 90) * DAY

    starts = [(f"k{n}", any_day()) for n in range(12)]
    # Some before their key's start, outside the range, of unknown keys, several on one day.
    amounts = [(f"k{rng.randint(0, 13)}", any_day(), rng.randint(-5, 50)) for _ in range(150)]
    amounts += [("k0", first + rng.randint(0, 6) * DAY, 1) for _ in range(100)]
    windows = (7, 14) if seed % 2 else (1, 3, 30)
    assert run(spark, starts, amounts, windows, first, last) == brute_force(starts, amounts, windows, first, last)


def test_days_are_spread_over_tasks(spark):
    # Few steps that expand to many days: a task holds about its share of the days, not all.
    first, last = dt.date(2020, 1, 1), dt.date(2020, 12, 31)
    starts = [(f"k{n}", first + (n % 30) * DAY) for n in range(200)]
    amounts = [(f"k{n}", first + (n % 30 + 3) * DAY, n) for n in range(200)]
    df = dense_timeline(
        spark.createDataFrame(starts, "k string, start date"),
        spark.createDataFrame(amounts, "k string, day date, amount bigint"),
        key="k", start="start", day="day", measures={"spent": "amount"}, windows=(7,),
        first=first, last=last, days_per_task=2_000,
    )
    per_task = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    days = sum(r["count"] for r in per_task)
    assert days == sum((last - start).days + 1 for _, start in starts)
    assert len(per_task) >= days // 2_000
    assert max(r["count"] for r in per_task) <= 4 * 2_000
    got = sorted(tuple(r) for r in df.collect())
    assert got == brute_force(starts, amounts, (7,), first, last)


def test_key_without_amounts_has_zeros(spark):
    day = dt.date(2020, 2, 28)
    rows = run(spark, [("a", day)], [], (7,), day, day + DAY)
    assert rows == [("a", day, day, 0, 0), ("a", day, day + DAY, 0, 0)]


def test_start_after_the_end_has_no_days(spark):
    day = dt.date(2020, 2, 28)
    assert run(spark, [("a", day + DAY)], [("a", day + DAY, 1)], (7,), day, day) == []


def test_expand_days_never_counts_down(spark):
    day = dt.date(2020, 2, 28)
    df = spark.createDataFrame([("a", day), ("b", day + 2 * DAY), ("c", None)], "k string, start date")
    found = [(r["k"], r["date"]) for r in expand_days(df, "start", "2020-02-29").collect()]
    assert found == [("a", day), ("a", day + DAY)]


def test_row_windows(spark):
    rows = [("a", n, 1 if n != 4 else None) for n in range(1, 11)] + [("b", 1, 5)]
    df = spark.createDataFrame(rows, "k string, n int, v int").select(
        "k", "n", running_sum("v", "k", "n").alias("total"), rolling_sum("v", "k", "n", 3).alias("last3")
    )
    found = {(r["k"], r["n"]): (r["total"], r["last3"]) for r in df.collect()}
    assert [found["a", n] for n in (1, 3, 4, 6, 7, 10)] == [(1, 1), (3, 3), (3, 2), (5, 2), (6, 3), (9, 3)]
    assert found["b", 1] == (5, 5)
