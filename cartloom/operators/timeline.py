"""Dense per-day series built from sparse daily amounts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.functions.dates import date_literal

# Days of the dense series one task expands and adds up; the steps are few, the days are many.
DAYS_PER_TASK = 4_000_000


def expand_days(
    df: DataFrame, start: Column | str, last: dt.date | str | Column, day: str = "date"
) -> DataFrame:
    """One row per day from ``start`` to ``last`` (both included); rows that start later vanish."""
    start = F.col(start) if isinstance(start, str) else start
    last = date_literal(last)
    return df.where(start <= last).withColumn(day, F.explode(F.sequence(start, last)))


def dense_timeline(
    starts: DataFrame,
    amounts: DataFrame,
    *,
    key: str,
    start: str,
    day: str,
    measures: Mapping[str, str],
    windows: Sequence[int],
    first: dt.date | str,
    last: dt.date | str,
    out_day: str = "date",
    days_per_task: int = DAYS_PER_TASK,
) -> DataFrame:
    """Running and rolling sums for every key and every day from its start to ``last``.

    ``starts`` has one row per key with its start date, ``amounts`` one row per key and day with
    the columns named by ``measures`` (output prefix -> column). The result has the key, the
    start, ``out_day``, ``<prefix>_total`` and ``<prefix>_<n>d`` for each window of n days, in the
    type of the measure (a sum that does not fit raises).

    The dense rows are never joined, shuffled or sorted. An amount raises its n-day sum on its
    own day and lowers it again n days later, so every feature is a running sum over those few
    steps and stays constant between two of them. Steps are shuffled once by key (a key has at
    most ``1 + (1 + number of windows) * days`` of them, however many raw rows it had), summed in
    one window, and each stretch is expanded to its days last, in place. The shuffle gets one
    task for every ``days_per_task`` days the keys will have, so that what a task expands (and
    what is grouped after it by key) stays bounded however many keys there are.
    """
    first_day, last_day = date_literal(first), date_literal(last)
    totals = [f"{prefix}_total" for prefix in measures]
    rolled = {n: [f"{prefix}_{n}d" for prefix in measures] for n in windows}
    features = totals + [name for names in rolled.values() for name in names]
    kinds = [amounts.schema[column].dataType for column in measures.values()] * (1 + len(rolled))

    # Every amount becomes 1 + len(windows) steps; `entered` is the day the amount was made.
    def step(on: Column, changes: dict[str, Column]) -> Column:
        filled = [changes.get(f, F.lit(None)).alias(f) for f in features]
        return F.struct(on.alias("on"), F.col(day).alias("entered"), *filled)

    entering = {}
    for prefix, column in measures.items():
        for name in [f"{prefix}_total", *(f"{prefix}_{n}d" for n in windows)]:
            entering[name] = F.col(column)
    steps = [step(F.col(day), entering)]
    for n, names in rolled.items():
        leaving = {name: -F.col(column) for name, column in zip(names, measures.values(), strict=True)}
        steps.append(step(F.date_add(day, n), leaving))
    changes = (
        amounts.where(F.col(day).between(first_day, last_day))
        .select(key, F.inline(F.array(*steps)))
        .where(F.col("on") <= last_day)
    )
    opening = F.greatest(F.col(start), first_day)
    anchors = starts.where(F.col(start) <= last_day).select(
        key, start, opening.alias("on"), opening.alias("entered")
    )

    # The steps are small, the days they expand to are not: tasks are counted by the days.
    days = anchors.agg(F.sum(F.datediff(last_day, F.col("on")) + 1)).first()[0] or 0
    tasks = max(starts.sparkSession.sparkContext.defaultParallelism, -(-days // days_per_task))

    # The anchor gives the key's start to the steps that follow it; keys without one, and
    # amounts made before it, have no day in the series.
    by_day = Window.partitionBy(key).orderBy("on")
    so_far = by_day.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    known = (
        anchors.unionByName(changes, allowMissingColumns=True)
        .repartition(tasks, key)
        .withColumn(start, F.max(start).over(so_far))
        .where(F.col("entered") >= F.col(start))
    )
    stretches = known.select(
        key,
        start,
        "on",
        F.lead("on").over(by_day).alias("until"),
        *[
            F.coalesce(F.sum(f).over(so_far), F.lit(0)).cast(kind).alias(f)
            for f, kind in zip(features, kinds, strict=True)
        ],
    )
    # Steps of one day share their sums; only the last of them reaches past the day.
    end = F.coalesce(F.date_sub("until", 1), last_day)
    return stretches.where(F.col("on") <= end).select(
        key, start, F.explode(F.sequence("on", end)).alias(out_day), *features
    )
