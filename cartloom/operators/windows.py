"""Running and rolling sums over the ordered rows of one key, also of keys that are too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.session import stored

# Rows of one key that a task sorts without trouble.
ROWS_PER_TASK = 4_000_000


def running_sum(value: Column | str, key: str, order: str) -> Column:
    """Sum from the first row of the key to the current one; a NULL value counts as 0."""
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(_value(value)).over(frame)


def rolling_sum(value: Column | str, key: str, order: str, rows: int) -> Column:
    """Sum over the last ``rows`` rows of the key, the current one included."""
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(1 - rows, Window.currentRow)
    return F.sum(_value(value)).over(frame)


def _value(value: Column | str) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0))


def over_key(
    df: DataFrame,
    key: str,
    order: str | Sequence[str],
    running: Mapping[str, Column | str] | None = None,
    rolling: Mapping[str, tuple[Column | str, int]] | None = None,
    following: Mapping[str, Column | str] | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """``df`` with columns over the ordered rows of each key, whatever share of the rows a key holds.

    ``running``: sums up to the row; ``rolling``: sums over so many last rows, the row included; ``following``: the value of
    the next row. In the sums NULL counts as 0. Rows of a key that agree in ``order`` are told apart by a hash of all columns.

    Keys up to ``rows_per_task`` rows, found by a count, take a plain window. The rows of larger ones are laid out in ranges
    of (key, order) of about that many rows and stored. Each range sums up its own rows, and what lies before it, one row a
    range, is joined to it: that gives running sums and the place of each row in its key. Frames of rows are then looked
    at in stretches of exactly ``rows_per_task`` places, which also see the few rows before and after them that the frames reach.
    No task holds more than a range or a stretch; the tables of large keys and of ranges, which are broadcast, have at most one
    row for each ``rows_per_task`` rows of ``df``, twice for ranges. ``rows_per_task=None`` says that no key is large and saves the count.
    """
    order = [order] if isinstance(order, str) else list(order)
    running, rolling, following = dict(running or {}), dict(rolling or {}), dict(following or {})
    tie = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])
    by_key = Window.partitionBy(key).orderBy(*order, tie)
    up_to = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = {n: F.sum(_value(v)).over(up_to) for n, v in running.items()}
    plain |= {n: F.sum(_value(v)).over(by_key.rowsBetween(1 - rows, Window.currentRow)) for n, (v, rows) in rolling.items()}
    plain |= {n: F.lead(v).over(by_key) for n, v in following.items()}
    all_plain = df.select("*", *[c.alias(n) for n, c in plain.items()])
    if rows_per_task is None:
        return all_plain
    large = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_task)
    large = stored(large)
    total = large.agg(F.sum("_n")).first()[0]
    if total is None:
        return all_plain
    hot = F.broadcast(large.select("_key"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    ranks = place_in_key(df.join(hot, same, "left_semi"), key, order, running, total, rows_per_task)
    if rolling or following:
        ranks = _framed(ranks, key, rolling, following, rows_per_task)
    rest = df.join(hot, same, "left_anti").select("*", *[c.alias(n) for n, c in plain.items()])
    kinds = {f.name: f.dataType for f in all_plain.schema.fields}
    return rest.union(ranks.select(*[F.col(quoted(c)).cast(kinds[c]).alias(c) for c in all_plain.columns]))


def place_in_key(
    df: DataFrame, key: str, order: Sequence[str], running: Mapping[str, Column | str], total: int, rows_per_task: int
) -> DataFrame:
    """``df`` of ``total`` rows with ``running`` sums, ``_range`` and ``_place``, the number of the row in its key from 0."""
    tie = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])
    named = df.select("*", tie.alias("_tie"), *[_value(v).alias(f"_{n}") for n, v in running.items()])
    spread = named.repartitionByRange(max(2, -(-total // rows_per_task)), key, *order, "_tie")
    rows = stored(spread.withColumn("_range", F.spark_partition_id()))
    sums = {n: F.sum(f"_{n}").alias(f"_{n}") for n in running}
    ranges = rows.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_of")).agg(F.count("*").alias("_n"), *sums.values())
    before = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    earlier = ranges.select("_key", "_of", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before{c}") for c in ("_n", *(f"_{n}" for n in running))])
    local = Window.partitionBy("_range", key).orderBy(*order, "_tie")
    within = rows.select(
        "*", (F.row_number().over(local) - 1).alias("_at"),
        *[F.sum(f"_{n}").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"_within_{n}") for n in running],
    )
    joined = within.join(F.broadcast(earlier), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of")))
    return joined.select(
        *[F.col(quoted(c)) for c in df.columns], "_range", (F.col("_before_n") + F.col("_at")).alias("_place"),
        *[(F.col(f"_before_{n}") + F.col(f"_within_{n}")).alias(n) for n in running],
    )


def _framed(
    ranks: DataFrame,
    key: str,
    rolling: Mapping[str, tuple[Column | str, int]],
    following: Mapping[str, Column | str],
    rows_per_task: int,
) -> DataFrame:
    reach = max([rows - 1 for _, rows in rolling.values()], default=0)
    size = max(rows_per_task, reach, 1)
    own, place = F.floor(F.col("_place") / size), F.col("_place") % size
    seen = [own, F.when(place >= size - reach, own + 1) if reach else None]
    seen.append(F.when((place == 0) & (own > 0), own - 1) if following else None)
    shown = F.array_compact(F.array(*[c for c in seen if c is not None]))
    rows = ranks.select("*", own.alias("_own"), F.explode(shown).alias("_stretch"))
    ordered = Window.partitionBy(key, "_stretch").orderBy("_place")
    columns = {n: F.sum(_value(v)).over(ordered.rowsBetween(1 - r, Window.currentRow)) for n, (v, r) in rolling.items()}
    columns |= {n: F.lead(v).over(ordered) for n, v in following.items()}
    return rows.select("*", *[c.alias(n) for n, c in columns.items()]).where("_own = _stretch")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
