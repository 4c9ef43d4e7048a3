"""Declarative data tests. A test passes when it finds no failing rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, FractionalType, IntegralType, StructType

from cartloom.operators.joins import orphan_keys

REPORT_COLUMNS = ("model", "column", "test", "severity", "failures", "status")


@dataclass(frozen=True)
class Check:
    """One test on one column.

    ``kind`` is ``unique``, ``not_null``, ``accepted_values`` (with ``values``) or
    ``relationships`` (with the parent model ``to`` and its ``field``).
    """

    column: str
    kind: str
    severity: str = "error"
    values: Sequence[object] = ()
    to: str | None = None
    field: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in ("unique", "not_null", "accepted_values", "relationships"):
            raise ValueError(f"unknown test kind {self.kind!r}")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}")


class DataTestError(AssertionError):
    """At least one test of severity ``error`` found failing rows."""


def failing_rows(check: Check, model: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """What a test complains about; its row count is the number of failures.

    unique: repeated values; not_null: the rows; accepted_values: unexpected values (both with
    ``n_rows``); relationships: missing keys with ``n_rows``, the sum of which is the count.
    """
    df, column = tables[model], F.col(check.column)
    if check.kind == "not_null":
        return df.where(column.isNull())
    if check.kind == "relationships":
        return orphan_keys(df, check.column, tables[check.to], check.field)
    if check.kind == "unique":
        suspects, bad = df.where(column.isNotNull()), F.col("n_rows") > 1
    else:
        suspects, bad = df.where(_unexpected(check)), F.lit(True)
    return suspects.groupBy(check.column).agg(F.count("*").alias("n_rows")).where(bad)


def quality_report(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Sequence[Check]],
    known: Mapping[tuple[str, Check], int] | None = None,
) -> DataFrame:
    """One row per test: (model, column, test, severity, failures, status).

    Every table is read once, however many tests are on it and however many others refer to it. A row gives one entry (test,
    value) for each test that needs its value: a key of a unique test, a reference or, of the parent, what it may refer to, an
    unexpected value, a missing one. All entries meet in a single grouping, combined before its shuffle, so a hot
    value is one entry a task; what a test counts is read off the groups. Tests in ``known`` have been counted before, as at
    the write, and are not counted again.
    """
    known = known or {}
    tests = [(model, check) for model, model_checks in checks.items() for check in model_checks]
    entries: dict[str, list[Column]] = {}
    for number, (model, check) in enumerate(tests):
        if (model, check) in known:
            continue
        column = F.col(check.column)
        if check.kind == "not_null":
            entries.setdefault(model, []).append(_entry(column.isNull(), number, None))
        elif check.kind == "unique":
            entries.setdefault(model, []).append(_entry(column.isNotNull(), number, column))
        elif check.kind == "accepted_values":
            entries.setdefault(model, []).append(_entry(_unexpected(check), number, column))
        else:
            child, parent = tables[model].select(check.column), tables[check.to].select(check.field)
            kind = child.union(parent).schema[0].dataType  # in which both sides compare
            entries.setdefault(model, []).append(_entry(column.isNotNull(), number, column.cast(kind), kind))
            field = F.col(check.field)
            entries.setdefault(check.to, []).append(_entry(field.isNotNull(), number, field.cast(kind), kind, parent=True))
    typed = {model: [e(tables[model]) for e in made] for model, made in entries.items()}
    parts = [tables[model].select(F.inline(F.array(*made))).where("number IS NOT NULL") for model, made in typed.items()]
    session = next(iter(tables.values())).sparkSession
    rows = [(i, model, c.column, c.kind, c.severity, known.get((model, c))) for i, (model, c) in enumerate(tests)]
    report = session.createDataFrame(rows, "number int, model string, column string, test string, severity string, known bigint")
    found = F.lit(None).cast("bigint")
    if parts:
        groups = reduce(DataFrame.union, parts).groupBy("number", "whole", "text").agg(
            F.sum("rows").alias("rows"), F.max("is_parent").alias("has_parent")
        )
        unique, reference, accepted = (
            F.col("number").isin([i for i, (_, c) in enumerate(tests) if c.kind == kind])
            for kind in ("unique", "relationships", "accepted_values")
        )
        failures = (
            F.when(unique, (F.col("rows") > 1).cast("bigint"))
            .when(reference, F.when(F.col("has_parent"), 0).otherwise(F.col("rows")))
            .when(accepted, 1)
            .otherwise(F.col("rows"))
        )
        # One row a test.
        report = report.join(F.broadcast(groups.groupBy("number").agg(F.sum(failures).alias("found"))), "number", "left")
        found = F.col("found")
    counted = report.withColumn("failures", F.coalesce("known", found, F.lit(0)).cast("bigint"))
    status = (
        F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    )
    return counted.withColumn("status", status).select(*REPORT_COLUMNS)


def _entry(
    condition: Column, number: int, value: Column | None, kind: DataType | None = None, parent: bool = False
) -> Callable[[DataFrame], Column]:
    """What a row adds to a test where ``condition`` holds: whole numbers as such, other values as text that tells them apart."""

    def made(df: DataFrame) -> Column:
        whole, text = F.lit(None), F.lit(None)
        if value is not None:
            type_ = kind or df.select(value).schema[0].dataType
            if isinstance(type_, IntegralType):
                whole = value
            elif isinstance(type_, (ArrayType, StructType)):
                text = F.to_json(value)
            elif isinstance(type_, FractionalType) and not isinstance(type_, DecimalType):
                text = (value + F.lit(0.0)).cast("string")  # one zero
            else:
                text = value
        struct = F.struct(
            F.lit(number).alias("number"), whole.cast("bigint").alias("whole"), text.cast("string").alias("text"),
            F.lit(0 if parent else 1).cast("bigint").alias("rows"), F.lit(parent).alias("is_parent"),
        )
        return F.when(condition, struct)

    return made


def measures(checks: Sequence[Check]) -> dict[str, Column]:
    """Counts that tell of some tests while a table is written: missing values, and rows with unexpected values."""
    found = {f"not_null.{c.column}": F.count_if(F.col(c.column).isNull()) for c in checks if c.kind == "not_null"}
    for i, check in enumerate(checks):
        if check.kind == "accepted_values":
            found[f"accepted_values.{i}.{check.column}"] = F.count_if(_unexpected(check))
    return found


def known_failures(model: str, checks: Sequence[Check], measured: Mapping[str, int]) -> dict[tuple[str, Check], int]:
    """Failures by what was measured. The number of different unexpected values is only known if there is none."""
    found = {}
    for i, check in enumerate(checks):
        if check.kind == "not_null" and (key := f"not_null.{check.column}") in measured:
            found[model, check] = int(measured[key])
        elif check.kind == "accepted_values" and int(measured.get(f"accepted_values.{i}.{check.column}", 1)) == 0:
            found[model, check] = 0
    return found


def enforce(report: DataFrame) -> None:
    """Raise if a test of severity ``error`` failed. The report has one row per declared test."""
    failed = report.where(F.col("status") == "fail").collect()
    if failed:
        lines = [f"{r['test']}({r['model']}.{r['column']}): {r['failures']} failures" for r in failed]
        raise DataTestError("; ".join(lines))


def _unexpected(check: Check) -> Column:
    column = F.col(check.column)
    return column.isNotNull() & ~column.isin(list(check.values))
