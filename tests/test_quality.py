import pytest
from pyspark.sql import functions as F

from cartloom.operators import Check, enforce, failing_rows, quality_report
from cartloom.operators.quality import DataTestError, known_failures, measures
from cartloom.plans import stg_customers, stg_order_payments, stg_orders
from cartloom.plans.project import MODELS
from tests import shop

ROWS = [(1, "a", 10), (1, "a", 10), (2, "b", None), (3, "z", 11), (3, "y", 12), (None, None, 12), (None, "z", 12)]


@pytest.fixture
def tables(spark):
    return {
        "child": spark.createDataFrame(ROWS, "id int, kind string, parent int"),
        "parent": spark.createDataFrame([(10,), (10,), (None,)], "id int"),
    }


CHECKS = [
    Check("id", "unique"),
    Check("id", "not_null"),
    Check("kind", "not_null", severity="warn"),
    Check("kind", "accepted_values", values=("a", "b"), severity="warn"),
    Check("parent", "relationships", to="parent", field="id"),
    Check("kind", "accepted_values", values=("a", "b", "y", "z")),
]


def test_failing_rows(tables):
    def found(check):
        return sorted(tuple(r) for r in failing_rows(check, "child", tables).collect())

    assert found(CHECKS[0]) == [(1, 2), (3, 2)]
    assert len(found(CHECKS[2])) == 1
    assert found(CHECKS[3]) == [("y", 1), ("z", 2)]
    assert found(CHECKS[4]) == [(11, 1), (12, 3)]
    assert failing_rows(CHECKS[1], "child", tables).count() == 2


def test_report(tables):
    report = quality_report(tables, {"child": CHECKS, "parent": [Check("id", "unique", severity="warn")]})
    rows = {(r["model"], r["column"], r["test"], r["severity"]): (r["failures"], r["status"]) for r in report.collect()}
    assert rows == {
        ("child", "id", "unique", "error"): (2, "fail"),
        ("child", "id", "not_null", "error"): (2, "fail"),
        ("child", "kind", "not_null", "warn"): (1, "warn"),
        ("child", "kind", "accepted_values", "warn"): (2, "warn"),
        ("child", "kind", "accepted_values", "error"): (0, "pass"),
        ("child", "parent", "relationships", "error"): (4, "fail"),
        ("parent", "id", "unique", "warn"): (1, "warn"),
    }
    assert dict(report.dtypes)["failures"] == "bigint"


def test_empty_tables_pass(spark, tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    report = quality_report(empty, {"child": CHECKS})
    assert {(r["failures"], r["status"]) for r in report.collect()} == {(0, "pass")}
    assert report.count() == len(CHECKS)


def test_enforce(tables):
    enforce(quality_report(tables, {"child": [CHECKS[2], CHECKS[3]]}))
    with pytest.raises(DataTestError, match=r"unique\(child.id\): 2 failures"):
        enforce(quality_report(tables, {"child": CHECKS}))


@pytest.mark.parametrize("bad", [{"kind": "positive"}, {"kind": "unique", "severity": "info"}])
def test_bad_declarations(bad):
    with pytest.raises(ValueError):
        Check("id", **bad)


def test_declared_tests(spark):
    checks = {name: model.checks for name, model in MODELS.items() if model.checks}
    kinds = [c.kind for cs in checks.values() for c in cs]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 2, "not_null": 10, "accepted_values": 2, "relationships": 2,
    }
    assert sum(c.severity == "warn" for cs in checks.values() for c in cs) == 3
    tables = {
        "stg_orders": stg_orders(shop.raw(spark, "orders")),
        "stg_customers": stg_customers(shop.raw(spark, "customers")),
        "stg_order_payments": stg_order_payments(shop.raw(spark, "order_payments")),
    }
    rows = {
        (r["model"], r["column"], r["test"]): (r["failures"], r["status"])
        for r in quality_report(tables, checks).collect()
        if r["failures"]
    }
    assert rows == {
        ("stg_orders", "customer_id", "not_null"): (1, "fail"),
        ("stg_orders", "customer_id", "relationships"): (1, "fail"),
        ("stg_customers", "customer_city", "not_null"): (1, "fail"),
        ("stg_customers", "customer_state", "accepted_values"): (1, "warn"),
        ("stg_order_payments", "order_id", "relationships"): (1, "warn"),
    }


def by_failing_rows(tables, checks):
    """Failures of each test from the rows that it complains about, test by test."""
    found = []
    for model, model_checks in checks.items():
        for check in model_checks:
            rows = failing_rows(check, model, tables)
            n = sum(r["n_rows"] for r in rows.collect()) if check.kind == "relationships" else rows.count()
            found.append((model, check.column, check.kind, n))
    return sorted(found)


def reported(report):
    return sorted((r["model"], r["column"], r["test"], r["failures"]) for r in report.collect())


def test_report_on_all_types(spark):
    rows = spark.range(60).selectExpr(
        "id", "CAST(id % 7 AS TINYINT) AS small", "CAST(id % 5 AS STRING) AS word", "CAST(id % 9 AS DECIMAL(9,3)) AS money",
        "IF(id % 2 = 0, 0.0D, -0.0D) AS zero", "IF(id < 2, CAST('NaN' AS FLOAT), CAST(id AS FLOAT)) AS real",
        "CAST(id % 4 AS STRING) = '1' AS flag", "date_add(date'2020-01-01', CAST(id AS INT) % 8) AS day",
        "CAST(date_add(date'2020-01-01', CAST(id AS INT)) AS TIMESTAMP_NTZ) AS at", "unhex(lpad(hex(id + 200), 4, '0')) AS bytes",
        "array(CAST(id % 3 AS STRING), 'x, y') AS list", "named_struct('a', id % 6) AS pair", "IF(id % 6 = 0, NULL, id) AS gaps",
    )
    tables = {"rows": rows, "other": rows.where("id % 10 < 5").select(F.col("small").cast("bigint").alias("b"), "word", "money", "day", F.col("id").cast("double").alias("d"))}
    checks = [Check(c, "unique") for c in rows.columns] + [Check(c, "not_null") for c in rows.columns]
    checks += [
        Check("small", "relationships", to="other", field="b"), Check("id", "relationships", to="other", field="d"),
        Check("money", "relationships", to="other", field="money"), Check("day", "relationships", to="other", field="day"),
        Check("word", "accepted_values", values=("1", "2")), Check("small", "accepted_values", values=(1, 2, 3)),
        Check("gaps", "relationships", to="rows", field="id"), Check("id", "relationships", to="rows", field="gaps"),
    ]
    every = {"rows": checks, "other": [Check("d", "unique")]}
    assert reported(quality_report(tables, every)) == by_failing_rows(tables, every)


def test_known_failures_are_not_counted_again(spark, tables):
    columns = measures(CHECKS)
    measured = tables["child"].agg(*[c.alias(n) for n, c in columns.items()]).first().asDict()
    known = known_failures("child", CHECKS, measured)
    # Different unexpected values are only known where there is none.
    assert known == {("child", CHECKS[1]): 2, ("child", CHECKS[2]): 1, ("child", CHECKS[5]): 0}
    both = [reported(quality_report(tables, {"child": CHECKS}, k)) for k in (None, known)]
    assert both[0] == both[1]
    only = [CHECKS[1], CHECKS[2]]
    report = quality_report(tables, {"child": only}, known)
    assert report.count() == 2
    assert "Scan ExistingRDD[id" not in report._jdf.queryExecution().executedPlan().toString()
