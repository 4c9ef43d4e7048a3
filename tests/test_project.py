import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartloom import configure
from cartloom.__main__ import main
from cartloom.operators import quality_report
from cartloom.operators.quality import DataTestError, known_failures
from cartloom.plans import MODELS, Project
from cartloom.plans.project import LANDING_VIEW, SEED, SNAPSHOT, sql_value
from cartloom.session import shared_dir
from cartloom.sources import RAW_SCHEMAS
from cartloom.sources.tables import measured
from tests import shop
from tests.compare import spark_rows

DATABASE = "project_test"
ROUNDS = [(dt.date(2017, 1, 2), dt.datetime(2020, 1, 1)), (dt.date(2017, 1, 31), dt.datetime(2020, 1, 2))]


@pytest.fixture
def project(spark):
    yield Project(spark, DATABASE, sources=shop.raw_tables(spark), variables={"updated_at": dt.datetime(2020, 1, 1)})
    spark.sql(f"DROP DATABASE IF EXISTS {DATABASE} CASCADE")


def test_run_all(spark, project):
    assert project.run() == list(MODELS)
    assert [t.name for t in spark.catalog.listTables(DATABASE) if not t.isTemporary] == sorted(MODELS)
    assert project.ref("int_customer_landing").count() == 4
    assert project.ref("int_seller_performance").count() == 2
    comments = {f.name: f.metadata.get("comment") for f in project.ref("stg_orders").schema.fields}
    assert comments["order_id"] == "Key of the order"
    assert comments["order_approved_at"] is None


def test_models_come_after_what_they_read():
    seen = set()
    for name, model in MODELS.items():
        assert set(model.refs) <= seen
        seen.add(name)


def test_selection(project):
    assert project.selected(["int_customer_tiers", "stg_orders"]) == ["stg_orders", "int_customer_tiers"]
    assert project.selected(["tag:staging"]) == ["stg_orders", "stg_customers"]
    assert project.selected(["tag:critical", "stg_order_items"]) == ["stg_orders", "stg_order_items"]
    with pytest.raises(ValueError):
        project.selected(["stg_order"])


def test_variables(project):
    project.run(["stg_order_items_snapshot", "int_seller_performance"], {"snapshot_date": "2017-01-02"})
    early = {r["seller_id"]: r["total_orders"] for r in project.ref("int_seller_performance").collect()}
    project.run(["int_seller_performance"])
    late = {r["seller_id"]: r["total_orders"] for r in project.ref("int_seller_performance").collect()}
    assert (early, late) == ({"sa": 1, "sb": 1}, {"sa": 2, "sb": 1})


def test_data_tests(project):
    project.run(["tag:staging", "stg_order_payments"])
    report = project.test(raise_on_error=False)
    assert report.count() == 16
    with pytest.raises(DataTestError):
        project.test()
    # Only warnings here.
    assert project.test(["stg_order_payments"]).where("status = 'warn'").count() == 1


def test_reset(spark, project):
    summary = project.reset(ROUNDS)
    expected = [("Intermediate", 4), ("Other", 1), ("Snapshot", 1), ("Staging", 5)]
    assert [tuple(r) for r in summary.collect()] == expected
    assert project.ref(SEED).count() == 15
    history = spark_rows(project.ref(SNAPSHOT))
    assert len(history[1]) == 4
    # A second reset starts the history again.
    assert [tuple(r) for r in project.reset(ROUNDS).collect()] == expected
    assert spark_rows(project.ref(SNAPSHOT)) == history
    # The performance is the one of the last round.
    assert {r["updated_at"] for r in project.ref("int_seller_performance").collect()} == {ROUNDS[-1][1]}
    dropped = project.clean()
    assert set(dropped) == {*MODELS, SNAPSHOT, SNAPSHOT + "_versions"}
    assert project.ref(SEED).count() == 15


def test_replay_equals_runs_and_snapshots_one_by_one(spark, project):
    project.reset(ROUNDS)
    replayed = spark_rows(project.ref(SNAPSHOT))
    project.clean()
    project.run()
    for day, at in ROUNDS:
        project.run(["int_seller_performance"], {"snapshot_date": day, "updated_at": at})
        project.snapshot()
    assert spark_rows(project.ref(SNAPSHOT)) == replayed


def test_replay_with_calculation_times_of_its_own(project):
    project.run(["stg_order_items_snapshot"])
    project.variables.clear()
    history = project.replay()
    # The standard dates; each sees all sellers there are by then, the first none.
    rows = history.orderBy("seller_id", "valid_from").collect()
    assert len(rows) == 2 * 3
    assert [r["valid_to"] is None for r in rows] == [False, False, True] * 2


def test_view_materialization(spark):
    models = {**MODELS, "int_customer_landing": dataclasses.replace(MODELS["int_customer_landing"], materialized="view")}
    project = Project(spark, DATABASE, sources=shop.raw_tables(spark), models=models)
    project.run()
    assert spark.table("int_customer_landing").count() == 4
    assert not spark.catalog.tableExists(f"{DATABASE}.int_customer_landing")
    assert project.ref("int_customer_daily_features").count() > 0
    project.clean()
    assert not spark.catalog.tableExists("int_customer_landing")
    spark.sql(f"DROP DATABASE {DATABASE} CASCADE")


def test_buckets(spark, project):
    project.run()
    plain = {name: spark_rows(project.ref(name)) for name in ("int_customer_tiers", "int_customer_daily_features")}
    project.buckets = 4
    project.run()
    for name, rows in plain.items():
        assert spark_rows(project.ref(name)) == rows


def test_docs(project):
    rows = {(r["model"], r["column"]): (r["description"], r["tags"]) for r in project.docs().collect()}
    assert rows["stg_orders", None][1] == "staging,critical"
    assert rows["stg_order_payments", "payment_value"] == ("Amount paid", "")
    assert {m for m, _ in rows} == set(MODELS)


def test_commands(spark, tmp_path, capsys):
    for name, rows in shop.TABLES.items():
        columns = RAW_SCHEMAS[name].names
        lines = [",".join("" if v is None else str(v) for v in row) for row in rows]
        (tmp_path / f"shop_{name}.csv").write_text("\n".join([",".join(columns), *lines]) + "\n")
    options = ["--database", DATABASE, "--source-prefix", "shop_"]
    main(["ingest", *options, "--directory", str(tmp_path)])
    main(["ingest", *options, "--directory", str(tmp_path), "--once"])
    assert "already loaded" in capsys.readouterr().out
    main(["reset", *options])
    assert "Staging" in capsys.readouterr().out
    loaded = Project(spark, DATABASE, source_prefix="shop_")
    given = Project(spark, DATABASE + "_given", sources=shop.raw_tables(spark))
    given.run()
    for name in MODELS:
        if name != "int_seller_performance":
            assert spark_rows(loaded.ref(name)) == spark_rows(given.ref(name))
    main(["run", *options, "--select", "int_seller_performance", "--vars", '{"snapshot_date": "2017-01-02"}'])
    assert capsys.readouterr().out.split() == ["int_seller_performance"]
    main(["snapshot", *options])
    with pytest.raises(SystemExit):
        main(["test", *options])
    main(["test", *options, "--select", "stg_order_payments"])
    main(["docs", *options])
    main(["clean", *options])
    assert "snap_seller_tier" in capsys.readouterr().out
    for name in (DATABASE, DATABASE + "_given"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_unknown_variables_raise(spark, project):
    with pytest.raises(ValueError, match="snapshot_dat"):
        project.run(["stg_orders"], {"snapshot_dat": "2017-01-01"})


def test_summary_leaves_out_raw_tables_by_name(spark):
    shop_tables = shop.raw_tables(spark)
    project = Project(spark, DATABASE)
    from cartloom.sources import save_table

    for name, rows in shop_tables.items():
        save_table(rows, f"{DATABASE}.{name}")
    project.run(["stg_orders"])
    assert {r["layer"]: r["table_count"] for r in project.summary().collect()} == {"Staging": 1}
    spark.sql(f"DROP DATABASE {DATABASE} CASCADE")


def test_tests_read_what_the_write_counted(spark, project):
    project.run(["tag:staging", "stg_order_payments"])
    report = project.test(raise_on_error=False)
    known = {}
    for name in ("stg_orders", "stg_customers", "stg_order_payments"):
        known |= known_failures(name, MODELS[name].checks, measured(spark, f"{DATABASE}.{name}"))
    assert sum(c.kind == "not_null" for _, c in known) == 10
    tables = {name: project.ref(name) for name in ("stg_orders", "stg_customers", "stg_order_payments")}
    counted = quality_report(tables, {name: MODELS[name].checks for name in tables})
    assert spark_rows(report) == spark_rows(counted)
    # Rows that came by another way were not counted.
    spark.sql(f"ALTER TABLE {DATABASE}.stg_orders SET LOCATION '{measured_elsewhere(spark)}'")
    assert measured(spark, f"{DATABASE}.stg_orders") == {}


def measured_elsewhere(spark):
    return shared_dir(spark)


def test_view_of_a_query_is_there_for_other_sessions(spark):
    raw = shop.raw_tables(spark)
    models = {**MODELS, "int_customer_landing": LANDING_VIEW}
    project = Project(spark, DATABASE, sources=raw, models=models)
    project.run(["tag:staging", "int_customer_landing"])
    plain = Project(spark, DATABASE + "_plain", sources=raw)
    plain.run(["tag:staging", "int_customer_landing"])
    expected = spark_rows(plain.ref("int_customer_landing"))
    other = configure(spark.newSession())
    assert spark_rows(Project(other, DATABASE, models=models).ref("int_customer_landing")) == expected
    # As a table, and with a variable.
    as_table = {**models, "int_customer_landing": dataclasses.replace(LANDING_VIEW, materialized="table")}
    project.models = as_table
    project.run(["int_customer_landing"])
    assert spark_rows(project.ref("int_customer_landing")) == expected
    project.models = models
    project.run(["int_customer_landing"], {"excluded": ("delivered", "odd {braces} 'quoted'")})
    plain.run(["int_customer_landing"], {"excluded": ("delivered", "odd {braces} 'quoted'")})
    assert spark_rows(project.ref("int_customer_landing")) == spark_rows(plain.ref("int_customer_landing")) != expected
    assert "int_customer_landing" in project.clean()
    assert not spark.catalog.tableExists(f"{DATABASE}.int_customer_landing")
    with pytest.raises(ValueError, match="as a table"):
        bad = dataclasses.replace(LANDING_VIEW, refs=["stg_customers"], sources=["orders"], sql="SELECT * FROM {orders}")
        Project(spark, DATABASE, sources=raw, models={"v": bad}).run()
    for name in (DATABASE, DATABASE + "_plain"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_docs_in_the_catalog(spark, project):
    models = {**MODELS, "int_customer_landing": LANDING_VIEW}
    project.models = models
    project.run(["tag:staging", "stg_order_payments", "int_customer_landing"])
    built = ("stg_orders", "stg_customers", "stg_order_payments", "int_customer_landing")
    declared = project.docs().where(F.col("model").isin(*built))
    other = Project(configure(spark.newSession()), DATABASE, models={})
    assert spark_rows(other.stored_docs()) == spark_rows(declared)
    # A new description comes with the next build.
    project.models = {**models, "stg_customers": dataclasses.replace(MODELS["stg_customers"], description="Who's \\ there", tags=["x"])}
    project.run(["stg_customers"])
    row = project.stored_docs().where("model = 'stg_customers' AND column IS NULL").first()
    assert (row["description"], row["tags"]) == ("Who's \\ there", "x")


def test_values_in_queries():
    assert sql_value(("a", "it's")) == "('a', 'it\\'s')"
    assert [sql_value(v) for v in (None, True, 1, 0.5)] == ["NULL", "TRUE", "1", "0.5"]
    assert sql_value(dt.date(2020, 1, 2)) == "DATE '2020-01-02'"
    assert sql_value(dt.datetime(2020, 1, 2, 3)) == "TIMESTAMP_NTZ '2020-01-02 03:00:00'"


def test_history_in_buckets(spark, project):
    project.reset(ROUNDS)
    plain = spark_rows(project.ref(SNAPSHOT))
    project.clean()
    project.history_buckets = 4
    project.reset(ROUNDS)
    assert spark_rows(project.ref(SNAPSHOT)) == plain
    assert {SNAPSHOT, SNAPSHOT + "_versions", SNAPSHOT + "_open"} <= set(project.clean())
