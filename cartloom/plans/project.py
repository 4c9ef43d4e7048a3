"""The project: its models, their order, tests and documentation, and the commands on them."""

from __future__ import annotations

import datetime as dt
import inspect
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartloom.operators.quality import Check, enforce, known_failures, measures, quality_report
from cartloom.plans import customers, sellers, staging
from cartloom.session import configure
from cartloom.sources.history import BucketedHistoryTable, HistoryTable
from cartloom.sources.seeds import seed_cities
from cartloom.sources.tables import (
    DOCS_SCHEMA, MODEL, TAGS, catalog_docs, catalog_summary, create_namespace, drop_built, drop_table, literal, measured, quote,
    save_table, save_view,
)

# Accepted order statuses and states of the data tests.
STATUSES = ("delivered", "shipped", "processing", "canceled", "invoiced", "approved", "created")
STATES = (
    "SP", "RJ", "MG", "RS", "PR", "SC", "BA", "GO", "ES", "PE", "CE", "PA", "DF", "MT", "MS", "PB",
    "RN", "AL", "PI", "SE", "RO", "AC", "AM", "RR", "AP", "TO", "MA",
)

SOURCES = ("orders", "customers", "order_items", "order_payments")
SNAPSHOT = "snap_seller_tier"
SEED = "brazil_cities"


@dataclass(frozen=True)
class Model:
    """A model, the tables its function takes in order, and what is declared about it.

    A model may be a query in place of a function: ``sql`` names its tables and variables in braces, ``defaults`` has the
    variables. As a view it is stored in the catalog, for every session; a function as a view lasts as long as its session.
    """

    build: Callable[..., DataFrame] | None = None
    sources: Sequence[str] = ()
    refs: Sequence[str] = ()
    materialized: str = "view"
    tags: Sequence[str] = ()
    description: str = ""
    columns: Mapping[str, str] = field(default_factory=dict)
    checks: Sequence[Check] = ()
    bucket_by: str | None = None
    cluster_by: Sequence[str] = ()
    sql: str = ""
    defaults: Mapping[str, object] = field(default_factory=dict)

    @property
    def variables(self) -> set[str]:
        return set(inspect.signature(self.build).parameters) if self.build else set(self.defaults)


# In dependency order.
MODELS: dict[str, Model] = {
    "stg_orders": Model(
        staging.stg_orders,
        sources=["orders"],
        materialized="table",
        tags=["staging", "critical"],
        description="Orders with typed times, without test orders",
        columns={
            "order_id": "Key of the order",
            "customer_id": "The customer that ordered",
            "order_status": "Where the order stands",
            "order_purchase_timestamp": "Time of purchase",
            "order_date": "Day of purchase",
        },
        checks=[
            Check("order_id", "unique"),
            Check("order_id", "not_null"),
            Check("customer_id", "not_null"),
            Check("customer_id", "relationships", to="stg_customers", field="customer_id"),
            Check("order_status", "not_null"),
            Check("order_status", "accepted_values", severity="warn", values=STATUSES),
            Check("order_purchase_timestamp", "not_null"),
            Check("order_date", "not_null"),
        ],
        bucket_by="order_id",
    ),
    "stg_customers": Model(
        staging.stg_customers,
        sources=["customers"],
        materialized="table",
        tags=["staging", "reference"],
        description="Customers and where they live",
        columns={
            "customer_id": "Key of the customer",
            "customer_city": "City",
            "customer_state": "State, one of the 27 codes",
        },
        checks=[
            Check("customer_id", "unique"),
            Check("customer_id", "not_null"),
            Check("customer_city", "not_null"),
            Check("customer_state", "not_null"),
            Check("customer_state", "accepted_values", severity="warn", values=STATES),
        ],
    ),
    "stg_order_items": Model(staging.stg_order_items, sources=["order_items"], materialized="table"),
    "stg_order_payments": Model(
        staging.stg_order_payments,
        sources=["order_payments"],
        materialized="table",
        description="Payments of orders",
        columns={"payment_value": "Amount paid"},
        checks=[
            Check("order_id", "not_null"),
            Check("order_id", "relationships", severity="warn", to="stg_orders", field="order_id"),
            Check("payment_value", "not_null"),
        ],
        bucket_by="order_id",
    ),
    "stg_order_items_snapshot": Model(
        staging.stg_order_items_snapshot,
        sources=["order_items", "orders"],
        materialized="table",
        # Snapshots ask for the items up to a day; the order splits a day that has many.
        cluster_by=["order_date", "order_id"],
    ),
    "int_customer_landing": Model(
        customers.customer_landing, refs=["stg_orders", "stg_customers"], materialized="table"
    ),
    "int_customer_daily_features": Model(
        customers.customer_daily_features,
        refs=["int_customer_landing", "stg_orders", "stg_order_payments"],
        materialized="table",
    ),
    "int_seller_performance": Model(
        sellers.seller_performance, refs=["stg_order_items_snapshot"], materialized="table"
    ),
    "int_customer_tiers": Model(
        customers.customer_tiers, refs=["stg_orders", "stg_order_payments"], materialized="table"
    ),
}

# The landing dates as a view that every session sees.
LANDING_VIEW = Model(
    refs=["stg_orders", "stg_customers"],
    materialized="view",
    description="First sale of every known customer",
    columns={"customer_id": "Key of the customer", "landing_date": "Day of the first sale"},
    sql=customers.LANDING_SQL,
    defaults={"excluded": staging.EXCLUDED_STATUSES},
)


class Project:
    """Runs the models in one database.

    ``sources`` maps a raw table to a DataFrame or table name; raw tables it leaves out are read
    from ``source_database`` under ``source_prefix``. ``variables`` are keyword arguments of the
    model functions (``snapshot_date``, ``last_day``, ...), each given to the models that take
    it. With ``buckets``, the staging tables joined on the order are laid out by it, with ``history_buckets``
    the open versions of the history by their key.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        source_database: str | None = None,
        source_prefix: str = "",
        sources: Mapping[str, DataFrame | str] | None = None,
        variables: Mapping[str, object] | None = None,
        models: Mapping[str, Model] = MODELS,
        buckets: int = 0,
        location: str | None = None,
        initial_partitions: int | None = None,
        history_buckets: int = 0,
    ):
        self.history_buckets = history_buckets
        self.spark, self.database, self.models, self.buckets = spark, database, models, buckets
        self.source_database, self.source_prefix = source_database or database, source_prefix
        self.sources, self.variables = dict(sources or {}), dict(variables or {})
        create_namespace(configure(spark, initial_partitions), database, location)

    def source(self, name: str) -> DataFrame:
        """A raw table."""
        given = self.sources.get(name)
        return given if isinstance(given, DataFrame) else self.spark.table(self._source_name(name))

    def _source_name(self, name: str) -> str:
        given = self.sources.get(name)
        if isinstance(given, DataFrame):
            raise ValueError(f"a stored view needs {name!r} as a table, not as a DataFrame")
        return given or f"{quote(self.source_database)}.{quote(self.source_prefix + name)}"

    def _text(self, model: Model, given: Mapping[str, object], tables: Mapping[str, str], braces: bool = False) -> str:
        """The query of a model with its tables and variables filled in; ``braces`` of values doubled to be filled in again."""
        values = {k: sql_value(given.get(k, default)) for k, default in model.defaults.items()}
        if braces:
            values = {k: v.replace("{", "{{").replace("}", "}}") for k, v in values.items()}
        return model.sql.format(**values, **tables)

    def ref(self, name: str) -> DataFrame:
        """A built model, seed or snapshot."""
        return self.spark.table(self._table(name))

    def selected(self, select: Sequence[str] | None) -> list[str]:
        """Models by name or by ``tag:<tag>``, in dependency order; None selects all."""
        if select is None:
            return list(self.models)
        names: set[str] = set()
        for term in select:
            if term.startswith("tag:"):
                found = {n for n, m in self.models.items() if term[4:] in m.tags}
            else:
                found = {term} & self.models.keys()
            if not found:
                raise ValueError(f"nothing matches {term!r}")
            names |= found
        return [n for n in self.models if n in names]

    def dataframe(self, name: str, variables: Mapping[str, object] | None = None) -> DataFrame:
        """A model over its built inputs, not yet executed."""
        self._check_variables(variables)
        model = self.models[name]
        inputs = {s: self.source(s) for s in model.sources} | {r: self.ref(r) for r in model.refs}
        given = {k: v for k, v in {**self.variables, **(variables or {})}.items() if k in model.variables}
        if model.build is None:
            # The inputs go in by name, as DataFrames.
            text = self._text(model, given, {n: "{" + n + "}" for n in inputs}, braces=True)
            df = self.spark.sql(text, **inputs)
        else:
            df = model.build(*inputs.values(), **given)
        for column, text in model.columns.items():
            df = df.withMetadata(column, {"comment": text})
        return df

    def run(
        self, select: Sequence[str] | None = None, variables: Mapping[str, object] | None = None
    ) -> list[str]:
        """Build the selected models and return their names."""
        names = self.selected(select)
        for name in names:
            model, stored = self.models[name], {MODEL: name, TAGS: ",".join(self.models[name].tags)}
            if model.materialized == "view" and model.sql:
                self._check_variables(variables)
                tables = {s: self._source_name(s) for s in model.sources} | {r: self._table(r) for r in model.refs}
                text = self._text(model, {**self.variables, **(variables or {})}, tables)
                save_view(self.spark, text, self._table(name), model.columns, model.description, stored)
            elif model.materialized == "view":
                self.dataframe(name, variables).createOrReplaceTempView(name)
            else:
                save_table(
                    self.dataframe(name, variables), self._table(name), model.bucket_by, self.buckets, model.cluster_by,
                    measures(model.checks), model.description, stored,
                )
        return names

    def seed(self) -> None:
        save_table(seed_cities(self.spark), self._table(SEED))

    def snapshot(self) -> DataFrame:
        """Record the present seller performance in the tier history."""
        return self._history().apply(self.ref("int_seller_performance"))

    def replay(self, rounds: Sequence[tuple[dt.date, dt.datetime | None]] | None = None) -> DataFrame:
        """Seller performance as of each date, each recorded in the tier history.

        The items are read for all dates together; a round without a calculation time gets the
        present one. The seller performance is left as of the last date.
        """
        now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        given = rounds or [(day, None) for day in sellers.REPLAY_DATES]
        timed = sorted((day, at or now + dt.timedelta(microseconds=i)) for i, (day, at) in enumerate(given))
        figures = sellers.seller_performance_rounds(
            self.ref("stg_order_items_snapshot"), timed, self.variables.get("thresholds")
        )
        stored = self._table("int_seller_performance_rounds")
        save_table(figures, stored)
        for _, at in timed:
            current = self.spark.table(stored).where(F.col(sellers.SELLER_TIME) == F.lit(str(at)).cast("timestamp_ntz"))
            history = self._history().apply(current)
        save_table(current, self._table("int_seller_performance"))
        drop_table(self.spark, stored)
        return history

    def test(self, select: Sequence[str] | None = None, raise_on_error: bool = True) -> DataFrame:
        """Report of the data tests; a failed one of severity ``error`` raises.

        Missing and unexpected values of tables were counted when they were written; the rest takes one pass a table.
        """
        checks = {n: self.models[n].checks for n in self.selected(select) if self.models[n].checks}
        needed = set(checks) | {c.to for cs in checks.values() for c in cs if c.to}
        known = {}
        for name in checks:
            if self._is_stored(name):
                known |= known_failures(name, checks[name], measured(self.spark, self._table(name)))
        report = quality_report({n: self.ref(n) for n in needed}, checks, known)
        # One row per declared test; kept, so that reading the report runs no test again.
        report = self.spark.createDataFrame(report.collect(), report.schema)
        if raise_on_error:
            enforce(report)
        return report

    def docs(self) -> DataFrame:
        """(model, column, description, tags): one row per model and per documented column.

        As declared; ``stored_docs`` has what the catalog keeps with the tables, for every session.
        """
        rows = []
        for name, model in self.models.items():
            rows.append((name, None, model.description, ",".join(model.tags)))
            rows += [(name, column, text, ",".join(model.tags)) for column, text in model.columns.items()]
        return self.spark.createDataFrame(rows, DOCS_SCHEMA)

    def stored_docs(self) -> DataFrame:
        return catalog_docs(self.spark, self.database)

    def clean(self) -> list[str]:
        """Drop everything the models built; raw tables and seeds stay."""
        dropped = drop_built(self.spark, self.database)
        for name, model in self.models.items():
            if model.materialized != "view":
                continue
            if not model.sql:
                self.spark.catalog.dropTempView(name)
            elif self.spark.catalog.tableExists(self._table(name)):
                # One whose name is none of the built ones.
                self.spark.sql(f"DROP VIEW {self._table(name)}")
                dropped.append(name)
        return sorted(dropped)

    def summary(self) -> DataFrame:
        """Stored tables per layer, without the raw ones."""
        sources = {s for m in self.models.values() for s in m.sources}
        raw = [self.source_prefix + s for s in sources]
        return catalog_summary(self.spark, self.database, raw_names=raw)

    def reset(self, rounds: Sequence[tuple[dt.date, dt.datetime | None]] | None = None) -> DataFrame:
        """Drop what was built, build it again with its history, and summarise."""
        self.clean()
        self.run()
        self.seed()
        self.replay(rounds)
        return self.summary()

    def _check_variables(self, variables: Mapping[str, object] | None) -> None:
        known = {p for m in self.models.values() for p in m.variables}
        unknown = {**self.variables, **(variables or {})}.keys() - known
        if unknown:
            raise ValueError(f"no model takes {', '.join(sorted(unknown))}")

    def _history(self) -> HistoryTable:
        named = (self.spark, self.database, SNAPSHOT, sellers.SELLER_KEY, sellers.SELLER_TIME)
        return BucketedHistoryTable(*named, self.history_buckets) if self.history_buckets else HistoryTable(*named)

    def _table(self, name: str) -> str:
        return f"{quote(self.database)}.{quote(name)}" if self._is_stored(name) else quote(name)

    def _is_stored(self, name: str) -> bool:
        return name not in self.models or self.models[name].materialized != "view" or bool(self.models[name].sql)


def sql_value(value: object) -> str:
    """A variable as it stands in a query; several values as a list in brackets."""
    if isinstance(value, (list, tuple, set, frozenset)):
        return "(" + ", ".join(map(sql_value, value)) + ")"
    if value is None or isinstance(value, bool):
        return "NULL" if value is None else str(value).upper()
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ {literal(str(value))}"
    if isinstance(value, dt.date):
        return f"DATE {literal(str(value))}"
    return str(value) if isinstance(value, (int, float)) else literal(str(value))
