"""Catalog operations: namespaces, table writes, cleanup and summaries."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Prefixes of the tables that models build, and the layer names of the summary.
BUILT_PREFIXES = ("stg_", "int_", "mart_", "snap_")
LAYERS = (("stg_%", "Staging"), ("int_%", "Intermediate"), ("snap_%", "Snapshot"))
OTHER_LAYER = "Other"
DOCS_SCHEMA = "model string, column string, description string, tags string"
# Ending of the folder that holds the versions of a table.
VERSIONS = "__versions"
# Start of the table properties that hold what was measured at the write.
MEASURE = "cartloom.measure."
# Table properties with the model of a table and its tags.
MODEL, TAGS = "cartloom.model", "cartloom.tags"


def quote(name: str) -> str:
    """A safely quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def namespace_exists(spark: SparkSession, database: str) -> bool:
    return spark.catalog.databaseExists(database)


def create_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create a database unless it exists, by default in the cluster's warehouse."""
    create = f"CREATE DATABASE IF NOT EXISTS {quote(database)}"
    if location is None:
        spark.sql(create)
    else:
        spark.sql(f"{create} LOCATION :location", {"location": location})


def database_location(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(quote(database)).locationUri.rstrip("/")


def save_table(
    df: DataFrame,
    name: str,
    bucket_by: str | None = None,
    buckets: int = 0,
    cluster_by: Sequence[str] = (),
    measures: Mapping[str, Column] | None = None,
    description: str = "",
    properties: Mapping[str, str] | None = None,
) -> dict[str, object]:
    """Replace a table with ``df``. The old rows stay readable until the table moves to the new ones in one catalog call.

    The rows go to a folder of their own, a version, below the database; then the table's location is set to it. A try
    that dies on the way, at whatever point, leaves the old rows, and nothing is ever copied. The version before stays for
    those who still read it; older ones, and what died tries have left, go with the next replacement. Only where the columns or
    buckets change is the entry dropped and made anew, two calls, with the rows of both versions in place.

    With ``buckets``, rows are laid out by ``bucket_by`` so that later joins and groupings on
    that column need no shuffle. Use it for a table that is joined on it more than once and has no hot value in
    it: a bucket is read by one task. ``buckets`` is a matter of the data, about bytes of the table / 256 MB.
    With ``cluster_by``, rows lie in the order of these columns, so that a filter on the first skips the files and row
    groups of other values by their statistics.

    ``measures`` are aggregates of the written rows, taken while they are written and returned by name; ``description`` and
    ``properties`` are stored with the table.
    """
    spark, (database, table) = df.sparkSession, _parts(df.sparkSession, name)
    versions = f"{database_location(spark, database)}/{table}{VERSIONS}"
    version = f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    new = f"{quote(database)}.{quote(_entry(table, version))}"
    if cluster_by:
        rows = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    elif bucket_by is None or not buckets:
        rows = df
    else:
        # About one task per bucket; one that a hot value makes too large is split over several.
        rows = df.hint("rebalance", buckets, F.col(bucket_by))
    # Behind the last shuffle, so that a task which is done again counts once.
    observed = Observation() if measures else None
    if observed:
        rows = rows.observe(observed, *[column.alias(key) for key, column in measures.items()])
    writer = rows.write.option("path", f"{versions}/{version}")
    if not cluster_by and bucket_by is not None and buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(new)
    found = observed.get if observed else {}
    # With its version, as the table may be at another one already when the property is set.
    counted = {f"{MEASURE}{key}": f"{version}:{value}" for key, value in found.items()}
    _switch(spark, f"{quote(database)}.{quote(table)}", new, description, {**(properties or {}), **counted})
    return found


def measured(spark: SparkSession, name: str) -> dict[str, str]:
    """What ``save_table`` measured of the rows that the table shows now."""
    layout = _layout(spark, name)
    if layout is None or layout["Type"] == "VIEW":
        return {}
    version = layout["Location"].rsplit("/", 1)[1]
    found = {k.removeprefix(MEASURE): v.split(":", 1) for k, v in table_properties(spark, name).items() if k.startswith(MEASURE)}
    return {key: value for key, (of, value) in found.items() if of == version}


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _switch(spark: SparkSession, name: str, new: str, description: str, properties: Mapping[str, str]) -> None:
    """Let ``name`` show the rows of the table ``new``, and remove versions that are past use."""
    old, made = _layout(spark, name), _layout(spark, new)
    if old is not None and old["Type"] == "EXTERNAL" and all(old[k] == made[k] for k in old.keys() - {"Location"}):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {literal(made['Location'])}")
        spark.sql(f"DROP TABLE {new}")
        _document(spark, name, description, properties)
    else:
        _document(spark, new, description, properties)
        if old is not None:
            spark.sql(f"DROP {'VIEW' if old['Type'] == 'VIEW' else 'TABLE'} {name}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    database, table = _parts(spark, name)
    versions, current = made["Location"].rsplit("/", 1)
    # The version before, if any, and whatever was begun since are not touched.
    least = min(old["Location"].rsplit("/", 1)[1], current) if old and old["Location"].startswith(f"{versions}/") else current
    files, path = _files(spark, versions)
    for status in files.listStatus(path):
        version = status.getPath().getName()
        if version < least:
            spark.sql(f"DROP TABLE IF EXISTS {quote(database)}.{quote(_entry(table, version))}")
            files.delete(status.getPath(), True)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table that ``save_table`` made, with all its versions."""
    database, table = _parts(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    files, path = _files(spark, f"{database_location(spark, database)}/{table}{VERSIONS}")
    files.delete(path, True)


def _entry(table: str, version: str) -> str:
    """The catalog entry of a version until the table shows it."""
    return f"{table}__v{version}"


def _parts(spark: SparkSession, name: str) -> tuple[str, str]:
    """Database and table of a name, each part of which may be quoted."""
    parts = [q.replace("``", "`") if q else plain for q, plain in re.findall(r"`((?:[^`]|``)+)`|([^.`]+)", name)]
    return (parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()), parts[-1]


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def literal(text: str) -> str:
    """A safely quoted text in SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _layout(spark: SparkSession, name: str) -> dict[str, str] | None:
    """Columns with their comments, buckets, kind and location of a table; None if there is none."""
    if not spark.catalog.tableExists(name):
        return None
    wanted = ("Type", "Provider", "Location", "Num Buckets", "Bucket Columns", "Sort Columns")
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return {"columns": spark.table(name).schema.json()} | {k: described.get(k, "") for k in wanted}


def _document(spark: SparkSession, name: str, description: str, properties: Mapping[str, str]) -> None:
    if description:
        spark.sql(f"COMMENT ON TABLE {name} IS {literal(description)}")
    if properties:
        listed = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def save_view(
    spark: SparkSession, text: str, name: str, columns: Mapping[str, str] | None = None, description: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Create or replace a view that every session sees, in one catalog call; ``columns`` are comments by column.

    A table of that name goes first.
    """
    old = _layout(spark, name)
    if old is not None and old["Type"] != "VIEW":
        drop_table(spark, name)
    comments = columns or {}
    listed = ", ".join(quote(c) + (f" COMMENT {literal(comments[c])}" if c in comments else "") for c in spark.sql(text).columns)
    comment = f" COMMENT {literal(description)}" if description else ""
    pairs = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in (properties or {}).items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} ({listed}){comment}{f' TBLPROPERTIES ({pairs})' if pairs else ''} AS {text}")


def catalog_docs(spark: SparkSession, database: str) -> DataFrame:
    """(model, column, description, tags) of the tables and views that models built, as the catalog tells them."""
    rows = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        name = f"{quote(database)}.{quote(table.name)}"
        properties = table_properties(spark, name)
        if MODEL not in properties:
            continue
        tags = properties.get(TAGS, "")
        rows.append((properties[MODEL], None, table.description or "", tags))
        comments = ((f.name, f.metadata.get("comment")) for f in spark.table(name).schema.fields)
        rows += [(properties[MODEL], column, text, tags) for column, text in comments if text]
    return spark.createDataFrame(rows, DOCS_SCHEMA)


def row_counts(spark: SparkSession, database: str, tables: Sequence[str]) -> DataFrame:
    """(table, row_count) for each table."""
    counts = [
        spark.table(f"{quote(database)}.{quote(t)}").agg(F.count("*").alias("row_count"))
        .select(F.lit(t).alias("table"), "row_count")
        for t in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def drop_built(spark: SparkSession, database: str) -> list[str]:
    """Drop the tables and views that models built; everything else stays. Returns the names."""
    dropped = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary or not table.name.startswith(BUILT_PREFIXES):
            continue
        name = f"{quote(database)}.{quote(table.name)}"
        if table.tableType == "VIEW":
            spark.sql(f"DROP VIEW IF EXISTS {name}")
        else:
            drop_table(spark, name)
        dropped.append(table.name)
    return sorted(dropped)


def catalog_summary(
    spark: SparkSession, database: str, raw_patterns: Sequence[str] = ("product_%",), raw_names: Sequence[str] = ()
) -> DataFrame:
    """(layer, table_count) over the stored tables of a database, without views and raw tables.

    Layers go by LIKE pattern, in which ``_`` matches any one character.
    """
    names = [
        (t.name,)
        for t in spark.catalog.listTables(database)
        if not t.isTemporary and t.tableType != "VIEW" and t.name not in raw_names
    ]
    tables = spark.createDataFrame(names, "table_name string")
    for pattern in raw_patterns:
        tables = tables.where(~F.col("table_name").like(pattern))
    layer = F.lit(OTHER_LAYER)
    for pattern, label in reversed(LAYERS):
        layer = F.when(F.col("table_name").like(pattern), label).otherwise(layer)
    return tables.groupBy(layer.alias("layer")).agg(F.count("*").alias("table_count")).orderBy("layer")
