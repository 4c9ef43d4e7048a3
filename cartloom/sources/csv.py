"""CSV scan and directory ingest."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from cartloom.functions.casts import to_int
from cartloom.sources.schemas import RAW_SCHEMAS
from cartloom.sources.tables import create_namespace, database_location, namespace_exists, quote, save_table

# Field texts that the usual CSV loaders take for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Types that an undeclared column may have, narrowest first, and how numbers are written.
TYPES = ("boolean", "int", "bigint", "double")
WHOLE_NUMBER = "^[+-]?(0|[1-9][0-9]*)$"
NUMBER = "^[+-]?((0|[1-9][0-9]*)(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Property of a database whose ingest is complete.
LOADED = "cartloom.loaded"
# A loader that holds its claim longer than this is taken for lost.
CLAIM_SECONDS = 24 * 3600.0


# Spark makes no two tasks of a file of this size.
SPLIT_BYTES = 4 << 20
# File endings of codecs that give one stream a file.
UNSPLITTABLE = (".gz", ".gzip", ".deflate", ".snappy", ".lz4", ".zst", ".zstd", ".xz")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    multiline: bool | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """CSV with a header row; a byte order mark and CRLF line ends are fine.

    Types are declared, never inferred; without a schema every column is text. Missing-value
    texts become NULL, whole numbers may be written ``12.0``, other bad values raise. The header
    must name the schema's columns in order, and without a schema the headers of all files must agree.
    Files beyond ``split_bytes`` are split over tasks unless a first pass over their lines finds one that is no row of its own, as
    line breaks inside quotes make it (see ``splittable``). ``multiline`` spares that pass: True reads each file in one
    task, False splits all, and then a quote that its line does not close raises.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None:
        text = _reader(spark, True).csv(paths).schema
    else:
        text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    split, whole = ([], paths) if multiline else (paths, []) if multiline is False else _by_lines(spark, paths, split_bytes)
    parts = [_reader(spark, m).schema(text).option("enforceSchema", False).csv(p) for m, p in ((False, split), (True, whole)) if p]
    fields = text.fields if schema is None else schema.fields
    return reduce(DataFrame.union, parts).select(*[_parse(f).alias(f.name) for f in fields])


def _reader(spark: SparkSession, multiline: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .option("unescapedQuoteHandling", "RAISE_ERROR")
    )


def _by_lines(spark: SparkSession, paths: list[str], split_bytes: int) -> tuple[list[str], list[str]]:
    """The files to read split and those to read as a whole; the given paths where all are of one kind."""
    files = spark.read.format("binaryFile").load(paths).select("path", (F.col("length") > split_bytes).alias("large"))
    names = {r["path"]: r["large"] and not r["path"].lower().endswith(UNSPLITTABLE) for r in files.collect()}
    split = splittable(spark, [n for n, large in names.items() if large])
    whole = sorted(names.keys() - set(split))
    return (split, whole) if split and whole else (paths, []) if split else ([], paths)


def splittable(spark: SparkSession, files: list[str]) -> list[str]:
    """Those of ``files`` in which every line is read alike alone and in its file: a pass over all lines, split over tasks.

    A value with a line break makes its first line hold an odd number of quotes, whatever else the line holds. A
    carriage return anywhere but before the line feed would be a line end to the reader of single lines, and a line of
    blanks would be no row to it.
    """
    if not files:
        return []
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    back = F.instr(line, "\r")
    alone = (quotes % 2 == 0) & back.isin(0, F.length(line)) & ((line == "\r") | ~line.rlike("^[\\x00-\\x20]+$"))
    lines = spark.read.option("lineSep", "\n").text(files).select("value", "_metadata.file_path")
    found = lines.where(~alone).select("file_path").distinct().collect()
    # The column holds encoded addresses.
    uri, path = spark._jvm.java.net.URI, spark._jvm.org.apache.hadoop.fs.Path
    bad = {path(uri(r["file_path"])).toString() for r in found}
    return [f for f in files if f not in bad]


def typed(rows: DataFrame) -> DataFrame:
    """Text columns in the narrowest type that holds all their values, found in one pass over all rows.

    boolean (true and false in any case), int, bigint, double, else text. Numbers that a type would change stay text: whole
    ones with leading zeros or beyond 64 bits, and next to decimals beyond 2^53. A column without values stays text, and so
    do times, which staging casts. Blanks around numbers are no part of them.
    """
    tests, names = [], [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType)]
    for i, name in enumerate(names):
        value = F.trim(F.col(quote(name)))
        whole, number = value.rlike(WHOLE_NUMBER), value.rlike(NUMBER)
        finite = F.abs(value.try_cast("double")) < float("inf")
        exact = F.when(whole, F.abs(value.try_cast("decimal(38,0)")) <= 2**53).otherwise(number & finite)
        holds = {
            "boolean": F.lower(value).isin("true", "false"),
            "int": whole & value.try_cast("int").isNotNull(),
            "bigint": whole & value.try_cast("bigint").isNotNull(),
            "double": F.coalesce(exact, F.lit(False)),
        }
        tests += [F.bool_and(F.when(value.isNotNull(), test)).alias(f"{kind}_{i}") for kind, test in holds.items()]
    if not names:
        return rows
    found = rows.agg(*tests).first()
    kinds = {n: next((k for k in TYPES if found[f"{k}_{i}"]), None) for i, n in enumerate(names)}
    as_kind = lambda n: F.trim(F.col(quote(n))).cast(kinds[n]) if kinds.get(n) else F.col(quote(n))
    return rows.select(*[as_kind(n).alias(n) for n in rows.columns])


def csv_tables(spark: SparkSession, directory: str) -> DataFrame:
    """(table, path) of every ``<table>.csv`` in a directory: a file, or a folder whose files are its parts.

    Only the directory itself is listed, and of such a folder whether it has files; deeper folders are no tables.
    Two sources that name one table raise.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, tuple[str, str]] = {}
    for status in sorted(files.listStatus(root), key=lambda s: s.getPath().getName()):
        name = status.getPath().getName()
        if not name.endswith(".csv") or name.startswith((".", "_")):
            continue
        if status.isDirectory() and not any(_is_part(s) for s in files.listStatus(status.getPath())):
            continue
        table = name.removesuffix(".csv")
        if table.lower() in found:
            raise ValueError(f"{found[table.lower()][1]} and {status.getPath()} are both table {table.lower()!r}")
        found[table.lower()] = (table, status.getPath().toString())
    return spark.createDataFrame(list(found.values()), "table string, path string")


def _is_part(status) -> bool:
    return status.isFile() and not status.getPath().getName().startswith((".", "_"))


def ingest_directory(
    spark: SparkSession,
    directory: str,
    database: str,
    schemas: Mapping[str, StructType] = RAW_SCHEMAS,
    prefix: str = "",
    single_line: Sequence[str] = (),
    location: str | None = None,
    infer: bool = True,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Load every CSV of a directory into the table of its name and report (table, row_count).

    ``schemas`` are looked up by table name without ``prefix``; undeclared tables get the types that their values allow
    (``typed``), or with ``infer=False`` load as text. Large files are split over tasks where their lines allow it; those of the
    tables in ``single_line`` always, which forbids line breaks inside quotes. Tables are replaced; the database is
    marked as loaded once all are there. Rows are counted as they are written.
    """
    found = csv_tables(spark, directory).collect()
    if not found:
        raise FileNotFoundError(f"no CSV files in {directory}")
    create_namespace(spark, database, location)
    report = []
    for row in found:
        bare = row["table"].removeprefix(prefix)
        declared = schemas.get(bare)
        df = read_csv(spark, row["path"], declared, False if bare in single_line else None, split_bytes)
        if declared is None and infer:
            df = typed(df)
        written = save_table(df, f"{quote(database)}.{quote(row['table'])}", measures={"rows": F.count("*")})
        report.append((row["table"], written["rows"]))
    spark.sql(f"ALTER DATABASE {quote(database)} SET DBPROPERTIES ('{LOADED}' = 'true')")
    return spark.createDataFrame(report, "table string, row_count bigint")


def ingest_once(
    spark: SparkSession, directory: str, database: str, location: str | None = None, lapse: float = CLAIM_SECONDS, **options
) -> DataFrame | None:
    """Ingest unless the database is already loaded, and wholly so; None means nothing was done.

    Of loaders at the same time one loads, the others wait for it. If it fails, the next one tries; if it vanished, its
    claim lapses after ``lapse`` seconds.
    """
    if is_loaded(spark, database):
        return None
    create_namespace(spark, database, location)
    with claimed(spark, f"{database_location(spark, database)}/_loading", lapse):
        if is_loaded(spark, database):
            return None
        return ingest_directory(spark, directory, database, location=location, **options)


def is_loaded(spark: SparkSession, database: str) -> bool:
    """Whether an ingest into the database came to its end."""
    if not namespace_exists(spark, database):
        return False
    described = spark.sql(f"DESCRIBE DATABASE EXTENDED {quote(database)}").where("info_name = 'Properties'").first()
    return described is not None and f"({LOADED},true)" in described["info_value"]


@contextmanager
def claimed(spark: SparkSession, path: str, lapse: float = CLAIM_SECONDS, pause: float = 0.5) -> Iterator[None]:
    """Hold a file that one process at a time can create, in a file system where creation is atomic; wait for it to be free.

    A claim older than ``lapse`` seconds belongs to a process that vanished. It is moved away before a new
    one is made; whoever finds that it moved a younger one puts that back.
    """
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = file.getFileSystem(spark._jsc.hadoopConfiguration())

    def age(held) -> float | None:
        found = [s for s in files.globStatus(held) or () if s.isFile()]
        return time.time() - found[0].getModificationTime() / 1000 if found else None

    while not _created(files, file):
        old = age(file)
        if old is None or old <= lapse:
            time.sleep(pause)
            continue
        aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
        if files.rename(file, aside):
            moved = age(aside)
            if moved is not None and moved <= lapse:
                files.rename(aside, file)
            else:
                files.delete(aside, False)
    try:
        yield
    finally:
        files.delete(file, False)


def _created(files, file) -> bool:
    if files.exists(file):
        return False
    try:
        files.create(file, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _parse(field: StructField) -> Column:
    text = F.col(quote(field.name))
    value = F.when(~text.isin(*MISSING), text)
    if isinstance(field.dataType, IntegerType):
        return to_int(value)
    if isinstance(field.dataType, LongType):
        # Not through double, which is exact only up to 2^53.
        return value.cast("decimal(20,1)").cast("bigint")
    return value.cast(field.dataType)
