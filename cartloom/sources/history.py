"""Storage of a type-2 history that grows by rounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartloom.operators.scd2 import HISTORY_COLUMNS, scd2_changes, scd2_new_versions, scd2_start
from cartloom.session import stored
from cartloom.sources.tables import quote

# Property of the stored versions: the last complete round.
ROUND = "cartloom.round"
# Columns of the stored versions that readers don't see.
INNER_COLUMNS = ("round", "state", "bucket")


class HistoryTable:
    """A history kept in a table partitioned by round and state, read through a view.

    A round writes one new partition: the versions it closed and the versions open after it.
    Older closed versions are never read or rewritten, so a round costs what the keys cost and
    not what the history has grown to. A property of the stored table names the last complete round, the view shows it;
    a round that dies half-way leaves readers on the old one and is written again from the start. A lost
    view is made anew.
    """

    def __init__(self, spark: SparkSession, database: str, name: str, key: str, updated_at: str):
        self.spark, self.key, self.updated_at = spark, key, updated_at
        self.view = f"{quote(database)}.{quote(name)}"
        self.store = f"{quote(database)}.{quote(name + '_versions')}"

    def round(self) -> int:
        """Number of the last complete round, 0 before the first. It is kept with the stored versions."""
        if not self.spark.catalog.tableExists(self.store):
            return 0
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.store}").where(F.col("key") == ROUND).first()
        return int(found["value"]) if found else 0

    def read(self) -> DataFrame:
        if not self.spark.catalog.tableExists(self.view) and self.round():
            self._show(self.round())
        return self.spark.table(self.view)

    def apply(self, current: DataFrame) -> DataFrame:
        """Take in the present state of all keys and return the new history.

        Columns go by name. A new column is NULL in versions that are closed or unchanged; a missing one raises.
        """
        done = self.round()
        if done:
            self._add_columns(current)
            last = f"round = {done} AND state = 'open'"
            stored = self.spark.table(self.store).where(last).drop("round", "state")
            versions = scd2_changes(stored, current, self.key, self.updated_at)
        else:
            # Without a complete round the store is what a first try has left.
            self.spark.sql(f"DROP TABLE IF EXISTS {self.store}")
            versions = scd2_start(current, self.key, self.updated_at)
        state = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
        rows = versions.select("*", F.lit(done + 1).alias("round"), state.alias("state"))
        if done:
            # What an unfinished earlier try of this round may have written.
            self._drop(done + 1, "open")
            self._drop(done + 1, "closed")
            rows.select(*map(quote, self.spark.table(self.store).columns)).write.insertInto(self.store)
        else:
            rows.write.partitionBy("round", "state").saveAsTable(self.store)
        self.spark.sql(f"ALTER TABLE {self.store} SET TBLPROPERTIES ('{ROUND}' = '{done + 1}')")
        self._show(done + 1)
        # The round before may still have readers; the one before that is past use.
        if done > 1:
            self._drop(done - 1, "open")
        return self.read()

    def _add_columns(self, current: DataFrame) -> None:
        known = [c for c in self.spark.table(self.store).columns if c not in (*HISTORY_COLUMNS, *INNER_COLUMNS)]
        missing = [c for c in known if c not in current.columns]
        if missing:
            raise ValueError(f"the present state lacks {', '.join(missing)}")
        added = [f for f in current.schema.fields if f.name not in known]
        if added:
            listed = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in added)
            for table in self._tables():
                # What an unfinished try has added is there already.
                if not {f.name for f in added} <= set(self.spark.table(table).columns):
                    self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")

    def _tables(self) -> list[str]:
        return [self.store]

    def _show(self, number: int) -> None:
        """Let the view show the history after a round: one catalog call."""
        columns = [c for c in self.spark.table(self.store).columns if c not in ("round", "state")]
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.view} AS SELECT {', '.join(map(quote, columns))} FROM {self.store} "
            f"WHERE round <= {number} AND (state = 'closed' OR round = {number})"
        )

    def _drop(self, number: int, state: str) -> None:
        partition = f"round = {number}, state = '{state}'"
        self.spark.sql(f"ALTER TABLE {self.store} DROP IF EXISTS PARTITION ({partition})")


class BucketedHistoryTable(HistoryTable):
    """A history whose open versions lie in hash buckets of the key: a round writes only the buckets in which something changed.

    The present state is brought to the buckets and joined there; the stored side is read as it lies, without a shuffle. What
    comes out of that join are the changes alone. They close versions in a table of closed ones, a partition a round, and
    only buckets with a change are written again, one file each; all others keep their files, from whichever round.
    A bucket is read by one task: choose ``buckets`` by the size of the open versions, about bytes / 256 MB.
    """

    def __init__(self, spark: SparkSession, database: str, name: str, key: str, updated_at: str, buckets: int):
        super().__init__(spark, database, name, key, updated_at)
        self.open, self.buckets = f"{quote(database)}.{quote(name + '_open')}", buckets

    def apply(self, current: DataFrame) -> DataFrame:
        """Take in the present state of all keys and return the new history; columns as in ``HistoryTable``."""
        done = self.round()
        if done:
            self._add_columns(current)
            self._forget(lambda number, _: number > done)
            latest = self.latest(done)
            changes = stored(self.changes(latest, current))
            closed = changes.where("old IS NOT NULL").select("old.*", F.lit(done + 1).alias("round"))
            closed.select(*map(quote, self.spark.table(self.store).columns)).write.insertInto(self.store)
            touched = [r["bucket"] for r in changes.select(self._bucket()).distinct().collect()]  # as many as buckets
            if touched:
                rows = self.reopened({b: r for b, r in latest.items() if b in touched}, changes)
                rows = rows.select("*", F.lit(done + 1).alias("round"), self._bucket())
                rows.select(*map(quote, self.spark.table(self.open).columns)).write.insertInto(self.open)
        else:
            for table in self._tables():
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            versions = scd2_start(current, self.key, self.updated_at).select("*", F.lit(1).alias("round"))
            versions.limit(0).write.partitionBy("round").saveAsTable(self.store)
            rows = versions.select("*", self._bucket()).repartition(self.buckets, self.key)
            rows.write.partitionBy("round", "bucket").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.open)
        self.spark.sql(f"ALTER TABLE {self.store} SET TBLPROPERTIES ('{ROUND}' = '{done + 1}')")
        self._show(done + 1)
        # A bucket's round before may still have readers if it was shown until now; earlier ones are past use.
        before = self.latest(done)
        latest = self.latest(done + 1)
        self._forget(lambda number, bucket: bucket is not None and number not in (before.get(bucket), latest.get(bucket)))
        return self.read()

    def latest(self, number: int) -> dict[int, int]:
        """The round that wrote each bucket last, up to round ``number``."""
        found: dict[int, int] = {}
        for spec in self._partitions(self.open):
            if spec["round"] <= number:
                found[spec["bucket"]] = max(found.get(spec["bucket"], 0), spec["round"])
        return found

    def open_versions(self, latest: dict[int, int]) -> DataFrame:
        """The open versions of some buckets, as they lie."""
        return self.spark.table(self.open).where(self._shown(latest)).drop("round", "bucket")

    def changes(self, latest: dict[int, int], current: DataFrame) -> DataFrame:
        return scd2_new_versions(self.open_versions(latest), current, self.key, self.updated_at)

    def reopened(self, latest: dict[int, int], changes: DataFrame) -> DataFrame:
        """The open versions of buckets with a change after it, in the buckets of the stored ones."""
        old = self.open_versions(latest)
        columns = old.columns
        old = old.select(F.col(self.key), F.struct(*map(quote, columns)).alias("old"))
        # The new versions may have their columns in another order.
        new = changes.select(self.key, F.struct(*[F.col(f"new.{quote(c)}") for c in columns]).alias("new"))
        return old.join(new, self.key, "full_outer").select(F.coalesce("new", "old").alias("v")).select("v.*")

    def _bucket(self) -> Column:
        # The hash by which Spark deals rows to buckets, so that each partition holds one bucket.
        return F.pmod(F.hash(self.key), F.lit(self.buckets)).alias("bucket")

    def _tables(self) -> list[str]:
        return [self.store, self.open]

    def _shown(self, latest: dict[int, int]) -> str:
        rounds: dict[int, list[int]] = {}
        for bucket, number in latest.items():
            rounds.setdefault(number, []).append(bucket)
        terms = [f"(round = {n} AND bucket IN ({', '.join(map(str, sorted(b)))}))" for n, b in sorted(rounds.items())]
        return " OR ".join(terms) or "false"

    def _show(self, number: int) -> None:
        """Let the view show the history after a round: one catalog call."""
        columns = [c for c in self.spark.table(self.store).columns if c not in INNER_COLUMNS]
        listed = ", ".join(map(quote, columns))
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.view} AS SELECT {listed} FROM {self.store} WHERE round <= {number} "
            f"UNION ALL SELECT {listed} FROM {self.open} WHERE {self._shown(self.latest(number))}"
        )

    def _partitions(self, table: str) -> list[dict[str, int]]:
        rows = self.spark.sql(f"SHOW PARTITIONS {table}").collect()
        return [{k: int(v) for k, v in (part.split("=") for part in r["partition"].split("/"))} for r in rows]

    def _forget(self, is_past: Callable[[int, int | None], bool]) -> None:
        for table in self._tables():
            past = [s for s in self._partitions(table) if is_past(s["round"], s.get("bucket"))]
            if past:
                specs = ", ".join("PARTITION (" + ", ".join(f"{k} = {v}" for k, v in s.items()) + ")" for s in past)
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
