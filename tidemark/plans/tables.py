"""Time-series tables on Parquet: partitions by time, keyed upsert, changes of rows and columns.

A table is a folder of Parquet data and of small state files (data folder,
columns, time unit, keys), of which the newest counts. Rows are added by Spark's
append; a keyed insert or an update rewrites only the time partitions that it
touches, by Spark's dynamic partition overwrite. What changes all rows writes a
new data folder and then its state, and the old folder goes. Adding or dropping
a column writes a state only.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import MAX_BYTES, table_name_ok
from tidemark.operators.ingest import merged, upserted
from tidemark.plans.storage import Files

UNITS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
#: Rows of a file, so that a large partition is written by many tasks and read in pieces.
FILE_ROWS = 5_000_000


@dataclass
class Table:
    spark: SparkSession
    path: str
    timestamp: str
    unit: str = "day"
    keys: tuple[str, ...] = ()

    def __post_init__(self):
        if self.unit not in UNITS:
            raise ValueError(f"no such unit: {self.unit}")
        self.files = Files(self.spark)

    # State

    def _states(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/state") if n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self._states())

    def _state(self) -> dict:
        if not (found := self._states()):
            raise ValueError(f"no table at {self.path}")
        return json.loads(self.files.text(f"{self.path}/state/{found[-1]}.json"))

    def _put(self, folder: str, schema: T.StructType, retired: list[str]) -> None:
        state = {"folder": folder, "schema": json.loads(schema.json()), "retired": retired, "timestamp": self.timestamp, "unit": self.unit, "keys": list(self.keys)}
        self.files.put(f"{self.path}/state/{(self._states() or [0])[-1] + 1}.json", json.dumps(state))

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._state()["schema"])

    # Reading

    def _stored(self) -> DataFrame:
        """All rows with their partition."""
        state = self._state()
        schema = T.StructType.fromJson(state["schema"]).add("__part", T.StringType())
        if not any(n.startswith("__part=") for n in self.files.names(f"{self.path}/{state['folder']}")):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{state['folder']}")

    def read(self) -> DataFrame:
        """The table's rows, in no order; ``ordered`` sorts by the designated timestamp."""
        return self._stored().drop("__part")

    def ordered(self) -> DataFrame:
        return self.read().orderBy(self.timestamp)

    def partitions(self) -> DataFrame:
        """part, n: rows of each time partition."""
        return self._stored().groupBy(F.col("__part").alias("part")).agg(F.count("*").alias("n"))

    # Writing

    def _parted(self, rows: DataFrame) -> DataFrame:
        part = F.date_format(F.date_trunc(self.unit, F.col(self.timestamp)), UNITS[self.unit])
        return rows.withColumn("__part", F.coalesce(part, F.lit("none")))

    def _write(self, rows: DataFrame, folder: str, mode: str) -> None:
        """Rows dealt by partition; Spark splits large partitions over tasks and joins small ones."""
        out = rows.hint("rebalance", F.col("__part"))
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_ROWS).partitionBy("__part").parquet(f"{self.path}/{folder}")

    def _rewrite(self, rows: DataFrame) -> None:
        """All rows anew in another folder."""
        old, folder = self._state()["folder"] if self.exists() else None, f"data-{uuid4().hex}"
        self._write(self._parted(rows), folder, "overwrite")
        self._put(folder, T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]), [])
        if old:
            self.files.drop(f"{self.path}/{old}")

    def create(self, rows: DataFrame, order: str | None = None) -> None:
        """A table of these rows, of none as well; with keys, the last row of each key."""
        if self.exists():
            raise ValueError(f"{self.path} holds a table already")
        self._rewrite(self._last(rows, order))

    def _last(self, rows: DataFrame, order: str | None) -> DataFrame:
        """The last row of each key, by ``order`` or by place in the batch."""
        if not self.keys:
            return rows
        rows = rows.withColumn("__order", F.col(order) if order else F.monotonically_increasing_id())
        return upserted(rows, list(self.keys), "__order").drop("__order")

    def insert(self, rows: DataFrame, order: str | None = None) -> None:
        """Add rows; new columns are backfilled with NULL; with keys, the newest row of a key stays.

        Of rows of one key in a batch the last by ``order`` counts, without one
        the last by place. Keys that have the timestamp touch only the batch's
        time partitions.
        """
        state, known = self._state(), self.schema
        rows = merged(self.spark.createDataFrame([], known), rows)
        if set(rows.columns) - {f.name for f in known.fields}:
            for field in rows.schema.fields:
                if field.name not in known.names:
                    self.add_column(field.name, field.dataType.simpleString())
            state = self._state()
        rows = self._parted(self._last(rows, order))
        if not self.keys:
            self._write(rows, state["folder"], "append")
            return
        rows = rows.persist()
        try:
            stored = self._stored()
            if self.timestamp in self.keys:
                parts = [r[0] for r in rows.select("__part").distinct().collect()]
                stored = stored.filter(F.col("__part").isin(parts)) if parts else stored.limit(0)
                both = stored.withColumn("__new", F.lit(0)).unionByName(rows.withColumn("__new", F.lit(1)))
                self._write(upserted(both, list(self.keys), "__new").drop("__new"), state["folder"], "overwrite")
            else:
                both = stored.withColumn("__new", F.lit(0)).unionByName(rows.withColumn("__new", F.lit(1)))
                self._rewrite(upserted(both, list(self.keys), "__new").drop("__new", "__part"))
        finally:
            rows.unpersist()

    def update(self, changes: dict[str, Column], where: Column) -> int:
        """Set columns where a condition holds; returns the number of rows."""
        stored, kinds = self._stored(), dict(self._stored().dtypes)
        touched = {r["__part"]: r["n"] for r in stored.filter(where).groupBy("__part").agg(F.count("*").alias("n")).collect()}
        changed = lambda rows: rows.withColumns({c: F.when(where, v).otherwise(F.col(c)).cast(kinds[c]) for c, v in changes.items()})
        if self.timestamp in changes:
            self._rewrite(changed(stored.drop("__part")))
        elif touched:
            self._write(changed(stored.filter(F.col("__part").isin(list(touched)))), self._state()["folder"], "overwrite")
        return sum(touched.values())

    # Columns

    def add_column(self, name: str, kind: str) -> None:
        """A column of NULLs."""
        state, schema = self._state(), self.schema
        if name.casefold() in (c.casefold() for c in schema.names):
            raise ValueError(f"{name} exists")
        if name in state["retired"]:
            self._rewrite(self.read())  # the dropped column's values go for good
            state = self._state()
        self._put(state["folder"], schema.add(name, T.DataType.fromDDL(kind)), state["retired"])

    def drop_column(self, name: str) -> None:
        """The column is read no longer; its values go with the next rewrite."""
        if name == self.timestamp or name in self.keys:
            raise ValueError(f"{name} can't be dropped")
        state, schema = self._state(), self.schema
        if name not in schema.names:
            raise ValueError(f"no column {name}")
        self._put(state["folder"], T.StructType([f for f in schema.fields if f.name != name]), [*state["retired"], name])

    def change_type(self, name: str, kind: str) -> None:
        """Cast a column; timestamps become microseconds where a number is asked for."""
        rows = self.read()
        column = F.unix_micros(F.col(name).cast("timestamp")) if dict(rows.dtypes)[name].startswith("timestamp") and kind == "bigint" else F.col(name).cast(kind)
        self._rewrite(rows.withColumn(name, column))

    # Whole tables

    def truncate(self) -> None:
        self._rewrite(self.spark.createDataFrame([], self.schema))

    def drop(self) -> None:
        self.files.drop(self.path)

    def rename(self, path: str) -> Table:
        self.files.move(self.path, path)
        return Table(self.spark, path, self.timestamp, self.unit, self.keys)


@dataclass
class Database:
    """Tables under one folder, by name."""

    spark: SparkSession
    path: str

    def tables(self) -> list[str]:
        return [n for n in Files(self.spark).names(self.path) if self.open(n) is not None]

    def open(self, name: str) -> Table | None:
        files, path = Files(self.spark), f"{self.path}/{name}"
        states = sorted(int(n[:-5]) for n in files.names(f"{path}/state") if n.endswith(".json"))
        if not states:
            return None
        state = json.loads(files.text(f"{path}/state/{states[-1]}.json"))
        return Table(self.spark, path, state["timestamp"], state["unit"], tuple(state["keys"]))

    def __getitem__(self, name: str) -> Table:
        if (table := self.open(name)) is None:
            raise KeyError(name)
        return table

    def create(self, name: str, rows: DataFrame, timestamp: str, unit: str = "day", keys: tuple[str, ...] = ()) -> Table:
        """A table of a DataFrame's columns and rows (of a query's result, or of none)."""
        if not name or len(name.encode()) > MAX_BYTES or not self.spark.range(1).select(table_name_ok(F.lit(name))).first()[0]:
            raise ValueError(f"not a table name: {name}")
        table = Table(self.spark, f"{self.path}/{name}", timestamp, unit, keys)
        table.create(rows)
        return table

    def drop(self, name: str, if_exists: bool = False) -> None:
        if (table := self.open(name)) is not None:
            table.drop()
        elif not if_exists:
            raise KeyError(name)

    def rename(self, name: str, to: str) -> Table:
        return self[name].rename(f"{self.path}/{to}")

    def columns(self, name: str) -> DataFrame:
        """position, name, type and whether it is the designated timestamp or a key."""
        table = self[name]
        rows = [(i, f.name, f.dataType.simpleString(), f.name == table.timestamp, f.name in table.keys) for i, f in enumerate(table.schema.fields)]
        return self.spark.createDataFrame(rows, "position int, name string, type string, designated boolean, key boolean")

    def view(self, *names: str) -> None:
        """Make tables readable in statements, under their names."""
        for name in names:
            self[name].read().createOrReplaceTempView(name)

    def sink(self, name: str) -> Callable[[DataFrame], None]:
        return lambda rows: self[name].insert(rows)
