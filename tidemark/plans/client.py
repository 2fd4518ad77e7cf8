"""A small SQL client: typed binds, column batches, results of statements.

Statements are Spark SQL and are planned by Spark; binds are Spark's own named
parameters, so values never become part of the text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BINDS = 2048
MAX_BATCH_ROWS = 1 << 20


class QueryError(Exception):
    """A statement that failed; kind tells why."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


@dataclass
class ExecResult:
    op: str
    rows_affected: int


@dataclass
class Cursor:
    """One pass over a result in batches; total_rows and batch_seq are known as they come."""

    frame: DataFrame
    tag: str
    batch_rows: int
    total_rows: int = 0
    batch_seq: int = -1
    closed: bool = False
    _read: bool = field(default=False, repr=False)

    def columns(self) -> list[dict]:
        """name, type, decimal scale and column metadata, by position."""
        return [{"name": f.name, "type": f.dataType.simpleString(), "scale": f.dataType.scale if isinstance(f.dataType, T.DecimalType) else None, "metadata": f.metadata} for f in self.frame.schema.fields]

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Arrow batches of batch_rows rows, the last one of what is left.

        Tasks hand their rows over as serialised Arrow batches, partition by
        partition, so no row becomes a Python object.
        """
        if self._read:
            raise QueryError("state", "a cursor is read once")
        self._read = True
        spark, most = self.frame.sparkSession, self.batch_rows

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as writer:
                    writer.write_batch(batch)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch"])

        spark.addTag(self.tag)
        try:
            held: list[pa.Table] = []
            rows = 0
            for (raw,) in self.frame.mapInArrow(packed, "batch binary").toLocalIterator(prefetchPartitions=True):
                if self.closed:
                    return
                held.append(pa.ipc.open_stream(raw).read_all())
                rows += len(held[-1])
                while rows >= most:
                    table = pa.concat_tables(held)
                    yield self._counted(table.slice(0, most))
                    if self.closed:
                        return
                    held, rows = [table.slice(most)], rows - most
            if rows:
                yield self._counted(pa.concat_tables(held))
        except PySparkException:
            if not self.closed:
                raise
        finally:
            spark.removeTag(self.tag)

    def _counted(self, table: pa.Table) -> pa.RecordBatch:
        self.total_rows += len(table)
        self.batch_seq += 1
        return table.combine_chunks().to_batches(max_chunksize=max(1, len(table)))[0]

    def cancel(self) -> None:
        """Stop what runs; the cursor ends without an error."""
        self.closed = True
        self.frame.sparkSession.interruptTag(self.tag)


@dataclass(frozen=True)
class Typed:
    """A bind with its type, NULL included; the type is a Spark SQL type name."""

    value: Any
    kind: str

    def __post_init__(self):
        T.DataType.fromDDL(self.kind)  # an error unless it is the name of a type


#: Text that binds aren't looked for in, or a bind.
_BIND = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|(?<![:\w]):(\w+)", re.S)
_INSERT = re.compile(r"\s*insert\s+into\s+(?:table\s+)?([\w.`]+)\s*(?:\(([^()]*)\)\s*)?((?:select|values|with|table|from)\b.*)", re.I | re.S)


def bound(sql: str, binds: dict[str, Any]) -> tuple[str, dict[str, Any]]:
    """The statement with each typed bind in a cast to its type, and the plain values."""
    kinds = {k: T.DataType.fromDDL(v.kind).simpleString() for k, v in binds.items() if isinstance(v, Typed)}

    def put(m: re.Match) -> str:
        return f"CAST(:{m[1]} AS {kinds[m[1]]})" if m[1] in kinds else m[0]

    return _BIND.sub(put, sql) if kinds else sql, {k: v.value if isinstance(v, Typed) else v for k, v in binds.items()}


class Client:
    """Runs statements in a Spark session."""

    def __init__(self, spark: SparkSession, batch_rows: int = 65_536):
        if not 0 < batch_rows <= MAX_BATCH_ROWS:
            raise ValueError("batch_rows is out of range")
        self.spark, self.batch_rows = spark, batch_rows

    def frame(self, sql: str, binds: dict[str, Any] | None = None) -> DataFrame:
        """The statement as a DataFrame; binds fill ``:name``."""
        if len(binds or {}) > MAX_BINDS:
            raise QueryError("binds", f"more than {MAX_BINDS} binds")
        sql, values = bound(sql, binds or {})
        try:
            return self.spark.sql(sql, args=values)
        except ParseException as e:
            raise QueryError("parse", str(e)) from e
        except AnalysisException as e:
            raise QueryError("analysis", str(e)) from e

    def query(self, sql: str, binds: dict[str, Any] | None = None) -> Cursor:
        return Cursor(self.frame(sql, binds), f"query-{uuid.uuid4().hex}", self.batch_rows)

    def exec(self, sql: str, binds: dict[str, Any] | None = None) -> ExecResult:
        """Run a statement that returns no rows; an INSERT tells how many it added."""
        verb = sql.split(None, 1)[0].lower() if sql.strip() else ""
        if verb in ("select", "with", "show", "describe", "values", "from"):
            raise QueryError("state", "exec takes statements without rows; use query")
        try:
            if verb == "insert" and (m := _INSERT.fullmatch(sql)):
                return ExecResult(verb, self._insert(m[1], m[2], self.frame(m[3], binds)))
            self.frame(sql, binds).collect()
        except PySparkException as e:
            raise QueryError("exec", str(e)) from e
        return ExecResult(verb, 0)

    def _insert(self, table: str, columns: str | None, rows: DataFrame) -> int:
        """Add rows to a table of the session's catalogue, counted as they are written."""
        target = self.spark.table(table).schema.fields
        if columns is not None:
            given = [c.strip().strip("`") for c in columns.split(",")]
            if len(given) != len(rows.columns) or not set(given) <= {f.name for f in target}:
                raise QueryError("analysis", f"columns of {table} and of the rows differ")
            rows = rows.toDF(*given)
            rows = rows.select(*(F.col(f"`{f.name}`").cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in target))
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.insertInto(table)
        return seen.get["n"]


def sequence(spark: SparkSession, n: int) -> DataFrame:
    """x from 1 to n."""
    return spark.range(1, n + 1).toDF("x")
