"""Streaming ingest: landed files to a keyed table, bad rows to a dead-letter folder.

Delivery is at least once; with keys, a batch that comes again changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ingest import split_rejects
from tidemark.plans.tables import Database, Table

# Status code, category, whether the writer stops.
STATUS = ((3, "schema_mismatch", False), (5, "parse_error", True), (6, "internal_error", True), (8, "security_error", True), (9, "write_error", False))
#: HTTP statuses after which a write is tried again.
RETRIED = (500, 503, 504, 507, 509, 523, 524, 529, 599)
#: Close codes that end a connection for good.
TERMINAL = (1002, 1003, 1007, 1008, 1009, 1010)


def category(status: Column) -> Column:
    out = F.lit("unknown")
    for code, name, _ in STATUS:
        out = F.when(status == code, name).otherwise(out)
    return out


def halts(status: Column) -> Column:
    """Unknown statuses always stop the writer."""
    out = F.lit(True)
    for code, _, stop in STATUS:
        out = F.when(status == code, F.lit(stop)).otherwise(out)
    return out


def retryable(status: Column) -> Column:
    """Whether a write is tried again after an HTTP status."""
    return F.coalesce(status.isin(*RETRIED), F.lit(False))


def terminal(code: Column) -> Column:
    """Whether a close code ends a connection for good."""
    return F.coalesce(code.isin(*TERMINAL), F.lit(False))


@dataclass
class Counters:
    """What an ingest has done so far."""

    batches: int = 0
    rows: int = 0
    rejected: int = 0
    replays: int = 0
    last_batch: int = -1


class Halted(Exception):
    """A rejected row of a kind after which nothing more is written."""


def ingest(stream: DataFrame, table: Table, checks: dict[str, Column], *, checkpoint: str, dead_letters: str, halting: tuple[str, ...] = (), counters: Counters | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Write a stream into a table batch by batch; rows that fail a check become dead letters.

    A dead letter is the row, the check it failed (rejected_by), a message and
    the span of batches it came in. A batch's dead letters overwrite those of an
    earlier try of the same batch. Checks named in ``halting`` stop the stream
    once the batch's dead letters are written, before its rows are.
    """
    counts = counters or Counters()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_rejects(batch, checks)
            lost = {r["rejected_by"]: r["n"] for r in bad.groupBy("rejected_by").agg(F.count("*").alias("n")).collect()}
            bad = bad.withColumns({"message": F.concat(F.lit("the row fails the check "), "rejected_by"), "from_batch": F.lit(batch_id), "to_batch": F.lit(batch_id)})
            bad.write.mode("overwrite").parquet(f"{dead_letters}/batch={batch_id}")
            if stopping := sorted(set(lost) & set(halting)):
                raise Halted(f"batch {batch_id} has rows that stop the stream: {', '.join(stopping)}")
            table.insert(good) if table.exists() else table.create(good)
            counts.batches, counts.rows, counts.rejected = counts.batches + 1, counts.rows + good.count(), counts.rejected + sum(lost.values())
            counts.replays += batch_id <= counts.last_batch
            counts.last_batch = max(counts.last_batch, batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def ingest_tables(stream: DataFrame, name: str, database: Database, timestamp: str, *, checkpoint: str, keys: tuple[str, ...] = (), unit: str = "day", trigger: dict | None = None) -> StreamingQuery:
    """Write a stream of rows of several tables, named by a column, each to its table, created at need."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for (table,) in batch.select(name).filter(F.col(name).isNotNull()).distinct().collect():
                rows = batch.filter(F.col(name) == table).drop(name)
                if (known := database.open(table)) is not None:
                    known.insert(rows)
                else:
                    database.create(table, rows, timestamp, unit, keys)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def late_windows(stream: DataFrame, ts: str, delay: str, width: str, value: str) -> DataFrame:
    """Count and sum per time window; rows later than ``delay`` are dropped by the watermark."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, width)).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), "n", "total")
