"""Row operators of ingest as DataFrame steps: merge, batch, reject, upsert, encode."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def folded(df: DataFrame, known: dict[str, str]) -> DataFrame:
    """Columns renamed to the casing first seen; names compare by Unicode case folding."""
    names = [known.setdefault(c.casefold(), c) for c in df.columns]
    if len({n.casefold() for n in names}) < len(names):
        raise ValueError("a column is given twice")
    return df.toDF(*names)


def merged(*batches: DataFrame) -> DataFrame:
    """Batches of one table under the union of their columns; what a batch lacks is NULL.

    A column that two batches type differently is an error, as types are fixed
    by first use.
    """
    known: dict[str, str] = {}
    frames = [folded(b, known) for b in batches]
    types: dict[str, str] = {}
    for f in frames:
        for name, kind in f.dtypes:
            if types.setdefault(name, kind) != kind:
                raise TypeError(f"{name} is {types[name]}, then {kind}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_rejects(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the first failed check); a row is taken or left as a whole."""
    failed = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()))
    marked = rows.withColumn("rejected_by", failed)
    return marked.filter("rejected_by is null").drop("rejected_by"), marked.filter("rejected_by is not null")


def upserted(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row by ``order`` for each key; a NULL order comes first.

    An aggregate, so each task sends on one row a key, however hot the key is.
    """
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*(F.col(f"`{c}`") for c in rest)), F.struct(F.col(f"`{order}`")))
    return rows.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(last.alias("__last")).select(*(F.col(f"`{c}`") if c in keys else F.col(f"__last.`{c}`") for c in rows.columns))


def numbered(rows: DataFrame, by: str, width: int = 1_000_000) -> DataFrame:
    """Rows with row_no from 0 in the order of a whole-number column with distinct values.

    Numbers are given inside value ranges, then shifted by the ranges before, so
    no task sees all rows.
    """
    rows = rows.withColumn("__range", F.floor(F.col(by) / width))
    sizes = rows.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    inside = Window.partitionBy("__range").orderBy(by)
    return rows.withColumn("__k", F.row_number().over(inside) - 1).join(before, "__range").withColumn("row_no", F.col("__before") + F.col("__k")).drop("__range", "__k", "__before")


def flush_batches(rows: DataFrame, by: str, batch_rows: int) -> DataFrame:
    """Rows with the batch that a flush after every ``batch_rows`` rows puts them in."""
    return numbered(rows, by).withColumn("batch", F.floor(F.col("row_no") / batch_rows)).drop("row_no")


def symbol_ids(rows: DataFrame, symbol: str, by: str) -> DataFrame:
    """symbol, symbol_id: dense ids in order of first appearance; ranks distinct symbols only."""
    first = rows.filter(F.col(symbol).isNotNull()).groupBy(symbol).agg(F.min(by).alias("first_seen"))
    return first.withColumn("symbol_id", (F.row_number().over(Window.orderBy("first_seen")) - 1).cast("bigint"))


def symbol_deltas(batches: DataFrame, symbol: str) -> DataFrame:
    """batch, new_symbols: symbols that each batch adds to the dictionary."""
    first = batches.filter(F.col(symbol).isNotNull()).groupBy(symbol).agg(F.min("batch").alias("batch"))
    return first.groupBy("batch").agg(F.count("*").alias("new_symbols"))


def gorilla_bytes(rows: DataFrame, series: str, ts: Column, by: str) -> DataFrame:
    """Per series, rows and the bytes of its timestamps as delta-of-delta; -1 if that can't hold them.

    The first two values take 8 bytes each. Fixed values: 1, 9, 12, 16 and 36
    bits for a second difference of 0, within -64..63, -256..255, -2048..2047,
    and within 32 bits.
    """
    w = Window.partitionBy(series).orderBy(by)
    d = rows.select(series, by, ts.alias("t")).withColumn("d", F.col("t") - F.lag("t").over(w))
    d = d.withColumn("dd", F.col("d") - F.lag("d").over(w))
    bits = F.lit(36)
    for size, low, high in ((16, -2048, 2047), (12, -256, 255), (9, -64, 63), (1, 0, 0)):
        bits = F.when(F.col("dd").between(low, high), size).otherwise(bits)
    held = F.max(F.coalesce(~F.col("dd").between(-(1 << 31), (1 << 31) - 1), F.lit(False)))
    total = 8 * F.least(F.count("*"), F.lit(2)) + F.ceil(F.coalesce(F.sum(F.when(F.col("dd").isNotNull(), bits)), F.lit(0)) / 8)
    return d.groupBy(series).agg(F.count("*").alias("points"), F.when(held, -1).otherwise(total).cast("bigint").alias("bytes"))


def flushes(rows: DataFrame, producer: str, order: str, size: str, at: str, *, most_rows: int, most_bytes: int, interval: int) -> DataFrame:
    """``rows`` with the flush that each producer's triggers put them in.

    A flush follows the row that brings the pending ones to ``most_rows`` rows or
    ``most_bytes`` bytes, or that comes ``interval`` or more after the first
    pending one. Each producer's rows pass one task in order, batch by batch;
    only its pending counts are held.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, flush, n, held, since = object(), 0, 0, 0, 0
        for batch in batches:
            out = []
            for p, b, t in zip(*(batch.column(c).to_pylist() for c in (producer, size, at)), strict=True):
                if p != who:
                    who, flush, n = p, 0, 0
                if not n:
                    held, since = 0, t
                n, held = n + 1, held + (b or 0)
                out.append(flush)
                if n >= most_rows or held >= most_bytes or t - since >= interval:
                    flush, n = flush + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, "flush"])

    schema = T.StructType([*rows.schema.fields, T.StructField("flush", T.LongType())])
    return rows.repartition(producer).sortWithinPartitions(producer, order).mapInArrow(work, schema)


def frames(rows: DataFrame, batch: str, table: str, size: str, cap: int) -> DataFrame:
    """batch, table, rows, bytes, frame: how a batch of several tables is sent under a size limit.

    A batch that fits goes as one frame ('whole'); else each table goes alone
    ('split'), and only the tables that are too large themselves are left out
    ('dropped').
    """
    sums = rows.groupBy(batch, table).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))
    whole = F.sum("bytes").over(Window.partitionBy(batch)) <= cap
    return sums.withColumn("frame", F.when(whole, "whole").when(F.col("bytes") <= cap, "split").otherwise("dropped"))


def stamped(rows: DataFrame, timestamp: str) -> DataFrame:
    """Rows whose designated timestamp, where they have none, is the time of writing."""
    if timestamp not in rows.columns:
        return rows.withColumn(timestamp, F.current_timestamp())
    return rows.withColumn(timestamp, F.coalesce(F.col(timestamp), F.current_timestamp().cast(rows.schema[timestamp].dataType)))
