"""Two-pass external shuffle into shards (DataFrame operations only).

Pass one scatters the records uniformly into buckets small enough for memory,
by a seeded hash. Pass two shuffles each bucket by Fisher-Yates, with seeded
draws, and the shuffled buckets laid end to end are cut into shards whose row
counts are at most one apart. The same rows, seed and shard count give the same
result, whatever the partitioning and whichever tasks run twice.

A bucket's permutation is made once per bucket as an array of row numbers; the
records themselves, whole, cross the network once, in the scatter. A swap copies its
bucket's array, so a bucket costs the square of its rows: buckets stay small
(``BUCKET_ROWS`` on average) however many rows there are. Rows with equal keys
would meet in one bucket; where a key has more than ``BUCKET_ROWS`` of them,
they are counted off and scattered by their number too.

Law ``rows`` looks at counts alone: rows of equal texts are dealt out like any
others, to whichever shard and slot their turn gives them; they are neither kept
together nor apart. Null ids and texts are records like any other; rows equal in
all columns may swap places, which can't be seen. An empty table gives an empty
result. Extra columns pass through untouched; a column of the input named like
one that is added is kept under that name and ``_in``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, id_text

#: Rows that a bucket holds on average.
BUCKET_ROWS = 128
#: Buckets whose offsets are summed together before the offsets of such groups.
BUCKET_GROUP = 4096


def _fisher_yates(n: Column, bucket: Column, seed: int) -> Column:
    """A permutation of 0..n-1 drawn by Fisher-Yates; n over 0."""
    draws = F.transform(
        F.when(n > 1, F.sequence(n - 1, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>")),
        lambda i: F.struct(i.cast("int").alias("i"), F.pmod(F.xxhash64(F.lit(seed), bucket, i), i + 1).cast("int").alias("j")),
    )

    def swap(a: Column, x: Column) -> Column:
        i, j = x["i"], x["j"]
        swapped = F.concat(F.slice(a, F.lit(1), j), F.slice(a, i + 1, F.lit(1)), F.slice(a, j + 2, i - j - 1), F.slice(a, j + 1, F.lit(1)), F.slice(a, i + 2, F.size(a)))
        return F.when(i == j, a).otherwise(swapped)

    return F.aggregate(draws, F.sequence(F.lit(0).cast("long"), n - 1), swap)


def _counted_off(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` (row, hash) with piece: 0, but for hashes of more than BUCKET_ROWS rows the hundreds of a row's number.

    Such rows are written once with the task and place they came from, so they
    keep their numbers if a task runs again; numbers run over the tasks.
    """
    if most <= BUCKET_ROWS:
        return rows.withColumn("piece", F.lit(0).cast("long"))
    hot = rows.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > BUCKET_ROWS).select("hash")
    many = checkpointed(rows.join(hot, "hash", "left_semi").withColumns({"task": F.spark_partition_id(), "place": F.monotonically_increasing_id()}))
    sizes = many.groupBy("hash", "task").agg(F.count("*").alias("n"))
    before = sizes.select("hash", "task", (F.sum("n").over(Window.partitionBy("hash").orderBy("task")) - F.col("n")).alias("before"))
    many = many.withColumn("k", F.row_number().over(Window.partitionBy("hash", "task").orderBy("place")) - 1).join(before, ["hash", "task"])
    piece = F.floor((F.col("before") + F.col("k")) / BUCKET_ROWS)
    few = rows.join(hot, "hash", "left_anti").withColumn("piece", F.lit(0).cast("long"))
    return few.unionByName(many.select("row", "hash", piece.alias("piece")))


def shard(rows: DataFrame, shards: int, *, key: list[str], seed: int = 20) -> DataFrame:
    """``rows`` with shard and slot (gapless from 0 in each shard).

    ``key`` names the columns that tell rows apart. The input is read twice
    (counted, then dealt) and must give the same rows both times.
    """
    hashed = F.xxhash64(F.lit(seed), *(id_text(F.col(f"`{k}`")) for k in key))
    renamed = {c: f"{c}_in" if c in ("shard", "slot") else c for c in rows.columns}
    inner = rows.select(F.struct(*(F.col(f"`{c}`").alias(n) for c, n in renamed.items())).alias("row"), hashed.alias("hash"))
    counts = inner.groupBy("hash").agg(F.count("*").alias("n")).agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
    total = counts["total"] or 0
    buckets = max(1, -(-total // BUCKET_ROWS))
    dealt = _counted_off(inner, counts["most"] or 0).withColumn("bucket", F.pmod(F.when(F.col("piece") == 0, F.col("hash")).otherwise(F.xxhash64("hash", "piece")), F.lit(buckets)))
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("group", F.floor(F.col("bucket") / BUCKET_GROUP))
    groups = sizes.groupBy("group").agg(F.sum("n").alias("m"))
    groups = groups.select("group", (F.sum("m").over(Window.orderBy("group")) - F.col("m")).alias("before"))
    inside = Window.partitionBy("group").orderBy("bucket")
    offsets = sizes.withColumn("in", F.sum("n").over(inside) - F.col("n")).join(groups, "group").select("bucket", "n", (F.col("before") + F.col("in")).alias("offset"))
    # A few bytes a bucket, but much work: kept apart in as many tasks as there are shuffle partitions.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan = offsets.repartition(tasks, "bucket").select("bucket", "offset", _fisher_yates(F.col("n"), F.col("bucket"), seed).alias("perm"))
    order = Window.partitionBy("bucket").orderBy(*(F.col(f"row.`{renamed[k]}`") for k in key), F.xxhash64("row"))
    # Permutations take 8 bytes a row: never broadcast.
    placed = dealt.withColumn("k", F.row_number().over(order)).join(plan.hint("merge"), "bucket").withColumn("g", F.col("offset") + F.element_at("perm", F.col("k")))
    placed = placed.withColumn("shard", F.expr(f"int(g * {shards} div {max(1, total)})"))
    start = F.expr(f"(bigint(shard) * {total} + {shards - 1}) div {shards}")
    return placed.select("row.*", "shard", (F.col("g") - start).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write each shard as its own folder, rows in slot order within files."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def sharded_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc (the whole document, all its columns), shard and slot of every document."""
    body = F.coalesce(F.col("text"), F.lit(""))
    record = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    keyed = docs.select(record.alias("doc"), "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    return shard(keyed, shards, key=["doc_id", "size", "text_crc32"]).select("doc", "shard", "slot")


def shard_digests(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, from the documents as they were dealt."""
    body = F.coalesce(F.col("doc.text"), F.lit(""))
    size, crc = (F.octet_length(body) + 1).cast("long"), F.crc32(body.cast("binary"))
    return sharded_documents(docs, shards).select("doc.doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_shard_shuffle(spark, sf_dir):
    return shard_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), 8)
