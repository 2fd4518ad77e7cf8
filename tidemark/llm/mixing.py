"""Mix sources to target weights by Sainte-Lague apportionment.

A mix takes ``share`` of all words. Each source's target follows its weight and
stops at ``cap`` times its size; what is cut off goes to the others by weight.
The mix is dealt in equal blocks of words: shard by shard, sources are awarded
blocks by highest quotients target / (2 k + 1), which gives whole quotas. A
source's documents stand in a seeded order, end to end, cut into blocks, and
its quota goes round them block by block, so that every block is taken
quota / blocks times, rounded down, and the first ones once more. Shards get
the blocks in the order of their awards, the rounds following each other: each
copy of a document goes to the shard that was awarded the block it begins in, so
a source's words in a shard differ from its quota there by less than a block and
a document at either end.

Only counts of words move; everything after the count is exact integer
arithmetic, so reruns agree. The running sum of a source is taken in two steps
(hash prefix, then within it), which splits a source that holds most rows; the
hash is over id and text, so rows of one id, or of none, spread too.

Nulls: a null text has size 0, a null source is a source of its own (the last).
Repeated rows count each. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, checkpointed, id_text, word_count

#: Weights of the sources by code point, repeating.
WEIGHTS = (3, 1, 2)
#: Words of a block. Its size doesn't change the cost.
BLOCK = 32
#: Shards of the mix that get quotas of their own.
SHARDS = 8


def targets(sizes: DataFrame, share: float, cap: int, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """A row for each source: source, source_no, source_size, target.

    With the sources in order of cap / weight, the first whose cap is at or
    above the level that the rest would share is where filling stops.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("source_no", F.row_number().over(in_order) - 1).withColumn("weight", weight).withColumn("most", F.col("source_size") * cap)
    filling = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    rest = by_source.withColumn("used", F.sum("most").over(filling) - F.col("most")).withColumn("weight_left", F.sum("weight").over(Window.partitionBy()) - F.sum("weight").over(filling) + F.col("weight")).withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
    level = (F.col("budget") - F.col("used")) / F.col("weight_left")
    level = rest.withColumn("level", level).withColumn("level", F.max(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))).over(Window.partitionBy()))
    return level.select("source", "source_no", "source_size", F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("most").cast("double"))).alias("target"))


def quotas(goals: DataFrame, block: int, shards: int) -> DataFrame:
    """source_no, shard, upto: blocks awarded to each source up to each shard's end.

    The awards of a house of M blocks are the M highest quotients. All but a few
    near the edge are sure from the proportional share, so only those few are
    ranked: about five for each source and shard.
    """
    whole = Window.partitionBy("shard")
    house = goals.withColumn("all", F.sum("target").over(Window.partitionBy())).withColumn("sources", F.count("*").over(Window.partitionBy())).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    house = house.withColumn("seats", F.floor(F.floor(F.col("all") / block + 0.5) * (F.col("shard") + 1) / shards)).withColumn("part", F.when(F.col("all") > 0, F.col("target") / F.col("all")).otherwise(0.0))
    slack = F.ceil(F.col("part") * F.col("sources") / 2) + 2
    house = house.withColumn("low", F.greatest(F.lit(0).cast("long"), F.floor(F.col("seats") * F.col("part")) - slack)).withColumn("high", F.floor(F.col("seats") * F.col("part")) + slack + 1).withColumn("open", F.col("seats") - F.sum("low").over(whole))
    near = house.withColumn("k", F.explode(F.sequence("low", F.col("high") - 1))).withColumn("quotient", F.col("target") / (2 * F.col("k") + 1))
    rank = F.row_number().over(whole.orderBy(F.col("quotient").desc(), "source_no", "k"))
    return near.withColumn("won", ((rank <= F.col("open")) & (F.col("target") > 0)).cast("long")).groupBy("source_no", "shard").agg((F.first("low") + F.sum("won")).alias("upto"))


def mix(docs: DataFrame, *, share: float = 1.5, cap: int = 2, block: int = BLOCK, shards: int = SHARDS, seed: int = 17, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, shards; taken is rounds whole copies and the first extra words.

    shards has the shard of each copy, the extra words last.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), id_text(F.col("doc_id")), F.lit(":"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))).cast("binary"))
    sizes = checkpointed(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), order.alias("order"), F.xxhash64("text").alias("tkey")).withColumn("prefix", F.substring("order", 1, 3)))
    goals = targets(sizes, share, cap, weights).withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    goals = checkpointed(goals)
    ends = quotas(goals, block, shards).groupBy("source_no").agg(F.sort_array(F.collect_list("upto")).alias("ends"))
    goals = goals.join(ends, "source_no", "left").withColumn("quota", F.least(F.col("blocks") * cap, F.coalesce(F.element_at("ends", -1), F.lit(0).cast("long"))))
    prefixes = sizes.groupBy("source", "prefix").agg(F.sum("size").alias("n"))
    prefixes = prefixes.select(F.col("source").alias("of"), F.col("prefix").alias("at"), (F.sum("n").over(Window.partitionBy("source").orderBy("prefix")) - F.col("n")).alias("before"))
    goals = goals.withColumnRenamed("source", "of")
    inside = Window.partitionBy("source", "prefix").orderBy("order", "doc_id", "size", "tkey").rowsBetween(Window.unboundedPreceding, 0)
    placed = sizes.withColumn("upto", F.sum("size").over(inside)).join(prefixes, F.col("source").eqNullSafe(F.col("of")) & (F.col("prefix") == F.col("at"))).withColumn("start", F.col("before") + F.col("upto") - F.col("size")).drop("of", "at", "before", "upto")
    placed = placed.join(goals, F.col("source").eqNullSafe(F.col("of")))

    rounds = F.expr("quota div greatest(blocks, 1)")
    last = F.expr(f"(quota % greatest(blocks, 1)) * {block}")
    placed = placed.withColumn("rounds", rounds).withColumn("extra", F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), last - F.col("start"))))
    taken = F.col("rounds") * F.col("size") + F.col("extra")
    copies = F.col("rounds") + F.when(F.col("extra") > 0, 1).otherwise(0)
    begins = lambda k: k * F.col("blocks") + F.expr(f"start div {block}")
    shard = lambda k: F.least(F.size(F.filter("ends", lambda e: e <= begins(k))), F.lit(shards - 1))
    dealt = F.when(taken > 0, F.transform(F.sequence(F.lit(0).cast("long"), copies - 1), shard))
    return placed.withColumn("taken", taken).withColumn("shards", dealt).select("doc_id", "source", "tkey", "size", "source_size", "target", "taken", "shards", "rounds", "extra")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with mix_shard: a document as often as it was taken.

    The document that a source's last block ends in comes with its first words
    only, joined by one space, and n_chars to match. Equal rows share a text but
    are taken each by its own place.
    """
    keys = {"__id": F.struct("doc_id", "source"), "__tkey": F.xxhash64("text")}
    placed = mix(docs, **options).select(F.struct("doc_id", "source").alias("__id"), F.col("tkey").alias("__tkey"), "size", "rounds", "extra", "shards").filter("rounds > 0 or extra > 0")
    copies = F.concat(F.array_repeat("size", F.col("rounds").cast("int")), F.when(F.col("extra") > 0, F.array("extra")).otherwise(F.array().cast("array<bigint>")))
    placed = placed.withColumn("__copy", F.explode(F.arrays_zip(copies.alias("words"), F.col("shards").alias("shard"))))
    placed = placed.select("__id", "__tkey", F.col("__copy.words").alias("__words"), F.col("__copy.shard").alias("__shard"), (F.col("__copy.words") < F.col("size")).alias("__part")).filter("__words > 0")
    rows = docs.withColumns(keys)
    columns = docs.columns
    rows = rows.dropDuplicates(["__id", "__tkey"]).join(placed, ["__id", "__tkey"])
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col("__words").cast("int")), " ")
    rows = rows.withColumn("text", F.when(F.col("__part"), cut).otherwise(F.col("text")))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__part"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*columns, F.col("__shard").alias("mix_shard"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, columns unchanged, for a shuffle of their own."""
    rows = mixed_rows(docs, **options)
    return rows.drop("mix_shard") if "mix_shard" not in docs.columns else rows.toDF(*docs.columns, "__shard").drop("__shard")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """A row for each document; mix_shards lists the shards of its copies."""
    return mix(docs, **options).select("doc_id", "size", "source_size", "target", "taken", F.array_join(F.col("shards").cast("array<string>"), ",").alias("mix_shards"))


def op2_sainte_lague_mix(spark, sf_dir):
    return mix_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS ord FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source),
w AS (SELECT *, CASE no % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * 2 AS most FROM s),
f AS (SELECT *, sum(most) OVER o - most AS used, sum(weight) OVER () - sum(weight) OVER o + weight AS wleft, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
  FROM w WINDOW o AS (ORDER BY most / weight, no)),
l AS (SELECT *, (budget - used::DOUBLE) / wleft::DOUBLE AS lev FROM f),
l2 AS (SELECT *, max(CASE WHEN lev <= most / weight THEN lev END) OVER () AS level FROM l),
t AS (SELECT source, no, source_size, least(most::DOUBLE, coalesce(level * weight::DOUBLE, most::DOUBLE)) AS target, (source_size + 31) // 32 AS blocks FROM l2),
a AS (SELECT no, target, blocks, sum(target) OVER () AS whole FROM t),
q0 AS (SELECT no, k, target / (2 * k + 1) AS quotient, whole FROM a, generate_series(0, 2 * blocks) g(k) WHERE target > 0),
q1 AS (SELECT no, k, row_number() OVER (ORDER BY quotient DESC, no, k) AS rk, whole FROM q0),
q AS (SELECT no, count(*) AS won FROM q1 WHERE rk <= floor(whole / 32 + 0.5) GROUP BY no),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.no, t.blocks, least(2 * t.blocks, coalesce(q.won, 0))::HUGEINT AS quota,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS hi
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN q ON q.no = t.no),
x AS (SELECT *, hi - size AS lo, greatest(blocks, 1)::HUGEINT AS n FROM p),
z AS (SELECT *, ((quota // n) * size + greatest(0, least(size, (quota % n) * 32 - lo)))::BIGINT AS taken, lo // 32 AS i0 FROM x),
c AS (SELECT z.doc_id, z.no, z.i0, r, (r * z.n + z.i0)::BIGINT AS k FROM z, generate_series(0, 2) g(r)
  WHERE r < z.quota // z.n AND z.size > 0 OR r = z.quota // z.n AND (z.quota % z.n) * 32 > z.lo AND z.size > 0),
m AS (SELECT c.no, c.i0, c.doc_id, string_agg((SELECT min(sh) FROM generate_series(0, 7) s(sh) WHERE v.rk <= floor(floor(v.whole / 32 + 0.5) * (sh + 1) / 8))::VARCHAR, ',' ORDER BY r) AS mix_shards
  FROM c JOIN q1 v ON v.no = c.no AND v.k = c.k GROUP BY c.no, c.i0, c.doc_id)
SELECT z.doc_id, z.size, z.source_size, z.target, z.taken, m.mix_shards
FROM z LEFT JOIN m ON m.no = z.no AND m.i0 = z.i0 AND m.doc_id IS NOT DISTINCT FROM z.doc_id
"""
