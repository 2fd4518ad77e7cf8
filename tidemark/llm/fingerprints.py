"""Document fingerprints as invertible Bloom lookup sketches (DataFrame operations only).

A document's set holds the 64-bit digests of its paragraphs (lines, cut at
sentence ends). A sketch hashes each digest into one cell of each of three rows
of cells; a cell keeps the count, the xor of its digests and the xor of their
checks. Two sketches subtract cell by cell, digests in both cancel, and peeling
recovers the rest: a cell that holds one digest, as its check confirms, gives it
up to be taken out of its other cells, until nothing is left. If something is
left, the pair is tried again on more cells under another seed: its digests are
dealt into as many sketches as the sets ask for, at most ``SPLIT``, and only
those that fail again are dealt on, up to ``TRIES`` times.

Likeness is shared over joint digests, from the number recovered.

All of this happens inside a document's row; no cell crosses the network. Texts
do once: the next document is found inside ranges of ids, and the last document
of a range takes the first text of the next range by a join of one row a range.

Null texts count as empty; two empty sets have likeness 1. Null ids come last;
repeated ids follow each other in the order of their text hashes, in ranges of
hashes, so many rows of one id are split; only rows equal in id and text stay in
one range. A single document follows itself. Empty table: empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

#: Cells of each of a sketch's three rows.
ROW = 11
#: Most sketches that a failed one is split into.
SPLIT = 8
#: Digests of both sets, on average, that a sketch of a retry gets.
PART = 12
#: Peeling rounds; each takes out all digests that stand alone in a row of cells.
ROUNDS = 9
#: Retries; digests still open then are compared themselves.
TRIES = 24
#: Documents of a range of ids, more if there would be over MOST_RANGES ranges.
RANGE_DOCS = 2000
MOST_RANGES = 1_000_000
#: Quantiles of the ids that ranges are laid between.
QUANTILES = 128
#: What ends a paragraph.
PARAGRAPH_END = r"(?<=[.!?])\s+|[\r\n]+"


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs."""
    parts = F.filter(F.split(text, PARAGRAPH_END), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(F.trim(p))))


def _check(x: Column) -> Column:
    return F.xxhash64(x, F.lit("check"))


def _cell(n: Column, x: Column, c: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), x.alias("x"), c.alias("c"))


def _cells_of(x: Column, seed: Column) -> Column:
    """The three cells of a digest, one a row, as bits of a number."""
    bits = F.lit(0).cast("long")
    for r in range(3):
        at = F.pmod(F.xxhash64(x, seed * 3 + r), F.lit(ROW)).cast("int") + r * ROW
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return bits


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _summed(cell: Column, digests_: Column, i: Column) -> Column:
    """A cell with the digests that fall into it: structs of n, x, c and the bits of their cells."""
    mine = F.filter(digests_, lambda u: F.getbit(u["at"], i) == 1)
    return F.aggregate(mine, cell, lambda s, u: _cell(s["n"] + u["n"], s["x"].bitwiseXOR(u["x"]), s["c"].bitwiseXOR(u["c"])))


def _counted(keys: Column, seed: Column, sign: int) -> Column:
    return F.transform(keys, lambda x: F.struct(F.lit(sign).alias("n"), x.alias("x"), _check(x).alias("c"), _cells_of(x, seed).alias("at")))


def _sketched(counted: Column) -> Column:
    zero = _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))
    return _let(counted, lambda us: F.transform(F.sequence(F.lit(0), F.lit(3 * ROW - 1)), lambda i: _summed(zero, us, i)))


def sketch(keys: Column) -> Column:
    """The cells of an array of digests, row by row, as the fingerprint shows them."""
    return _sketched(_counted(keys, F.lit(0), 1))


def subtracted(a: Column, b: Column) -> Column:
    """Sketch a less sketch b."""
    return F.zip_with(a, b, lambda p, q: _cell(p["n"] - q["n"], p["x"].bitwiseXOR(q["x"]), p["c"].bitwiseXOR(q["c"])))


def peeled(cells: Column, seed: Column) -> Column:
    """Digests that peeling recovers from a difference of sketches; null if something is left.

    A round looks at one row of cells: there each digest has one cell, so none
    is taken out twice.
    """

    def round_(s: Column, k: Column) -> Column:
        cells = F.slice(s["cells"], k % 3 * ROW + 1, F.lit(ROW))
        pure = F.filter(cells, lambda c: (F.abs(c["n"]) == 1) & (_check(c["x"]) == c["c"]))
        alone = F.transform(pure, lambda c: F.struct((-c["n"]).alias("n"), c["x"].alias("x"), c["c"].alias("c"), _cells_of(c["x"], seed).alias("at")))
        touched = lambda us: F.aggregate(us, F.lit(0).cast("long"), lambda bits, u: bits.bitwiseOR(u["at"]))
        less = lambda us: _let(touched(us), lambda bits: F.transform(s["cells"], lambda c, i: F.when(F.getbit(bits, i) == 0, c).otherwise(_summed(c, us, i))))
        taken = lambda us: F.struct(less(us).alias("cells"), (s["out"] + F.size(us)).alias("out"))
        return _let(alone, lambda us: F.when(F.size(us) == 0, s).otherwise(taken(us)))

    start = F.struct(cells.alias("cells"), F.lit(0).alias("out"))
    end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, round_)
    empty = lambda c: (c["n"] == 0) & (c["x"] == 0) & (c["c"] == 0)
    return _let(end, lambda s: F.when(F.forall(s["cells"], empty), s["out"]))


def differing(a: Column, b: Column, a_cells: Column, b_cells: Column) -> Column:
    """How many digests two sets don't share, from their sketches and, where these fail, larger ones."""

    def unit(left: Column, right: Column, differ: Column) -> Column:
        return F.struct(left.alias("a"), right.alias("b"), differ.cast("int").alias("differ"))

    def split(u: Column, t: Column) -> Column:
        parts = F.least(F.lit(SPLIT), F.greatest(F.lit(2), F.ceil((F.size(u["a"]) + F.size(u["b"])) / PART).cast("int")))
        mine = lambda keys, p, of: F.filter(keys, lambda x: F.pmod(F.xxhash64(x, -t), of) == p)
        dealt = _let(parts, lambda of: F.transform(F.sequence(F.lit(0), of - 1), lambda p: F.struct(mine(u["a"], p, of).alias("a"), mine(u["b"], p, of).alias("b"))))
        # One set counted up and the other down in the same cells: the difference of their sketches.
        both = lambda v: F.concat(_counted(v["a"], t, 1), _counted(v["b"], t, -1))
        return F.transform(dealt, lambda v: unit(v["a"], v["b"], peeled(_sketched(both(v)), t)))

    def again(units: Column, t: Column) -> Column:
        dealt = F.flatten(F.transform(units, lambda u: F.when(u["differ"].isNotNull(), F.array(u)).otherwise(split(u, t))))
        return F.when(F.forall(units, lambda u: u["differ"].isNotNull()), units).otherwise(dealt)

    first = F.array(unit(a, b, peeled(subtracted(a_cells, b_cells), F.lit(0))))
    units = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), first, again)
    plain = lambda u: F.size(F.array_except(u["a"], u["b"])) + F.size(F.array_except(u["b"], u["a"]))
    return F.aggregate(units, F.lit(0), lambda s, u: s + F.coalesce(u["differ"], plain(u)))


def _range(docs: DataFrame, total: int) -> Column:
    """A number for each document's range; ranges follow each other by descending id, null last, then text hash.

    Ids are cut at no more than QUANTILES values, evenly in between. An id that
    spans two quantiles, and the null id, are cut by text hash.
    """
    ranges = -(-total // max(RANGE_DOCS, total // MOST_RANGES)) if total else 1
    levels = min(QUANTILES, ranges)
    found = docs.agg(F.percentile_approx("doc_id", [i / levels for i in range(levels + 1)], 10_000)).first()[0] or []
    cuts, many = sorted(set(found), reverse=True), sorted({c for c in found if found.count(c) > 1 and ranges > 1})
    slots = -(-ranges // levels)
    by_hash = F.floor((F.col("tkey") / F.lit(2.0**64) + 0.5) * ranges).cast("long")
    hot = F.col("doc_id").isNull() | (F.col("doc_id").isin(many) if many else F.lit(False))
    level = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c > F.col("doc_id"))) if cuts else F.lit(0)
    bounds = F.array(*(F.lit(float(c)) for c in cuts))
    high, low = F.get(bounds, F.col("level") - 1), F.get(bounds, F.col("level"))
    slot = F.when(F.col("level") == 0, 0).otherwise(F.least(F.lit(slots - 1), F.floor((high - F.col("doc_id")) / (high - low) * slots)))
    at = F.when(F.col("doc_id").isNull(), F.lit((len(cuts) + 1) * slots)).otherwise(F.col("level") * slots + slot).cast("long")
    return level, at * (ranges + 2) + F.when(hot, by_hash + 1).otherwise(0)


def _edited(text: Column, following: Column) -> Column:
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(following, F.lit(1), cut))


def in_pairs(docs: DataFrame) -> DataFrame:
    """Every document with its own digests, those of its edited text and of the next by descending id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    level, place = _range(docs, docs.count())
    docs = docs.withColumn("tkey", F.xxhash64("text")).withColumn("level", level).withColumn("range", place).drop("level")
    docs = docs.repartition("range").withColumn("keys", digests(F.col("text")))
    order = Window.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), "tkey")
    rows = docs.withColumn("n", F.row_number().over(order)).withColumn("next", F.lead(F.struct("text", "keys")).over(order))

    def judged(text: str, following: str) -> list[Column]:
        edited = _edited(F.col(text), F.col(following))
        return [F.sha2(edited.cast("binary"), 256).alias("edited_sha256"), digests(edited).alias("edited_keys")]

    last = F.col("next").isNull()
    rows = checkpointed(rows.select("range", "doc_id", F.length("text").cast("long").alias("n_chars"), "keys", F.col("next.keys").alias("next_keys"), *(F.when(~last, c).alias(n) for c, n in zip(judged("text", "next.text"), ("edited_sha256", "edited_keys"), strict=True)), F.when(last | (F.col("n") == 1), F.col("text")).alias("text"), (F.col("n") == 1).alias("first"), last.alias("last")))
    heads = rows.filter("first").select(F.col("range").alias("after"), F.col("text").alias("next_text"), F.col("keys").alias("next_keys"))
    each = Window.orderBy("range")
    ranges = rows.filter("last").select("range").withColumn("after", F.coalesce(F.lead("range").over(each), F.min("range").over(Window.partitionBy())))
    ends = rows.filter("last").drop("next_keys").join(ranges, "range").join(heads, "after")
    out = ["doc_id", "n_chars", "keys"]
    return rows.filter("not last").select(*out, "next_keys", "edited_sha256", "edited_keys").unionAll(ends.select(*out, "next_keys", *judged("text", "next_text")))


def as_text(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(".", F.hex(c["n"]), F.hex(c["x"]), F.hex(c["c"]))), "-")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    def likeness(other: str, differ: Column) -> Column:
        both = F.size("keys") + F.size(other)
        return _let(differ, lambda d: F.when(both == 0, 1.0).otherwise((both - d) / (both + d)))

    rows = in_pairs(docs)
    for name in ("keys", "edited_keys", "next_keys"):
        rows = rows.withColumn(f"{name}_cells", sketch(F.col(name)))
    differ = {name: differing(F.col("keys"), F.col(name), F.col("keys_cells"), F.col(f"{name}_cells")) for name in ("edited_keys", "next_keys")}
    rows = rows.select("*", *(d.alias(f"{name}_differ") for name, d in differ.items()))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("keys_cells")).alias("fingerprint"), as_text(F.col("edited_keys_cells")).alias("edited_fingerprint"), *(likeness(name, F.col(f"{name}_differ")).alias(out) for name, out in (("edited_keys", "near_edited"), ("next_keys", "near_next"))))


def op8_iblt_fingerprint(spark, sf_dir):
    return fingerprint_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
