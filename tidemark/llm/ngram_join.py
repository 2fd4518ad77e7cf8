"""N-gram Jaccard self-join by PartEnum signatures.

A document's set holds its distinct word shingles. Sets of equal text collapse
into one class first. Sizes are cut into bands; within a band a Jaccard
threshold is a bound k on the number of differing shingles. The shingle domain
is hashed into k / 2 + 1 parts, and some spare ones, of three sub-parts: two sets that
differ in at most k shingles differ in at most one in every part but k / 2, so
they agree on two of the three sub-parts there. Each part's three pairs of
sub-parts are the signatures, and sets that are similar enough share one, surely.

A signature over no shingle at all would be shared by strangers. It isn't used:
if a set has such ones in no more parts than are spare, a part without any is
left for each of its pairs. A set that has more takes part in a further
partition by another seed, up to the last one, where such signatures count too,
so no pair is lost.

Classes that share a signature are compared by parity sketches, whose distance
never exceeds the true one, so a rejection is sure. What passes is verified on
the sets themselves, in two rounds: first a spanning forest of the best pairs of
each bucket, then the pairs that are still not connected. A pair that meets in
several buckets is looked at in the largest of either only. Large buckets are
cut into chunks. In the first round a chunk meets a few hubs of its bucket,
which gives as many pairs as members. In the second, chunks of a bucket that
still holds several components meet in separate tasks, but for those whose
members are connected already. Where a bucket has so many chunks that this would
take many times the rows, it is dealt out by prefixes instead: of each set's
shingles in one order of all, the first ones, so many that two sets without a
common one can't be similar enough. Members meet where they share one; strangers
that only share a signature, as very short texts do, don't. Either way finds all
pairs.

Nulls, empty texts and texts without words have an empty set and link to
nothing; fewer words than a shingle make one shingle. Rows with equal ids or
null ids are documents of their own; component_id is the least non-null id
(null if there is none). Extra columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, checkpointed, released, written
from tidemark.llm.components import components
from tidemark.llm.wordhash import Run, mix, word_runs

#: Ratio of the ends of a size band.
BAND = 1.4
#: Partitions tried by sets with empty signatures.
SEEDS = 4
#: Parts are added until the spare ones outnumber, by so many standard deviations,
#: the parts where the smallest sets of a band are expected to have an empty
#: signature. With 0, sets make the fewest signatures over all partitions.
SPARE = 0.0
#: Bits of a parity sketch for each shingle that two sets may differ by; with 32,
#: pairs that differ by a twentieth more than allowed are rejected.
SKETCH_BITS = 32
#: Members of a bucket's chunk; two chunks meet in one task.
CHUNK = 256
#: A bucket is dealt out by prefixes if that makes so many times fewer rows than chunks can meet.
PREFIX_GAIN = 16
#: Members of a large bucket, on average, that every chunk of it is held against.
HUBS = 16

_bands = [1]
while _bands[-1] < 1 << 40:
    _bands.append(max(_bands[-1] + 1, int(_bands[-1] * BAND)))
_BANDS = np.array(_bands, np.int64)
#: Stands for a null id where texts are fetched.
NO_ID = -(1 << 63)
SKETCHED = "doc_id bigint, tkey bigint, n_shingles bigint, class bigint, sketch binary"


def most_differing(n: int, percent: int) -> int:
    """Of two sets with n shingles together: how many may be in one only."""
    return n - 2 * -(-percent * n // (100 + percent))


def shingles(run: Run, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row of the batch, sorted distinct shingles) for every text of a run."""
    h, k = run.hashes, np.uint64(0x9E3779B97F4A7C15)
    total = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for i in range(size if len(total) else 0):
        total = total * k + h[i : len(h) - size + 1 + i]
    total = mix(total)
    for t in range(len(run.bounds) - 1):
        at, to = int(run.upto[t]), int(run.upto[t + 1])
        if to - at >= size:
            yield run.first + t, np.unique(total[at : to - size + 1])
        elif to > at:
            yield run.first + t, mix(np.array([reduce(lambda x, y: (x * int(k) + int(y)) % (1 << 64), h[at:to], to - at)], np.uint64))
        else:
            yield run.first + t, h[:0]


@cache
def domain(band: int, percent: int) -> tuple[int, int, int]:
    """(parts, spare ones among them, sub-parts of each) of a size band."""
    both = 2 * (_bands[band + 1] - 1)
    k = max(most_differing(both, percent), most_differing(both - 1, percent))  # grows by steps of two, so the largest is among the last even and odd totals
    if k == 0:
        return 1, 0, 1
    needed, least, spare = k // 2 + 1, percent * _bands[band] / 100, 0
    while spare < needed:
        parts = needed + spare
        empty = parts * min(1.0, 3 * float(np.exp(-2 * least / (3 * parts))))
        if spare >= empty + SPARE * empty**0.5:
            break
        spare += 1 + needed // 64
    return needed + spare, spare, 3


def signatures(found: np.ndarray, percent: int) -> np.ndarray:
    """PartEnum signatures of a set of shingles."""
    n, out = len(found), []
    band = int(np.searchsorted(_BANDS, n, "right")) - 1
    weights = mix(found ^ np.uint64(0x5851F42D4C957F2D))
    for b in (band, band + 1):
        if b > band and 100 * n < percent * _bands[b]:
            continue  # too small for any set of the next band
        parts, spare, subs = domain(b, percent)
        for seed in range(SEEDS):
            cell = (mix(found + np.uint64(seed * 1009 + 1)) % np.uint64(parts * subs)).astype(np.int64)
            sums = np.zeros(parts * subs, np.uint64)
            np.add.at(sums, cell, weights)
            held = np.bincount(cell, minlength=parts * subs).reshape(parts, subs)
            sums = sums.reshape(parts, subs)
            if subs == 3:
                sums, held = sums[:, [0, 0, 1]] + sums[:, [1, 2, 2]], held[:, [0, 0, 1]] + held[:, [1, 2, 2]]
            label = mix(np.arange(sums.size, dtype=np.uint64) + np.uint64((b * SEEDS + seed) << 40))
            made = mix(sums.ravel() + label)
            full = held.ravel() > 0
            out.append(made if seed == SEEDS - 1 else made[full])
            if np.count_nonzero((held == 0).any(axis=1)) <= spare:
                break
    return np.concatenate(out)


def sketch(found: np.ndarray, percent: int) -> bytes:
    """Parities of the set's shingles hashed to bits, at least SKETCH_BITS for each that may differ."""
    band = int(np.searchsorted(_BANDS, len(found), "right")) - 1
    bits = 64
    while bits < SKETCH_BITS * most_differing(2 * _bands[band + 1], percent):
        bits *= 2
    return np.packbits((np.bincount((mix(found) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def class_of(found: np.ndarray) -> int | None:
    """One number for equal sets; null for the empty set."""
    return int(_signed(mix(np.array([int(mix(found).sum()) ^ len(found)], np.uint64)))[0]) if len(found) else None


def sketched(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """A row for each document: its class (equal sets, equal class) and sketch.

    Of equal sets in one batch only the first carries a sketch.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, classes, sketches, seen = [], [], [], {None}
            for run in word_runs(batch.column(2), fold=True):
                for _, found in shingles(run, size):
                    n.append(len(found))
                    classes.append(class_of(found))
                    sketches.append(None if classes[-1] in seen else sketch(found, percent))
                    seen.add(classes[-1])
            columns = (pa.array(n, pa.int64()), pa.array(classes, pa.int64()), pa.array(sketches, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "tkey", "n_shingles", "class", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text").mapInArrow(work, SKETCHED)


def signed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(class, sig): the signatures of every set, once for equal sets in one batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int | None] = {None}
            for run in word_runs(batch.column(0), fold=True):
                classes, sigs = [], []
                for _, found in shingles(run, size):
                    if (key := class_of(found)) not in seen:
                        seen.add(key)
                        classes.append(key)
                        sigs.append(_signed(signatures(found, percent)))
                if sigs:
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(classes, np.int64), [len(x) for x in sigs])), pa.array(np.concatenate(sigs))], ["class", "sig"])

    return docs.select("text").mapInArrow(work, "class bigint, sig bigint")


def _buckets(rows: DataFrame) -> DataFrame:
    """(sig, class, home) of every bucket that has to be looked at; home: the class's largest bucket."""
    by_sig = Window.partitionBy("sig")
    rows = rows.withColumn("least", F.min("class").over(by_sig)).withColumn("most", F.max("class").over(by_sig)).filter("least < most").select("sig", "class").distinct()
    rows = checkpointed(rows)
    sizes = rows.groupBy("sig").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y"))
    sizes = sizes.groupBy("members", "x", "y").agg(F.min("sig").alias("sig"))  # equal member lists count once
    rows = rows.join(sizes.select("sig", "members"), "sig")
    homes = rows.groupBy("class").agg(F.max(F.struct("members", "sig")).alias("home"))
    rows = rows.join(homes.select("class", F.col("home.sig").alias("home")), "class")
    inner = rows.groupBy("sig").agg(F.min("home").alias("p"), F.max("home").alias("q")).filter("p = q and p <> sig").select("sig")
    return rows.join(inner, "sig", "left_anti")


def _gathered(rows: DataFrame, by: list[str]) -> DataFrame:
    """The keys, sig, i and j among them, and members: rows that meet in one task."""
    return rows.groupBy(*by).agg(F.collect_list(F.struct("class", "n_shingles", "home", "root", "chunk", "sketch")).alias("members"))


def _hubs(rows: DataFrame) -> DataFrame:
    """A bucket's chunks, each with the bucket's hubs: as many rows as members, and HUBS more a chunk."""
    chunks = F.ceil(F.col("members") / CHUNK)
    drawn = F.xxhash64("class", F.lit(7))
    hub = (chunks > 1) & (F.pmod(drawn, F.col("members")) < HUBS)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("class"), chunks))
    rows = rows.withColumn("i", F.explode(F.when(hub, F.sequence(F.lit(0).cast("long"), chunks - 1)).otherwise(F.array("chunk"))))
    # Dealt out before they are gathered: plain rows take less room in a shuffle than lists do.
    return _gathered(rows.withColumn("j", F.col("i")).repartition("sig", "i", "j"), ["sig", "i", "j"])


def _dealt(rows: DataFrame, firsts: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Members with a token: 0 where chunks meet, else each of the set's first shingles.

    A bucket is dealt out by shingles where its members have PREFIX_GAIN times
    fewer of them than chunks to meet. Two sets of n and m shingles that reach the threshold share one of the first
    n - (least overlap) + 1 and m - (least overlap) + 1 in any common order.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, tokens = [], []
            for run in word_runs(batch.column(0), fold=True):
                for _, found in shingles(run, size):
                    classes.append(class_of(found))
                    tokens.append(_signed(found[: len(found) + percent * -len(found) // 100 + 1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array([c or 0 for c in classes], np.int64), [len(t) for t in tokens])), pa.array(np.concatenate([np.zeros(0, np.int64), *tokens]))], ["class", "token"])

    first = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    wide = rows.filter(F.col("members") > CHUNK).groupBy("sig").agg(F.sum(first).alias("shingles"), F.first("members").alias("m"))
    wide = checkpointed(wide.filter(F.col("shingles") * PREFIX_GAIN < F.col("m") * F.ceil(F.col("m") / CHUNK)).select("sig"))
    if wide.isEmpty():
        return rows.withColumn("token", F.lit(0).cast("long"))
    small, large = rows.join(wide, "sig", "left_anti"), rows.join(wide, "sig", "left_semi")
    texts = _texts_of(large.select("class").distinct(), firsts, docs)
    tokens = texts.mapInArrow(prefixes, "class bigint, token bigint").distinct()
    dealt = checkpointed(large.join(tokens, "class").select("sig", "class", "token", "root"))
    sizes = dealt.groupBy("sig", "token").agg(F.count("*").alias("members"), F.min("root").alias("p"), F.max("root").alias("q")).filter("p < q").drop("p", "q")
    large = large.drop("members").join(dealt.drop("root").join(sizes, ["sig", "token"]), ["sig", "class"])
    return small.withColumn("token", F.lit(0).cast("long")).unionByName(large)


def _chunks(rows: DataFrame) -> DataFrame:
    """The members of two chunks of a part of a bucket, or of one, unless all have one root."""
    part = ["sig", "token"]
    by_root = Window.partitionBy(*part, "root")
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy(*part).orderBy("root", "class")) - 1)
    rows = rows.withColumn("from", F.min("at").over(by_root)).withColumn("to", F.max("at").over(by_root))
    chunk, chunks = F.floor(F.col("at") / CHUNK), F.ceil(F.col("members") / CHUNK)
    # Chunks low..high hold this root alone.
    low, high = F.ceil(F.col("from") / CHUNK), F.when(F.col("to") == F.col("members") - 1, chunks - 1).otherwise(F.floor((F.col("to") + 1) / CHUNK) - 1)
    rows = rows.withColumns({"chunk": chunk, "chunks": chunks, "low": low, "high": high})
    alone = F.col("chunk").between(F.col("low"), F.col("high"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda c: ~(alone & c.between(F.col("low"), F.col("high"))))
    rows = rows.withColumn("other", F.explode(others))
    return _gathered(rows.withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")), [*part, "i", "j"])


def _close_pairs(groups: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs of a group that the sketches let pass; forest: only as many as connect them."""

    def folded(x: bytes, size: int) -> np.ndarray:
        row = np.frombuffer(x, np.uint8)
        while len(row) > size:
            row = row[: len(row) // 2] ^ row[len(row) // 2 :]
        return row

    def close(sig: int, i: int, j: int, members: list[dict]) -> list[tuple[int, int]]:
        size = min(len(m["sketch"]) for m in members)
        bits = np.stack([folded(m["sketch"], size) for m in members])
        n = np.array([m["n_shingles"] for m in members])
        home, root, chunk = (np.array([m[k] for m in members]) for k in ("home", "root", "chunk"))
        found = []
        for a in range(len(members) - 1):
            both = n[a] + n[a + 1 :]
            ok = np.bitwise_count(bits[a + 1 :] ^ bits[a]).sum(1) if size < 8 else np.bitwise_count(bits[a + 1 :].view(np.uint64) ^ bits[a].view(np.uint64)).sum(1)
            apart = ok.astype(np.int64)
            passes = (apart <= both - 2 * -(-percent * both // (100 + percent))) & (root[a + 1 :] != root[a]) & ((home[a + 1 :] != home[a]) | (home[a] == sig)) & ((i == j) | (chunk[a + 1 :] != chunk[a]))
            b = np.flatnonzero(passes)
            found.extend(zip((apart[b] / both[b]).tolist(), [a] * len(b), (b + a + 1).tolist(), strict=True))
        if forest:
            found.sort()
            up = list(range(len(members)))

            def top(x: int) -> int:
                while up[x] != x:
                    up[x] = x = up[up[x]]
                return x

            kept = []
            for x in found:
                p, q = top(x[1]), top(x[2])
                if p != q:
                    up[p] = q
                    kept.append(x)
            found = kept
        return [tuple(sorted((members[a]["class"], members[b]["class"]))) for _, a, b in found]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[int, int]] = set()
            for k in range(batch.num_rows):  # a group at a time: a batch of them, as Python objects, takes too much room
                row = batch.slice(k, 1).to_pylist()[0]
                out.update(close(row["sig"], row["i"], row["j"], row["members"]))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return groups.mapInArrow(work, "a bigint, b bigint").distinct()


def _texts_of(classes: DataFrame, firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """Texts, one of each class at least, maybe of others too."""
    keys = classes.join(firsts, "class").select(F.col("first").alias("key")).distinct()
    return docs.withColumn("key", F.coalesce("doc_id", F.lit(NO_ID))).join(keys, "key", "left_semi").select("text")


def _verified(pairs: DataFrame, firsts: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold, counted on the whole texts of one document of each class."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s for run in word_runs(batch.column(0), fold=True) for _, s in shingles(run, size)]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["class", "set"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    found = _texts_of(wanted, firsts, docs).mapInArrow(sets, "class bigint, set binary").join(wanted, "class", "left_semi")
    found = checkpointed(found.groupBy("class").agg(F.first("set").alias("set")))
    both = pairs.join(found.withColumnsRenamed({"class": "a", "set": "x"}), "a").join(found.withColumnsRenamed({"class": "b", "set": "y"}), "b").select("a", "b", "x", "y")
    return both.mapInArrow(count, "a bigint, b bigint")


def ngram_join(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, tkey (text hash), n_shingles, class, root and component_id of every document."""
    docs, since = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), written()
    marks = checkpointed(sketched(docs, size, percent))
    buckets = _buckets(signed(docs, size, percent))  # hashed anew: signatures take less room sent than kept
    sketches = marks.filter("sketch is not null").groupBy("class").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    members = checkpointed(buckets.join(sketches, "class"))
    shared = members.select("class").distinct()
    firsts = marks.join(shared, "class", "left_semi").groupBy("class").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("first"))
    tried = checkpointed(_close_pairs(_hubs(members.withColumn("root", F.col("class"))), percent, forest=True))
    links = checkpointed(_verified(tried, firsts, docs, size, percent))
    roots = checkpointed(components(links))
    labelled = members.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    open_ = labelled.groupBy("sig").agg(F.min("root").alias("p"), F.max("root").alias("q")).filter("p < q").select("sig")
    dealt = _dealt(labelled.join(open_, "sig", "left_semi"), firsts, docs, size, percent)
    rest = checkpointed(_close_pairs(_chunks(dealt), percent, forest=False).join(tried, ["a", "b"], "left_anti"))
    more = checkpointed(_verified(rest, firsts, docs, size, percent))
    roots = components(links.unionAll(more)).withColumnRenamed("node", "class")
    placed = marks.select("doc_id", "tkey", "n_shingles", "class").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    placed = checkpointed(placed)
    released(docs.sparkSession, since, but=1)
    names = placed.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(names, "root", "left").select("doc_id", "tkey", "n_shingles", "class", "root", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def deduplicated(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each component left, columns unchanged: the first by id, null last.

    Documents without words stay, as they are linked with nothing. Rows that
    share the first id of their component are told apart by text hash; of equal
    rows one stays.
    """
    first = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.col("tkey"))
    since = written()
    placed = checkpointed(ngram_join(docs, size=size, percent=percent).filter("class is not null").select("doc_id", "tkey", "root"))
    released(docs.sparkSession, since, but=1)
    keep = placed.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.id").alias("__id"), F.col("first.tkey").alias("__tkey"), F.lit(True).alias("__keep"))
    marked = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), "__tkey": F.xxhash64("text")})
    kept = marked.join(keep, ["__id", "__tkey"], "left").filter(F.col("__keep") | (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) == 0))
    worded = kept.filter("__keep").dropDuplicates(["__id", "__tkey"])
    return worded.unionByName(kept.filter("__keep is null")).drop("__id", "__tkey", "__keep")


def op1_partenum_join(spark, sf_dir):
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=4, percent=85).select("doc_id", "n_shingles", "component_id", F.col("class").alias("class_id"))
