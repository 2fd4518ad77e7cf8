"""Mixing and sharding."""

import random
import re
import time
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import mixing, sharding


def quota_by_awards(goals, seats):
    """Highest quotients, one seat after another."""
    won = Counter()
    for _ in range(seats):
        won[max((g / (2 * won[n] + 1), -n) for n, g in goals if g > 0)[1] * -1] += 1
    return won


def test_quotas_are_highest_quotients(spark):
    goals = [(0, 700.0), (1, 33.0), (2, 0.0), (3, 180.0), (4, 180.0), (5, 1.0)]
    frame = spark.createDataFrame(goals, "source_no int, target double")
    got = {(r.source_no, r.shard): r.upto for r in mixing.quotas(frame, 8, 3).collect()}
    seats = int(sum(g for _, g in goals) / 8 + 0.5)
    for shard in range(3):
        want = quota_by_awards(goals, seats * (shard + 1) // 3)
        assert {n: got[n, shard] for n, _ in goals} == {n: want[n] for n, _ in goals}


def test_targets_stop_and_share_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 500), ("c", 90), (None, 0)], "source string, size bigint")
    got = {r.source: r.target for r in mixing.targets(sizes, 1.5, 2).collect()}
    # a stops at 20, c at 180, b takes what is left of 900
    assert got == {"a": 20.0, "b": 700.0, "c": 180.0, None: 0.0}


def test_taken_is_near_target(spark, odd):
    rows = mixing.mix_report(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    again = mixing.mix_report(odd.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    sums = Counter()
    for r in rows:
        sums[r.target] += r.taken
    assert all(abs(t - s) <= 2 * mixing.BLOCK for t, s in sums.items() if t)


def test_mixed_documents_hold_what_was_taken(spark, odd):
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    words = sum(len(re.findall("[^\x20\x09-\x0d]+", r.text)) for r in mixed.collect())
    assert words == sum(r.taken for r in mixing.mix_report(odd).collect())


def test_empty_mix(none):
    assert mixing.mix_report(none).count() == 0 and mixing.mixed_documents(none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 1500])
def test_shards_are_even_and_gapless(spark, n):
    docs = spark.range(n).selectExpr("id AS doc_id", "repeat('x', int(id % 50)) AS text", "1 AS shard", "2 AS __bucket_of")
    rows = sharding.shard_digests(docs, 8).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.text_crc32 == zlib.crc32(b"x" * (r.doc_id % 50)) and r.size == r.doc_id % 50 + 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(k, [])) for k in range(8)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    again = sharding.shard_digests(docs.repartition(5), 8).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_order_is_shuffled(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'' AS text")
    rows = sorted((r.shard, r.slot, r.doc_id) for r in sharding.shard_digests(docs, 4).collect())
    ids = [r[2] for r in rows]
    assert sorted(ids) == list(range(2000))
    assert sum(abs(a - b) > 50 for a, b in zip(ids, ids[1:], strict=False)) > 1500


def test_odd_rows_are_dealt(odd, none, tmp_path, spark):
    assert sharding.shard_digests(odd, 8).count() == odd.count()
    assert sharding.shard_digests(none, 8).count() == 0
    whole = sharding.shard(odd, 2, key=["doc_id", "text", "source"])
    sharding.write_shards(whole, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd.count()


def test_shards_get_their_quotas(spark):
    """Per source and shard, words are within a block and a document, at either end, of the awards there."""
    rng = random.Random(8)
    rows = [(i if i % 9 else None, " ".join(["w"] * rng.choice([0, 3, 20, 200])) + f" {i}", rng.choice("aaab") if i % 11 else None) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    goals = {r.source_no: (r.source, r.source_size, r.target) for r in mixing.targets(docs.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("size")), 1.5, 2).collect()}
    longest = max(len(t.split()) for _, t, _ in rows)
    words = {(r.source, r.mix_shard): r.n for r in mixing.mixed_rows(docs, shards=5).groupBy("source", "mix_shard").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("n")).collect()}
    seats = int(sum(t for _, _, t in goals.values()) / mixing.BLOCK + 0.5)
    held = Counter()
    for shard in range(5):
        upto = quota_by_awards([(n, t) for n, (_, _, t) in goals.items()], seats * (shard + 1) // 5)
        for n, (source, size, _) in goals.items():
            quota = (upto[n] - held[n]) * mixing.BLOCK
            assert quota and abs(words[source, shard] - quota) <= 2 * (mixing.BLOCK + longest)
            held[n] = upto[n]


def spark_hash(*values):
    out = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
            out = xxhash.xxh64_intdigest(raw, seed=out)
    return out - (1 << 64) if out >> 63 else out


def brute_shards(rows, shards, seed=20):
    """Rows (doc_id, size, crc) to (shard, slot), by scatter and Fisher-Yates in place; no key repeats often."""
    buckets = max(1, -(-len(rows) // sharding.BUCKET_ROWS))
    held = [[] for _ in range(buckets)]
    for row in rows:
        held[spark_hash((seed, 4), *("" if v is None else str(v) for v in row)) % buckets].append(row)
    out, at = [], 0
    for number, bucket in enumerate(held):
        bucket.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        places = list(range(len(bucket)))
        for i in range(len(bucket) - 1, 0, -1):
            j = spark_hash((seed, 4), (number, 8), (i, 8)) % (i + 1)
            places[i], places[j] = places[j], places[i]
        for row, place in zip(bucket, places, strict=True):
            g = at + place
            shard = g * shards // len(rows)
            out.append((*row, shard, g - -(-shard * len(rows) // shards)))
        at += len(bucket)
    return out


def test_shards_against_brute_force(spark):
    texts = [(i if i % 40 else None, f"text {i % 300}" * (i % 7)) for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    rows = [(d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts]
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in sharding.shard_digests(docs, 8).collect()]
    assert sorted(got, key=repr) == sorted(brute_shards(rows, 8), key=repr)


def test_very_many_equal_rows(spark):
    rows = spark.range(100_000).selectExpr("IF(id % 3 > 0, 7, id) AS doc_id", "'x' AS text")
    began = time.time()
    got = sharding.shard_digests(rows, 8)
    counts = got.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last"), F.countDistinct("slot").alias("slots"), F.sum(F.expr("int(doc_id = 7)")).alias("same")).collect()
    assert time.time() - began < 60
    assert len(counts) == 8 and all(r.n == 12_500 == r.slots == r.last + 1 for r in counts)
    assert all(abs(r.same / r.n - 2 / 3) < 0.05 for r in counts)


def test_names_that_clash_are_kept(spark):
    rows = spark.range(20).selectExpr("id AS doc_id", "'a' AS shard", "id * 2 AS slot", "1 AS bucket", "2 AS row", "3 AS hash", "4 AS g")
    got = sharding.shard(rows, 3, key=["doc_id", "slot"])
    assert got.columns == ["doc_id", "shard_in", "slot_in", "bucket", "row", "hash", "g", "shard", "slot"]
    assert all(r.slot_in == 2 * r.doc_id and r.shard_in == "a" for r in got.collect()) and got.count() == 20


def test_whole_documents_are_shuffled(spark, odd, tmp_path):
    """The scatter takes texts and all columns along; digests are those of what arrived."""
    dealt = sharding.sharded_documents(odd, 3)
    assert sorted(repr(tuple(r.doc)) for r in dealt.collect()) == sorted(repr(tuple(r)) for r in odd.collect())
    sharding.write_shards(dealt.select("doc.*", "shard", "slot"), str(tmp_path / "out"))
    got = sorted(repr((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), r.shard, r.slot)) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    digests = sharding.shard_digests(odd, 3)
    assert got == sorted(repr((r.doc_id, r.size, r.text_crc32, r.shard, r.slot)) for r in digests.collect())
    odd.write.parquet(str(tmp_path / "in"))
    plan = sharding.shard_digests(spark.read.parquet(str(tmp_path / "in")), 3)._jdf.queryExecution().optimizedPlan().toString()
    scatter = next(line for line in plan.splitlines() if "Window" in line)
    assert "crc32" not in scatter and "octet_length" in plan.splitlines()[0] and ".text" in plan.splitlines()[0]
