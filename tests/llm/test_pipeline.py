"""The whole pipeline against a brute-force version on a small table, and on odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from tests.llm.test_join import shingle_set
from tests.llm.test_mixing_sharding import brute_shards, quota_by_awards, spark_hash
from tests.llm.test_text import brute_leaks, brute_short_leaks
from tidemark.llm import language, mixing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, __id string, range string"


def rows_and_items():
    """Real documents of both kinds, near and exact copies, leaks cut short or whole, nulls and repeated rows."""
    found = duckdb.sql("SELECT doc_id, text, lang, source FROM '/root/testdata/sf0.001/documents.parquet' WHERE length(text) BETWEEN 60 AND 2500 ORDER BY doc_id LIMIT 90").fetchall()
    items = duckdb.sql("SELECT item_id, text FROM '/root/testdata/sf0.001/benchmark.parquet' ORDER BY item_id LIMIT 25").fetchall() + [(900, None), (901, "")]
    rng, rows = random.Random(12), [(d, t, lang, s) for d, t, lang, s in found]
    for k in range(12):
        words = rows[k * 5][1].split(" ")
        rows.append((1000 + k, " ".join(words + ["extra"] * (k % 3)), rows[k * 5][2], rng.choice(["src1", None])))
    for k in range(8):
        item = items[k][1].split()
        around = rows[40 + k][1].split()
        rows.append((2000 + k, " ".join(around[:30] + item[k % 2 :] + around[30:60] if k % 3 else item[:-1]), "en", "src2"))
    rows += [rows[0], rows[0], (None, rows[3][1], None, None), (None, rows[4][1] + " und mehr davon", None, "src1"), (3000, None, "en", "src1"), (3001, "", None, None), (3002, "12 34 !!", "de", None), (3003, rows[7][1].upper(), "en", "src9")]
    return rows, items


def one_of_each(rows):
    """Near duplicates: of each group the least id, null last, then the least text hash."""
    sets, up = [shingle_set(t, 5) for _, t, _, _ in rows], list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                up[top(i)] = top(j)
    first = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0, spark_hash(r[1]))
        if top(i) not in first or key < first[top(i)][0]:
            first[top(i)] = (key, r)
    return [r for _, r in first.values()]


def mixed(rows):
    """Texts of the mix: targets by filling up, quotas by awards, documents end to end in seeded order."""
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(size(r[1]) for r in rows if r[3] == s) for s in sources]
    weights, goals, left = [(3, 1, 2)[i % 3] for i in range(len(sources))], {}, 1.5 * sum(sizes)
    while True:
        open_ = [i for i in range(len(sources)) if i not in goals]
        level = left / sum(weights[i] for i in open_) if open_ else 0
        over = [i for i in open_ if level * weights[i] > 2 * sizes[i]]
        if not over:
            goals |= {i: level * weights[i] for i in open_}
            break
        for i in over:
            goals[i] = 2.0 * sizes[i]
            left -= goals[i]
    won = quota_by_awards(sorted(goals.items()), math.floor(sum(goals.values()) / mixing.BLOCK + 0.5))
    out = []
    for i, s in enumerate(sources):
        blocks = -(-sizes[i] // mixing.BLOCK)
        quota = min(2 * blocks, won[i])
        rounds, last = (quota // blocks, quota % blocks * mixing.BLOCK) if blocks else (0, 0)
        name = lambda r: hashlib.md5(f"17:{'' if r[0] is None else r[0]}:{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest()
        at = 0
        for r in sorted((r for r in rows if r[3] == s), key=name):
            n = size(r[1])
            out += [(r[0], r[1])] * rounds
            if (extra := max(0, min(n, last - at))) > 0:
                out.append((r[0], r[1] if extra == n else " ".join(re.findall("[^\x20\x09-\x0d]+", r[1])[:extra])))
            at += n
    return out


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "mix", "shards"]


def test_against_brute_force(spark, tmp_path):
    rows, items = rows_and_items()
    docs = spark.createDataFrame([(d, t, lang, s, len(t or ""), "x", None) for d, t, lang, s in rows], SCHEMA)
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    parser = language.fit(docs)
    judged = parser.judge([r[1] for r in rows])
    kept = [r for r, j in zip(rows, judged, strict=True) if j["lang"] != "und" and j["phrases"] <= language.MOST_PHRASES]
    assert {r[0] for r in rows} - {r[0] for r in kept} == {3000, 3001, 3002}
    kept = one_of_each(kept)
    assert len(kept) < len(rows) - 12
    usable = [(k, t) for k, t in items if t]
    pairs = [(i, r[1]) for i, r in enumerate(kept)]
    leaking = {i for i, _ in brute_leaks(pairs, usable) | brute_short_leaks(pairs, usable)}
    assert leaking
    kept = [r for i, r in enumerate(kept) if i not in leaking]
    want = brute_shards([(d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in mixed(kept)], corpus_pipeline.SHARDS)

    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert Counter(r[:3] for r in got) == Counter(r[:3] for r in want)
    assert Counter(got) == Counter(want)


@pytest.mark.parametrize("left", ["doc_id < 0", "doc_id = 4"])
def test_no_rows(spark, odd, tmp_path, left):
    """An empty table, and one whose rows the first stage drops."""
    odd.filter(left).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "one two")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and not {4, 5, 6, 7, 8} & {r.doc_id for r in got}
