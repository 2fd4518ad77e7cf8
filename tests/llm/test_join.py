"""The n-gram join, its components and its bounds, against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import ngram_join
from tidemark.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, size, percent):
    """(doc_id, n_shingles, component_id) of each row."""
    sets = [shingle_set(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None) if sets[i] else d))
    return sorted(map(repr, out))


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows + [(n + i, " ".join(f"y{rng.randrange(9)}" for _ in range(rng.randrange(12)))) for i in range(60)]


@pytest.mark.parametrize("size,percent,chunk,gain", [(4, 85, 256, 16), (5, 80, 8, 16), (5, 80, 8, 0)])
def test_against_brute_force(spark, monkeypatch, size, percent, chunk, gain):
    """gain 0: every bucket of more than one chunk is dealt out by prefixes."""
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    monkeypatch.setattr(ngram_join, "PREFIX_GAIN", gain)
    monkeypatch.setattr(ngram_join, "HUBS", 2)
    rows = near_copies(120, size)
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string"), size=size, percent=percent)
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got.collect()) == brute(rows, size, percent)


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = ngram_join.ngram_join(odd, size=4, percent=85)
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got.collect()) == brute(rows, 4, 85)


def test_empty(spark, none):
    assert ngram_join.ngram_join(none).count() == 0
    assert ngram_join.deduplicated(none).columns == none.columns


def test_one_of_each_group_stays(spark, odd):
    kept = ngram_join.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "4", "5", "6", "7", "9", "10", "None"])


@settings(max_examples=60, deadline=None)
@given(st.integers(5, 400), st.integers(0, 10**6), st.sampled_from([80, 85, 90]))
def test_similar_sets_share_a_signature(n, seed, percent):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    most = ngram_join.most_differing(2 * n, percent) // 2
    b = np.concatenate([a[most:], rng.integers(0, 1 << 63, most, dtype=np.uint64)])
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b))
    if 100 * shared >= percent * (len(a) + len(b) - shared):
        assert set(ngram_join.signatures(a, percent)) & set(ngram_join.signatures(b, percent))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        up[max(p, q)] = min(p, q)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: top(x) for a, b in edges if a != b for x in (a, b)}


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("n", range(1, 16))
def test_nested_small_sets_share_a_signature(n, percent):
    for seed in range(40):
        larger = np.unique(np.random.default_rng(seed).integers(0, 1 << 63, n + 1, dtype=np.uint64))
        shared = set(ngram_join.signatures(larger, percent)) & set(ngram_join.signatures(larger[1:], percent))
        assert shared or 100 * n < percent * (n + 1)


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_short_texts_and_one_word_more(spark, size, percent):
    rows = []
    for n in range(1, 20):
        words = [f"t{n}w{i}" for i in range(n + 1)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:-1])), (len(rows) + 2, " ".join(words[1:]))]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string"), size=size, percent=percent)
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got.collect()) == brute(rows, size, percent)


def test_regular_patterns_share_nothing(spark):
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    docs = spark.createDataFrame([(1, " ".join([one] * 5)), (2, " ".join([two] * 5))], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.component_id) for r in ngram_join.ngram_join(docs, size=4, percent=85).collect()) == [(1, 1), (2, 2)]
