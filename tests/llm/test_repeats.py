"""Removal of repeated byte and word windows, against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import repeats
from tidemark.llm.anchors import triple_names


def brute(sequences, length):
    seen, out = set(), []
    for s in sequences:
        gone = bytearray(len(s))
        for i in range(len(s) - length + 1):
            w = bytes(s[i : i + length]) if isinstance(s, bytes) else tuple(s[i : i + length])
            if w in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(w)
        out.append(gone)
    return out


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def byte_rows(rows, length):
    data = [(t or "").encode() for _, t in rows]
    return [(d, len(b), sum(g), len(re.findall(b"\x01+", bytes(g))), sha(bytes(x for x, y in zip(b, g, strict=True) if not y))) for (d, _), b, g in zip(rows, data, brute(data, length), strict=True)]


def word_rows(rows, length):
    data = [words(t) for _, t in rows]
    return [(d, len(w), sum(g), sha(" ".join(x for x, y in zip(w, g, strict=True) if not y).encode())) for (d, _), w, g in zip(rows, data, brute(data, length), strict=True)]


def passages(n, seed):
    rng = random.Random(seed)
    shared = [" ".join(f"p{rng.randrange(500)}" for _ in range(rng.randrange(15, 80))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(60))) for _ in range(3)]
        rows.append((i, " ".join(x for p in parts for x in (p, rng.choice(shared)))))
    return [*rows, (n, rows[3][1]), (n + 1, "la " * 90), (n + 2, "la " * 40 + "lo " * 30), (n + 3, "é" * 130), (n + 4, None), (n + 5, "")]


def test_against_brute_force(spark):
    rows = passages(60, 3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(map(tuple, repeats.byte_dedup(docs).collect())) == byte_rows(rows, 100)
    assert sorted(map(tuple, repeats.word_dedup(docs).collect())) == word_rows(rows, 20)
    assert sorted(map(tuple, repeats.word_dedup(docs, 45).collect())) == word_rows(rows, 45)


def test_odd_rows(spark, odd):
    rows = sorted({(r.doc_id, r.text) for r in odd.collect()}, key=lambda r: (r[0] is None, r[0] or 0, r[1] != next(x.text for x in odd.collect() if x.doc_id is None)))
    got = {(r[0], r[1]): tuple(r[2:]) for r in repeats.word_dedup(odd).collect()}
    named = [r for r in word_rows(rows, 20) if r[0] is not None]
    assert {(r[0], r[1]): tuple(r[2:]) for r in named}.items() <= got.items()
    assert repeats.byte_dedup(odd).count() == repeats.word_dedup(odd).count() == 13


def test_empty(none):
    assert repeats.byte_dedup(none).count() == 0 and repeats.word_dedup(none).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=160), st.integers(20, 45))
def test_equal_windows_have_equal_names(letters, length):
    text = " ".join(letters)
    for pieces, units in ((repeats.word_pieces, letters), (repeats.byte_pieces, list(text.encode()))):
        found = {}
        for piece in pieces(pa.array(["x y z " * 9, text]), length):
            starts, names, places = piece.names()
            low = piece.upto[1]
            for s, n, p in zip(starts, names, places, strict=True):
                if s >= low:
                    found.setdefault(tuple(units[s - low : s - low + length]), set()).add((int(n),))
        assert all(len(v) == 1 for v in found.values())
        assert len(found) == len({tuple(units[i : i + length]) for i in range(len(units) - length + 1)})


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 500)
    text = "".join(random.Random(2).choices("abcdef", k=3000))
    starts = sorted(int(s) + p.shift for p in repeats.byte_pieces(pa.array([text]), 100) for s in p.names()[0])
    assert starts == list(range(2901))


@pytest.mark.parametrize("texts,letters", [(800, 4000), (1, 2_000_000)])
def test_kernels_hold_little_at_once(texts, letters):
    """Six tasks of an executor look for stretches at the same time."""
    import tracemalloc

    rng = random.Random(3)
    column = pa.array(["".join(rng.choices("abcdefgh ", k=letters)) for _ in range(texts)])
    ids = pa.array(range(texts), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, ids.cast(pa.string()), column], ["at", "tkey", "digest", "text"])
    tracemalloc.start()
    assert sum(b.num_rows for b in repeats._stretch_rows(repeats.byte_pieces, 100)(iter([batch]))) > 50_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_triple_names_are_names():
    data = np.frombuffer(b"abcabcabcabdabc" * 20, np.uint8)
    for size in (1, 3, 40, 100):
        names = triple_names(data, size)
        assert len(names) == len(data) - size + 1
        assert len({(int(n), bytes(data[i : i + size])) for i, n in enumerate(names)}) == len(set(map(int, names)))


def thue_morse(n):
    """A word of n letters and its complement: equal under any polynomial modulo 2^64 with an odd base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_regular_patterns_are_told_apart(spark):
    one, two = thue_morse(2048)
    tail = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{one} {tail}"), (2, f"{two} {tail}"), (3, " ".join(one)), (4, " ".join(two)), (5, f"{tail} {two}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for length in (20, 1024):
        assert sorted(map(tuple, repeats.word_dedup(docs, length).collect())) == word_rows(rows, length)
    assert sorted(map(tuple, repeats.byte_dedup(docs, 1024).collect())) == byte_rows(rows, 1024)


def test_a_very_common_passage_makes_few_rows():
    common = " ".join(f"c{i}" for i in range(60))
    texts = [f"u{i} " * 3 + common + f" v{i}" * 3 for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(range(300), pa.int64()), pa.array(texts), pa.array(texts)], ["at", "tkey", "digest", "text"])
    rows = pa.Table.from_batches(repeats._stretch_rows(repeats.word_pieces, 20)(iter([batch]))).to_pandas()
    again = rows[rows.windows < 0]
    assert len(again) > 1000 and again.name.nunique() == len(again)
    assert rows[rows.windows > 0].groupby("name").size().max() <= 300


def test_first_query_of_a_fresh_worker():
    """The kernels import what they use themselves."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import pyarrow as pa; from tidemark.llm.repeats import _lists; _lists(pa.array([[{'a': 1, 'b': 2}], None], pa.list_(pa.struct([('a', pa.int64()), ('b', pa.int32())]))))"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[2])
