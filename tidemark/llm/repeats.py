"""Removal of every symbol under a window that also starts earlier, corpus-wide.

Shared by the byte and the word operator, which differ in their kernels only.

1. Whole texts that equal an earlier one are found by digest. They go entirely,
   and nothing that they hold could be the first of its kind.
2. Every stretch of windows with one name (see ``anchors``) becomes a row: name,
   digest of the stretch, place. Windows with equal text have equal names, so
   all that could equal a window meets under its name. Names with one stretch
   are done; a stretch whose digest occurs earlier is a repeat as a whole.
3. What is left, the first of each distinct stretch under names with several,
   gives a row for each window, sorted by the window's digest; all but the
   first of equal neighbours are repeats.
4. Texts meet their repeats once more to be cut.

A task sends on only the first of equal stretches or windows that it meets
together; the others are repeats already, and go to any task. So a passage that
very many documents share makes about one row a batch under its name, however
often it occurs. Rows are sorted by Spark within shuffle partitions and spill to
disk; no group is gathered in memory.

Two texts count as equal if their lengths and two independent digests of 61 and
64 bits agree.

A text that is null counts as empty. Documents are ordered by id, null last,
then by text hash (id 2^63 - 1 counts as null); rows equal in id and text are one
document (they share ranks below) and get the same result. Texts shorter than a
window stay whole, unless they repeat nothing anyway. Long texts are read whole,
in pieces where the kernel can. Extra columns are ignored. Empty table: empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.anchors import least_grams, recompressed, stretches
from tidemark.llm.common import checkpointed
from tidemark.llm.wordhash import BYTE, OTHER, OtherSpans, Spans, byte_runs, mix, word_runs

NULL_LAST = (1 << 63) - 1


#: Rows of stretches or windows that a task looks through for equal ones before it sends them.
TOGETHER = 1 << 18

Digests = tuple[np.ndarray, np.ndarray]


@dataclass
class Piece:
    """A run of texts (or part of a long one) as symbols."""

    first: int  # row of the batch of the first text
    upto: np.ndarray  # symbol offsets of the texts
    shift: int  # of the first symbol inside its text
    names: Callable[[], tuple[np.ndarray, np.ndarray, np.ndarray]]
    digests: Callable[[np.ndarray, np.ndarray], Digests]  # of symbol ranges


def word_pieces(texts: pa.Array, length: int) -> Iterator[Piece]:
    for run in word_runs(texts, twice=True):

        def digests(a: np.ndarray, b: np.ndarray, one=Spans(run.hashes), two=OtherSpans(run.others)) -> Digests:
            return one.hashes(a, b), two.hashes(a, b)

        yield Piece(run.first, run.upto, 0, lambda run=run: recompressed(run.hashes, run.upto, length), digests)


#: Bytes of a gram that names a window, and of a piece of a long text and a run of
#: short ones: the kernels hold about 120 bytes for each of them at once.
GRAM = 40
PIECE = 1 << 18


def byte_pieces(texts: pa.Array, length: int) -> Iterator[Piece]:
    for first, bounds, whole in byte_runs(texts, PIECE):
        for shift in range(0, max(1, len(whole)), PIECE) if len(whole) > 2 * PIECE else (0,):
            data = whole[shift : shift + PIECE + length - 1] if len(whole) > 2 * PIECE else whole
            upto = np.array([0, len(data)]) if len(whole) > 2 * PIECE else bounds

            def digests(a: np.ndarray, b: np.ndarray, one=Spans(BYTE[data], small=True), two=OtherSpans(OTHER[data])) -> Digests:
                return one.hashes(a, b), two.hashes(a, b)

            yield Piece(first, upto, shift, lambda d=data, u=upto: least_grams(d, u, length, min(GRAM, length)), digests)


#: windows is negative for what repeats an earlier row of its task.
STRETCHES = "name bigint, digest bigint, other bigint, at bigint, tkey bigint, first bigint, windows int"
WINDOWS = "digest bigint, other bigint, at bigint, tkey bigint, first bigint, windows int"


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, first, windows) of a column of lists of stretches; null counts as empty."""
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.nan_to_num(pc.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
    rows = pc.list_flatten(column)
    return np.append(0, np.cumsum(sizes)), rows.field(0).to_numpy(zero_copy_only=False), rows.field(1).to_numpy(zero_copy_only=False)


def _later(*keys: np.ndarray) -> np.ndarray:
    """Which rows equal an earlier one in all keys."""
    key = keys[0]
    for k in keys[1:]:
        key = mix(key ^ k)
    order = np.argsort(key, kind="stable")
    same = np.ones(len(order) - 1, bool)
    for k in keys:
        same &= k[order[1:]] == k[order[:-1]]
    out = np.zeros(len(order), bool)
    out[order[1:]] = same
    return out


class _Rows:
    """Rows in the order of documents and places, sent on in batches of TOGETHER."""

    def __init__(self, keys: int, schema: str):
        self.keys, self.names, self.held, self.count = keys, [c.split()[0] for c in schema.split(", ")], [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.count += len(columns[0])
        if self.count >= TOGETHER:
            yield from self.sent()

    def sent(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        columns = [np.concatenate(c) for c in zip(*self.held, strict=True)]
        self.held, self.count = [], 0
        keys, (at, tkey, first, windows) = columns[: self.keys], columns[self.keys :]
        later = _later(*keys)
        # A row that is known to repeat needs to meet nothing: any name will do.
        keys[0] = np.where(later, mix(at.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + first.astype(np.uint64)), keys[0])
        yield pa.RecordBatch.from_arrays([*map(_long, keys), _long(at), _long(tkey), _long(first), pa.array(np.where(later, -windows, windows).astype(np.int32))], self.names)


def _stretch_rows(pieces: Callable, length: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, tkey = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            chosen, out = {}, _Rows(3, STRETCHES)
            digests = batch.column(2).to_pylist()
            for i in np.lexsort((tkey, at)):
                chosen.setdefault(digests[i], i)  # of equal texts the first of the batch will do
            keep = np.fromiter(chosen.values(), np.int64, len(chosen))
            at, tkey = at[keep], tkey[keep]
            for piece in pieces(batch.column(3).take(pa.array(keep)), length):
                starts, names, places = piece.names()
                a, b = stretches(starts, places)
                if not len(a):
                    continue
                text = np.searchsorted(piece.upto, starts[a], "right") - 1
                row = piece.first + text
                yield from out.add(names[a], *piece.digests(starts[a], starts[b] + length), at[row], tkey[row], starts[a] - piece.upto[text] + piece.shift, b - a + 1)
            yield from out.sent()

    return work


def _window_rows(pieces: Callable, length: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.lexsort((batch.column(1).to_numpy(), batch.column(0).to_numpy()))
            batch, out = batch.take(pa.array(order)), _Rows(2, WINDOWS)
            at, tkey = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            upto, first, windows = _lists(batch.column(3))
            for piece in pieces(batch.column(2), length):
                starts, rows = [], []
                for t in range(len(piece.upto) - 1):
                    row = piece.first + t
                    low, n = piece.upto[t], piece.upto[t + 1] - piece.upto[t]
                    f, w = first[upto[row] : upto[row + 1]], windows[upto[row] : upto[row + 1]]
                    s = np.repeat(f - np.append(0, np.cumsum(w)[:-1]), w) + np.arange(w.sum()) - piece.shift
                    s = np.sort(s[(s >= 0) & (s + length <= n)])
                    if len(s):
                        starts.append(s + low)
                        rows.append(np.full(len(s), row))
                if starts:
                    s, row = np.concatenate(starts), np.concatenate(rows)
                    low = piece.upto[row - piece.first]
                    yield from out.add(*piece.digests(s, s + length), at[row], tkey[row], s - low + piece.shift, np.ones(len(s), np.int64))
            yield from out.sent()

    return work


def covered(first: np.ndarray, windows: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of n symbols lie under the given stretches of windows."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, first + windows + length - 1, -1)
    return np.cumsum(depth[:-1]) > 0


def repeated(docs: DataFrame, pieces: Callable, length: int) -> DataFrame:
    """doc_id, text, whole (an earlier equal text), repeats (first, windows) of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"at": F.coalesce("doc_id", F.lit(NULL_LAST)), "tkey": F.xxhash64("text"), "digest": F.md5(F.col("text").cast("binary"))})
    heads = docs.groupBy("digest").agg(F.min("at").alias("head"), F.max("at").alias("tail")).filter("head < tail").select("digest", "head")
    heads = checkpointed(heads)  # a plain table: Spark can split the join below where a text has very many copies
    rows = docs.select("at", "tkey", "digest", "text").mapInArrow(_stretch_rows(pieces, length), STRETCHES).repartition("name")
    place = ["at", "tkey", "first"]
    same, named = Window.partitionBy("name", "digest", "other").orderBy(*place), Window.partitionBy("name")
    rows = rows.withColumn("k", F.dense_rank().over(same)).withColumn("p", F.min("digest").over(named)).withColumn("q", F.max("digest").over(named))
    later = (F.col("k") > 1) | (F.col("windows") < 0)
    marks = checkpointed(rows.filter(later | F.expr("p < q")).select(*place, F.abs("windows").alias("windows"), later.alias("repeat")))
    unsure = marks.filter("not repeat").groupBy("at", "tkey").agg(F.collect_list(F.struct("first", "windows")).alias("stretches"))
    asked = docs.select("at", "tkey", "text").join(unsure, ["at", "tkey"]).select("at", "tkey", "text", "stretches")
    windows = asked.mapInArrow(_window_rows(pieces, length), WINDOWS)
    windows = windows.withColumn("k", F.dense_rank().over(Window.partitionBy("digest", "other").orderBy(*place))).filter(later)
    found = checkpointed(windows.select(*place, F.abs("windows").alias("windows")))
    found = marks.filter("repeat").select(*place, "windows").unionAll(found)
    whole = docs.select("at", "tkey", "digest").join(heads, "digest").filter("at > head").select("at", "tkey", F.lit(-1).cast("long").alias("first"), F.lit(0).alias("windows"))
    found = found.unionAll(whole).groupBy("at", "tkey").agg(F.collect_list(F.when(F.col("first") >= 0, F.struct("first", "windows"))).alias("repeats"), (F.min("first") < 0).alias("whole"))
    return docs.select("at", "tkey", "doc_id", "text").join(found, ["at", "tkey"], "left").select("doc_id", "text", "whole", "repeats")


def _cut_bytes(length: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto, first, windows = _lists(batch.column(3))
            out = []
            for row, (text, whole) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(), strict=True)):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                n = len(data)
                gone = np.full(n, True) if whole and n >= length else covered(first[upto[row] : upto[row + 1]], windows[upto[row] : upto[row + 1]], n, length)
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
                out.append((n, int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes() if gone.any() else data).hexdigest()))
            yield _packed(batch.column(0), out, ["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return work


def _cut_words(length: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto, first, windows = _lists(batch.column(3))
            whole, out = batch.column(2).to_pylist(), []
            for run in word_runs(batch.column(1)):
                raw = run.data.tobytes()
                for t in range(len(run.bounds) - 1):
                    row, low, high = run.first + t, run.upto[t], run.upto[t + 1]
                    n = int(high - low)
                    gone = np.full(n, True) if whole[row] and n >= length else covered(first[upto[row] : upto[row + 1]], windows[upto[row] : upto[row + 1]], n, length)
                    kept = " ".encode().join([raw[a:b] for a, b in zip(run.starts[low:high][~gone].tolist(), run.ends[low:high][~gone].tolist(), strict=True)])
                    out.append((n, int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            yield _packed(batch.column(0), out, ["n_words", "n_removed", "kept_sha256"])

    return work


def _packed(ids: pa.Array, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], pa.string() if name.endswith("sha256") else pa.int64()) for i, name in enumerate(names)]
    return pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", *names])


def byte_dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """Per document: bytes, bytes under repeated windows, their runs, digest of the rest."""
    return repeated(docs, byte_pieces, length).mapInArrow(_cut_bytes(length), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def word_dedup(docs: DataFrame, length: int = 20) -> DataFrame:
    """Per document: words, words under repeated windows, digest of the rest."""
    return repeated(docs, word_pieces, length).mapInArrow(_cut_words(length), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def op6_suffix_dedup(spark, sf_dir):
    return byte_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_recompression_dedup(spark, sf_dir):
    return word_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
