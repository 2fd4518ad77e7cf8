"""Language identification by cross-parsing entropy.

For each labelled language a suffix automaton is built over a bounded sample of
its text. A document is parsed against each automaton into longest matches: the
language whose text needs the fewest phrases per letter wins. The score is
1 - best / second best phrases (0: a tie, near 1: no doubt).

The automata are laid out as one table, state x letter, for the most frequent
letters, and as sorted transitions for the others; texts run through them side by
side in segments of ``SEGMENT`` characters. Each segment is first parsed as if a
phrase began with it; then the parse of the segment before is carried on into it,
up to where both begin a phrase at one letter, from where they agree, and the
phrases up to there are counted anew. So phrase counts are those of whole texts,
in bounded memory.

The fit reads at most ``SAMPLE_DOCS`` rows a language and at most
``SAMPLE_LETTERS`` letters of them, and ``SAMPLE_LETTERS_ALL`` of all languages;
beyond ``SAMPLE_LANGS`` languages it takes those with the most labelled rows. It
is the only bounded step.

Null texts and texts without letters get ``und`` and score 0; so does every text
if nothing is labelled. Ties go to the language first in code point order. Long
texts are parsed whole. Repeated rows get equal results.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_text

#: Labelled rows that the fit reads of each language.
SAMPLE_DOCS = 64
#: Letters and spaces that a language's automaton is built on.
SAMPLE_LETTERS = 12_000
#: The same for all languages together.
SAMPLE_LETTERS_ALL = 400_000
#: Languages that the fit looks at.
SAMPLE_LANGS = 1000
#: Distinct letters that have a column in the table; rarer ones are looked up among sorted transitions.
ALPHABET = 124
#: Characters parsed as one run.
SEGMENT = 256
#: Segments parsed side by side, for four languages or fewer.
TOGETHER = 4096
#: A language is rejected in a filter if the best parse needs more phrases a letter.
MOST_PHRASES = 0.6

UNKNOWN = "und"
RESULT = "struct<lang: string, score: double, phrases: double>"

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _cleaned(text: str, codes: np.ndarray) -> np.ndarray:
    """Letter codes of a text; runs of anything else become one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    out = codes[points]
    keep = out > 0
    keep[1:] |= out[:-1] > 0
    return out[keep]


def _automaton(text: list[int], letters: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of the text's suffix automaton: state x letter (-1 for none), and rows (state, letter, to) for letters beyond these."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in go[at]:
            go[at][c] = new
            at = link[at]
        if at >= 0:
            to = go[at][c]
            if length[to] != length[at] + 1:
                copy = len(go)
                go.append(dict(go[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and go[at].get(c) == to:
                    go[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
            else:
                link[new] = to
        last = new
    table, others = np.full((len(go), letters), -1, np.int32), []
    for state, edges in enumerate(go):
        for c, to in edges.items():
            if c < letters:
                table[state, c] = to
            else:
                others.append((state, c, to))
    return table, np.array(others, np.int64).reshape(-1, 3)


class Parser:
    """Automata of several languages in one table.

    Codes: 0 anything but a letter, 1 a letter that no sample has, then the
    ALPHABET most frequent letters, the padding, which changes nothing, and the
    other letters, which have no column. State 0: no match.
    """

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        letter = _is_letter()
        share = min(SAMPLE_LETTERS, SAMPLE_LETTERS_ALL // max(1, len(samples)))
        counts = Counter(c for texts in samples.values() for t in texts for c in t.lower() if letter[ord(c)])
        ranked = [c for c, _ in counts.most_common()]
        known, others = sorted(ranked[:ALPHABET]), sorted(ranked[ALPHABET:])
        self.pad = len(known) + 2
        width = self.pad + 1
        self.codes = letter.astype(np.min_scalar_type(self.pad + len(others)))
        for i, c in enumerate([*known, "", *others]):
            if c:
                self.codes[ord(c)] = i + 2
        tables, starts, at, rare = [np.zeros((1, width), np.int32)], [], 1, []
        for lang in self.langs:
            texts = [_cleaned(t, self.codes) for t in samples[lang]]
            each = max(64, share // max(1, len(texts)))
            pieces = [t[:each].tolist() for t in texts]
            table, far = _automaton([c for p in pieces for c in p][:share], width)
            rare.append(far + [at, 0, at])
            table = np.where(table >= 0, table + at, 0).astype(np.int32)
            alone = np.zeros((1, width), np.int32)  # after a letter that nothing matches
            table = np.concatenate([table, alone])
            table[:, self.pad] = np.arange(at, at + len(table))
            tables.append(table)
            starts.append(at)
            at += len(table)
        self.table = np.concatenate(tables)
        first = self.table[starts] if self.langs else np.zeros((0, width), np.int32)
        #: Of each language the state after a phrase of one unmatched letter, and before the first phrase.
        self.alone = np.array([*starts[1:], at][: len(starts)], np.int32) - 1
        self.restart = np.where(first > 0, first, self.alone[:, None]).astype(np.int32)
        self.starts = np.array(starts, np.int64)
        #: Transitions by letters without a column, sorted by state and letter.
        self.span = self.pad + len(others) + 1
        far = np.concatenate([np.zeros((0, 3), np.int64), *rare])
        keys = far[:, 0] * self.span + far[:, 1]
        order = np.argsort(keys)
        self.far, self.far_to = keys[order], far[order, 2].astype(np.int32)

    def _beyond(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """States reached by letters without a column, 0 for none."""
        wanted = states.astype(np.int64) * self.span + codes
        at = np.minimum(np.searchsorted(self.far, wanted), len(self.far) - 1)
        return np.where(self.far[at] == wanted, self.far_to[at], 0)

    def phrases(self, segments: np.ndarray, follows: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each language (row) in each segment (column), and the states after the last one.

        segments: segment x position; follows: whether a segment goes on with the
        text of the one before; before: the states after what came before the first.
        """
        n, langs, width = len(segments), len(self.langs), self.pad + 1
        columns, flat, restart = np.ascontiguousarray(segments.T), self.table.ravel(), self.restart.ravel()
        base = (np.arange(langs, dtype=np.int32) * width)[:, None]
        state = np.repeat(self.alone[:, None], n, axis=1)
        count = np.zeros((langs, n), np.int32)
        begun = np.zeros((len(columns), langs, n), bool)
        for step, letters in enumerate(columns):
            c, rare = letters, np.flatnonzero(letters > self.pad)
            if len(rare):
                c = np.where(letters > self.pad, 1, letters)  # a column without transitions
                codes = letters[rare].astype(np.int64)
                reached = self._beyond(state[:, rare], codes) if len(self.far) else 0
            state *= width
            state += c
            state = flat.take(state)
            if len(rare):
                state[:, rare] = reached
            miss = np.equal(state, 0, out=begun[step])
            count += miss
            at = np.flatnonzero(miss)
            if len(at):
                state.ravel()[at] = restart.take((base + c).ravel()[at])
            if len(rare) and len(self.far):
                first = self._beyond(self.starts[:, None], codes)
                state[:, rare] = np.where(miss[:, rare] & (first > 0), first, state[:, rare])
        return self._carried(columns, follows, before, state, count, begun)

    def _carried(self, columns: np.ndarray, follows: np.ndarray, before: np.ndarray, fresh: np.ndarray, count: np.ndarray, begun: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and last states with each segment parsed on from the one before."""
        n, end, more = len(follows), fresh.copy(), np.zeros_like(count)
        lane = np.flatnonzero(follows)
        langs, lanes = (x.ravel() for x in np.meshgrid(np.arange(len(self.langs)), lane, indexing="ij"))
        while len(lanes):
            states = np.where(lanes > 0, end[langs, lanes - 1], before[langs])
            unlike = np.zeros(len(lanes), np.int32)
            alive, state = np.arange(len(lanes)), states
            for step, letters in enumerate(columns):
                state, miss = self._step(state, langs[alive], letters[lanes[alive]])
                old = begun[step, langs[alive], lanes[alive]]
                unlike[alive] += miss.astype(np.int32) - old
                on = ~(miss & old)
                alive, state = alive[on], state[on]
                if not len(alive):
                    break
            more[langs, lanes] = unlike
            now = fresh[langs, lanes]
            now[alive] = state
            moved = (now != end[langs, lanes]) & (lanes + 1 < n)
            end[langs, lanes] = now
            langs, lanes = langs[moved], lanes[moved] + 1
            ok = follows[lanes]
            langs, lanes = langs[ok], lanes[ok]
        return count + more, end[:, -1]

    def _step(self, state: np.ndarray, langs: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after a letter each, and whether a phrase begins with it."""
        width, rare = self.pad + 1, letters > self.pad
        c = np.where(rare, 1, letters).astype(np.int64)
        to = self.table.ravel().take(state.astype(np.int64) * width + c)
        if rare.any() and len(self.far):
            to[rare] = self._beyond(state[rare], letters[rare].astype(np.int64))
        miss = to == 0
        to = np.where(miss, self.restart.ravel().take(langs * width + c), to)
        if rare.any() and len(self.far):
            first = self._beyond(self.starts[langs], letters.astype(np.int64))
            to = np.where(miss & rare & (first > 0), first, to)
        return to.astype(np.int32), miss

    def judge(self, texts: list[str | None]) -> list[dict]:
        out: list[dict] = [{"lang": UNKNOWN, "score": 0.0, "phrases": None}] * len(texts)
        waiting: list[tuple[int, np.ndarray]] = []
        held = 0
        for i, text in enumerate(texts):
            codes = _cleaned(text, self.codes) if text else None
            if codes is not None and self.langs and codes.any():
                waiting.append((i, codes))
                held += -(-len(codes) // SEGMENT)
            if waiting and (held >= TOGETHER or i == len(texts) - 1):
                self._parse(waiting, out)
                waiting, held = [], 0
        if waiting:
            self._parse(waiting, out)
        return out

    def _parse(self, waiting: list[tuple[int, np.ndarray]], out: list[dict]) -> None:
        sizes = np.array([-(-len(codes) // SEGMENT) for _, codes in waiting])
        ends = np.cumsum(sizes)
        room = np.full(int(ends[-1]) * SEGMENT, self.pad, self.codes.dtype)
        for (_, codes), end, size in zip(waiting, ends, sizes, strict=True):
            room[(end - size) * SEGMENT : (end - size) * SEGMENT + len(codes)] = codes
        room, follows, counted, before = room.reshape(-1, SEGMENT), np.ones(int(ends[-1]), bool), [], self.alone
        follows[ends - sizes] = False
        together = max(16, TOGETHER * 4 // max(4, len(self.langs)))
        for at in range(0, len(room), together):
            found, before = self.phrases(room[at : at + together], follows[at : at + together], before)
            counted.append(found)
        found = np.add.reduceat(np.concatenate(counted, axis=1), ends - sizes, axis=1)
        for k, (i, codes) in enumerate(waiting):
            counts = found[:, k]
            order = np.argsort(counts, kind="stable")
            best = float(counts[order[0]])
            rate = best / len(codes)
            score = 1 - best / float(counts[order[1]]) if len(order) > 1 else 1 - min(1.0, rate)
            out[i] = {"lang": self.langs[order[0]], "score": score, "phrases": rate}


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees."""
    return F.crc32(id_text(doc_id).cast("binary")) % 5 == 0


def fit(docs: DataFrame, seed: int = 7) -> Parser:
    """Build the automata from at most SAMPLE_DOCS labelled rows a language."""
    key = ["doc_id", "lang", "hash"]
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.filter(~held_out(F.col("doc_id"))).groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(SAMPLE_LANGS).collect()
    langs = [r["lang"] for r in counts]
    letters = min(SAMPLE_LETTERS, SAMPLE_LETTERS_ALL // max(1, len(langs)))
    rows = usable.filter(F.col("lang").isin(langs)).select("doc_id", "lang", F.substring("text", 1, letters).alias("text")).withColumn("hash", F.xxhash64("text"))
    labelled = rows.filter(~held_out(F.col("doc_id"))).select(*key, F.xxhash64(F.lit(seed), "doc_id").alias("order"))
    chosen = labelled.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id", "hash"))).filter(F.col("k") <= SAMPLE_DOCS)
    chosen = chosen.groupBy(key).agg(F.count("*").alias("times"))  # equal rows are sent once
    found = rows.join(F.broadcast(chosen), key).groupBy(key).agg(F.first("text").alias("text"), F.first("times").alias("times")).collect()
    samples: dict[str, list[str]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        samples.setdefault(row["lang"], []).extend([row["text"]] * row["times"])
    return Parser(samples)


def identify(docs: DataFrame, parser: Parser, *, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with a struct column (lang, score, phrases)."""
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    @F.arrow_udf(RESULT)
    def judged(texts: pa.Array) -> pa.Array:
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("phrases", pa.float64())])
        return pa.array(shared.value.judge(texts.to_pylist()), kind)

    return docs.withColumn(out_col, judged(F.col(text_col)))


def accepted(docs: DataFrame, parser: Parser) -> DataFrame:
    """The documents that have a language: a filter stage with unchanged columns."""
    found = identify(docs, parser, out_col="__language")
    return found.filter((F.col("__language.lang") != UNKNOWN) & (F.col("__language.phrases") <= MOST_PHRASES)).drop("__language")


def op7_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.col("language.phrases").alias("phrases_per_letter"))
