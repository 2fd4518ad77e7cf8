"""Anchors: places inside a text that any two equal windows of it agree on.

A window is ``length`` consecutive symbols (words or bytes). Each kernel gives
every window of a sequence a name that depends on the window's own symbols
only, so equal windows have equal names wherever they stand, and far fewer
distinct names than windows. Each kernel also tells where in the sequence the
name was taken from; consecutive windows named from one place form a stretch. No
two windows of a stretch are equal, as their names stand at different offsets.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.wordhash import Spans, mix

#: (rounds, symbols in a row) that may name a window of words. The deepest level
#: that leaves a window so many settled symbols names it. A short window keeps too
#: few symbols after a second round: over 140 million words, windows of 20 gave
#: 38.6 million stretches with ((0, 8), (2, 3)) and 24.6 million with this.
SETTLED = ((0, 8), (1, 5))
#: The same from LONG words on.
SETTLED_LONG = ((0, 8), (1, 5), (2, 6))
LONG = 40


def _following(marks: np.ndarray, n: int) -> np.ndarray:
    """For each i in 0..n the first mark over i (n + 1 if none)."""
    out = np.full(n + 2, n + 1, np.int32)
    out[marks] = marks
    out = np.minimum.accumulate(out[::-1])[::-1]
    return out[1:]


def _preceding(marks: np.ndarray, n: int) -> np.ndarray:
    """For each i in 0..n the last mark below i (-1 if none)."""
    out = np.full(n + 2, -1, np.int32)
    out[marks + 1] = marks
    return np.maximum.accumulate(out)[:-1]


def recompressed(words: np.ndarray, upto: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, names, places) by recompression of token hashes; upto: word offsets of the texts.

    A round names each run of one symbol by symbol and length, then each pair of
    a left and a right symbol, the sides being a bit of the symbol's hash. Names
    are hashes of what they replace, so they are the same all over the corpus. A
    window keeps the symbols that its own words settle: each round takes the
    first and last run, then the first and last symbol off it. Of the sequences
    of symbols left at the deepest level that has enough, the least by
    hash names the window.
    """
    n = len(words)
    text = np.repeat(np.arange(len(upto) - 1), np.diff(upto))
    starts = np.arange(max(0, n - length + 1), dtype=np.int64)
    starts = starts[text[starts] == text[starts + length - 1]] if len(starts) else starts
    names, places = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)
    symbols, at = words.copy(), np.arange(n, dtype=np.int64)
    low, high, live = starts.copy(), starts + length, np.arange(len(starts))
    done, levels = 0, SETTLED_LONG if length >= LONG else SETTLED
    for rounds, row in levels:
        while done < rounds:
            symbols, at, low, high, live = _round(symbols, at, text, low, high, live, done)
            done += 1
        first, last = np.searchsorted(at, low), np.searchsorted(at, high)
        enough = last - first >= min(row, length)
        first, last, of = first[enough], last[enough], live[enough]
        if not len(of):
            continue
        value = Spans(symbols).hashes(np.arange(len(symbols) - min(row, length) + 1), np.arange(min(row, length), len(symbols) + 1)) ^ np.uint64(rounds)
        last = last - min(row, length)
        best = first
        for step in range(1, int((last - first).max(initial=0)) + 1):
            other = np.minimum(first + step, last)
            best = np.where(value[other] < value[best], other, best)
        names[of], places[of] = value[best], at[best] * 8 + rounds
    return starts, names, places


def _round(symbols: np.ndarray, at: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray, live: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """One round of run and pair naming: the shorter sequence, and the windows that keep settled symbols."""
    n = len(text)
    if not len(symbols):
        return symbols, at, low[:0], high[:0], live[:0]
    same = np.zeros(len(symbols), bool)
    same[1:] = (symbols[1:] == symbols[:-1]) & (text[at[1:]] == text[at[:-1]])
    heads = np.flatnonzero(~same)
    runs = np.diff(np.append(heads, len(symbols)))
    symbols, at = symbols[heads], at[heads]
    symbols = np.where(runs > 1, mix(symbols ^ (runs.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), symbols)
    low, high = _following(at, n)[low], _preceding(at, n)[high]
    left = (mix(symbols + np.uint64(seed * 77 + 5)) >> np.uint64(63)) == 0
    joined = left[:-1] & ~left[1:] & (text[at[1:]] == text[at[:-1]])
    pair = mix(symbols[:-1] * np.uint64(0x9E3779B97F4A7C15) + symbols[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    symbols[:-1] = np.where(joined, pair, symbols[:-1])
    kept = np.append(True, ~joined)
    symbols, at = symbols[kept], at[kept]
    ok = low < high
    live, low, high = live[ok], low[ok], high[ok]
    low, high = _following(at, n)[low], _preceding(at, n)[high]
    ok = low < high
    return symbols, at, low[ok], high[ok], live[ok]


#: Low bits of a gram's hash that give way to its place.
PLACE = np.uint64((1 << 22) - 1)


def least_grams(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, names, places) of byte windows: the least gram of each by hash, the leftmost of equal ones."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashed, span = triple_names(data, gram), length - gram + 1
    m = len(hashed)
    order = (hashed & ~PLACE) | np.arange(m, dtype=np.uint64)
    padded = np.full(-(-m // span) * span, ~np.uint64(0), np.uint64)
    padded[:m] = order
    rows = padded.reshape(-1, span)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    places = (np.minimum(backward[: m - span + 1], forward[span - 1 : m]) & PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts = np.flatnonzero(text[: n - length + 1] == text[length - 1 :])
    return starts, hashed[places[starts]], places[starts]


def triple_names(data: np.ndarray, size: int) -> np.ndarray:
    """Names of all substrings of ``size`` bytes, by recursion on names of triples.

    Names of 1, 3, 9, 27, ... bytes: each is the name of a triple of the names
    before; what is left of ``size`` is covered by two overlapping names.
    """
    names, width = mix(data.astype(np.uint64) + np.uint64(11)), 1
    while width * 3 <= size:
        m = len(names) - 2 * width
        if m <= 0:
            return np.zeros(0, np.uint64)
        names = mix(names[:m] * np.uint64(0x9E3779B97F4A7C15) + names[width : m + width] * np.uint64(0xC2B2AE3D27D4EB4F) + names[2 * width :] * np.uint64(0x165667B19E3779F9))
        width *= 3
    while width < size:
        step = min(width, size - width)
        m = len(names) - step
        if m <= 0:
            return np.zeros(0, np.uint64)
        names = mix(names[:m] * np.uint64(0x9E3779B97F4A7C15) + names[step:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(step))
        width += step
    return names


def stretches(starts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) indices of the maximal stretches of consecutive windows named from one place."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero((places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    return np.append(0, new), np.append(new - 1, len(starts) - 1)
