"""Periodic runs of words: passages that repeat with a period, found by block convolution.

A text's words become numbers. At every dyadic scale L the text is cut into
blocks of L words, and an integer number-theoretic transform gives, for all
blocks at once, the sum of squared differences between a block and each place
of the window that follows it. The sums are exact, since words are hashed to so
few values that no sum reaches the modulus. A sum of zero is an occurrence, and
its distance seeds an extension to both sides, this time over the words
themselves. A run of period q and length of at least ``max(MIN_WORDS, MIN_TIMES * q)``
holds a whole block of the scale ``L <= q < 2 L`` (the first scale takes all
shorter periods) together with that block's copy q words on, so none is missed.
Seeds inside a run already known whose period divides their distance would
only find it again and are left out.

A row needs no other row: no shuffle, and memory in proportion to the longest
text. Work is n log² n for a text of n words.

Defined results: a null or blank text has no words, no runs and the empty
collapsed text. Texts are taken whole, however long. Repeated rows are worked
on one by one; of stretches that several distances explain, the smallest
period counts. Extra columns are kept unless they clash with the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: A run has at least this many words and this many times its period.
MIN_WORDS, MIN_TIMES = 24, 3
#: A prime 15 * 2^27 + 1 and a generator of its residues.
PRIME, GENERATOR = 2013265921, 31
FIRST_BLOCK = 8
#: Words worked on at once (a longer text is worked on alone), and cells of a transform.
BATCH_WORDS, CELLS = 1 << 19, 1 << 18

RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

_P = np.uint64(PRIME)


def _powers(root: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    step = 1
    while step < count:
        out[step : 2 * step] = out[:step] * np.uint64(pow(root, step, PRIME)) % _P
        step *= 2
    return out


@cache
def _roots(half: int, inverse: bool) -> np.ndarray:
    """Powers of the root of unity of order ``2 * half``, as a column."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    return _powers(pow(root, -1, PRIME) if inverse else root, half)[:, None]


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below twice the prime: the other choice wraps around and is larger."""
    return np.minimum(x, x - _P)


def forward(x: np.ndarray) -> None:
    """Transform each column in place; the result is in bit-reversed order."""
    half = len(x) // 2
    while half:
        pairs = x.reshape(-1, 2, half, x.shape[1])
        a, b = pairs[:, 0], pairs[:, 1]
        difference = (a + (_P - b)) * _roots(half, False) % _P
        pairs[:, 0] = _reduced(a + b)
        pairs[:, 1] = difference
        half //= 2


def backward(x: np.ndarray) -> None:
    """Undo ``forward`` in place."""
    half = 1
    while half < len(x):
        pairs = x.reshape(-1, 2, half, x.shape[1])
        a, b = pairs[:, 0].copy(), pairs[:, 1] * _roots(half, True) % _P
        pairs[:, 0] = _reduced(a + b)
        pairs[:, 1] = _reduced(a + (_P - b))
        half *= 2
    x *= np.uint64(pow(len(x), -1, PRIME))
    x %= _P


def occurrences(codes: np.ndarray, blocks: np.ndarray, length: int, first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) wherever a block equals what lies ``first`` to ``first + count - 1`` words on.

    ``codes`` must be so small that ``length`` squares of them stay below the prime.
    """
    size = 1 << (length + count - 2).bit_length()
    padded = np.concatenate((codes, np.zeros(first + size + length, np.int64)))
    squares = np.concatenate(([0], np.cumsum(padded * padded)))
    starts, distances = [], []
    # Few columns would make for short inner loops: then one at a time.
    width = CELLS // size if CELLS // size >= 16 else 1
    for at in range(0, len(blocks), width):
        own = blocks[at : at + width]
        x = np.zeros((size, len(own)), np.uint64)
        t = np.arange(length)
        x[-t] = padded[own[None, :] + t[:, None]]
        y = padded[own[None, :] + (first + np.arange(size))[:, None]].astype(np.uint64)
        forward(x)
        forward(y)
        x *= y
        x %= _P
        backward(x)
        there = own[None, :] + (first + np.arange(count))[:, None]
        differences = (squares[own + length] - squares[own])[None, :] + squares[there + length] - squares[there]
        differences -= 2 * x[:count].astype(np.int64)
        k, which = np.nonzero(differences == 0)
        starts.append(own[which])
        distances.append(first + k)
    return (np.concatenate(starts), np.concatenate(distances)) if starts else (blocks[:0], blocks[:0])


def _agreeing(ids: np.ndarray, at: int, distance: int, room: int, step: int) -> int:
    """How many words from ``at`` on, forwards or backwards, equal the one ``distance`` later; at most ``room``."""
    seen, size = 0, 32
    while seen < room:
        size = min(2 * size, room - seen)
        low = at + seen if step > 0 else at - seen - size + 1
        unlike = np.flatnonzero(ids[low : low + size] != ids[low + distance : low + distance + size])
        if len(unlike):
            return seen + int(unlike[0] if step > 0 else size - 1 - unlike[-1])
        seen += size
    return seen


def _extended(ids: np.ndarray, start: int, stop: int, blocks: np.ndarray, length: int, distance: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of the stretches with period ``distance`` around the blocks, which are in order."""
    i = 0
    while i < len(blocks):
        block = int(blocks[i])
        right = block + _agreeing(ids, block, distance, stop - distance - block, 1)
        if right - block >= length:  # else only the hashes agree
            yield block - _agreeing(ids, block - 1, distance, block - start, -1), right + distance
        i = max(i + 1, int(np.searchsorted(blocks, right - length, "right")))


def find_runs(ids: np.ndarray, stops: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of every text; the texts' word numbers lie end to end, ending at ``stops``."""
    sizes = np.diff(np.concatenate(([0], stops)))
    begins = stops - sizes
    found: list[dict[tuple[int, int], int]] = [{} for _ in stops]
    longest = int(sizes.max(initial=0))
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    length = FIRST_BLOCK
    while longest >= MIN_WORDS and MIN_TIMES * length <= longest:
        first, count = (1, 2 * length - 1) if length == FIRST_BLOCK else (length, length)
        blocks = np.arange(0, len(ids), length)
        text = np.searchsorted(stops, blocks, "right")
        inside = (blocks + length + first <= stops[text]) & (sizes[text] >= max(MIN_WORDS, MIN_TIMES * first))
        few = np.uint64(max(2, min(1 << 15, int(np.sqrt((PRIME - 1) // length)))))
        codes = ((mixed >> np.uint64(33)) % few).astype(np.int64)
        at, distance = occurrences(codes, blocks[inside], length, first, count)
        text = np.searchsorted(stops, at, "right")
        fits = at + distance + length <= stops[text]
        at, distance, text = at[fits], distance[fits], text[fits]
        order = np.lexsort((at, distance, text))
        at, distance, text = at[order], distance[order], text[order]
        for k in np.unique(text):
            own = slice(*np.searchsorted(text, [k, k + 1]))
            a, d = at[own], distance[own]
            for (start, stop), period in found[k].items():
                new = (a < start) | (a + d + length > stop) | (d % period != 0)
                a, d = a[new], d[new]
            for q in np.unique(d):
                same = slice(*np.searchsorted(d, [q, q + 1]))
                for start, stop in _extended(ids, int(begins[k]), int(stops[k]), a[same], length, int(q)):
                    if stop - start >= max(MIN_WORDS, MIN_TIMES * q):
                        found[k][start, stop] = min(int(q), found[k].get((start, stop), int(q)))
        length *= 2
    return [
        sorted((start - int(begin), stop - start, period) for (start, stop), period in own.items())
        for own, begin in zip(found, begins)
    ]


def _batches(texts: list[str | None]) -> Iterator[tuple[list[list[bytes]], np.ndarray, np.ndarray]]:
    """(words of each text, their numbers end to end, stops): exact numbers, equal for equal words of a batch."""
    numbers: dict[bytes, int] = {}
    words, ids, stops = [], [], []
    total = 0
    for text in texts:
        own = (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space alone
        words.append(own)
        ids.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own)))
        total += len(own)
        stops.append(total)
        if total >= BATCH_WORDS:
            yield words, np.concatenate(ids), np.array(stops)
            words, ids, stops, total = [], [], [], 0
            numbers.clear()
    if words:
        yield words, np.concatenate(ids), np.array(stops)


def _described(texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    for words, ids, stops in _batches(texts):
        for own, runs in zip(words, find_runs(ids, stops)):
            kept = own
            if runs:
                stays = np.ones(len(own), bool)
                for start, length, period in runs:
                    stays[start + period : start + length] = False
                kept = [own[i] for i in np.flatnonzero(stays)]
            yield len(own), runs, b" ".join(kept).decode("utf-8", "surrogatepass")


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, runs and collapsed.

    ``runs`` are the maximal stretches with a smallest period (words that far
    apart are equal), by start, then period, in numbers of words. ``collapsed``
    are the words that no run contains after its first period, joined by blanks.
    """

    @F.pandas_udf(RESULT)
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for at in range(0, len(texts), 1024):
                for n, runs, collapsed in _described([x if isinstance(x, str) else None for x in texts[at : at + 1024]]):
                    rows.append((n, [dict(zip(("start", "length", "period"), r)) for r in runs], collapsed))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "collapsed"])

    names = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed")]
    found = docs.select(*(F.col(f"`{c}`") for c in names), describe(F.col(f"`{text}`")).alias("_found"))
    return found.select(*(F.col(f"`{c}`") for c in names), "_found.*")


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with each run's words after its first period taken out of the text; texts without runs stay as they are."""
    found = periodic_runs(docs.select(F.struct("*").alias("_row"), F.col("text")))
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("text")).alias("text")
    return found.select(*(text if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))
