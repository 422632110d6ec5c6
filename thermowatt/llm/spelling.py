"""Spelling variants: words one edit apart, grouped under their most frequent form.

Search scheme: of two words one edit apart the shorter (or either, if they are
as long) has a half that the other has unchanged at the same end. So words meet
in a shard by a half: as a prefix or as a suffix. A shard indexes its words, with a
delimiter around each, in a bidirectional FM-index: the ranks of suffixes of the
text and of its reverse, and pairs of intervals that grow by a letter on either
side. A word's exact half is matched from its inner end to the
delimiter; then the interval is extended across the other half, letter by
letter, with one error allowed: a letter replaced or one more. A letter less is
found from the other word. What reaches the far delimiter is one word of the
vocabulary.

A shard holds some ``SHARD_WORDS`` words. A half that more words share is cut
into parts, and every pair of parts gets a shard: one to index, one to look up.

Defined results: null words and those shorter than ``min_length`` code points
are left out. A word that occurs in several rows has the sum of their numbers;
null numbers count as 0. Lengths and edits are in code points. Ties go to the
word that is first in code-point order. Words are taken whole, whatever their length.
Extra columns are ignored. No rows: an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

MIN_LENGTH = 7
#: A form is at least this many times as frequent as its variant.
RATIO = 10
#: Words to a shard, about, and words that may share a half before it is dealt over several shards.
SHARD_WORDS = 100_000
#: Words looked up at once.
LOOKUPS = 4_096

_END, _BORDER, _LETTERS = 0, 1, 2  # symbols: end of the text, delimiter, letters from here on


def suffix_ranks(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of all suffixes in order: sorted by as many symbols as fit a number, then by twice as many, and so on."""
    n = len(text)
    bits = max(1, int(symbols - 1).bit_length())
    width = max(1, 62 // bits)
    padded = np.concatenate((text, np.zeros(width, np.int64)))
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = key << bits | padded[i : i + n]
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        later = np.zeros(n, np.int64)
        later[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + later
        width *= 2


class _Ranks:
    """How many symbols before a place are at most a given one: a bit per symbol and place, and sums every 64 places."""

    def __init__(self, text: np.ndarray, symbols: int):
        suffixes = suffix_ranks(text, symbols)
        before = text[suffixes - 1]
        self.words = (len(text) >> 6) + 1
        self.bits = np.zeros((symbols, self.words), np.uint64)
        row = np.zeros(self.words * 64, bool)
        for c in range(symbols):
            row[: len(text)] = before <= c
            self.bits[c] = np.packbits(row, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.bits).astype(np.int64)
        self.sums = (np.cumsum(ones, 1) - ones).ravel()
        self.bits = self.bits.ravel()
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        # Of suffixes that begin with a delimiter: the place of that delimiter.
        self.borders = suffixes[self.first[_BORDER] : self.first[_BORDER + 1]]

    def up_to(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        at = symbol * self.words + (place >> 6)
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[at] + np.bitwise_count(self.bits[at] & mask)


#: Interval pairs: first rank among suffixes, first rank among those of the reverse, size.
_Intervals = tuple[np.ndarray, np.ndarray, np.ndarray]


def _points(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)


class BidirectionalIndex:
    """Words between delimiters, searchable to both sides."""

    def __init__(self, words: list[str]):
        self.alphabet = np.unique(np.concatenate([_points(w) for w in words]))
        self.letters = np.arange(_LETTERS, _LETTERS + len(self.alphabet))
        self.symbols = len(self.alphabet) + _LETTERS + 1  # the last one is any other letter, which occurs nowhere
        codes = [self.encode(w) for w in words]
        border = np.array([_BORDER])
        line = np.concatenate([x for c in codes for x in (border, c)] + [border])
        starts = np.cumsum([0] + [len(c) + 1 for c in codes[:-1]])
        end = np.array([_END])
        self.forth = _Ranks(np.concatenate((line, end)), self.symbols)
        self.back = _Ranks(np.concatenate((line[::-1], end)), self.symbols)
        self.size = len(line) + 1
        # Which word begins, or ends, at a delimiter.
        word = np.full(len(line), -1)
        word[starts] = np.arange(len(words))
        self.beginning = word[self.forth.borders]
        word = np.full(len(line), -1)
        word[starts + np.array([len(c) + 1 for c in codes])] = np.arange(len(words))
        self.ending = word[len(line) - 1 - self.back.borders]

    def encode(self, word: str) -> np.ndarray:
        points = _points(word)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + _LETTERS, self.symbols - 1).astype(np.int64)

    def side(self, right: bool) -> tuple[_Ranks, np.ndarray]:
        """(what extends to that side, word of each delimiter where a whole word was found by extending to it)."""
        return (self.back, self.beginning) if right else (self.forth, self.ending)


def _extend(ranks: _Ranks, own: np.ndarray, other: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> _Intervals:
    """Intervals one symbol longer on the side that ``ranks`` extends; ``own`` are the first ranks there."""
    low, high = ranks.up_to(symbol - 1, own), ranks.up_to(symbol - 1, own + size)
    first, last = ranks.up_to(symbol, own) - low, ranks.up_to(symbol, own + size) - high
    return ranks.first[symbol] + first, other + high - low, last - first


def _look_up(index: BidirectionalIndex, right: bool, letters: np.ndarray, start: np.ndarray, length: np.ndarray, half: np.ndarray):
    """(query, word) of indexed words one edit away in what follows the first ``half`` letters.

    ``letters`` holds the queries' symbols end to end; if not ``right``, reversed ones, and
    all directions are the other way round.
    """
    inwards, _ = index.side(not right)
    outwards, word_at = index.side(right)
    count = len(start)
    # The exact half, extended from its inner end to the delimiter.
    own, other, size = np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, index.size)
    for t in range(int(half.max()) + 1):
        q = np.flatnonzero((t <= half) & (size > 0))
        at = half[q] - 1 - t
        symbol = np.where(at >= 0, letters[start[q] + np.maximum(at, 0)], _BORDER)
        own[q], other[q], size[q] = _extend(inwards, own[q], other[q], size[q], symbol)
    # Across the rest: intervals without an error, and those with one.
    z = np.flatnonzero(size > 0)
    clean = z, other[z], own[z], size[z]
    none = np.empty(0, np.int64)
    marred = none, none, none, none
    found_q, found_w = [none], [none]
    every = index.letters
    step = 0
    while len(clean[0]) or len(marred[0]):
        q, own, other, size = clean
        at = half[q] + step
        # One error here: any letter instead of the next, or before it.
        wide = [np.repeat(x, len(every)) for x in clean]
        symbol = np.tile(every, len(q))
        grown = _extend(outwards, *wide[1:], symbol)
        there = grown[2] > 0
        branch = wide[0][there], *(g[there] for g in grown)
        symbol, place = symbol[there], half[branch[0]] + step
        more = place < length[branch[0]]
        expected = np.where(more, letters[start[branch[0]] + np.minimum(place, length[branch[0]] - 1)], _BORDER)
        replaced = [x[more & (symbol != expected)] for x in branch]
        marred = tuple(np.concatenate(x) for x in zip(marred, branch))
        # All go on by the next letter of their query, the delimiter behind the last one.
        done = at >= length[q]
        clean = _advanced(outwards, [x[~done] for x in clean], letters, start, length, half + step)
        over = half[marred[0]] + step >= length[marred[0]]
        ended = _advanced(outwards, [x[over] for x in marred], letters, start, length, half + step)
        found_q.append(ended[0])
        # Suffix ranks of the side searched from: what was found begins there with a delimiter.
        found_w.append(word_at[ended[2] - inwards.first[_BORDER]])
        going = _advanced(outwards, [x[~over] for x in marred], letters, start, length, half + step)
        marred = tuple(np.concatenate(x) for x in zip(going, replaced))
        step += 1
    return np.concatenate(found_q), np.concatenate(found_w)


def _advanced(ranks: _Ranks, states, letters, start, length, place):
    q = states[0]
    at = place[q]
    symbol = np.where(at < length[q], letters[start[q] + np.minimum(at, length[q] - 1)], _BORDER)
    grown = _extend(ranks, *states[1:], symbol)
    there = grown[2] > 0
    return q[there], *(g[there] for g in grown)


def near_words(index: BidirectionalIndex, asked: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(asked word, indexed word) of the indexed words that share the left half (``right``: the rest lies there) or else
    the right half of an asked one and differ from it by one replaced or one more letter in the rest; places in the lists.
    """
    pairs = []
    for at in range(0, len(asked), LOOKUPS):
        codes = [index.encode(w)[:: 1 if right else -1] for w in asked[at : at + LOOKUPS]]
        length = np.array([len(c) for c in codes])
        half = length // 2 if right else length - length // 2
        q, w = _look_up(index, right, np.concatenate(codes), np.cumsum(length) - length, length, half)
        pairs.append(np.unique(np.stack((at + q, w)), axis=1))
    found = np.concatenate(pairs, 1) if pairs else np.empty((2, 0), np.int64)
    return found[0], found[1]


_FOUND = "word string, near string, near_n long"


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pairs of near words of a shard, either way round."""
    indexed = pdf[pdf["indexed"]].drop_duplicates("word")
    out = [pd.DataFrame({"word": [], "near": [], "near_n": []}, dtype=object).astype({"near_n": "int64"})]
    if len(indexed):
        index = BidirectionalIndex(indexed["word"].tolist())
        words, numbers = indexed["word"].to_numpy(dtype=object), indexed["n"].to_numpy()
        for right in (True, False):
            asked = pdf[pdf["asked"] & (pdf["prefix"] == right)]
            own, own_n = asked["word"].to_numpy(dtype=object), asked["n"].to_numpy()
            q, w = near_words(index, own.tolist(), right)
            out.append(pd.DataFrame({"word": own[q], "near": words[w], "near_n": numbers[w]}))
            out.append(pd.DataFrame({"word": words[w], "near": own[q], "near_n": own_n[q]}))
    return pd.concat(out).drop_duplicates(["word", "near"])


def _halves(min_length: int) -> Column:
    """Where a word is indexed, and where it is looked up: by its own halves, and by those a word one letter shorter would have."""
    return F.expr(f"""
        filter(array(
            struct(true AS prefix, left(word, m div 2) AS half, true AS asked),
            struct(false AS prefix, right(word, m - m div 2) AS half, true AS asked),
            IF(m % 2 = 0 AND m > {min_length}, struct(true AS prefix, left(word, (m - 1) div 2) AS half, false AS asked), NULL),
            IF(m % 2 = 1 AND m > {min_length}, struct(false AS prefix, right(word, m - 1 - (m - 1) div 2) AS half, false AS asked), NULL)
        ), x -> x IS NOT NULL)
    """)


def near_pairs(vocabulary: DataFrame, min_length: int = MIN_LENGTH, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows (word, near, near_n) for all words of ``vocabulary`` (word, n; each word once) one edit apart, each pair either way."""
    rows = vocabulary.withColumn("m", F.length("word")).select("word", "n", F.explode(_halves(min_length)).alias("h")).select("word", "n", "h.*")
    rows = stored(rows, "spelling-halves")
    shared = rows.groupBy("prefix", "half").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > shard_words)
    shared = stored(shared.selectExpr("prefix", "half", "size", f"size div {shard_words} + 1 AS parts"), "spelling-shared-halves")
    copies = shared.agg(F.sum(F.expr("2 * size * parts")).alias("n")).first()["n"] or 0
    shards = max(16, -(-(rows.count() + copies) // shard_words))
    # Word i of a shared half is indexed in cells (i, all) and looked up in cells (all, i) of a square.
    cells = """
        concat(
            transform(sequence(0L, parts - 1), j -> struct(home AS i, j AS j, true AS indexed, asked AND j = home AS asked)),
            IF(asked, transform(filter(sequence(0L, parts - 1), i -> i <> home), i -> struct(i AS i, home AS j, false AS indexed, true AS asked)), array())
        )
    """
    dealt = rows.join(shared.drop("size"), ["prefix", "half"], "left").selectExpr(
        "word", "n", "prefix", "half", "asked", "coalesce(parts, 1L) AS parts", "pmod(xxhash64(word), coalesce(parts, 1L)) AS home"
    ).selectExpr("word", "n", "prefix", "half", f"explode({cells}) AS c").selectExpr(
        "word", "n", "prefix", "c.asked", "c.indexed", f"pmod(xxhash64(prefix, half, c.i, c.j), {shards}L) AS shard"
    )
    return dealt.groupBy("shard").applyInPandas(_search, _FOUND).distinct()


def spelling_variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root) of the distinct words of ``words`` (word, n).

    ``n_near`` counts the words one edit away. The most frequent of them is the
    word's form, if it is ``ratio`` times as frequent at least. The root is the last of the forms' forms.
    """
    vocabulary = words.where(F.length("word") >= min_length).groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    vocabulary = stored(vocabulary, "spelling-vocabulary")
    best = near_pairs(vocabulary, min_length, shard_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top")
    )
    is_form = f"-top.less >= {ratio} * n AND n_near > 0"
    found = vocabulary.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near", f"IF({is_form}, top.near, NULL) AS form", f"IF({is_form}, -top.less, NULL) AS form_n"
    )
    found = stored(found, "spelling-forms")
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # A form is ``ratio`` times as frequent, so a chain of forms is short; each round doubles how far a word looks ahead.
    most = found.agg(F.max("form_n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(1, math.log(max(most, 2), max(ratio, 2)) + 1)))):
        roots = stored(roots, "spelling-roots")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(ahead, "root", "left").selectExpr("word", "coalesce(next, root) AS root")
    return found.join(roots, "word", "left").selectExpr("word", "n", "n_near", "form", "form_n", "coalesce(root, word) AS root")
