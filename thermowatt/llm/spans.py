"""Substring deduplication over sliding sentence spans.

A text is cut into sentences: up to a period, question or exclamation mark and
closing quotes before white space, a full stop of a script that sets none after
it, or a line break. A sentence of more than ``MIN_WORDS`` words is cut further,
after word pairs chosen by their hash, so that equal parts of two sentences are
cut alike. Every run of at least ``MIN_SENTENCES`` such sentences and
``MIN_WORDS`` words is a span: the first of equal spans by doc_id and position
stays, and the sentences that any other one covers are removed. Overlapping
spans make one passage. Where a script has no blanks, two ideographs or kana
count as a word, or four letters.

Of all these runs, the shortest from every sentence on and the shortest up to
every sentence are hashed (128 bits, of lower-cased words with single blanks).
No run covers more than these: of a repeated run, a sentence from which the
rest of the run is long enough lies in the shortest run from it on, any other
one in the shortest run up to the last sentence; both lie within the run, so
they repeat where it does.

Hashes are counted before the join, with partial sums in each task; places are
only compared for those that come twice. Texts join once, by document.

Defined results: a null text has no sentences. A null doc_id counts as larger
than any other. Rows that repeat both doc_id and text count as one document
and are not held against each other. Extra columns are kept. Texts are taken
whole, however long; a text of one word over and over has no place to be cut.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import stored

MIN_SENTENCES = 2
MIN_WORDS = 25

#: A place to cut comes after one of this many word pairs.
CUT = 8

_END = re.compile(r"""[.!?]["'”’»)\]]*(?=\s)|[。！？｡।॥؟۔።]["'”’»)\]」』）】]*|\n""")
_IDEOGRAPHS = r"぀-ヿ㐀-䶿一-鿿豈-﫿"
_LETTERS = r"฀-໿က-႟ក-៿"
_DENSE, _THIN = re.compile(f"[{_IDEOGRAPHS}]"), re.compile(f"[{_LETTERS}]")
_WORD = re.compile(rf"[^\s{_IDEOGRAPHS}{_LETTERS}]+")
_BLANKS_APART = re.compile(r"\S+")
_TOKEN = re.compile(rf"[{_IDEOGRAPHS}{_LETTERS}]|[^\s{_IDEOGRAPHS}{_LETTERS}]+")


def _blanks_alone(text: str) -> bool:
    """Whether words are told by blanks alone."""
    return text.isascii() or not (_DENSE.search(text) or _THIN.search(text))


def n_words(text: str) -> int:
    if _blanks_alone(text):
        return len(text.split())
    return len(_WORD.findall(text)) + len(_DENSE.findall(text)) // 2 + len(_THIN.findall(text)) // 4


def _cuts(sentence: str, blanks: bool) -> list[int]:
    """Where a long sentence is cut; told by the two words before the place alone."""
    places = [m.span() for m in (_BLANKS_APART if blanks else _TOKEN).finditer(sentence)]
    words = [sentence[i:j].lower() for i, j in places]
    ends = (j for (_, j), pair in zip(places[1:], zip(words, words[1:])) if zlib.crc32(" ".join(pair).encode()) % CUT == 0)
    return [j for j in ends if j < len(sentence)]


def _sentences(text: str, blanks: bool) -> list[tuple[int, int]]:
    ends = [m.end() for m in _END.finditer(text)]
    out = []
    for start, stop in zip([0, *ends], [*ends, len(text)]):
        sentence = text[start:stop]
        if own := sentence.strip():
            start += len(sentence) - len(sentence.lstrip())
            # A sentence this short cannot have so many words.
            if len(own) <= MIN_WORDS or (len(own.split()) if blanks else n_words(own)) <= MIN_WORDS:
                out.append((start, start + len(own)))
                continue
            cuts = _cuts(own, blanks)
            for i, j in zip([0, *cuts], [*cuts, len(own)]):
                out.append((start + j - len(own[i:j].lstrip()), start + j))
    return out


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, stop) of the sentences of a text, or parts of long ones, in characters."""
    return _sentences(text, _blanks_alone(text))


def spans(text: str) -> list[tuple[int, int, int, bytes]]:
    """(first sentence, last sentence, words, hash) of the shortest spans from and up to each sentence of a text."""
    blanks = _blanks_alone(text)
    parts = [text[i:j].lower() for i, j in _sentences(text, blanks)]
    words = [p.split() for p in parts]
    joined = [" ".join(w) for w in words]
    until = [0, *accumulate(map(len, words) if blanks else map(n_words, parts))]

    def enough(first: int, stop: int) -> bool:
        return stop - first >= MIN_SENTENCES and until[stop] - until[first] >= MIN_WORDS

    runs, first = set(), 0
    for stop in range(1, len(parts) + 1):
        # All starts that this sentence is the first to suffice for, and the last start that suffices for it.
        begun = first
        while enough(first, stop):
            runs.add((first, stop))
            first += 1
        if begun == first and first and enough(first - 1, stop):
            runs.add((first - 1, stop))
    return [
        (i, j - 1, until[j] - until[i], xxhash.xxh3_128_digest("\n".join(joined[i:j])))
        for i, j in sorted(runs)
    ]


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 512):
            part = pdf.iloc[at : at + 512]
            found = [spans(text or "") for text in part["text"]]
            own = part[["doc_id", "doc_key"]].astype({"doc_id": "Int64"})
            out = own.loc[own.index.repeat([len(x) for x in found])].reset_index(drop=True)
            for column, place in (("first", 0), ("last", 1), ("hash", 3)):
                out[column] = pd.Series([span[place] for x in found for span in x], dtype="object" if place == 3 else "int32")
            yield out


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Non-first spans: doc_id, doc_key, first, last, first_doc_id."""
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc_key"), "text")
    found = stored(
        keyed.mapInPandas(_find, "doc_id long, doc_key long, first int, last int, hash binary"), "sentence-spans"
    )
    # Hashes alone are counted first: most come once, and a count is small to shuffle.
    twice = stored(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "span-hashes")
    found = stored(found.join(twice, "hash", "left_semi"), "repeated-spans")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key", "first")
    ends = found.groupBy("hash").agg(F.min(place).alias("kept"), F.max(place).alias("other")).where("kept <> other")
    ends = stored(ends.select("hash", "kept"), "span-firsts")
    return found.join(ends, "hash").where(place != F.col("kept")).select(
        "doc_id", "doc_key", "first", "last", F.col("kept.doc_id").alias("first_doc_id")
    )


def _passages(gone: list, text: str) -> list[tuple[int, int, int, int | None]]:
    """(first sentence, start, stop, first document) of each run of covered sentences."""
    places = sentences(text)
    out: list[list] = []
    for first, last, source in sorted(gone, key=lambda g: (g[0], g[1])):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last, source])
    return [(first, places[first][0], places[last][1], source) for first, last, source in out]


_PASSAGE = "array<struct<sentence: int, start: int, stop: int, words: int, first_doc_id: bigint, passage: string>>"


def _cut_out(lists: pd.Series, texts: pd.Series) -> pd.Series:
    out = []
    for gone, text in zip(lists, texts):
        own = _passages([(g["first"], g["last"], g["first_doc_id"]) for g in gone], text)
        out.append([
            {"sentence": s, "start": i, "stop": j, "words": n_words(text[i:j]), "first_doc_id": d, "passage": text[i:j]}
            for s, i, j, d in own
        ])
    return pd.Series(out, dtype=object)


def _without(lists: pd.Series, texts: pd.Series) -> pd.Series:
    out = []
    for gone, text in zip(lists, texts):
        if gone is None:
            out.append(text)
            continue
        parts, at = [], 0
        for _, start, stop, _ in _passages([(g["first"], g["last"], None) for g in gone], text):
            parts.append(text[at:start])
            at = stop
        out.append("".join(parts) + text[at:])
    return pd.Series(out, dtype=object)


def _gathered(docs: DataFrame) -> DataFrame:
    """(_doc_id, _doc_key, _gone): covered runs of each document; their number is bounded by its sentences."""
    names = F.col("doc_id").alias("_doc_id"), F.col("doc_key").alias("_doc_key")
    covered = repeated_spans(docs).groupBy(*names, "first", "last").agg(F.min("first_doc_id").alias("first_doc_id"))
    return covered.groupBy("_doc_id", "_doc_key").agg(F.collect_list(F.struct("first", "last", "first_doc_id")).alias("_gone"))


def _with_gone(docs: DataFrame, how: str) -> DataFrame:
    """``docs`` with _gone; a document is known by its id and the hash of both id and text."""
    key = F.xxhash64("doc_id", "text")
    return docs.join(_gathered(docs), (key == F.col("_doc_key")) & F.col("doc_id").eqNullSafe(F.col("_doc_id")), how)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per removed passage: doc_id, sentence, start, stop (in characters), words, first_doc_id, passage."""
    rows = _with_gone(docs.select("doc_id", "text"), "inner")
    rows = rows.select("doc_id", F.explode(F.pandas_udf(_cut_out, _PASSAGE)("_gone", "text")).alias("p"))
    return rows.select("doc_id", "p.*")


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of their texts."""
    # The document as one struct: its columns may have any names.
    left = _with_gone(docs.select("doc_id", "text", F.struct("*").alias("_doc")), "left")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.pandas_udf(_without, "string")("_gone", "text"))
    return left.select(*(text.alias(c) if c == "text" else F.col("_doc").getField(c).alias(c) for c in docs.columns))
