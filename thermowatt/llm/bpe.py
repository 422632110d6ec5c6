"""Byte-level BPE encoding and decoding.

A text is cut into pre-tokens. Tier one: a minimal perfect hash over the
vocabulary resolves a pre-token that is a token as a whole with one hash, one
displacement and one comparison. Tier two, for the rest: the bytes form a
linked list, and a heap of (rank, position) yields the next pair to merge, so
a pre-token of n bytes takes O(n log n). What either tier found is remembered
per task in a memo of bounded size. Rows need no shuffle.

Defined results: a null text is the empty text, with no ids. Decoding any ids
gives their bytes back, exactly those of the text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Entries of a task's memo; a full one becomes the older of two, and its words move over when they come again.
MEMO_ENTRIES = 250_000
#: Longer pre-tokens are not remembered, which bounds the memo in bytes.
MEMO_BYTES = 64


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Tokens by id from a file of lines ``base64 rank``. A vocabulary is a parameter of fixed size, some 1 MB."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """Minimal perfect hash by displacement: n keys, n slots, one displacement for about three keys.

    A bucket with several keys has a displacement >= 0 that spreads them; one
    with a single key stores ``-1 - slot``.
    """

    def __init__(self, keys: list[bytes]):
        n = max(1, len(keys))
        self.keys, self.size, self.buckets = keys, n, n // 3 + 1
        members: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_128_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            members.setdefault((h & 0xFFFFFFFF) % self.buckets, []).append(i)
        self.shift, self.slots = [0] * self.buckets, [-1] * n
        free, next_free = bytearray(b"\1") * n, 0
        for bucket, own in sorted(members.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:
                next_free = free.index(1, next_free)
                places, self.shift[bucket] = [next_free], -1 - next_free
            else:
                d = 0
                while True:
                    places = [self._place(hashes[i], d) for i in own]
                    if all(map(free.__getitem__, places)) and len(set(places)) == len(own):
                        break
                    d += 1
                self.shift[bucket] = d
            for place, i in zip(places, own):
                free[place], self.slots[place] = 0, i

    def _place(self, h: int, d: int) -> int:
        x = ((h >> 32 ^ d * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
        return (x >> 32) % self.size

    def get(self, key: bytes) -> int | None:
        """The key's place in the list of keys, None if it isn't one."""
        h = xxhash.xxh3_128_intdigest(key)
        d = self.shift[(h & 0xFFFFFFFF) % self.buckets]
        at = self.slots[-1 - d if d < 0 else self._place(h, d)]
        return at if at >= 0 and self.keys[at] == key else None


def merge_bytes(piece: bytes, rank_of: Callable[[bytes], int | None]) -> list[int]:
    """Ids of a pre-token: the pair of lowest rank is merged first, the leftmost of equals."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the token that starts here ends; 0: merged into an earlier one
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := rank_of(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, stop = pop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (rank := rank_of(piece[i : end[stop]])) is not None:
                push(heap, (rank, i, end[stop]))
        if (j := before[i]) >= 0 and (rank := rank_of(piece[j:stop])) is not None:
            push(heap, (rank, j, stop))
    ids, i = [], 0
    while i < n:
        ids.append(rank_of(piece[i : end[i]]))
        i = end[i]
    return ids


def narrow_pattern(pattern: str, top: int = 0x250) -> re.Pattern | None:
    """The pattern for texts below code point ``top``, with classes written out, which the plainer engine runs faster.

    None if the pattern has other escapes than letters, numbers and white space.
    """
    if re.search(r"\\(?!p\{[LN]\}|[sS])", pattern):
        return None

    def members(kind: str) -> str:
        return "".join(re.escape(chr(i)) for i in range(top) if regex.match(kind, chr(i)))

    out, inside, i = [], False, 0
    while i < len(pattern):
        kind = next((k for k in (r"\p{L}", r"\p{N}", r"\s", r"\S") if pattern.startswith(k, i)), None)
        if kind:
            body = members(kind)
            out.append(body if inside else f"[{body}]")
            i += len(kind)
            continue
        inside = inside and pattern[i] != "]" or pattern[i] == "["
        out.append(pattern[i])
        i += 1
    return re.compile("".join(out))


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.table = PerfectHash(tokens)
        self.ranks = {token: i for i, token in enumerate(tokens)}  # of pairs to merge
        self._start()

    def _start(self) -> None:
        self.by_decimal = {str(i): token for i, token in enumerate(self.tokens)}
        self.memo: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.cuts = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("by_decimal", "memo", "older", "cuts")}

    def __setstate__(self, state):
        self.__dict__ = state
        self._start()

    def pretokens(self, text: str) -> list[str]:
        if self.cuts is None:
            narrow = narrow_pattern(self.pattern)
            self.cuts = regex.compile(self.pattern).findall, narrow and narrow.findall
            self.wide = re.compile("[\u0250-\U0010ffff]").search
        whole, narrow = self.cuts
        return narrow(text) if narrow and not self.wide(text) else whole(text)

    def piece(self, text: str) -> str:
        """Ids of a pre-token as decimals, with a comma after each."""
        raw = text.encode()
        if (found := self.older.get(text)) is None:
            whole = self.table.get(raw)
            ids = [whole] if whole is not None else merge_bytes(raw, self.ranks.get)
            found = "".join([f"{i}," for i in ids])
        if len(raw) <= MEMO_BYTES:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo, self.older = {}, self.memo
            self.memo[text] = found
        return found

    def listed(self, text: str) -> str:
        """Ids of a text as decimals joined by commas."""
        piece, out = self.piece, []
        pretokens = self.pretokens(text)
        for at in range(0, len(pretokens), 4096):  # the memo may be exchanged in between
            known = self.memo.get
            out += [known(t) or piece(t) for t in pretokens[at : at + 4096]]
        return "".join(out)[:-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, four bytes each."""
        return np.fromstring(self.listed(text), np.int32, sep=",")

    def decode(self, ids) -> bytes:
        """The bytes of ids; a long list is joined piece by piece."""
        ids = np.asarray(ids, np.int32)
        pieces = (map(self.tokens.__getitem__, ids[at : at + 65536].tolist()) for at in range(0, len(ids), 65536))
        return b"".join([b"".join(p) for p in pieces])

    def digests(self, text: str) -> tuple[int, str, str]:
        listed = self.listed(text)
        ids = listed.split(",") if listed else []
        decoded = b"".join(map(self.by_decimal.__getitem__, ids))
        return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def codec(spark: SparkSession, vocabulary: str, pattern: str):
    """The codec as a broadcast; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(Codec(read_ranks(spark, vocabulary), pattern))


def encode_column(text: Column, shared) -> Column:
    """array<int> of the ids of ``text``."""

    @F.pandas_udf("array<int>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for s in texts:
            yield pd.Series([own.encode(t) for t in s], dtype=object)

    return encode(F.coalesce(text, F.lit("")))


def decode_column(ids: Column, shared) -> Column:
    """The bytes that ids stand for; null if the ids are null."""

    @F.pandas_udf("binary")
    def decode(arrays: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for s in arrays:
            yield pd.Series([None if a is None else own.decode(a) for a in s], dtype=object)

    return decode(ids)


def encode_documents(docs: DataFrame, shared) -> DataFrame:
    """``docs`` with token_ids, n_tokens and round_trip (whether the ids decode to the text).

    Encoded and decoded in one pass, a few hundred rows at a time, so that memory
    does not depend on the size of the batches Spark hands over.
    """
    names = [c for c in docs.columns if c not in ("token_ids", "n_tokens", "round_trip")]
    rows = docs.select(*names)
    schema = T.StructType([
        *rows.schema.fields,
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = [own.encode(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    *part.columns,
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([own.decode(i) == t.encode() for i, t in zip(ids, texts)], pa.bool_()),
                ], names=schema.names)

    return rows.mapInArrow(encode, schema)


def bpe_digests(docs: DataFrame, shared) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of its texts, encoded and decoded again."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for s in texts:
            yield pd.DataFrame([own.digests(t) for t in s], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn("_d", digests(F.coalesce("text", F.lit("")))).select(
        *[F.col(c) for c in docs.columns if c not in ("n_tokens", "ids_sha256", "decoded_sha256")], "_d.*"
    )
