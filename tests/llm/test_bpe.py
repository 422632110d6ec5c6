import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from thermowatt.llm import bpe

FILE = P.path("byte_bpe_multi_50k.tiktoken")
ODD = [chr(i) for i in range(32, 127)] + list("\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0　 éßñªº²½漢字😀́١٢Ⅷ'sSǅ ")


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def shared(spark):
    return bpe.codec(spark, FILE, P.PATTERN)


def texts(n=600):
    rng = random.Random(4)
    for _ in range(n):
        yield "".join(rng.choice(ODD) for _ in range(rng.randrange(50)))
    yield from ("", " ", "  x", "don't we'll I'VE", "a" * 5000 + "ab" * 3000, "\n\n  \n x", "<|endoftext|>")


def test_same_ids_as_the_library(library, shared):
    for t in texts():
        ids = shared.value.encode(t).tolist()
        assert ids == library.encode_ordinary(t)
        assert shared.value.decode(ids) == t.encode()


def test_memo_of_two_generations(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    own = bpe.Codec([library.decode_single_token_bytes(i) for i in range(library.n_vocab)], P.PATTERN)
    for t in [*texts(50), *texts(50)]:
        assert own.encode(t).tolist() == library.encode_ordinary(t)
        assert len(own.memo) <= 4100 and len(own.older) <= 4100


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.slots) == list(range(5000))
    assert [table.get(k) for k in keys] == list(range(5000))
    assert table.get(b"x") is None and bpe.PerfectHash([]).get(b"x") is None


def test_digests_of_a_table(spark, shared, library):
    rows = [(1, "Some text, and more."), (2, None), (3, ""), (3, ""), (None, "漢字 " * 20_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.text): (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_digests(df, shared).collect()}
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        listed = ",".join(map(str, ids)).encode()
        want = len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        assert got[doc_id, text] == want
    assert bpe.bpe_digests(df.where("false"), shared).collect() == []


def test_columns_round_trip(spark, shared):
    df = spark.createDataFrame([(t,) for t in texts(40)] + [(None,)], "text string")
    out = df.withColumn("ids", bpe.encode_column(df["text"], shared))
    out = out.withColumn("raw", bpe.decode_column(out["ids"], shared))
    for r in out.collect():
        assert bytes(r.raw) == (r.text or "").encode()


def test_documents_keep_their_columns(spark, shared, library):
    rows = [(1, "Some text.", None), (None, None, 2), (3, "", 3), (3, "", 3), (2**60 + 1, "long text " * 30_000, 4)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n long, token_ids string")
    out = bpe.encode_documents(df, shared)
    assert out.columns == ["doc_id", "text", "n", "token_ids", "n_tokens", "round_trip"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = [(*r, ids, len(ids), True) for r in rows for ids in [library.encode_ordinary(r[1] or "")]]
    assert got == sorted(want, key=str)
    assert bpe.encode_documents(df.where("false"), shared).collect() == []
