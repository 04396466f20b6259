import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from basketlab.llm import byte_bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return B.Codec(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def truth(codec):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def _texts():
    rng = random.Random(4)
    letters = "abcdeth AZ09.,\n'é中\U0001F600-=_\u0085 "
    made = ["", "a" * 5000, "ab" * 3000, "=" * 777 + "x", " \n\n\t  hi  <|endoftext|> it's 'S", "\u0000\U0001F600é" * 50]
    made += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(200)]
    return made + ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(60, 2000))) for _ in range(40)]


def test_encodes_like_the_library_and_decodes_back(codec, truth):
    texts = _texts()
    got = codec.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [truth.encode_ordinary(t) for t in texts]
    assert codec.decode(got) == [t.encode() for t in texts]


def test_memory_of_pieces_is_bounded(codec, monkeypatch, truth):
    monkeypatch.setattr(B, "CACHE_PIECES", 50)
    texts = _texts()[:60]
    assert [np.frombuffer(g, "<u4").tolist() for g in codec.encode(texts)] == [truth.encode_ordinary(t) for t in texts]
    assert len(codec.memo) < 10_000


def test_frames(make, truth):
    rows = [(1, "hello world"), (1, "hello world"), (2, None), (None, ""), (3, "x" * 200_000)]
    df = make(rows, clash=("ids", "decoded"))
    out = B.encode(df, PATH, P.PATTERN, decode=True)
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "text"]
    for r in out.collect():
        t = r.text or ""
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == truth.encode_ordinary(t) and bytes(r.decoded) == t.encode()
    back = B.decode(B.encode(df, PATH, P.PATTERN).select("ids", F.col("doc_id")), PATH)
    assert all(r.decoded is not None for r in back.collect())
    assert B.encode(make([]), PATH, P.PATTERN).count() == 0


def test_query(spark, truth):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in B.op9_byte_bpe(spark, d).collect():
        ids = truth.encode_ordinary(docs[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
