import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from basketlab.llm import token_files as K
from basketlab.llm.common import new_folder

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def truth():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        h = K.PerfectHash.build(keys)
        assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))


def test_chunked_encoding_is_the_librarys(truth):
    rng = random.Random(1)
    letters = "abAB 'sTé́̀\n\t\r\x0b\x1c\x85\xa0 ΣσςİßǅﬁＡ中\U0001F600.,!?<|startoftext|>0129"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["<|endoftext|> x <|startoftext|>", "IT'S it'LL", "", "z" * 3000]
    c = K.WordCodec(PATH)
    assert [np.frombuffer(x, c.kind).tolist() for x in c.encode(texts)] == [truth(t) for t in texts]


def test_plain_characters_follow_the_librarys_rules(truth):
    """Every character that is split here, alone and between others."""
    plain = [c for c in map(chr, range(0x3000)) if K._OTHER.match(c) is None]
    assert {"a", "Z", "é", "ß", "Ж", "ё", "7", "!", "’", "—", "\t"} < set(plain)
    assert not {"\x0b", "\x1c", "\x85", "\xa0", "\u0301", "İ", "²", "Σ", "\u2028"} & set(plain)
    rng = random.Random(5)
    texts = [f"{c} x{c}y {c}{c} .{c}! 1{c}2 '{c}" for c in plain]
    texts += ["".join(rng.choices(plain, k=40)) for _ in range(500)]
    texts += ["".join(rng.choices("sStTrReEvVmMlLdD''\" ", k=40)) for _ in range(500)]
    c = K.WordCodec(PATH)
    assert [np.frombuffer(x, c.kind).tolist() for x in c.encode(texts)] == [truth(t) for t in texts]


def test_mixed_texts_through_a_small_memory(truth, monkeypatch):
    rng = random.Random(6)
    words = ["don't", "Ab", "ab.", "e\u0301", "中文", "x²y", "...", "4.5", "Σας", "\n", "a\x85b", "“quote”", "\u0301", ""]
    texts = [" ".join(rng.choice(words) + rng.choice("aB7!é") * rng.randint(0, 3) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    for name, most in (("CACHE_PIECES", 20), ("CACHE_CHARS", 60)):
        with monkeypatch.context() as m:
            m.setattr(K, name, most)
            c = K.WordCodec(PATH)
            for k in range(0, len(texts), 10):  # several rounds, so that the memory is cleared between them
                part = texts[k : k + 10]
                assert [np.frombuffer(x, c.kind).tolist() for x in c.encode(part)] == [truth(t) for t in part]
                assert len(c.number) == len(c.first) == len(c.size)


class Listening:
    """The tokenizer, noting what it is asked to encode."""

    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, []

    def encode(self, text, **options):
        self.asked.append(text)
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.asked += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_known_words_are_not_encoded_again_beside_odd_characters():
    """Digits, quotes or a rare character must not make the library encode a text's known words once more."""
    c = K.WordCodec(PATH)
    c.encode(["Alpha, beta. gamma delta"])
    c.tokenizer = Listening(c.tokenizer)
    c.encode(["alpha beta! Gamma-delta", "Alpha's 'beta'", "beta4gamma, (alpha) 中"])
    asked = " ".join(c.tokenizer.asked).split()
    assert sorted(asked) == sorted(["!", "-", "'s", "'", "4", "(", ")", "中"])


def test_failed_learning_leaves_no_numbers_without_ids(truth, monkeypatch):
    c = K.WordCodec(PATH)
    with monkeypatch.context() as m:
        m.setattr(c, "_learn", lambda new: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            c.encode(["some words"])
    assert [np.frombuffer(x, c.kind).tolist() for x in c.encode(["some words"])] == [truth("some words")]


def test_files_round_trip(spark, make, truth):
    rows = [(None, "a"), (None, None), (5, "b c"), (5, "b c"), (5, "b d"), (1, ""), (7, "z" * 100), (-3, "neg")] + [(9, f"hot {i}") for i in range(60)]
    folder = new_folder(spark, "test")
    catalog = K.write_shards(make(rows, clash=("key", "name")), PATH, 2, folder)
    found = K.read_records(catalog, folder).join(K.shard_starts(catalog), "name").collect()
    got = [(r.key, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in found]
    assert sorted(got, key=str) == sorted([(k, truth(t) + [2]) for k, t in rows], key=str)
    # starts tile the stream in key order
    at = 0
    for r in sorted(found, key=lambda r: r.start + r.at):
        assert r.start + r["at"] == at
        at += len(r.ids) // 4
    keys = [r.key for r in sorted(found, key=lambda r: r.start + r["at"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    name = catalog.where("key = 7").first()["name"]
    first, count = K.Shard(folder, name).find(K.hashable(np.array([7, 123456789])))
    assert count.tolist() == [1, 0]


def test_empty_table(spark, make):
    folder = new_folder(spark, "test")
    assert K.write_shards(make([]), PATH, 2, folder).count() == 0


def test_query(spark, truth):
    d = "/root/testdata/sf0.001"
    at, expected = 0, []
    for r in sorted(spark.read.parquet(f"{d}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = truth(r.text) + [2]
        expected.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in K.op8_token_files(spark, d).collect()) == expected
