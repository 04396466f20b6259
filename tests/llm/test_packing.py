import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from basketlab.llm import packing as K
from basketlab.llm.common import table

PATH = P.path("byte_bpe_50k.json")


def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(rows, docs, size):
    """Every id of every document lies in one piece; windows are gapless, at most ``size``; returns the padding."""
    t, want = tokenizer(), defaultdict(list)
    for d, text in docs:
        want[d].append(np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == np.cumsum([0, *[n for _, n in w]])[:-1].tolist() and sum(n for _, n in w) <= size
    assert pieces.keys() == want.keys()
    for d, rs in pieces.items():
        crc = lambda ids: zlib.crc32(ids.tobytes())
        if len(want[d]) == 1:
            ids, at = want[d][0], 0
            for r in sorted(rs, key=lambda r: r.start):
                assert r.start == at and r.ids_crc32 == crc(ids[at : at + r.length]) and r.doc_tokens == len(ids)
                at += r.length
            assert at == len(ids)
        else:
            assert sum(r.length for r in rs) == sum(map(len, want[d]))
    fill = [sum(n for _, n in w) for w in windows.values()]
    return sum(0 if n & (n - 1) == 0 else size - n for n in fill)


def texts():
    rng = random.Random(1)
    v = ["word", "The", "it's", "don't", "naïve", "Über", "x1", "$$$", "end.", "a,b", "(q)", "…", "éé!", "日本語", "\U0001f600", "<|endoftext|>", "'s", "ǅ", "ﬁ", "º", "12", "_", "ab́c", "٠"]
    marks = [" ", " ", " ", " ", "\n", "  ", "\n\n", "\t", " \n", " ", "\r\n", " ", "\x1c", "\x85"]
    made = ["".join(rng.choice(v) + (rng.choice(marks) if rng.random() < 0.15 else " ") for _ in range(rng.randint(0, 80))).strip(rng.choice(["", " "])) for _ in range(400)]
    made = [*made, "", None, " ", "\n", " lead", "trail ", "\n\nlead", "trail\n\n", "a  b", "a \n b", "'s", " 's ok", "word " * 20_000, "w" * 3_000, "it's we'll I'd '" + "'s 'S''t", "a1b2 3c%%% $$$ $x .,;", "line one\nline two. it's\n'so", "º ª × ÷ ǆ ȡ", "1 a\n2\n'"]
    return made + ["".join(rng.choice("aB1é'$., \n") for _ in range(rng.randint(1, 30))) for _ in range(600)]


def test_chunks_encode_like_whole_texts(monkeypatch):
    monkeypatch.setattr(K, "CACHE_CHUNKS", 50)
    monkeypatch.setattr(K, "CACHE_PIECES", 40)
    t, c = tokenizer(), K.ChunkCodec(PATH)
    every = [x or "" for x in texts()]
    for k in range(0, len(every), 7):
        part = every[k : k + 7]
        assert [np.frombuffer(x, "<u4").tolist() for x in c.encode(part)] == [e.ids for e in t.encode_batch(part, add_special_tokens=False)]


def test_level_minimises_the_sum_of_squares():
    rng = np.random.default_rng(2)
    for _ in range(300):
        p = K.Packer(16)
        p.count[1:16] = rng.integers(0, 4, 15)
        s = int(rng.integers(1, 16))

        def after(h):
            n = p.count.astype(object)
            n = n.copy()
            if h:
                n[h] -= 1
            if h + s < 16:
                n[h + s] += 1
            return sum(int(x) ** 2 for x in n)

        fits = [h for h in range(0, 16 - s + 1) if h == 0 or p.count[h]]
        best = min(after(h) for h in fits)
        assert after(p.level(s)) == best and p.level(s) == max(h for h in fits if after(h) == best)


@pytest.mark.parametrize("size, most", [(16, 1 << 22), (64, 200), (16, 16)])
def test_packer_loses_nothing_and_pads_nothing(size, most):
    rng = random.Random(size + most)
    p, docs = K.Packer(size, most), {}
    for d in range(500):
        n = rng.choice([1, 3, size // 2 + 1, size - 1, size, size + 1, rng.randint(1, 5 * size)])
        docs[d] = np.array([rng.randrange(1 << 32) for _ in range(n)], "<u4")
        p.add(d, docs[d].tobytes())
        assert p.held <= most
    p.finish()
    at, fill = defaultdict(list), defaultdict(list)
    for d, start, n, crc, w, offset in p.out:
        assert crc == zlib.crc32(docs[d][start : start + n].tobytes())
        at[d].append((start, n))
        fill[w].append((offset, n))
    for d, x in docs.items():
        assert sorted(a for a, _ in at[d]) == np.cumsum([0, *[n for _, n in sorted(at[d])]])[:-1].tolist() and sum(n for _, n in at[d]) == len(x)
    sizes = [sum(n for _, n in w) for w in fill.values()]
    assert all(n == size or n & (n - 1) == 0 for n in sizes) and len([n for n in sizes if n < size]) <= size.bit_length()
    assert all(sorted(o for o, _ in w) == np.cumsum([0, *[n for _, n in sorted(w)]])[:-1].tolist() for w in fill.values())


def test_pack_on_odd_texts(make):
    docs = list(enumerate(texts())) + [(3, "same id"), (None, "no id"), (None, None)]
    rows = K.pack(make(docs, clash=("start", "offset", "length")), PATH, 1).collect()
    assert check(rows, docs, 2048) == 0
    assert K.pack(make([]), PATH, 1).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, d, "documents").collect()]
    assert check(K.op12_packing(spark, d).collect(), docs, 2048) == 0
