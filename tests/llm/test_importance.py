import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from basketlab.llm import importance as I
from basketlab.llm.common import table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def feats(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    return len(w), [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, bench):
    s, t = [0] * 10_000, [0] * 10_000
    for side, texts in ((s, [x for _, x in docs]), (t, bench)):
        for x in texts:
            for b in feats(x)[1]:
                side[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    rows = []
    for d, x in docs:
        n, f = feats(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: 25 * len(fit) // 100]):
        r[4] = k + 1
    return sorted([tuple(r[:5]) for r in rows], key=str)


def got(df):
    return sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()], key=str)


def test_matches_brute_force(spark, make, monkeypatch):
    monkeypatch.setattr(I, "CHUNK", 300)
    rng = random.Random(4)
    v = ["a", "B", "The", "of", "éÀ", "x1", "\U0001f600", "data", "zz9"]
    marks = [" ", "-", "\n", "\x00", "  ", "\x7f."]
    text = lambda k: "".join(rng.choice(v) + rng.choice(marks) for _ in range(k))
    docs = [(i, text(rng.randint(0, 60))) for i in range(150)]
    docs += [(None, None), (None, text(30)), (None, text(30)), (500, ""), (7, docs[7][1]), (7, docs[7][1]), (501, "..."), (502, "word " * 100_000), (503, "éa" * 50_000 + " " + "b " * 30)]
    bench = [text(rng.randint(0, 40)) for _ in range(20)] + [None, ""]
    out = I.resample(make(docs, clash=("score", "rank", "n", "bucket")), make(list(enumerate(bench)), "item_id long, text string"))
    assert got(out) == brute(docs, bench)
    assert got(I.resample(make(docs[:40]), make([], "item_id long, text string"))) == brute(docs[:40], [])
    assert got(I.resample(make([]), make([], "item_id long, text string"))) == []


def test_pair_crcs():
    rng = random.Random(0)
    a = [bytes(rng.randrange(256) for _ in range(rng.randrange(9))) for _ in range(300)]
    b = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 7, 255, 70_000]))) for _ in range(300)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    assert I.pair_crcs(crc(a), crc(b), np.array([len(x) for x in b])).tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


def test_empty_batch():
    n, w, p, o = I.features(pa.array([], pa.string()))
    assert not len(n) and not len(w) and not len(p) and not len(o)


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_matches_brute_force(spark, sf):
    d = f"/root/testdata/sf{sf}"
    docs = [(r.doc_id, r.text) for r in table(spark, d, "documents").collect()]
    bench = [r.text for r in table(spark, d, "benchmark").collect()]
    assert got(I.op13_importance_resampling(spark, d)) == brute(docs, bench)
