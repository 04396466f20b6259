import random
import re
from collections import Counter, defaultdict

import pytest

from basketlab.llm import collocations as C

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand, longer = [p for p, a in count.items() if len(p) > 1 and a >= least], defaultdict(int)
        for p in cand:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], count[p])
        rows_ = []
        for p in cand:
            a = count[p]
            if len(p) == 2 and 100 * longer[p] >= 50 * a and longer[p]:
                continue
            s, _, left, r = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            rows_.append((-s, -a, " ".join(p).encode(), left, r))
        for i, (s, a, p, left, r) in enumerate(sorted(rows_)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, r, n[lang], -s))
    return sorted(out)


def got(df, **k):
    return sorted(tuple(r) for r in C.collocations(df, **k).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, n=300):
    rng = random.Random(seed)
    v = ["a", "B", "the", "of", "é\U0001f600", "x\xa0y", "don't", "word", "Of", "q"]
    marks = [" ", "  ", "\t", ", ", ".", "\n", "\r\n", ";", "!?", " : "]
    rows = []
    for i in range(n):
        t = "".join(rng.choice(v) + rng.choice(marks if rng.random() < 0.2 else [" "]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "de", None, "und", ""]), t))
    return rows + [("en", None), (None, ""), ("en", ".,;"), ("en", "new york city " * 30), ("en", "new york city " * 30), ("fr", "one two"), ("de", "lang " * 40_000 + "ende")]


@pytest.mark.parametrize("chunk, hot", [(1 << 23, 1000), (500, 40)])
def test_matches_brute_force(spark, monkeypatch, chunk, hot):
    monkeypatch.setattr(C, "CHUNK", chunk)  # many blocks a bucket
    monkeypatch.setattr(C, "HOT", hot)  # nodes dealt by their third word
    rows = texts(1)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    if hot == 40:
        assert C.hot_nodes(df)
    assert got(df) == brute(rows) != []
    assert got(df, top=7) == brute(rows, top=7)


def test_blocks_are_added_up_when_they_double(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 200)
    held = C._Held.__init__

    def small(self):
        held(self)
        self.before = 64

    monkeypatch.setattr(C._Held, "__init__", small)
    rows = texts(2)
    assert got(spark.createDataFrame(rows, "lang string, text string").coalesce(1)) == brute(rows)


def test_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([(3_000_000_000, 4_000_000_000, 5_000_000_000)], "a long, l long, r long")
    assert df.select(C._score(df.a, df.l, df.r)).first()[0] == 1_000_000 * 3_000_000_000**2 // (4_000_000_000 * 5_000_000_000)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert got(df) == []
    rows = [("en", "x y z. " * 12)]
    df = spark.createDataFrame([(*r, 7, "old") for r in rows], "lang string, text string, n long, bucket string")
    assert got(df) == brute(rows)
