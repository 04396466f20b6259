import random

import numpy as np
import pytest

from basketlab.llm import near_dedup as N
from brute import jaccard, near_classes as brute, shingles


def copies(rng, n_base=4, n_near=25):
    v = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(n_base):
        base = [rng.choice(v) for _ in range(rng.choice([30, 120, 300]))]
        for _ in range(n_near):
            p = rng.random() * 0.08
            out.append(" ".join(rng.choice(v) if rng.random() < p else w for w in base))
    return out + [" ".join(rng.choice(v) for _ in range(60)) for _ in range(40)]


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(2)
    texts = copies(rng, 1, 40)[:45] + ["", "a", "a b", "A  B\n", "a b c d e " * 50, "a b c d e " * 60, None]
    sig, some = N.signatures(*N.elements(texts), len(texts), 2000)
    sets, packed = [shingles(t) for t in texts], N.packed_elements(texts)
    miss = []
    for i in range(len(texts)):
        for j in range(i):
            e = jaccard(sets[i], sets[j])
            assert N.similarity(packed[i], packed[j]) == pytest.approx(e, abs=1e-12)
            if some[i] and some[j]:
                miss.append((sig[i] == sig[j]).mean() - e)
    assert abs(np.mean(miss)) < 0.01 and np.sqrt(np.mean(np.square(miss))) < 0.012
    assert not some[texts.index("")] and not some[-1]


def test_real_weights():
    doc, element = np.repeat([0, 1], 300), np.tile(N.mix(np.arange(300, dtype=np.uint64)), 2)
    rng = np.random.default_rng(0)
    w = rng.random(600) * 3 + 0.01
    sig, _ = N.signatures(doc, element, w, 2, 4000)
    expected = np.minimum(w[:300], w[300:]).sum() / np.maximum(w[:300], w[300:]).sum()
    assert (sig[0] == sig[1]).mean() == pytest.approx(expected, abs=0.03)


def test_classes_match_brute_force(make, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)  # large groups span several blocks
    rng = random.Random(9)
    texts = copies(rng)
    docs = [(i, t) for i, t in enumerate(texts)] + [(500, texts[0]), (500, texts[0]), (None, texts[0]), (None, "lonely words here"), (600, None), (601, None), (602, ""), (603, ""), (604, "a b"), (605, "A\tB "), (606, "x " * 40_000)]
    rows = N.classes(make(docs, clash=("class_id", "key"))).collect()
    assert sorted([(r.id, r.class_id) for r in rows], key=str) == brute(docs)
    best = {(r.class_id, r.row_key) for r in rows if r.is_representative}
    assert len(best) == len({r.class_id if r.class_id is not None else r.row_key for r in rows})
    kept = N.representatives(make(docs)).collect()
    assert len(kept) == len(best) and {r.doc_id for r in kept} == {c for c, _ in best}


def test_a_long_chain_is_compared_bucket_by_bucket(make, monkeypatch):
    """Texts that each resemble only their neighbours: the whole chain as one unit would be more work than its buckets."""
    monkeypatch.setattr(N, "BLOCK", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(30):
        docs.append((i, " ".join(words)))
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(len(words))] = f"n{i}x{rng.randrange(1000)}"
    rows = N.classes(make(docs)).collect()
    assert sorted([(r.id, r.class_id) for r in rows], key=str) == brute(docs)


def test_no_near_copies_and_empty(make):
    assert sorted(r.class_id for r in N.classes(make([(1, "one two"), (2, "three four five")])).collect()) == [1, 2]
    assert N.classes(make([])).count() == 0


def test_one_large_class_with_outliers_in_its_buckets(make, monkeypatch):
    """A class of many blocks beside texts just under the bound: each outlier meets the class, the class never itself."""
    monkeypatch.setattr(N, "BLOCK", 8)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([1, 1, 1, 2])):
            words[rng.randrange(len(words))] = f"n{i}"
        docs.append((i, " ".join(words)))
    for i in range(12):
        words = list(base)
        for k in range(3 + i % 3):
            words[(17 * k + i) % len(words)] = f"o{i}x{k}"
        docs.append((1000 + i, " ".join(words)))
    rows = N.classes(make(docs)).collect()
    assert sorted([(r.id, r.class_id) for r in rows], key=str) == brute(docs)


def test_components_contract_to_the_least_node(spark):
    from basketlab.llm.graph import components

    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, k) for k in range(100, 160)] + [(rng.randrange(300, 380), rng.randrange(300, 380)) for _ in range(60)] + [(900, 900)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        p, q = sorted((top(a), top(b)))
        up[q] = p
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
