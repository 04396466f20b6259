import random

from basketlab.llm import decontaminate as D
from brute import contaminated as brute

def run(make, docs, bench):
    out = D.contamination(make(docs, clash=("spans",)), make(bench, "item_id long, text string"))
    rows = out.collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
    return sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows], key=str)


def test_matches_brute_force_with_short_items_and_many_repeats(make):
    rng = random.Random(5)
    v = ["a", "B", "c1", "éx", "the", "of"]
    docs = [(i, " ".join(rng.choice(v) for _ in range(rng.randint(0, 150)))) for i in range(40)]
    docs += [(None, None), (61, ""), (61, ""), (62, "a B c1 " * 30), (62, "a B c1 " * 30), (63, "plain " * 5000 + "a the of")]
    bench = [(i, " ".join(rng.choice(v) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 9, 10, 12, 15])))) for i in range(20)]
    bench += [(None, "the of a"), (3, None), (200, docs[5][1]), (201, docs[5][1]), (200, "zz zz")]
    assert run(make, docs, bench) == brute(docs, bench)


def test_every_long_shared_span_is_found(make):
    rng = random.Random(6)
    v = [f"w{i}" for i in range(400)]
    bench = [(i, " ".join(rng.choice(v) for _ in range(30))) for i in range(30)]
    docs = []
    for i in range(60):
        w = [rng.choice(v) for _ in range(80)]
        if i % 2:
            b, n = bench[i % 30][1].split(), 8 + i % 12
            w[20 : 20 + n] = b[5 : 5 + n]
        docs.append((i, " ".join(w)))
    assert run(make, docs, bench) == brute(docs, bench)
    kept = {r.doc_id for r in D.clean(make(docs), make(bench, "item_id long, text string")).collect()}
    assert kept == {d for d, _, n, _ in brute(docs, bench) if n == 0}


def test_empty_tables(make):
    assert run(make, [], [(1, "a b c")]) == []
    assert run(make, [(1, "a b")], []) == [(1, 2, 0, [])]
