import math
import re
from collections import Counter

import pytest

from basketlab.llm import quality_rules as Q
from basketlab.llm.common import written

GOOD = "The quick brown fox jumps over the lazy dog and then it runs away into the dark green forest near the old quiet town. "
VARIED = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)) + "."
TEXTS = [
    None,
    "",
    " \n\t\x0b ",
    "short text only",
    VARIED,
    VARIED.upper().replace(" ", "!! ") + "!!",
    VARIED.replace(" ", "### "),
    "a b c d e f g h " * 10,
    "same line here\n" * 30,
    "x" * 100_000,
    VARIED + "\n" + "é ñ \U0001F600 " * 20,
    GOOD * 40,
    GOOD,
]


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if at[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_base_counts(make):
    df = make(list(enumerate(TEXTS)) + [(4, TEXTS[4])], clash=("n_words", "kept"))
    names = Q.RESULT[1:6]
    got = sorted(tuple(r) for r in Q.text_counts(df).select("doc_id", *names).collect())
    assert got == sorted((i, *counts(t)) for i, t in [*enumerate(TEXTS), (4, TEXTS[4])])


def em(patterns, tol=1e-4, rounds=200, strength=20.0):
    """The same estimation, plainly, over {votes: documents}."""
    prior, good, bad = Q.START.prior, list(Q.START.good), list(Q.START.bad)
    n_rules = range(len(Q.RULES))

    def post(v):
        z = math.log(prior / (1 - prior)) + sum(math.log(good[r] / (1 - bad[r])) if v[r] == 1 else math.log((1 - good[r]) / bad[r]) if v[r] == -1 else 0.0 for r in n_rules)
        return 1 / (1 + math.exp(-z))

    for _ in range(rounds):
        p = {v: post(v) for v in patterns}
        share = lambda right, wrong, start: (right + strength * start) / (right + wrong + strength)
        tot = lambda f: sum(n * f(v) for v, n in patterns.items())
        new_prior = share(tot(lambda v: p[v]), tot(lambda v: 1 - p[v]), Q.START.prior)
        new_good = [share(tot(lambda v, r=r: p[v] * (v[r] == 1)), tot(lambda v, r=r: p[v] * (v[r] == -1)), Q.START.good[r]) for r in n_rules]
        new_bad = [share(tot(lambda v, r=r: (1 - p[v]) * (v[r] == -1)), tot(lambda v, r=r: (1 - p[v]) * (v[r] == 1)), Q.START.bad[r]) for r in n_rules]
        moved = max(abs(a - b) for a, b in zip([new_prior, *new_good, *new_bad], [prior, *good, *bad], strict=True))
        prior, good, bad = new_prior, new_good, new_bad
        if moved <= tol:
            break
    return {v: post(v) for v in patterns}


def test_em_and_verdicts_match_plain_python(make):
    texts = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)] + [(100 + i, VARIED.replace("word", f"w{i}")) for i in range(120)]
    voted = written(Q.with_votes(Q.text_counts(make(texts))), "votes")
    model = Q.fit(Q.vote_patterns(voted))
    rows = Q.judge(voted, model).collect()
    post = em(Counter(tuple(r.votes) for r in rows))
    for r in rows:
        assert r.quality == pytest.approx(post[tuple(r.votes)], abs=1e-6)
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.quality >= 0.5)
    by = {r.doc_id: r for r in rows}
    assert by[100].kept and not by[5].kept and not by[6].kept and not by[0].kept


def test_empty_table(make):
    out = Q.judged(make([]))
    assert out.count() == 0 and {"kept", "base_failed", "quality"} <= set(out.columns)
