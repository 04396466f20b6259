import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from basketlab.llm import secret_scan as S
from brute import base_secrets as base, secrets as brute


def listed(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{e}" for a, k, e in spans)


def _texts():
    rng = random.Random(3)
    made = [
        "", None, "secret: token: abcdefgh", "password=token=abc", "é\U0001F600 Token = 'abcdef' AKIA" + "A" * 30 + " " + "0123456789abcdef" * 3,
        "x aB3dE5gH7jK9mN1pQ3sT5vW7yZ9" + "_" * 60 + "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9", "123e4567-e89b-12d3-a456-426614174000 /usr/local/some/path/very/long-12",
        "word " * 30_000 + "passwd='hunter22'",
    ]
    parts, letters = ["password", "token", "Secret", "api_key", "AKIA", "=", ": ", "deadbeef", "0a1b2c3d"], "abAKI01234567890defABZxyz+/_-=: '\"é"
    return made + ["".join(rng.choice(parts) if rng.random() < 0.2 else rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(300)]


def test_scan_matches_brute_force(make):
    texts = _texts()
    df = make(list(enumerate(texts)) + [(0, "")], clash=("base", "spans"))
    rows = S.scan(df).select("doc_id", S.listed(F.col("base")), S.listed(F.col("spans"))).collect()
    assert len(rows) == len(texts) + 1
    for i, b, s in rows:
        assert (b, s) == (listed(base(texts[i])), listed(brute(texts[i]))), texts[i]
    assert sum("entropy" in s for _, _, s in rows) > 20


def test_redaction_leaves_the_rest(make):
    texts = _texts()
    df = S.scan(make(list(enumerate(texts)))).withColumn("r", S.redacted(F.coalesce("text", F.lit("")), F.col("spans")))
    for r in df.select("doc_id", "r").collect():
        t, out, at = texts[r.doc_id] or "", [], 0
        for a, _, e in brute(t):
            if a >= at:
                out.append(t[at:a] + "[SECRET]")
            at = max(at, e)
        assert r.r == "".join(out) + t[at:]


def test_empty_table(make):
    assert S.scan(make([])).count() == 0


def plain_bits(v):
    """The least entropy of a candidate's windows by plain rules; None: never a secret."""
    has = lambda x, letters: any(c in letters for c in x)
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    uuid = lambda x: [len(y) for y in x.split("-")] == [8, 4, 4, 4, 12] and all(c in digits + "abcdefABCDEF-" for c in x)
    parts = "".join(" " if c in "+/_-" else c for c in v).split()
    for p in parts:
        if len(p) >= 20 and has(p, digits) and any(has(p, x) and all(c in digits + x for c in p) for x in ("abcdef", "ABCDEF")):
            return 2.9
    if len(parts) == 1 and parts[0] == v and has(v, digits) and has(v, lower) != has(v, upper):
        return 3.4
    named = lambda x: any(uuid(x[k:]) or (len(x[k:]) <= 6 and all(c in digits for c in x[k:])) for k in range(len(x) + 1) if all(c in lower + upper + "_-" for c in x[:k]))
    if not all(named(x) for x in v.split("/")):
        marks = [k for k, c in enumerate(v) if c in "+/_-"]
        for a in [0, *marks]:  # stretches from one mark to another
            for b in [*marks, len(v)]:
                if b - a >= 20 and has(v[a:b], digits) and has(v[a:b], lower) != has(v[a:b], upper):
                    return 3.4
    return 3.7 if has(v, digits) and has(v, lower) and has(v, upper) else None


KEYS = ["3ax6xnjp29jd6fds4gc373sgvjxteol0", "9zq4w7x2k8m3v6b1n5t0", "R7K2Q-9XW4P-ZT83M-LC6VB-H5N1D", "r7k2q_9xw4p_zt83m_lc6vb", "9233A8ECF7C5B09FE594", "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9", "abcd-1234-efgh-5678-ijkl"]
BESIDE = ["{}", "key-{}", "sk_live_{}", "/srv/app/{}", "/Users/Me/{}/x", "KEY/{}+", "a-B_c/{}-{}", "user/{}/12/some-title"]


def test_a_prefix_or_path_hides_no_key(make):
    plain = ["/usr/lib/python3/dist-packages/numpy", "/api/v1/users/123e4567-e89b-12d3-a456-426614174000", "blog/2024/01/15/some-title-here", "-" * 200, "1/2/" * 30, "x1" + "-" * 90_000, "some-words_and/more-words-of-text"]
    texts = [f"see {b.replace('{}', k)} there" for k in KEYS for b in BESIDE] + [f"see {x} there" for x in plain]
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in S.scan(make(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts[: -len(plain)]):
        key, at = KEYS[i // len(BESIDE)], t.index(KEYS[i // len(BESIDE)])
        cover = [(a, e) for a, _, e in spans[i] if a < at + len(key) and e > at]
        assert cover and min(a for a, _ in cover) <= at and max(e for _, e in cover) >= at + len(key), t
    assert [spans[len(texts) - len(plain) + k] for k in range(len(plain))] == [[]] * len(plain)


def test_entropy_against_plain_rules(make):
    rng = random.Random(8)
    letters = ["abc0123456789xyz", "ABC0123456789XYZ", "abcdef0123456789", "abcXYZ0189", "qwertzuiop", "0123456789"]
    word = lambda: "".join(rng.choices(rng.choice(letters), k=rng.choice([1, 4, 5, 8, 20, 24])))
    values = [rng.choice(["", "/", "-"]) + rng.choice("+/_-").join(word() for _ in range(rng.randint(1, 6))) for _ in range(600)]
    rows = {r.doc_id: [tuple(x) for x in r.spans] for r in S.scan(make(list(enumerate(values)))).collect()}
    entropy = lambda w: -sum(n / 20 * math.log2(n / 20) for n in Counter(w).values())
    for i, v in enumerate(values):
        bits, hot = plain_bits(v), set()
        if len(v) >= 20 and bits and not any(re.search(p, v) for p in S.ALLOW):
            hot = {at for k in range(len(v) - 19) if entropy(v[k : k + 20]) >= bits - 1e-5 for at in range(k, k + 20)}
        whole = [(a, e) for a, _, e in base(v)]
        got = {at for a, kind, e in rows[i] if kind == 3 for at in range(a, e)}
        runs = [k for k in sorted(hot) if k - 1 not in hot]
        want = set()
        for a in runs:
            e = next(k for k in range(a, len(v) + 1) if k not in hot)
            want |= set() if any(x <= a and y >= e for x, y in whole) else set(range(a, e))
        assert got == want, v


def test_counts_are_kept_along_long_candidates(make):
    """A candidate of a million characters, and one that only just is a numbered name."""
    rng = random.Random(1)
    texts = ["a-" * 500_000 + "x", "x" * 1_000_000, "".join(rng.choice("abcdefgh0123456789XYZ") for _ in range(30_000)), "one-two_three/four-five-12/", "one-two_three/four-five-six_"]
    rows = S.scan(make(list(enumerate(texts)))).select("doc_id", S.listed(F.col("spans"))).collect()
    assert len(rows) == 5
    for i, s in rows:
        if i > 1:
            assert s == listed(brute(texts[i]))


def test_numbered_names_without_a_repeated_group():
    """The pattern without a repeated group knows the same strings as the plain one."""
    plain = r"^/?([A-Za-z]+[/_-])*[A-Za-z]+([/_-]?[0-9]{1,6})?/?$"
    rng = random.Random(8)
    for _ in range(60_000):
        t = "".join(rng.choice("aZ09/_-") for _ in range(rng.randint(0, 11)))
        assert bool(re.search(plain, t)) == bool(re.search(S.ALLOW[1], t)), t
