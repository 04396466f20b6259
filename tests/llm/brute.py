"""Plain-Python versions of operators, shared by the tests."""

import re
from collections import Counter, defaultdict

from basketlab.llm import near_dedup as N
from basketlab.llm import secret_scan as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_words(t):
    return WORD.findall((t or "").translate(LOW))


def contaminated(docs, bench):
    wins = {}
    for item, t in bench:
        w = item_words(t)
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[j : j + k]), set()).add(item)
    out = []
    for d, t in docs:
        w, hit, items = item_words(t), set(), set()
        for k in {len(x) for x in wins}:
            for j in range(len(w) - k + 1):
                if found := wins.get(tuple(w[j : j + k])):
                    items |= found
                    hit.update(range(j, j + k))
        out.append((d, len(w), len(hit), sorted(str(i) for i in items if i is not None)))
    return sorted(out, key=str)


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if k else Counter()


def jaccard(a, b):
    n = sum((a & b).values())
    return n / (sum(a.values()) + sum(b.values()) - n) if a and b else 0.0


def near_classes(docs):
    up = list(range(len(docs)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    sets, seen = [shingles(t) for _, t in docs], {}
    for i, (_, t) in enumerate(docs):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= N.THRESHOLD:
                up[top(i)] = top(j)
        if t is not None:
            up[top(i)] = top(seen.setdefault(t, i))
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[top(i)].append(docs[i][0])
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        out += [(i, min(known) if known else None) for i in ids]
    return sorted(out, key=str)


def base_secrets(t):
    t, out = t or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def secrets(t):
    t, b = t or "", base_secrets(t)
    out = list(b)
    for m in re.finditer(S.CANDIDATE, t):
        v = m[0]
        bits = next((x for _, p, x in S.CLASSES if re.search(p, v)), None)
        if bits is None or any(re.search(p, v) for p in S.ALLOW):
            continue
        run = None
        for i in range(len(v) - S.WIDTH + 1):
            if sum(S.weight(c) for c in Counter(v[i : i + S.WIDTH]).values()) <= S.bound(bits):
                if run and i <= run[1]:
                    run = (run[0], i + S.WIDTH)
                else:
                    out += [(m.start() + run[0], 3, m.start() + run[1])] if run else []
                    run = (i, i + S.WIDTH)
        out += [(m.start() + run[0], 3, m.start() + run[1])] if run else []
    return sorted(x for x in out if x[1] < 3 or not any(a <= x[0] and e >= x[2] for a, _, e in b))
