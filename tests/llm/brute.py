"""Plain re-statements of the contracts, one document at a time."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def low(b):
    return bytes(x + 32 if 65 <= x <= 90 else x for x in b)


def words(text):
    return SPACE.findall((text or "").encode())


def op1(docs, window=50):
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def op10(docs, items, window=10):
    find = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low((t or "").encode()))
    own = defaultdict(set)
    for i, t in items:
        w = find(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            own[tuple(w[k : k + n])].add(str(i))
    sizes = {len(k) for k in own}
    out = {}
    for d, t in docs:
        w = find(t)
        hit, got = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if x := own.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    got |= x
        out[d] = (len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit))
    return out


def op5(docs):
    sets = {}
    for d, t in docs:
        w = SPACE.findall(low((t or "").encode()))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    post = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            post[x].append(d)
    shared = Counter()
    for ds in post.values():
        ds = sorted(ds)
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def op7(docs):
    out = {}
    for d, t in docs:
        w = words(t)
        lines = [x for x in (t or "").split("\n") if words(x)]
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i : i + 5])].append(i)
        rep = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(5)}
        n = len(w)
        out[d] = (n, sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep), n < 10 or 100 * len(rep) > 20 * n)
    return out


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def op4(text):
    """Base spans by kind."""
    t = text or ""
    spans = {k: [] for k in ("email", "ip", "card", "phone")}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        spans["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        s = re.sub("[^0-9]", "", m[0])
        if 16 <= len(s) <= 19 and luhn(s):
            spans["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans["phone"].append(m.span())
    return spans


def crc(data):
    return zlib.crc32(data)
