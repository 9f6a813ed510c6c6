"""Plain versions of the operators, for small tables."""

import functools
import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
]
PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m[0])) <= 15),
]


def spans(text, kinds, by_start):
    found = []
    for rank, (kind, pattern, keep) in enumerate(kinds):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if keep(m)]
    found.sort(key=(lambda s: s[:2]) if by_start else (lambda s: (s[1], s[0])))
    return Counter(s[2] for s in found), ",".join(f"{k}:{a}:{b}" for a, _, k, b in found)


def base_numbers(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@functools.cache
def simhash(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(lower)
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in list(parent)}


def groups(docs):
    prints = {simhash(t) for _, t in docs}
    return len(set(components([(a, b) for a in prints for b in prints if a == b or (a ^ b).bit_count() <= 2]).values()))


def near_copies(docs):
    prints = [simhash(t) for _, t in docs]
    roots = components([(a, b) for a in set(prints) for b in set(prints) if a == b or (a ^ b).bit_count() <= 2])
    ids = defaultdict(list)
    for (doc, _), p in zip(docs, prints):
        ids[roots[p]] += [] if doc is None else [doc]
    return Counter((doc, f"{p:016x}", min(ids[roots[p]], default=None)) for (doc, _), p in zip(docs, prints))


def targets(sizes):
    """Targets by filling round after round."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    rest, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in open_}
        for s in above:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
        open_ -= above


def tiles(item, text, least):
    """Coverage by always taking the longest match of unmarked words; first in the item, then first in the text."""
    a, b = [False] * len(item), [False] * len(text)
    least = max(1, min(least, len(item)))
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and not a[i + k] and not b[j + k] and item[i + k] == text[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least or not k:
            return sum(a)
        a[i : i + k] = b[j : j + k] = [True] * k
