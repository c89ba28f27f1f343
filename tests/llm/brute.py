"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import re
from collections import Counter

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remove_repeats(texts, window=35):
    docs = [BLANK.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def contamination(texts, items, window=10):
    def words(t):
        return PLAIN.findall((t or "").translate(LOWER))

    wanted = {}
    for name, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if k else ():
            wanted.setdefault(tuple(w[i : i + k]), set()).add(name)
    sizes = {len(k) for k in wanted}
    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in wanted:
                    hit.update(range(i, i + k))
                    names |= wanted[tuple(w[i : i + k])]
        out.append((len(w), len(hit), sorted(str(n) for n in names if n is not None)))
    return out
