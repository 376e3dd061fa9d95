"""Plain Python versions of the contracts, for small inputs."""

import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def jaccard(docs, k=4, percent=85):
    """docs: (doc_id, text) -> {doc_id: (n, component)}"""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in docs:
        w = words((t or "").translate(low))
        sets[d] = {tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    for d, s in sets.items():
        common = {}
        for g in s:
            for e in holders[g]:
                if e < d:
                    common[e] = common.get(e, 0) + 1
        for e, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[e]) - c):
                a, b = find(d), find(e)
                up[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeats(docs, length=50):
    """docs: (doc_id, text) -> {doc_id: (n_words, n_removed, kept_sha256)}"""
    first, out = {}, {}
    tokens = [(d, words(t)) for d, t in docs]
    for d, w in tokens:
        for i in range(len(w) - length + 1):
            key = tuple(w[i: i + length])
            first[key] = min(first.get(key, d), d)
    for d, w in tokens:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i: i + length])] < d:
                gone[i: i + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out
