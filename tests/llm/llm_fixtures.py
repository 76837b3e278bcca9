"""Small documents and brute-force versions shared by the tests of the subpackage."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, k string, key string, line int"


def docs(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "src", len(t or ""), -1, "x", "y", 7) for i, t in zip(ids, texts, strict=True)], DOCS)


def near_copies(seed, groups, copies, words, rate):
    """Groups of texts, each a base with some words replaced."""
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(copies):
            out.append(" ".join(w if rng.random() > rate else f"e{rng.randrange(10**6)}" for w in base))
    rng.shuffle(out)
    return out


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", ascii_lower(text or "")) if x]
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def components(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_groups(texts, k, num, den):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    edges = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if sets[a] and sets[b]
             and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in components(edges, ids).items()}
