"""Brute-force forms of the operators, for small tables."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=""):
    """rows of (doc_id, text) or (doc_id, text, lang); ``extra`` names clashing string columns."""
    names = [x for x in extra.split() if x]
    data = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), *["x"] * len(names)) for r in rows]
    return spark.createDataFrame(data, ", ".join([SCHEMA, *(f"{n} string" for n in names)]))


def lower_ascii(text):
    return (text or "").encode().lower()


def shingles(text, n):
    w = WORD.findall(lower_ascii(text))
    if len(w) >= n:
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    return {tuple(w)} if w else set()


def groups(rows, n, percent):
    """(doc_id, set size, component) of each row."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)].append(i)
    return [(i, len(s), min(least[find(k)], default=None)) for k, (i, s) in enumerate(sets)]


def repeated(rows, window):
    """(doc_id, words, removed, kept text) of each row."""
    split = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    seen = Counter(tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                keep[k : k + window] = [False] * window
        left = [x for x, ok in zip(w, keep) if ok]
        out.append((i, len(w), len(w) - len(left), b" ".join(left)))
    return out


def _last_row(item, text, first):
    row = first
    for a in item:
        new = [row[0] + 1]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return row


def edit_distance(a, b):
    return _last_row(a, b, list(range(len(b) + 1)))[-1]


def edit_distance_in(item, text):
    """Least edit distance of ``item`` to a substring of ``text``."""
    return min(_last_row(item, text, [0] * (len(text) + 1)))


def prose(seed, words, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


def edited(text, seed, changes):
    rnd, w = random.Random(seed), text.split()
    for _ in range(changes):
        w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
    return " ".join(w)
