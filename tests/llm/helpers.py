from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def shingle_set(text):
    """The distinct shingles of five words, as tuples of bytes."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_components(rows):
    """Component by id from all pairs; rows are (id, text) with different ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    where = {}
    for i in ids:
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    for i in ids:
        for j in {j for s in sets[i] for j in where[s] if j > i}:
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}
