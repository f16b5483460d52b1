"""op5: against brute force; the tree and the cells lose no link; edge rows."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import ngram_join as J


def _shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def _brute(rows):
    sets = [(i, _shingles(t)) for i, t in rows]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                up[root(a)] = root(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return Counter((i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets))


def _near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_components_match_brute_force(make_docs, monkeypatch):
    monkeypatch.setattr(J, "CELL", 8)  # large cells are searched in blocks
    rng = random.Random(2)
    rows, vocab = [], [f"w{i}" for i in range(300)]
    for length in (4, 5, 7, 12, 40, 64, 130, 260, 520):
        for _ in range(3):
            base = [rng.choice(vocab) for _ in range(length)]
            rows += [_near(rng, base, rng.randrange(0, max(1, length // 20) + 1)) for _ in range(10)]
            rows.append(" ".join(base[:int(length * 0.87)]))
    rows = [(i * 7 % 1009, t) for i, t in enumerate(rows)]
    docs = make_docs(rows, 4).withColumns({"key": F.lit(1), "digest": F.lit("x"), "node": F.lit(2)})
    got = J.ngram_jaccard_components(docs).collect()
    assert Counter(map(tuple, got)) == _brute(rows)


def test_edge_rows_and_hot_copies(make_docs):
    assert J.ngram_jaccard_components(make_docs([])).count() == 0
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE "), (6, "one two"), (7, "one  two"), (8, "É x"), (9, "é x"),
            (10, "a b c d"), (10, "a b c d"), (None, "a b c d"), (None, "lonely words of no id"), (11, "w " * 5000), (12, None)]
    rows += [(100 + i, "many copies of one short text") for i in range(200)]
    assert Counter(map(tuple, J.ngram_jaccard_components(make_docs(rows)).collect())) == _brute(rows)
    kept = J.keep_one_of_each(make_docs(rows)).collect()
    assert Counter(r.doc_id for r in kept) == Counter([1, 2, 3, 4, 6, 8, 9, 10, None, 11, 12, 100])
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_tree_finds_every_pair_within_the_bound():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 6, (12, J.COORDINATES))
    v = np.clip(base[rng.integers(0, 12, 400)] + rng.integers(-1, 2, (400, J.COORDINATES)) * (rng.random((400, J.COORDINATES)) < 0.1), 0, None)
    n, comp = v.sum(axis=1), rng.integers(0, 40, 400)
    i, j, bound = J.RTree(v, n, comp, 85).pairs()
    assert bound.tolist() == np.minimum(v[i], v[j]).sum(axis=1).tolist()
    got = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    want = {(a, b) for a in range(400) for b in range(a + 1, 400) if comp[a] != comp[b]
            and 185 * int(np.minimum(v[a], v[b]).sum()) >= 85 * int(n[a] + n[b])}
    sized = {(a, b) for a, b in want if min(n[a], n[b]) * 100 >= 85 * max(n[a], n[b])}
    assert sized <= got <= want


def test_linked_sets_share_a_cell():
    rng = np.random.default_rng(3)
    for n in [1, 2, 5, 6, 20, 63, 64, 110, 127, 128, 140, 250, 255, 256, 500, 1000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            drop = rng.integers(0, J.most_different(len(a), 85) + 1)
            add = J.most_different(len(a), 85) - drop
            b = np.union1d(rng.permutation(a)[drop:], rng.integers(0, 2 ** 63, add, dtype=np.uint64))
            common = len(np.intersect1d(a, b))
            if len(b) and 185 * common >= 85 * (len(a) + len(b)):
                assert set(J.cell_keys(a, 85)) & set(J.cell_keys(b, 85)), (n, drop, add)
