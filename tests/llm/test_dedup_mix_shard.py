"""op3, op8, op9: against brute force, and on nulls, empty texts, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm.exact_dedup import tree_merge_dedup
from riskloom.llm.mixing import mix_sources
from riskloom.llm.sharding import lex_searchsorted, sampled_splitter_shards

ROWS = [(1, "a b"), (2, "ab"), (3, " a\tb\n "), (4, None), (5, ""), (6, "  "), (7, "x" * 100_000), (8, "Ab"),
        (9, "ab "), (10, "ünï"), (10, "ünï"), (None, "ab"), (11, "ü nï"), (12, None)]


def test_exact_dedup_brute(make_docs):
    docs = make_docs(ROWS, 5).withColumns({"run": F.lit("x"), "digest": F.lit(1), "rid": F.lit(0), "n": F.lit(2)})
    got = tree_merge_dedup(docs, fan_in=2).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()].append((-len(t or ""), i is None, i))
    want = Counter((i, min(g)[2], len(g), h) for h, g in groups.items() for _, _, i in g)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(groups.keys())
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_empty_and_hot(make_docs):
    assert tree_merge_dedup(make_docs([])).count() == 0
    got = tree_merge_dedup(make_docs([(i, "same text") for i in range(500)] + [(1000, "other")], 9), fan_in=3)
    assert {(r.keep_id, r.group_size) for r in got.collect()} == {(0, 500), (1000, 1)}
    assert got.filter("kept").count() == 2


def _targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, capped = share * sum(sizes.values()), {}
    while True:  # share out, cap, share the excess again
        rest = [s for s in names if s not in capped]
        unit = (left - sum(capped.values())) / max(sum(w[s] for s in rest), 1)
        over = [s for s in rest if unit * w[s] > most * sizes[s]]
        if not over:
            return {**capped, **{s: unit * w[s] for s in rest}}
        capped |= {s: most * sizes[s] for s in over}


def test_mixing_targets_and_budget(make_docs):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), "en", s) for i, s in
            enumerate(rng.choices(["a", "b", "é", "Z", None, "tiny"], [50, 20, 10, 9, 8, 1], k=1500))]
    rows += [(5000, None, "en", "empty"), (5001, " \t\x0b\x0c ", "en", "empty"), (None, "x y", "en", "a"), (7, "q r", "en", "a")]
    docs = make_docs(rows).withColumns({"h": F.lit("x"), "target": F.lit(1), "cell": F.lit(2)})
    got = mix_sources(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size(t)) for i, t, *_ in rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    want, taken, by_id = _targets(sizes), Counter(), {(i, t): s for i, t, _, s in rows}
    source = {i: s for i, _, _, s in rows}
    for r in got:
        s = "a" if r.doc_id == 7 and r.size == 1 else source[r.doc_id]
        if r.doc_id == 7:
            continue
        assert abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and r.source_size == sizes[s]
        assert 0 <= r.taken <= 2 * r.size
    for r in got:
        taken[(r.source_size, round(r.target, 6))] += r.taken
    for (_, target), words in taken.items():
        assert abs(words - target) <= 40
    again = mix_sources(docs.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and by_id


def test_mixing_empty_and_repeats(make_docs):
    assert mix_sources(make_docs([])).count() == 0
    assert [r.taken for r in mix_sources(make_docs([(1, None), (2, "")])).collect()] == [0, 0]
    rows = mix_sources(make_docs([(1, "same words here")] * 50)).collect()
    assert len(rows) == 50 and len({r.taken for r in rows}) == 1


def test_lex_searchsorted_matches_tuples():
    rng = np.random.default_rng(0)
    b = np.unique(rng.integers(0, 4, (40, 3)), axis=0)
    k = rng.integers(0, 4, (500, 3))
    want = [sum(tuple(x) <= tuple(q) for x in b) for q in k]
    assert lex_searchsorted([b[:, i] for i in range(3)], [k[:, i] for i in range(3)]).tolist() == want


def _check_shards(rows, got, near):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    held, slots = Counter(), defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean = sum(held.values()) / 16
    assert all(abs(held[s] - mean) <= near * mean for s in range(16))


def test_shards_balanced_with_hot_group(make_docs):
    rng = random.Random(5)
    rows = [(i, "copy " * 20) for i in range(1000)] + [(i, f"{i} " + "x" * rng.randint(0, 400)) for i in range(1000, 3000)]
    docs = make_docs(rows).withColumns({"k1": F.lit("x"), "range": F.lit(1), "size": F.lit(2)})
    got = sampled_splitter_shards(docs).collect()
    _check_shards(rows, got, 0.05)
    again = sampled_splitter_shards(docs).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_shards_edge_rows(make_docs):
    assert sampled_splitter_shards(make_docs([])).count() == 0
    rows = [(1, None), (2, ""), (None, "x"), (3, "é" * 50_000), (4, "dup"), (4, "dup")]
    _check_shards(rows, sampled_splitter_shards(make_docs(rows)).collect(), 100)
    same = [(7, "same row")] * 2000  # one row repeated: only the row number tells them apart
    _check_shards(same, sampled_splitter_shards(make_docs(same)).collect(), 0.1)
