"""op11, op12: against exact arithmetic and brute force; nulls, ties, repeats, odd lengths, empty tables, clashing names."""

import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm.hash_search import CodeIndex, cosines, encode, hashed_neighbours, learn_rotations
from riskloom.llm.queries import op11_whitening, op12_hash_search
from riskloom.llm.whitening import polarised_moments, usable_vectors, whiten_embeddings
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>"


def make(spark, rows, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def exact_covariance(x):
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(d)]
    return [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(d)] for i in range(d)]


def integers(v):
    return [math.floor(64 * c) + 1_000_000 for c in v]


def check_whitening(vectors, got, components):
    """vectors: (id, entries) of the fit list; got: the operator's rows."""
    x = [integers(v) for _, v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    cov = np.array([[float(c) for c in row] for row in exact_covariance(x)])
    values = np.linalg.eigvalsh(cov)[::-1]
    deviation = Counter((i, sum((n * c - t) ** 2 for c, t in zip(r, s))) for (i, _), r in zip(vectors, x))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == deviation
    assert {r.component for r in got} == set(range(1, min(components, d) + 1)) and {r.n for r in got} == {n}
    assert len(got) == n * min(components, d)
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-4, abs=1e-12)
    by_id = defaultdict(dict)
    for r in got:
        by_id[r.vec_id][r.component] = r.whitened
    w = np.array([[by_id[i][c + 1] for c in range(min(components, d))] for i, _ in vectors], float)
    alive = values[:w.shape[1]] > 1e-9
    if alive.any():
        error = np.abs(w[:, alive].T @ w[:, alive] / n - np.outer(w[:, alive].mean(0), w[:, alive].mean(0)) - np.eye(alive.sum())).max()
        assert error < 1e-4 and got[0].identity_error < 1e-4
        assert got[0].identity_error == pytest.approx(error, abs=1e-9)


def test_moments_are_exact(spark):
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((300, 7)) * [1, 100, 1e-3, 5, 1e6, 3, 1]).tolist()
    got = polarised_moments(usable_vectors(make(spark, list(enumerate(x))), "vec_id", "embedding"), 7)
    want = exact_covariance([integers(v) for v in x])
    assert (got.covariance() == np.array([[float(c) for c in row] for row in want])).all()


def test_moments_beyond_64_bits(spark):
    x = [[1e12 * (i % 3), -3e13 + i, 0.5] for i in range(50)]
    got = polarised_moments(usable_vectors(make(spark, list(enumerate(x))), "vec_id", "embedding"), 3)
    assert (got.covariance() == np.array([[float(c) for c in row] for row in exact_covariance([integers(v) for v in x])])).all()
    rows = whiten_embeddings(make(spark, list(enumerate(x)))).collect()
    assert len(rows) == 150 and all(r.deviation is None for r in rows)


def test_whitening_brute(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((400, 5)) @ rng.standard_normal((5, 5))
    vectors = list(enumerate(base.tolist()))
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [float("nan")] * 5), (904, [float("inf")] + [0.0] * 4),
           (905, [1.0, 2.0]), (906, [1e300] * 5)]
    rows = make(spark, vectors + bad + [(None, base[0].tolist())], 5).withColumns({"v": F.lit("x"), "n": F.lit(1), "component": F.lit(2)})
    got = whiten_embeddings(rows, components=3).collect()
    check_whitening(vectors + [(None, base[0].tolist())], got, 3)


def test_whitening_without_variance(spark):
    got = whiten_embeddings(make(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got, key=lambda r: r.component)] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = whiten_embeddings(make(spark, [(i, [float(i), 3.0]) for i in range(10)])).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)}
    assert {round(r.explained, 9) for r in flat} == {1.0, 0.0} and flat[0].identity_error < 1e-9
    assert whiten_embeddings(make(spark, [])).count() == 0


def test_whitening_hot_vector(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.standard_normal(4).tolist()) for i in range(200)] + [(500 + i, [0.1, 0.2, 0.3, 0.4]) for i in range(100)]
    check_whitening(vectors, whiten_embeddings(make(spark, vectors, 7)).collect(), 32)


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    got = op11_whitening(spark, SF_SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening([(r.vec_id, r.embedding) for r in rows], got.collect(), 32)


def brute_neighbours(rows, k=5, every=50):
    """query row number → candidates (score, id), nearest first."""
    out = {}
    for i, (qid, q) in enumerate(rows):
        if qid is not None and qid % every == 0:
            scored = [(-float(np.dot(q, v) / (np.linalg.norm(q) * np.linalg.norm(v))), math.inf if vid is None else vid)
                      for j, (vid, v) in enumerate(rows) if j != i]
            out[i] = sorted((round(s, 12), v) for s, v in scored)[:k]
    return out


def recall(got, want):
    """Share of the true neighbours (by score) that were found; checks ranks, scores and order."""
    by_query = defaultdict(list)
    for r in got:
        by_query[r.query_id].append(r)
    hit = total = 0
    for query, best in want.items():
        own = sorted(by_query[query], key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(own) + 1)) and len(own) == len(best)
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(own, own[1:]))
        hit += len({r.vec_id for r in own} & {v for _, v in best})
        total += len(best)
    return hit / total


def test_pigeonhole_misses_nothing():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 256, (3000, 32), np.uint8)
    codes[1000:] = codes[rng.integers(0, 1000, 2000)] ^ np.packbits(rng.random((2000, 256)) < 0.1, axis=1)
    queries, radius = codes[::100], rng.integers(0, 110, 30)
    query, row = CodeIndex(codes).search(queries, radius)
    distance = np.bitwise_count(queries[:, None] ^ codes).sum(axis=2)
    assert set(zip(query.tolist(), row.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(distance <= radius[:, None]))))


def test_rotations_are_learned_and_orthogonal():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((500, 16)) * np.linspace(3, 0.1, 16)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = learn_rotations(x, 32)
    assert np.allclose(turn[:, :16].T @ turn[:, :16], np.eye(16)) and turn.shape == (16, 32)
    loss = lambda r: ((np.sign(x @ r) - x @ r) ** 2).sum()
    assert loss(turn[:, :16]) < loss(learn_rotations(x, 16, steps=0))
    assert (encode(x, turn)[7] == encode(x[7:8], turn)[0]).all()


def test_search_recall_on_the_query(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = op12_hash_search(spark, SF_SMALL)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == ["query_id bigint", "rank int", "vec_id bigint", "score double"]
    got = got.collect()
    want = {rows[i][0]: best for i, best in brute_neighbours(rows).items()}
    assert recall(got, want) >= 0.9
    by_id = dict(rows)
    for r in got:
        q, v = by_id[r.query_id], by_id[r.vec_id]
        assert r.score == pytest.approx(float(q @ v / (np.linalg.norm(q) * np.linalg.norm(v))), abs=1e-14)


@pytest.mark.parametrize("parts", [1, 4])
def test_search_beyond_the_sample(spark, parts, monkeypatch):
    """A small sample, clusters of near copies and a third of all rows equal: recall, ties by id."""
    import riskloom.llm.hash_search as hs

    monkeypatch.setattr(hs, "LEAST_ROWS", 300)
    monkeypatch.setattr(hs, "QUERY_ROWS", 17)
    rng = np.random.default_rng(6)
    loose, centre, hot = rng.standard_normal((700, 24)), rng.standard_normal(24), rng.standard_normal(24)
    near = centre + 0.05 * rng.standard_normal((300, 24))
    rows = [(i, v.tolist()) for i, v in enumerate([*loose, *near, *[hot] * 500])]
    got = hashed_neighbours(make(spark, rows, parts * 2), sample_rows=200).collect()
    want = {rows[i][0]: best for i, best in brute_neighbours([(i, np.array(v)) for i, v in rows]).items()}
    assert recall(got, want) >= 0.9
    hot_rows = sorted((r.query_id, r.rank, r.vec_id) for r in got if r.query_id == 1050)
    assert hot_rows == [(1050, i + 1, 1000 + i) for i in range(5)]


def test_search_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (None, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]),
            (7, [float("inf"), 1.0]), (8, []), (9, [1.0, 1.0, 1.0]), (50, [-1e150, 1e150]), (10, [3e-200, 0.0])]
    table = make(spark, rows).withColumns({"rid": F.lit("x"), "rank": F.lit(1), "code": F.lit(0), "score": F.lit(2)})
    got = Counter((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in hashed_neighbours(table).collect())
    a = round(-math.sqrt(0.5), 12)
    assert got == Counter([(0, 1, 0, 1.0), (0, 2, 10, 1.0), (0, 3, None, 1.0), (0, 4, 50, a)] * 2
                          + [(50, 1, 0, a), (50, 2, 0, a), (50, 3, 10, a), (50, 4, None, a)])
    assert hashed_neighbours(make(spark, [])).count() == 0
    assert hashed_neighbours(make(spark, [(1, [1.0]), (2, [1.0])])).count() == 0
    assert hashed_neighbours(make(spark, [(50, [1.0])])).count() == 0


def test_cosines_do_not_depend_on_position():
    rng = np.random.default_rng(8)
    v = rng.standard_normal((1000, 64))
    v[1::2] = v[0]
    s = cosines(np.repeat(v[2:3], 1000, axis=0), v)
    assert len(set(s[1::2].tolist())) == 1 and s[0] == s[1]
