"""The binned ROC curve: against a plain version, whatever the partitioning; ties, groups, nulls, missing classes."""

import random

import pytest

from riskloom.operators.evaluate import auc_binned, auc_exact, roc_binned


def plain(rows, bins):
    """Points (point, threshold, tp, fp) of (score, label) rows."""
    by_score = {}
    for s, y in rows:
        if s is not None and y is not None:
            own = by_score.setdefault(float(s), [0, 0])
            own[0 if y == 1 else 1] += 1
    ranked = sorted(by_score, reverse=True)
    run, out, tp, fp = max(1, len(ranked) // bins), [], 0, 0
    for i in range(0, len(ranked), run):
        for s in ranked[i:i + run]:
            tp, fp = tp + by_score[s][0], fp + by_score[s][1]
        out.append((i // run + 1, ranked[min(i + run, len(ranked)) - 1], tp, fp))
    return [(0, None, 0, 0), *out] if out else []


def area(points):
    n_pos, n_neg = points[-1][2], points[-1][3]
    return sum((b[3] - a[3]) * (b[2] + a[2]) / 2 for a, b in zip(points, points[1:])) / (n_pos * n_neg)


def got_points(df):
    return sorted((r.point, r.threshold, r.tp, r.fp) for r in df.collect())


@pytest.mark.parametrize("bins", [1, 7, 40, 1000])
@pytest.mark.parametrize("partitions", [1, 5])
def test_curve_follows_the_rank(spark, bins, partitions):
    rng = random.Random(bins)
    rows = [(rng.choice([rng.random(), 0.25, -0.0, 0.0]), int(rng.random() < 0.4)) for _ in range(700)] + [(None, 1), (0.3, None)]
    df = spark.createDataFrame(rows, "score double, label int").repartition(partitions)
    want = plain(rows, bins)
    points = roc_binned(df, "score", "label", bins)
    assert got_points(points) == want and len(want) <= 2 * bins + 1
    got = auc_binned(points).first()
    assert got.auc == pytest.approx(area(want), abs=1e-12) and got.n_points == want[-1][0]


def test_close_to_the_exact_area(spark):
    """The binned area differs by at most half of the pairs that share a point."""
    rng = random.Random(5)
    rows = [(y + rng.gauss(0, 1), y) for y in (int(rng.random() < 0.3) for _ in range(4000))]
    df = spark.createDataFrame(rows, "score double, label int")
    exact = auc_exact(df, "score", "label").first().auc
    for bins in (10, 100):
        points = plain(rows, bins)
        within = sum((b[2] - a[2]) * (b[3] - a[3]) for a, b in zip(points, points[1:])) / 2 / (points[-1][2] * points[-1][3])
        assert abs(auc_binned(roc_binned(df, "score", "label", bins)).first().auc - exact) <= within + 1e-12


def test_groups_and_missing_classes(spark):
    rng = random.Random(9)
    rows = [(g, rng.random(), int(rng.random() < 0.5)) for g in ("a", "b", None) for _ in range(rng.randint(50, 300))] + [("pos", 0.1, 1)]
    df = spark.createDataFrame(rows, "g string, score double, label int").repartition(4)
    points = roc_binned(df, "score", "label", 11, ["g"])
    for g in ("a", "b", None, "pos"):
        own = [(r.point, r.threshold, r.tp, r.fp) for r in points.collect() if r.g == g]
        assert sorted(own) == plain([(s, y) for x, s, y in rows if x == g], 11)
    areas = {r.g: r.auc for r in auc_binned(points, ["g"]).collect()}
    assert areas["pos"] is None and all(0 <= areas[g] <= 1 for g in ("a", "b", None))


def test_no_rows(spark):
    assert roc_binned(spark.createDataFrame([], "score double, label int"), "score", "label").count() == 0
