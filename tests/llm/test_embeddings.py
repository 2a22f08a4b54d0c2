"""Whitening and centroid clustering against numpy."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import centroids, vectors, whitening


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.select("*", *[F.lit("extra").alias(c) for c in "n cluster distance component x item data ids place value c h v".split()])


def distinct_integers(rows, scale):
    kept = [[math.floor(scale * x) for x in v] for _, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return np.array(sorted(set(map(tuple, kept))), dtype=object)


def check_whitening(got, rows, k=4):
    x = distinct_integers(rows, 256)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array(x - np.array([s / n for s in sums], object), float)
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    flat = np.diff(values[: k + 1]) > -1e-9 * values[0]
    by_id = dict(rows)
    for r in got:
        own = np.array([math.floor(256 * c) for c in by_id[r.vec_id]], object)
        assert r.n == n and int(r.deviation) == int(((n * own - sums) ** 2).sum())
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
        if not flat[max(0, r.component - 2) : r.component].any():
            z = float((own - sums / n).astype(float) @ directions[:, r.component - 1]) / math.sqrt(values[r.component - 1])
            assert abs(abs(r.whitened) - abs(z)) < 1e-8


def test_whitening_against_eigenvectors(spark):
    draw = np.random.default_rng(4)
    data = draw.normal(size=(300, 12)) @ np.diag(2.0 ** -np.arange(12)) * 4 + 3
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (904, rows[0][1]), (905, rows[0][1])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 302 * 4 and {r.vec_id for r in got} == {*range(300), 904, 905}
    check_whitening(got, rows)


def test_whitening_finds_equal_eigenvalues_and_ends_of_directions(spark):
    # the corners of a cube: three equal eigenvalues, and five dimensions without variance
    rows = [(i, [float(i & 1), float(i >> 1 & 1), float(i >> 2 & 1), 7.0, 7.0, 7.0, 7.0, 7.0]) for i in range(8)]
    got = whitening.whiten(frame(spark, rows)).collect()
    for component in (1, 2, 3):
        own = [r for r in got if r.component == component]
        assert own[0].explained == pytest.approx(1 / 3) and np.var([r.whitened for r in own]) == pytest.approx(1)
    last = [r for r in got if r.component == 4]
    assert all(r.whitened is None and r.explained == 0 for r in last) and all(r.identity_error < 1e-12 for r in got)


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0])])).collect()
    assert len(one) == 6 and all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.identity_error is None for r in one)
    short = whitening.whiten(frame(spark, [(1, [1.0]), (2, [1.0, 2.0]), (3, [2.0, 0.0]), (4, [1e300, 0.0])])).collect()
    assert len(short) == 8 and all(r.n == 4 for r in short)
    assert whitening._deviations(np.array([[1 << 30, -5]]), 1 << 30, [3, 1]) == [((1 << 60) - 3) ** 2 + (5 * (1 << 30) + 1) ** 2]
    assert whitening._deviations(np.array([[1 << 31]]), 1 << 60, [0]) == [None]


def test_ill_conditioned_rows_stay_orthogonal(spark):
    draw = np.random.default_rng(9)
    rows = [(i, [float(a), float(a + b), float(b) / 64]) for i, (a, b) in enumerate(zip(draw.integers(-4000, 4000, 200), draw.integers(0, 3, 200) * 1.0))]
    check_whitening(whitening.whiten(frame(spark, rows), components=2).collect(), rows, 2)


@pytest.mark.parametrize("seed", range(3))
def test_tree_finds_the_nearest_and_the_smallest_number(seed):
    draw = np.random.default_rng(seed)
    points = draw.integers(-6, 6, (200, 3))  # many equal points and ties
    rows = draw.integers(-8, 8, (500, 3))
    apart = ((rows[:, None] - points[None]) ** 2).sum(axis=2)
    number, distance = centroids.nearest(centroids.grow(points), rows)
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def brute_force(rows, k, rounds, width):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centre = [v for _, v in start[:k]]
    for step in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centre)) for _, v in kept]
        if step < rounds:
            for n in range(len(centre)):
                own = [v for (_, v), f in zip(kept, found) if f[1] == n]
                centre[n] = [sum(column) // len(own) for column in zip(*own)] if own else centre[n]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    spread = [sum(d for d, m in found if m == n) for n in range(len(centre))]
    return sorted(((i, n, d, spread[n], sum(spread), digest[n]) for (i, _), (d, n) in zip(kept, found)), key=repr)


def test_clusters_against_brute_force(spark):
    draw = np.random.default_rng(2)
    rows = [(int(i), v.tolist()) for i, v in enumerate(draw.normal(size=(150, 5)))]
    rows += [(3, rows[3][1]), (None, rows[9][1]), (None, rows[10][1]), (200, None), (201, [0.5] * 4), (202, [None] * 5), (203, [float("nan")] * 5)]
    df = frame(spark, rows)
    for k in (1, 6, 300):
        got = sorted((tuple(r) for r in centroids.cluster(df, k=k, rounds=4, width=5).collect()), key=repr)
        assert got == brute_force(rows, k, 4, 5)
    assert centroids.cluster(frame(spark, []), width=5).collect() == []
    assert len(centroids.cluster(frame(spark, [(1, [1e300, -1e300]), (2, [0.0, 0.0])]), width=2).collect()) == 2


def test_keys_are_equal_for_equal_rows_only():
    matrix = np.array([[1, -1], [40_000, 2], [1, -1], [1 << 40, 0], [0, 0]])
    keys = vectors.row_keys(matrix).to_pylist()
    assert len(set(keys)) == 4
    back = vectors.from_keys(vectors.row_keys(matrix), 2)
    assert sorted(map(tuple, back.tolist())) == sorted(map(tuple, matrix.tolist()))
