"""Bounded k-means against plain Lloyd rounds in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from searchmill.llm import centroids


def plain(rows, k=40, rounds=5, dims=64, scale=256):
    """(sorted (vec_id, cluster, distance), final centroids)."""
    kept = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]

    def place(row):
        raw = np.array(row[1], "<i4").tobytes()
        if row[0] is None:
            return (1, "", raw)
        return (0, hashlib.sha256(f"2:{row[0]}".encode()).hexdigest(), raw)

    centres = [v for _, v in sorted(kept, key=place)[:k]]

    def assign():
        out = []
        for i, v in kept:
            square = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres]
            least = min(square)
            out.append((i, square.index(least), least))
        return out

    for _ in range(rounds):
        mine = assign()
        for c in range(len(centres)):
            own = [v for (_, v), (_, at, _) in zip(kept, mine, strict=True) if at == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return sorted(assign(), key=str), centres


def vectors(rng, n, dims, spread):
    """Clouds on a coarse grid, so that distances are often equal."""
    middles = [[rng.randrange(-spread, spread) / 4 for _ in range(dims)] for _ in range(7)]
    return [
        (k, [m + rng.choice([0, 0, 0.25, -0.25, 1 / 256]) for m in rng.choice(middles)]) for k in range(n)
    ]


@pytest.mark.parametrize("dims, k, n, spread", [(64, 40, 300, 4), (2, 5, 200, 3), (3, 9, 400, 2), (2, 1, 30, 3), (2, 40, 12, 2)])
def test_against_plain_rounds(spark, dims, k, n, spread):
    rng = random.Random(dims * k)
    rows = vectors(rng, n, dims, spread)
    rows += [rows[0], rows[1], (None, rows[2][1]), (None, rows[3][1])]
    rows += [(9000, None), (9001, []), (9002, [0.5] * (dims - 1)), (9003, [None] * dims)]
    rows += [(9004, [float("nan")] * dims), (9005, [float("-inf")] + [0.0] * (dims - 1))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found, centres = centroids.cluster_vectors(df, k=k, dims=dims)
    want, want_centres = plain(rows, k, dims=dims)
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert centres.tolist() == want_centres


def test_ties_go_to_the_smaller_number():
    """All points of a small grid, around centroids that are often equally near."""
    rng = np.random.default_rng(3)
    grid = np.stack(np.meshgrid(np.arange(-6, 7), np.arange(-6, 7)), -1).reshape(-1, 2).astype(np.int64)
    for _ in range(60):
        centres = rng.integers(-6, 7, (int(rng.integers(1, 9)), 2))
        state, moved = None, None
        for _ in range(4):
            search = centroids.Search(centres, moved)
            n = len(grid)
            state = state or [np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n)]
            search.nearest(grid, *state)
            square = ((grid[:, None] - centres[None]) ** 2).sum(2)
            assert (state[0] == square.argmin(1)).all()
            assert (state[2] ** 2 >= square.min(1)).all()
            if len(centres) > 1:
                rest = square.copy()
                rest[np.arange(n), state[0]] = 1 << 40
                assert (state[3] ** 2 <= rest.min(1)).all()
            new = centres + rng.integers(-1, 2, centres.shape)
            moved = np.sqrt(centroids.distances(new, centres)) * centroids.UP
            centres = new


def test_most_distances_are_saved(monkeypatch):
    rng = np.random.default_rng(4)
    middles = rng.integers(-4000, 4000, (40, 64))
    points = middles[rng.integers(0, 40, 4000)] + rng.integers(-40, 40, (4000, 64))
    state = [np.zeros(4000, np.int32), np.zeros(4000, np.int32), np.zeros(4000), np.zeros(4000)]
    centroids.Search(middles, None).nearest(points, *state)
    asked = []
    plain_distances = centroids.distances
    search = centroids.Search(middles + 1, np.full(40, 8.001))
    monkeypatch.setattr(centroids, "distances", lambda v, c: asked.append(len(v)) or plain_distances(v, c))
    search.nearest(points, *state)
    assert sum(asked) < 4000


def test_digest_and_empty_tables(spark):
    kind = "vec_id long, embedding array<float>, cluster int, distance string, `a.b` int"
    assert centroids.digest(spark.createDataFrame([], kind)).collect() == []
    rng = random.Random(6)
    rows = vectors(rng, 90, 64, 4)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], kind)
    want, centres = plain(rows)
    got = centroids.digest(df).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    for r in got:
        assert r.inertia == sum(w[2] for w in want)
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
        text = ",".join(map(str, centres[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_too_large_components(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="is beyond"):
        centroids.digest(df)
