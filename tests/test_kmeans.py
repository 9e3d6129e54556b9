"""Starts of k-means side by side, against plain NumPy."""

import numpy as np
import pytest

from shelfwise.operators import kmeans


def table(spark, xs):
    names = [f"x{i}" for i in range(xs.shape[1])]
    return spark.createDataFrame([tuple(map(float, x)) for x in xs], ", ".join(f"{n} double" for n in names)), names


def test_a_round_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "TASK_ROWS", 400)
    rng = np.random.default_rng(3)
    xs = np.vstack([rng.normal(0, 1, (1500, 3)), rng.normal(1e4, 0.1, (500, 3)), np.full((600, 3), 2.0)])
    df, names = table(spark, xs)
    packed = df.repartition(3).select(*names).mapInArrow(kmeans.pack, "xs array<double>").cache()
    assert packed.count() < len(xs) / 100
    runs = [xs[rng.choice(len(xs), k, replace=False)] + rng.normal(0, 0.1, (k, 3)) for k in (1, 4, 60)]
    sums, costs = kmeans.one_round(packed, runs)
    for centres, got, cost in zip(runs, sums, costs):
        gaps = ((xs[:, None] - centres[None]) ** 2).sum(-1)
        own = gaps.argmin(1)
        assert cost == pytest.approx(gaps.min(1).sum())
        assert got[:, -1].tolist() == np.bincount(own, minlength=len(centres)).tolist()
        assert got[:, :-1] == pytest.approx(np.array([xs[own == c].sum(0) for c in range(len(centres))]))


def test_all_starts_of_all_numbers_share_their_rounds(spark, monkeypatch):
    sizes, plain = [], kmeans.one_round
    monkeypatch.setattr(kmeans, "one_round", lambda packed, runs: sizes.append(len(runs)) or plain(packed, runs))
    rng = np.random.default_rng(5)
    xs = np.vstack([rng.normal(c, 0.4, (40, 2)) for c in ([0, 0], [6, 0], [0, 6], [6, 6])])
    df, names = table(spark, xs)
    found = kmeans.fit_many(df, names, [2, 4], n_init=4)
    assert sizes[0] == sizes[-1] == 8 and sizes[:-1] == sorted(sizes[:-1], reverse=True)
    centres, inertia = found[4]
    assert centres == pytest.approx(np.array(sorted(xs[i : i + 40].mean(0).tolist() for i in range(0, 160, 40))))
    assert inertia == pytest.approx(((xs[:, None] - centres[None]) ** 2).sum(-1).min(1).sum())
    assert found[2][1] > inertia


def test_one_point_and_equal_points(spark):
    df, names = table(spark, np.ones((5, 2)))
    centres, inertia = kmeans.fit_many(df, names, [3], n_init=2)[3]
    assert centres.tolist() == [[1.0, 1.0]] and inertia == 0


def test_starts_of_all_runs_take_four_jobs_over_all_points(spark, monkeypatch):
    passes, round_, draw = [], kmeans.one_round, kmeans.draw
    monkeypatch.setattr(kmeans, "one_round", lambda packed, runs: passes.append(len(runs)) or round_(packed, runs))
    monkeypatch.setattr(kmeans, "draw", lambda packed, runs, *more: passes.append(len(runs)) or draw(packed, runs, *more))
    rng = np.random.default_rng(7)
    xs = np.vstack([rng.normal(c, 0.05, (700, 2)) for c in ([0, 0], [6, 0], [0, 6])])
    df, names = table(spark, xs)
    packed = df.repartition(3).select(*names).mapInArrow(kmeans.pack, "xs array<double>").cache()
    found = kmeans.starts(packed, [(k, i) for k in (2, 3) for i in range(5)], 2, 1)
    assert passes == [10] * 4 and [len(f) for f in found] == [2] * 5 + [3] * 5
    for centres in found[5:]:  # far groups of points each get their start
        assert np.array(sorted(centres.round().tolist())).tolist() == [[0, 0], [0, 6], [6, 0]]
    far = kmeans.draw(packed, [np.array([[0.0, 0.0]])] * 2, [50, 1], 2, [1, 1])
    assert len(far[0]) == 50 and (far[0].max(1) > 4).all() and len(np.unique(far[0], axis=0)) == 50


def test_points_without_a_place_are_refused(spark):
    df, names = table(spark, np.array([[1, 2], [np.nan, 1]]))
    with pytest.raises(ValueError, match="1 of 2"):
        kmeans.fit_many(df, names, [2], n_init=1)
