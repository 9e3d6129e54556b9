"""Clustering against brute force on small point sets."""

import numpy as np
import pytest

from shelfwise.operators import cluster, dbscan


def points(spark, xs, labels=None):
    names = [f"x{i}" for i in range(xs.shape[1])]
    schema = "id long, " + ", ".join(f"{n} double" for n in names) + (", cluster int" if labels is not None else "")
    rows = [
        (i, *map(float, x), *([int(labels[i])] if labels is not None else [])) for i, x in enumerate(xs)
    ]
    return spark.createDataFrame(rows, schema).repartition(3), names


def brute_dbscan(xs, eps, least):
    near = ((xs[:, None] - xs[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= least
    label, current = np.full(len(xs), -1), 0
    for i in range(len(xs)):
        if not core[i] or label[i] != -1:
            continue
        stack, label[i] = [i], current
        while stack:
            for k in np.flatnonzero(near[stack.pop()]):
                if label[k] == -1:
                    label[k] = current
                    if core[k]:
                        stack.append(k)
        current += 1
    return label


def crowd(seed, d):
    rng = np.random.default_rng(seed)
    blob = rng.normal(0, 0.05, (80, d))  # a third of the points within a cell or two
    chain = np.column_stack([np.linspace(1, 6, 60), *[rng.normal(0, 0.05, 60) for _ in range(d - 1)]])
    scatter = rng.uniform(-2, 8, (60, d))
    twins = np.repeat(rng.uniform(0, 5, (4, d)), 8, axis=0)
    xs = np.vstack([blob, chain, scatter, twins])
    return xs[rng.permutation(len(xs))]


@pytest.mark.parametrize("seed, d, eps, least", [(1, 2, 0.3, 5), (2, 2, 0.12, 4), (3, 3, 0.45, 6), (4, 1, 0.05, 3), (5, 2, 1.0, 10)])
def test_dbscan_equals_brute_force(spark, seed, d, eps, least):
    xs = crowd(seed, d)
    df, names = points(spark, xs)
    got = {r["id"]: r["cluster"] for r in dbscan.fit_dbscan(df, "id", names, eps, least, split=7).collect()}
    assert [got[i] for i in range(len(xs))] == brute_dbscan(xs, eps, least).tolist()


def test_dbscan_without_any_core_point(spark):
    df, names = points(spark, np.arange(12.0).reshape(6, 2) * 10)
    assert {r["cluster"] for r in dbscan.fit_dbscan(df, "id", names, 0.5, 3).collect()} == {-1}


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, k) for k in range(101, 140)]
    edges = spark.createDataFrame(chain + star, "u long, v long")
    roots = {r["node"]: r["root"] for r in dbscan.connected_components(edges).collect()}
    assert {roots[i] for i in range(1, 41)} == {0} and {roots[k] for k in range(101, 140)} == {100}


def brute_silhouette(xs, labels, squared=False):
    d = ((xs[:, None] - xs[None]) ** 2).sum(-1)
    d = d if squared else np.sqrt(d)
    scores = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


@pytest.fixture(scope="module")
def labelled():
    rng = np.random.default_rng(11)
    labels = np.concatenate([np.zeros(60, int), rng.integers(1, 4, 60), [4]])  # one hot cluster, one singleton
    return rng.normal(0, 1, (121, 3)) + labels[:, None], labels


def test_silhouettes(spark, labelled):
    xs, labels = labelled
    df, names = points(spark, xs, labels)
    exact = cluster.silhouette_exact(df, "id", names, block_rows=25).first()[0]
    assert exact == pytest.approx(brute_silhouette(xs, labels))
    squared = cluster.silhouette(df, "id", names, "squared").first()[0]
    assert squared == pytest.approx(brute_silhouette(xs, labels, squared=True))
    assert -1 <= exact <= 1


def test_davies_bouldin_and_calinski_harabasz(spark, labelled):
    xs, labels = labelled
    df, names = points(spark, xs, labels)
    groups = {c: xs[labels == c] for c in set(labels)}
    centre = {c: g.mean(0) for c, g in groups.items()}
    scatter = {c: np.linalg.norm(g - centre[c], axis=1).mean() for c, g in groups.items()}
    dbi = np.mean([max((scatter[a] + scatter[b]) / np.linalg.norm(centre[a] - centre[b]) for b in groups if b != a) for a in groups])
    assert cluster.davies_bouldin(df, names).first()[0] == pytest.approx(dbi)
    between = sum(len(g) * ((centre[c] - xs.mean(0)) ** 2).sum() for c, g in groups.items())
    within = sum(((g - centre[c]) ** 2).sum() for c, g in groups.items())
    want = (between / (len(groups) - 1)) / (within / (len(xs) - len(groups)))
    assert cluster.calinski_harabasz(df, names).first()[0] == pytest.approx(want)


def test_one_cluster_is_an_error_line(spark):
    df, names = points(spark, np.random.default_rng(0).normal(size=(10, 2)), np.zeros(10, int))
    rows = cluster.evaluate(df, "id", names, "squared").collect()
    assert [r["metric"] for r in rows] == ["error: need at least 2 clusters"]
    assert cluster.silhouette(df, "id", names, "squared").first()[0] == 0.0


def blobs():
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0], [6, 0], [0, 6], [6, 6]])
    return np.vstack([rng.normal(c, 0.4, (30, 2)) for c in centres]), np.repeat(np.arange(4), 30)


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_kmeans_finds_blobs_and_is_stable(spark):
    xs, truth = blobs()
    df, names = points(spark, xs)
    first, inertia = cluster.fit_kmeans(df, names, 4, n_init=5)
    again, _ = cluster.fit_kmeans(df, names, 4, n_init=5)
    labels = [r["cluster"] for r in first.orderBy("id").collect()]
    assert same_partition(labels, truth) and labels == [r["cluster"] for r in again.orderBy("id").collect()]
    assert inertia == pytest.approx(sum(((xs[truth == c] - xs[truth == c].mean(0)) ** 2).sum() for c in range(4)))


@pytest.mark.parametrize("linkage", cluster.LINKAGES)
@pytest.mark.parametrize("micro", [500, 20])
def test_agglomerative_finds_blobs(spark, linkage, micro):
    xs, truth = blobs()
    df, names = points(spark, xs)
    rows = cluster.fit_hac(df, "id", names, 4, linkage, micro=micro, n_init=2).orderBy("id").collect()
    assert same_partition([r["cluster"] for r in rows], truth)


def test_ward_merges_the_cheapest_pair_first():
    xs = np.array([[0.0], [1.0], [5.0], [5.5], [20.0]])
    labels = cluster.linkage_labels(xs, np.ones(5), 3, "ward")
    assert same_partition(labels, [0, 0, 1, 1, 2])


def test_pca_coordinates(spark):
    xs = np.random.default_rng(2).normal(size=(50, 3)) * [5, 2, 0.1] + 10
    df, names = points(spark, xs)
    got = np.array([tuple(r)[1:] for r in cluster.pca_2d(df, "id", names).orderBy("id").collect()])
    centred = xs - xs.mean(0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(centred @ axes[:2].T))


def test_find_k_marks_the_best(spark):
    xs, _ = blobs()
    df, names = points(spark, xs)
    rows = cluster.find_k(df, "id", names, range(2, 6), n_init=3).orderBy("k").collect()
    assert [r["k"] for r in rows if r["best"]] == [4]
    assert all(a["inertia"] >= b["inertia"] for a, b in zip(rows, rows[1:]))


def brute_davies_bouldin(xs, labels):
    names = np.unique(labels)
    centre = np.array([xs[labels == c].mean(0) for c in names])
    scatter = np.array([np.linalg.norm(xs[labels == c] - m, axis=1).mean() for c, m in zip(names, centre)])
    gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(-1))
    np.fill_diagonal(gap, np.inf)
    return ((scatter[:, None] + scatter[None]) / gap).max(1).mean()


def brute_squared(xs, labels):
    names, own = np.unique(labels, return_inverse=True)
    size = np.bincount(own)
    centre = np.array([xs[own == c].mean(0) for c in range(len(names))])
    variance = np.array([((xs[own == c] - centre[c]) ** 2).sum(1).mean() for c in range(len(names))])
    to = ((xs[:, None] - centre[None]) ** 2).sum(-1) + variance
    at = np.arange(len(xs)), own
    a = to[at] * size[own] / np.maximum(size[own] - 1, 1)
    to[at] = np.inf
    b = to.min(1)
    return np.where(size[own] == 1, 0, (b - a) / np.maximum(np.maximum(a, b), 1e-300)).mean()


@pytest.mark.parametrize("width, few", [(1, 1), (3, 1), (5, 1), (2, None)])
def test_many_clusters_are_looked_up_in_a_grid(spark, monkeypatch, width, few):
    rng = np.random.default_rng(width)
    if few is not None:
        monkeypatch.setattr(cluster, "FEW_CLUSTERS", few)
    k = 60 if few else 700
    # Most centres crowd in one corner, some are far off, one cluster holds a third of the points.
    home = np.concatenate([rng.normal(0, 0.3, (k - 10, width)), rng.normal(0, 300, (10, width))])
    labels = np.concatenate([np.arange(k), rng.integers(0, k, 4 * k), np.zeros(2 * k, int)])
    xs = home[labels] + rng.normal(0, 0.05, (len(labels), width)) * (1 + labels[:, None] % 5)
    df, names = points(spark, xs, labels)
    assert cluster.davies_bouldin(df, names).first()[0] == pytest.approx(brute_davies_bouldin(xs, labels))
    assert cluster.silhouette(df, "id", names).first()[0] == pytest.approx(brute_squared(xs, labels))


def test_grid_with_equal_and_missing_others(spark, monkeypatch):
    monkeypatch.setattr(cluster, "FEW_CLUSTERS", 0)
    xs = np.ones((6, 2))
    df, names = points(spark, xs, np.array([0, 0, 1, 1, 2, 2]))
    assert cluster.silhouette(df, "id", names).first()[0] == 0.0  # all centres are one point
    df, names = points(spark, xs, np.zeros(6, int))
    assert cluster.davies_bouldin(df, names).first()[0] is None
    assert cluster.silhouette(df, "id", names).first()[0] == 0.0


def test_plan_for_many_clusters_gathers_none(spark, monkeypatch):
    monkeypatch.setattr(cluster, "FEW_CLUSTERS", 3)
    rng = np.random.default_rng(1)
    df, names = points(spark, rng.normal(size=(40, 2)), np.arange(40) % 10)
    for table in (cluster.davies_bouldin(df, names), cluster.silhouette_squared(df, names)):
        assert "collect_list" not in table._jdf.queryExecution().toString()


def test_exact_silhouette_measures_a_pair_of_blocks_once(spark, monkeypatch):
    rng = np.random.default_rng(7)
    labels = np.concatenate([np.zeros(150, int), rng.integers(-1, 30, 150), [40]])
    xs = rng.normal(0, 1, (301, 2)) + 1e4 + labels[:, None] % 3
    df, names = points(spark, np.vstack([xs, xs[:40]]), np.concatenate([labels, labels[:40]]))
    monkeypatch.setattr(cluster, "MOST_BLOCKS", 5)
    monkeypatch.setattr(cluster, "TILE", (7, 16))
    got = cluster.silhouette_exact(df, "id", names, block_rows=10)
    assert got.first()[0] == pytest.approx(brute_silhouette(np.vstack([xs, xs[:40]]), np.concatenate([labels, labels[:40]])), abs=1e-6)
    plan = got._jdf.queryExecution().toString()
    tasks = max(int(part.split(")")[0]) for part in plan.split("RoundRobinPartitioning(")[1:])
    assert tasks <= 15  # pairs of five blocks; before, the square of one block for ten rows
    assert cluster.silhouette_exact(df.where("cluster = 0"), "id", names).first()[0] is None
    assert cluster.silhouette_exact(df.where("false"), "id", names).first()[0] is None


def test_exact_silhouette_of_many_clusters(spark, monkeypatch):
    monkeypatch.setattr(cluster, "MOST_SUMS", 2000)  # blocks of 20 points
    rng = np.random.default_rng(8)
    xs, labels = rng.normal(size=(200, 3)), rng.permutation(np.arange(200) % 100)
    df, names = points(spark, xs, labels)
    assert cluster.silhouette_exact(df, "id", names).first()[0] == pytest.approx(brute_silhouette(xs, labels))
