"""Grid operators against comparison of all pairs on small fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import cells
from millrace.operators.components import component_roots
from millrace.operators.silhouette import silhouette, silhouette_plain


def fixture(n, dims, seed):
    """Two dense clumps, a string of points, copies of one position and stragglers."""
    rng = random.Random(seed)
    points = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4:
            p = [rng.gauss(0.2, 0.01) for _ in range(dims)]
        elif kind < 0.6:
            p = [rng.gauss(0.7, 0.05) for _ in range(dims)]
        elif kind < 0.7:
            p = [0.5] * dims
        elif kind < 0.8:
            p = [0.9, *([0.02 * (i % 20)] * (dims - 1))]
        else:
            p = [rng.random() for _ in range(dims)]
        points.append((i, *p))
    return points


def gap(a, b, metric):
    diffs = [abs(x - y) for x, y in zip(a[1:], b[1:])]
    return sum(diffs) if metric == "manhattan" else math.sqrt(sum(d * d for d in diffs))


def frame(spark, points, dims):
    return spark.createDataFrame(points, "id long, " + ", ".join(f"x{i} double" for i in range(dims))).repartition(4)


def brute_components(points, links):
    root = {p[0]: p[0] for p in points}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {p[0]: find(p[0]) for p in points}


def brute_dbscan(points, eps, m, metric="euclidean"):
    near = {p[0]: [q[0] for q in points if gap(p, q, metric) <= eps] for p in points}
    core = {i for i, ns in near.items() if len(ns) >= m}
    roots = brute_components([p for p in points if p[0] in core], [(i, j) for i in core for j in near[i] if j in core])
    out = {}
    for i, ns in near.items():
        touching = [roots[j] for j in ns if j in core]
        out[i] = (roots[i] if i in core else min(touching, default=-1), int(i in core))
    return out


CASES = [
    (160, 2, "euclidean", 0.05, 4), (160, 2, "manhattan", 0.06, 5), (120, 3, "euclidean", 0.12, 4),
]


@pytest.mark.parametrize("n,dims,metric,eps,m", CASES)
@pytest.mark.parametrize("direct", [1, cells.DIRECT_PAIRS])
def test_dbscan(spark, n, dims, metric, eps, m, direct):
    points = fixture(n, dims, 11)
    space = cells.Space(tuple(f"x{i}" for i in range(dims)), metric)
    got = cells.dbscan(frame(spark, points, dims), "id", space, eps, m, direct_pairs=direct).collect()
    assert {r.id: (r.cluster, r.is_core) for r in got} == brute_dbscan(points, eps, m, metric)


def test_dbscan_hot_cell_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(cells, "CELL_PART", 7)
    points = fixture(160, 2, 3)
    space = cells.Space(("x0", "x1"))
    got = cells.dbscan(frame(spark, points, 2), "id", space, 0.05, 6).collect()
    assert {r.id: (r.cluster, r.is_core) for r in got} == brute_dbscan(points, 0.05, 6)
    near = cells.kth_distance(frame(spark, points, 2), "id", space, 3).collect()
    for r in near:
        p = points[r.id]
        assert r.dist == pytest.approx(sorted(gap(p, q, "euclidean") for q in points if q is not p)[2])


def test_dbscan_sweep(spark):
    points = fixture(120, 2, 8)
    space = cells.Space(("x0", "x1"))
    got = cells.dbscan_sweep(frame(spark, points, 2), "id", space, [0.05], [3, 8]).collect()
    for row in got:
        want = brute_dbscan(points, row.eps, row.min_samples)
        assert row.n_clusters == len({c for c, _ in want.values() if c != -1})
        assert row.n_noise == sum(c == -1 for c, _ in want.values())


def test_cells_apart_are_compared_only_where_touching_cells_do_not_join_them(spark, monkeypatch):
    given, links = [], cells.cell_links

    def counted(grid, spots, pairs, direct_pairs):
        given.append(pairs.count())
        return links(grid, spots, pairs, direct_pairs)

    monkeypatch.setattr(cells, "cell_links", counted)
    space = cells.Space(("x0", "x1"))
    block = [(10 * i + j, 0.1 * i, 0.1 + 0.1 * j) for i in range(8) for j in range(8)]
    # Beside the block, within reach of it, but not in a touching cell; then one out of reach.
    for points, apart, clusters in ((block, 0, 1), ([*block, (200, 0.3, 1.05), (201, 0.3, 1.5)], 1, 2)):
        got = {r.id: r.cluster for r in cells.single_link(frame(spark, points, 2), "id", space, 0.29).collect()}
        pairs = [(a[0], b[0]) for a in points for b in points if gap(a, b, "euclidean") <= 0.29]
        assert got == brute_components(points, pairs) and len(set(got.values())) == clusters
        touching, others = given[-2:]
        assert touching > 0 and (others > 0) == apart


def test_line_of_two_clusters_and_noise(spark):
    xs = [0.0, 0.1, 0.2, 0.3, 1.0, 1.1, 1.2, 5.0]
    points = [(i, x) for i, x in enumerate(xs)]
    got = cells.dbscan(frame(spark, points, 1), "id", cells.Space(("x0",)), 0.15, 3).collect()
    assert {r.id: r.cluster for r in got} == {0: 1, 1: 1, 2: 1, 3: 1, 4: 5, 5: 5, 6: 5, 7: -1}


@pytest.mark.parametrize("direct", [1, cells.DIRECT_PAIRS])
def test_single_link_at_distance(spark, direct):
    points = fixture(150, 2, 21)
    space = cells.Space(("x0", "x1"))
    got = {r.id: r.cluster for r in cells.single_link(frame(spark, points, 2), "id", space, 0.04, direct).collect()}
    links = [(a[0], b[0]) for a in points for b in points if gap(a, b, "euclidean") <= 0.04]
    assert got == brute_components(points, links)


def test_single_link_into_k(spark):
    points = fixture(60, 2, 4)
    space = cells.Space(("x0", "x1"))
    got = {r.id: r.cluster for r in cells.single_link_k(frame(spark, points, 2), "id", space, 4).collect()}
    pairs = sorted((gap(a, b, "euclidean"), a[0], b[0]) for a in points for b in points if a[0] < b[0])
    links, roots = [], {}
    for _, a, b in pairs:
        links.append((a, b))
        roots = brute_components(points, links)
        if len(set(roots.values())) == 4:
            break
    assert got == roots


@pytest.mark.parametrize("dims,metric,k", [(2, "euclidean", 1), (2, "manhattan", 5), (3, "euclidean", 9)])
def test_kth_distance(spark, dims, metric, k):
    points = fixture(140, dims, 2)
    space = cells.Space(tuple(f"x{i}" for i in range(dims)), metric)
    got = {r.id: r.dist for r in cells.kth_distance(frame(spark, points, dims), "id", space, k).collect()}
    for p in points:
        want = sorted(gap(p, q, metric) for q in points if q is not p)[k - 1]
        assert got[p[0]] == pytest.approx(want)


def test_kth_distance_without_enough_rows(spark):
    points = [(0, 0.0, 0.0), (1, 1.0, 1.0)]
    got = cells.kth_distance(frame(spark, points, 2), "id", cells.Space(("x0", "x1")), 2).collect()
    assert [r.dist for r in got] == [None, None]


def test_distance_pairs_merge_copies(spark):
    points = [(0, 0.0, 0.0), (1, 0.0, 0.0), (2, 0.3, 0.4), (3, 9.0, 9.0)]
    got = cells.distance_pairs(frame(spark, points, 2), "id", cells.Space(("x0", "x1")), 0.5).collect()
    assert [(r.a, r.b, r.w_a, r.w_b) for r in got] == [(0, 2, 2, 1)]
    assert got[0].dist == pytest.approx(0.5)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, b) for b in range(101, 160)] + [
        (rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)
    ]
    got = {r.node: r.root for r in component_roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {v for e in edges for v in e if e[0] != e[1]}
    want = brute_components([(v,) for v in nodes], [e for e in edges if e[0] != e[1]])
    assert got == want


def test_components_of_nothing(spark):
    assert component_roots(spark.createDataFrame([], "a long, b long")).collect() == []


def test_silhouettes(spark):
    points = fixture(80, 2, 9)
    labelled = frame(spark, points, 2).withColumn("label", (F.col("x0") > 0.5).cast("int"))
    label = {p[0]: int(p[1] > 0.5) for p in points}

    def want(power):
        scores = []
        for p in points:
            mean = {}
            for k in (0, 1):
                others = [gap(p, q, "euclidean") ** power for q in points if label[q[0]] == k and q is not p]
                mean[k] = sum(others) / len(others)
            a, b = mean[label[p[0]]], mean[1 - label[p[0]]]
            scores.append((b - a) / max(a, b))
        return sum(scores) / len(scores)

    assert silhouette(labelled, ["x0", "x1"], "label") == pytest.approx(want(2))
    plain = silhouette_plain(labelled, "id", ["x0", "x1"], "label", block=13)
    assert plain.agg(F.avg("silhouette")).first()[0] == pytest.approx(want(1))
    with pytest.raises(ValueError):
        silhouette_plain(labelled, "id", ["x0", "x1"], "label", max_rows=10)
