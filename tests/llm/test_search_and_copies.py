"""Operators 3 and 10 against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldtally.llm import covering_simhash as cs
from fieldtally.llm.components import components
from fieldtally.llm.queries import CORPUS_QUERIES
from fieldtally.llm.voronoi_knn import KnnPlan, top_k

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_top(rows, k=5, every=50):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors.setdefault(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64))
    out = []
    for q, v in vectors.items():
        if q % every == 0:
            def score(w, v=v):
                n = min(len(v), len(w))
                return int(v[:n] @ w[:n])
            best = sorted((-score(w), i) for i, w in vectors.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def clustered(n, seed=1):
    """Well separated clusters, one vector in a third of all rows, and ties."""
    r = np.random.default_rng(seed)
    centers = r.standard_normal((6, 8)) * 3
    rows = [(i, (centers[i % 6] + r.standard_normal(8) * 0.05).astype(np.float32).tolist()) for i in range(n)]
    return [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows]


@pytest.mark.parametrize("plan", [KnnPlan(), KnnPlan(group=3, block=2, packed=7)])
def test_top_k_equals_brute_force(spark, plan):
    rows = clustered(700)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    got = top_k(df, F.col("vec_id") % 10 == 0, plan).collect()
    assert sorted(map(tuple, got)) == brute_top([(i, np.float32(v)) for i, v in rows], every=10)


def test_bounds_prune(spark):
    """Groups in separate clusters get no vectors of most others."""
    from fieldtally.llm.voronoi_knn import Groups, _bounds

    x = np.array([[100, 0], [0, 100], [-100, 0]])
    groups = Groups(np.array([[100, 0]]), np.array([5.0]), np.array([1]))
    middle, reach = _bounds(x, groups)
    assert ((middle + reach) >= (middle - reach)[0]).ravel().tolist() == [True, False, False]


def test_cell_bounds_hold():
    """Every product between a cell and a group lies within the bounds from their summaries."""
    from fieldtally.llm.voronoi_knn import Summaries, _nearest, cell_bounds, sure_scores

    r = np.random.default_rng(4)
    centers = r.integers(-200, 200, (5, 6))
    data, asking = r.integers(-300, 300, (300, 6)), r.integers(-300, 300, (60, 6))

    def summed(v):
        near, d = _nearest(v, centers)
        norm = np.sqrt((v * v).sum(1))
        of = [near == c for c in range(5)]
        return near, Summaries(*(np.array([f(x[m]) for m in of]) for f, x in
                                 ((len, d), (np.min, d), (np.max, d), (np.min, norm), (np.max, norm))))

    (cell, cells), (group, groups) = summed(data), summed(asking)
    low, high = cell_bounds(centers, cells, groups)
    scores = data @ asking.T
    assert (scores >= low[cell][:, group]).all() and (scores <= high[cell][:, group]).all()
    sure = sure_scores(low, cells, 6)
    assert (np.sort(scores, axis=0)[-6] >= sure[group]).all()


def test_cells_meet_few_groups(spark):
    """In separate clusters most pairs of cell and bundle are never sent."""
    from fieldtally.llm.voronoi_knn import Summaries, bundles, cell_bounds, sure_scores

    centers = np.array([[1000, 0], [0, 1000], [-1000, 0], [0, -1000]])
    one = np.ones(4)
    s = Summaries(100 * one, 0 * one, 20 * one, 980 * one, 1020 * one)
    low, high = cell_bounds(centers, s, s)
    assert (high >= sure_scores(low, s, 6)).tolist() == np.eye(4, dtype=bool).tolist()
    bundle, blocks = bundles(np.array([3, 4, 2, 25, 1]), 8)
    assert bundle.tolist() == [0, 0, 1, 2, 3] and blocks.tolist() == [1, 1, 4, 1]


@pytest.mark.parametrize("plan", [KnnPlan(), KnnPlan(group=3, block=4, packed=9)])
def test_ids_with_several_vectors(spark, plan):
    """Every vector of an id asks, and each of a candidate's vectors counts."""
    r = np.random.default_rng(9)
    rows = {(int(i), tuple(map(float, v))) for i, v in zip(r.integers(0, 40, 200), r.integers(-4, 4, (200, 3)), strict=True)}
    rows |= {(10, (5.0, 5.0, float(x))) for x in range(12)}  # its own vectors are all nearest
    df = spark.createDataFrame([(i, list(v), 1) for i, v in rows], VECTORS)
    got = top_k(df.union(df), F.col("vec_id") % 10 == 0, plan).collect()
    wanted = []
    for q in range(0, 40, 10):
        pairs = [(-65536 * int(np.dot(v, w)), j) for i, v in rows if i == q for j, w in rows if j != q]
        wanted += [(q, n + 1, j, -s) for n, (s, j) in enumerate(sorted(pairs)[:5])]
    assert sorted(map(tuple, got)) == wanted


def test_awkward_vectors(spark, at):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (0, [0.5, 0.25]), (50, None), (100, [nan, 1.0]), (150, [inf, 0.0]), (200, [None, 1.0]),
            (1, [1e6, -1e6]), (2, []), (3, [0.5]), (4, [0.5, 0.25]), (5, [0.5, 0.25]), (None, [1.0, 1.0]), (250, [-1e6, 1e6])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).withColumn("q", F.lit("x"))
    got = CORPUS_QUERIES["op3_voronoi_knn"](spark, at(df, "embeddings")).collect()
    assert sorted(map(tuple, got)) == brute_top(rows)


def test_no_vectors(spark, at):
    got = CORPUS_QUERIES["op3_voronoi_knn"](spark, at(spark.createDataFrame([], VECTORS), "embeddings"))
    assert got.count() == 0 and got.columns == ["query_id", "rank", "vec_id", "score"]


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points):
    """Smallest id reachable over links of two bits or fewer."""
    root = {i: i for i in points}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in points:
        for b in points:
            if a < b and (points[a] ^ points[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in points}


@pytest.mark.parametrize("table", ["corpus", "odd", "empty"])
def test_components_of_documents(request, spark, at, table):
    docs = request.getfixturevalue(table)
    got = CORPUS_QUERIES["op10_covering_simhash"](spark, at(docs)).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((str(i), format(plain_fingerprint(t), "016x")) for i, t in texts) == sorted((str(r["doc_id"]), r["fingerprint"]) for r in got)
    wanted = groups({i: plain_fingerprint(t) for i, t in texts if i is not None})
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == wanted


def test_every_close_pair_meets_in_a_table():
    masks = cs.masks(2)
    assert len(masks) == 7
    for a in range(64):
        for b in range(64):
            assert any(not (m >> a & 1 or m >> b & 1) for m in masks)


@pytest.mark.parametrize("size", [5, 400])
def test_links_keep_components(spark, size):
    """Dense neighbourhoods (large buckets), chains, and lone points."""
    r = random.Random(size)
    base = r.getrandbits(64)
    points = {base, r.getrandbits(64)}
    while len(points) < size:
        p = r.choice(sorted(points))
        for _ in range(r.choice([1, 2, 2, 3])):
            p ^= 1 << r.choice(range(0, 64, 3))
        points.add(p)
    points = {i: p for i, p in enumerate(sorted(points))}
    signed = {i: cs._signed(p) for i, p in points.items()}
    nodes = spark.createDataFrame([(p,) for p in signed.values()], "fp long")
    edges = cs.links(nodes)
    assert all((u ^ v).bit_count() <= 2 or ((u ^ v) & (2**64 - 1)).bit_count() <= 2 for u, v in edges.collect())
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    wanted = groups(points)
    mine = {i: roots.get(p, p) for i, p in signed.items()}
    assert len(set(mine.values())) == len(set(wanted.values()))
    assert len({(mine[i], wanted[i]) for i in points}) == len(set(wanted.values()))


def test_links_do_not_grow_with_pairs(spark):
    base = 0x0123456789ABCDEF
    points = {base ^ (1 << a) ^ (1 << b) ^ (1 << c) for a in range(0, 30) for b in range(a) for c in range(0, b, 3)}
    edges = cs.links(spark.createDataFrame([(cs._signed(p),) for p in points], "fp long"))
    assert edges.count() < 80 * len(points)


@pytest.mark.parametrize("n", [1, 2, 30])
def test_long_chains_and_stars(spark, n):
    chain = [(i, i + 1) for i in range(100, 100 + n)]
    star = [(i, 7) for i in range(1000, 1200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame([*chain, *star, (5, 5)], "u long, v long")).collect()}
    assert all(got[i] == 100 for i in range(100, 101 + n))
    assert all(got[i] == 7 for i in range(1000, 1200)) and got[7] == 7


def test_one_of_each_group_stays(odd, empty):
    left = cs.deduplicate(odd)
    assert left.columns == odd.columns
    # ids 2, 3 and 4 have no words and are one group
    assert sorted((str(r["doc_id"]) for r in left.collect())) == ["1", "2", "5", "6", "7", "None"]
    assert cs.deduplicate(empty).count() == 0
