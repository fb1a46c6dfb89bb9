"""Hard negatives and integer clusters against brute force."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslake.llm import clusters, negatives
from corpuslake.llm.common import table

COLUMNS = "vec_id long, embedding array<float>, label int, id string, cluster int, rank string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 9, "y", "z") for r in rows], COLUMNS)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 9), st.integers(0, 9), st.integers(0, 9), st.integers(1, 4), st.integers(0, 2**32))
def test_strassen_equals_plain_product(m, k, n, direct, seed):
    random = np.random.default_rng(seed)
    a, b = random.integers(-(2**30), 2**30, (m, k)), random.integers(-(2**30), 2**30, (k, n))
    assert (negatives.strassen(a, b, direct) == a @ b).all()


def test_strassen_of_large_odd_tiles():
    random = np.random.default_rng(4)
    a, b = random.integers(-500, 500, (131, 65)), random.integers(-500, 500, (65, 257))
    assert (negatives.strassen(a, b) == a @ b).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 3), st.integers(0, 9)), max_size=60), st.integers(1, 7))
def test_heaps_merge_in_any_pieces(entries, piece):
    heaps = negatives.Heaps(4, 3)
    for at in range(0, len(entries), piece):
        part = np.array(entries[at : at + piece], np.int64)
        heaps.merge(part[:, 0], part[:, 1], part[:, 2])
    want = [(g, s, i) for g in range(4) for s, i in sorted([(s, i) for e, s, i in entries if e == g], key=lambda x: (-x[0], x[1]))[:3]]
    assert list(zip(heaps.group.tolist(), heaps.score.tolist(), heaps.id.tolist(), strict=True)) == want
    for g in range(4):
        own = [s for e, s, _ in want if e == g]
        assert heaps.floor[g] == (own[2] if len(own) == 3 else np.iinfo(np.int64).min)


def mined(rows):
    """All pairs, in plain Python."""
    taking_part = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        taking_part.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for i, (anchor, a, own) in enumerate(taking_part):
        if anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v, strict=False)), id_, label) for j, (id_, v, label) in enumerate(taking_part) if j != i)
        for p_score, positive, _ in [s for s in scored if s[2] == own][:5]:
            inside = [s for s in scored if s[2] != own and 30 * -p_score <= 100 * -s[0] <= 90 * -p_score]
            out += [(anchor, positive, rank, id_, -p_score, -score) for rank, (score, id_, _) in enumerate(inside[:10], 1)]
    return sorted(out)


def vectors(seed, n, ids=400):
    random = np.random.default_rng(seed)
    return [(int(random.integers(0, ids) if i % 9 else 100 * random.integers(0, 4)), (random.integers(-3, 6, 5) / 16).tolist(), int(random.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("block", [3, 8_192])
def test_hard_negatives_equal_brute_force(spark, block):
    """Ties, equal ids with equal and different rows, other lengths, nulls and values that aren't finite."""
    rows = vectors(1, 150) + vectors(1, 20)
    rows += [(100, [0.5] * 5, 1), (100, [0.5] * 5, 1), (100, [0.5] * 5, 2), (300, [], 1), (301, [], 2), (200, [0.25, 0.5], 0), (201, [0.25] * 7, 0)]
    rows += [(None, [0.5] * 5, 1), (500, None, 1), (600, [0.5] * 5, None), (700, [0.5, None], 1), (800, [float("nan")] * 5, 1), (900, [float("inf")] * 5, 0)]
    got = negatives.mine(frame(spark, rows).repartition(5), block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == mined(rows)


def test_hard_negatives_of_few_rows(spark):
    for rows in ([], [(100, [0.5], 1)], [(101, [0.5], 1), (102, [0.5], 2)], [(100, [0.5], 1), (102, [0.5], 1), (103, [-0.5], 2)]):
        assert negatives.mine(frame(spark, rows)).count() == 0
    with pytest.raises(Exception, match="no exact 64-bit scores"):
        negatives.mine(frame(spark, [(100, [1e30], 1), (101, [1.0], 1)])).count()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(1, 4), st.integers(0, 2**32))
def test_nearest_centroid_equals_all_distances(count, leaf, seed):
    random = np.random.default_rng(seed)
    places, points = random.integers(-2, 3, (count, 3)), random.integers(-3, 4, (50, 3))
    found, squared = clusters.VantageTree(places, leaf).nearest(points)
    every = ((points[:, None] - places[None]) ** 2).sum(2)
    assert (squared == every.min(1)).all() and (found == every.argmin(1)).all()


def test_search_skips_centroids(monkeypatch):
    random = np.random.default_rng(2)
    places = random.integers(-10_000, 10_000, (200, 2))
    tree, tried = clusters.VantageTree(places), []
    monkeypatch.setattr(tree, "centroids", type("Counted", (), {"__getitem__": lambda _, i: (tried.append(i), places[i])[1]})())
    tree.nearest(random.integers(-10_000, 10_000, (1, 2)))
    assert len(tried) < 60


def clustered(rows, count, rounds, components, scale):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, _ in rows if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    places = [v for _, _, v in sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v, v) for i, v in kept if i is not None)[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(places))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        moved = []
        for c, p in enumerate(places):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            moved.append([sum(x) // len(mine) for x in zip(*mine, strict=True)] if mine else p)
        places = moved
    return [(i, *nearest(v)[::-1]) for i, v in kept], places


def test_clusters_equal_brute_force(spark):
    rows = vectors(3, 200) + vectors(3, 40) + [(7, [0.25] * 5, 1)] * 30
    rows += [(None, [0.5] * 5, 1), (500, None, 1), (600, [0.5] * 5, None), (700, [0.5, None, 1.0, 1.0, 1.0], 1), (800, [float("nan")] * 5, 1), (900, [float("-inf")] * 5, 0), (901, [0.5] * 4, 0), (902, [], 0)]
    got, places = clusters.cluster(frame(spark, rows).repartition(5), centroids=9, components=5, scale=64)
    want, at = clustered(rows, 9, 3, 5, 64)
    order = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order) and places.tolist() == at


def test_clusters_of_few_rows(spark):
    for rows, n in (([], 0), ([(1, [0.5] * 64, 1)], 1), ([(1, [0.5] * 64, 1)] * 20, 20), ([(None, [0.5] * 64, 1)], 0), ([(i, [float(i)] * 64, 1) for i in range(3)], 3)):
        got, places = clusters.cluster(frame(spark, rows))
        assert got.count() == n and len(places) <= 16
        assert {r["distance"] for r in got.collect()} <= {0}
    with pytest.raises(Exception, match="no exact 64-bit distances"):
        clusters.cluster(frame(spark, [(1, [1e30] * 64, 1)]))


def test_clusters_of_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, sf, "embeddings").collect()]
    want, places = clustered(rows, 16, 3, 64, 64)
    got = {r["vec_id"]: r for r in clusters.op13_centroids(spark, sf).collect()}
    assert len(got) == len(want)
    for vec_id, own, distance in want:
        r = got[vec_id]
        assert (r["cluster"], r["distance"], r["centroid_sha256"]) == (own, distance, hashlib.sha256(",".join(map(str, places[own])).encode()).hexdigest())
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == own) and r["inertia"] == sum(d for _, _, d in want)
