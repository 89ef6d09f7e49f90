"""Vector codes: against plain k-means in whole numbers, and the trees on their own."""

import brute
import numpy as np
import pytest

from souk.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, id string, code string, trees string, vector string"


def key(row):
    return tuple((v is not None, v) for v in row)


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, vc.compress(frame).collect()), key=key)
    as_read = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]  # components as 32-bit floats
    assert got == sorted(brute.vector_codes(as_read), key=key)
    return got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [float(x) / 7 for x in range(-4, 4)]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.5, None, *[0.0] * 6], 1), (4, [nan] * 8, 1), (5, [inf] * 8, 1),
        (6, [-inf] + [0.0] * 7, 1), (7, good, None), (7, good, None), (7, good[::-1], 2), (8, good, 2),
        (9, [1.0] * 4, 2), (10, [1.0] * 7, 2), (None, good, 3), (None, [-0.0001] * 8, None), (11, [300.0] * 8, 3),
    ]
    got = check(spark, rows)
    assert len(got) == 7
    assert check(spark, []) == []
    assert check(spark, rows[:6]) == []


def test_first_length_decides_among_many_others(spark):
    """More vectors of other lengths than the codebook has entries stand before the kept ones."""
    rows = [(0, [0.25] * 8, 1), *((i, [0.5] * 4, 1) for i in range(1, 300)), *((i, [i / 400] * 8, 1) for i in range(300, 310))]
    assert len(check(spark, rows)) == 11


def test_many_copies_and_clusters(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(30, 8))
    rows = [(i, (centers[i % 30] + rng.normal(size=8) * 0.05).tolist(), int(i % 4)) for i in range(700)]
    rows += [(1000 + i, [0.125] * 8, None) for i in range(300)]
    check(spark, rows)


def test_too_large(spark):
    frame = spark.createDataFrame([(1, [1e9] * 8, 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="beyond"):
        vc.compress(frame).collect()


@pytest.mark.parametrize("kind", ["normal", "clusters", "copies", "line", "large"])
def test_trees_assign_like_brute_force(kind):
    rng = np.random.default_rng(11)
    x = rng.integers(-500, 500, (1500, 6))
    if kind == "clusters":
        x = rng.integers(-500, 500, (12, 6))[rng.integers(0, 12, 1500)] + rng.integers(-4, 5, (1500, 6))
    elif kind == "copies":
        x = np.where(rng.random((1500, 1)) < 0.6, 7, x // 100)
    elif kind == "line":
        x = np.arange(1500)[:, None] * np.ones(6, dtype=np.int64)
    elif kind == "large":
        x = x * (vc.LIMIT // 512)
    tree = vc.tree_of(x, 16)
    assert sorted(tree.order) == list(range(1500)) and (x[tree.order] == tree.points).all()
    for i, (a, b) in enumerate(zip(tree.start, tree.stop, strict=True)):
        assert (tree.sums[i] == tree.points[a:b].sum(axis=0)).all()
        assert np.sqrt(((tree.points[a:b] - tree.center[i]) ** 2).sum(axis=1)).max() <= tree.radius[i] * (1 + 1e-9)
        if tree.left[i] >= 0:
            assert (tree.start[tree.left[i]], tree.stop[tree.left[i]]) == (a, tree.start[tree.right[i]])
            assert tree.stop[tree.right[i]] == b
    book = vc.Codebook(x[rng.integers(0, 1500, 40)])  # some entries are equal
    c = book.entries.astype(object)
    distance = np.array([[int(((p - e) ** 2).sum()) for e in c] for p in x.astype(object)], dtype=object)
    want = [row.tolist().index(min(row)) for row in distance]
    code, error = vc.codes(tree, book)
    assert code.tolist() == want and error.tolist() == [min(row) for row in distance]
    n, sums = vc.entry_sums(tree, book)
    assert n.tolist() == np.bincount(want, minlength=40).tolist()
    assert all((sums[k] == x[code == k].sum(axis=0)).all() for k in range(40))


def test_balls_are_owned_wholly():
    """Where each cluster has its entry, most points are never looked at."""
    rng = np.random.default_rng(11)
    centers = rng.integers(-5000, 5000, (12, 6))
    tree = vc.tree_of(centers[rng.integers(0, 12, 1500)] + rng.integers(-40, 41, (1500, 6)), 16)
    owned, single = vc.assigned(tree, vc.Codebook(centers))
    assert sum(tree.stop[b] - tree.start[b] for b, _ in owned) > 1400
    assert sum(b - a for a, b, _ in single) < 100
