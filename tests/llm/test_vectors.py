"""Hard negatives by cover trees, and codes by value dictionaries."""

import math
import random

import numpy as np
import pytest

from assaylake.llm import cover_tree, value_dictionaries, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(x):
    return None if x is None or any(c is None or not math.isfinite(c) for c in x) else [math.floor(256 * c) for c in x]


# ---- op12 -------------------------------------------------------------------


def brute_negatives(rows):
    kept = []
    for i, x, label in rows:
        v = whole(x)
        if i is not None and label is not None and v is not None:
            kept.append((i, v, (label + 1) % 10 if i % 7 == 0 else label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for k, (i, v, label) in enumerate(kept):
        if i % 50:
            continue
        others = sorted((-dot(v, w), j, l) for m, (j, w, l) in enumerate(kept) if m != k)
        for p, pid, _ in [o for o in others if o[2] == label][:5]:
            fit = [o for o in others if o[2] != label and 50 * -p <= 100 * -o[0] <= 95 * -p][:3]
            out += [(i, pid, r + 1, nid, -p, -n) for r, (n, nid, _) in enumerate(fit)]
    return sorted(out)


def got_negatives(df):
    return sorted(tuple(r) for r in cover_tree.mine(df).collect())


def clustered(n, dims, seed):
    """Vectors of uneven lengths around some centres, one of them a hot point."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + 0.05 * rng.normal(size=(n, dims))
    x *= rng.choice([0.5, 1, 2], (n, 1))
    x[rng.random(n) < 0.3] = centres[0]
    return [(int(i), x[i].astype(np.float32).tolist(), int(rng.integers(0, 10))) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_negatives_against_brute_force(spark, monkeypatch, small):
    rows = clustered(700, 6, 1)
    if small:  # many cells, chunks, blocks and levels
        for name, value in (("CHUNK_ROWS", 40), ("BLOCK_ROWS", 5), ("LEAF_ROWS", 4), ("MOST_CELLS", 8), ("_AT_ONCE", 16)):
            monkeypatch.setattr(cover_tree, name, value)
    assert got_negatives(spark.createDataFrame(rows, SCHEMA)) == brute_negatives(rows)


def test_bounds_hold(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-300, 300, (400, 8)) * rng.choice([1, 3], (400, 1))
    q = rng.integers(-300, 300, (50, 8))
    most = float((x * x).sum(1).max())
    points = cover_tree.augmented(x, most)
    centres, radii, inside = points[:20], [], []
    for c in centres:
        away = np.sqrt(((points - c) ** 2).sum(1))
        near = np.argsort(away)[:30]
        inside.append(near)
        radii.append(away[near].max())
    low, high = cover_tree.bounds(q, most, centres, np.array(radii))
    for k, rows in enumerate(inside):
        scores = q @ x[rows].T
        assert (low[:, k] <= scores.min(1)).all() and (scores.max(1) <= high[:, k]).all()


def test_covering_radii_halve():
    rows = clustered(2000, 5, 3)
    points = cover_tree.augmented(np.array([whole(x) for _, x, _ in rows]), 1e7)
    root = cover_tree.build(points)

    def under(node):
        found = node.rows if node.rows is not None else np.concatenate([under(c) for c in node.children])
        assert (np.sqrt(((points[found] - node.centre) ** 2).sum(1)) <= node.radius + 1e-6).all()
        for c in node.children:
            assert c.radius <= node.radius / 2 or c.rows is not None
        return found

    assert sorted(under(root)) == list(range(2000)) and root.children


def test_clusters_are_skipped():
    rows = clustered(4000, 6, 4)
    v = np.array([whole(x) for _, x, _ in rows])
    label = np.array([r[2] for r in rows])
    most = float((v * v).sum(1).max())
    uid = np.arange(len(v))
    asked = np.arange(0, 4000, 50)
    best = cover_tree.Best(np.full((80, 1), -(10**15)), np.full((80, 1), 10**15), 5)
    root = cover_tree.build(cover_tree.augmented(v, most))
    verified = cover_tree.descend(root, v, uid, label, most, v[asked], asked, label[asked], best, same=True)
    assert verified < 0.7 * 80 * 4000  # the hot point alone is 0.3 of all
    for k, a in enumerate(asked):
        s = v @ v[a]
        order = sorted((-s[j], j) for j in range(4000) if j != a and label[j] == label[a])[:5]
        assert [(-int(x), int(j)) for x, j in zip(best.score[k, 0], best.place[k, 0], strict=True)] == [
            (int(x), int(j)) for x, j in order]


def test_negatives_of_odd_rows(spark):
    rng = random.Random(4)
    unit = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    same = unit()
    rows = [(50 * k, same if k % 2 else unit(), k % 3) for k in range(8)]
    rows += [(k, same, 0) for k in range(1, 40)] + [(k, unit(), rng.randrange(4)) for k in range(40, 90) if k % 50]
    rows += [(100, same, 1), (100, same, 1), (101, [], 2), (102, [0.5], 1), (7, [9.0] * 4, 9)]
    rows += [(None, same, 1), (103, None, 1), (104, [1.0, None, 0.0, 0.0], 1), (105, [float("nan")] * 4, 1),
             (106, [float("-inf")] + [0.0] * 3, 1), (107, same, None), (350, [0.0] * 4, 2)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as uid", "'x' as v", "2 as cell", "3 as rank", "4 as w")
    assert got_negatives(df) == brute_negatives(rows)
    assert cover_tree.mine(df.limit(0)).collect() == []
    assert cover_tree.mine(df.filter("vec_id = 103")).collect() == []
    alone = spark.createDataFrame([(50, same, 1), (51, same, 2)], SCHEMA)  # no positive
    assert cover_tree.mine(alone).collect() == []


def test_negatives_of_huge_components(spark):
    rows = [(50, [1e30, 1.0], 1), (1, [1e30, 2.0], 1), (2, [-1e30, 2.0], 2), (3, [1e9, 3.0], 1), (4, [9e5, 1.0], 2)]
    got = cover_tree.mine(spark.createDataFrame(rows, SCHEMA)).collect()  # scores are cut off
    assert {r["anchor_id"] for r in got} <= {50}


# ---- op13 -------------------------------------------------------------------


def brute_codes(rows, parts=16):
    kept = [(i, whole(x), label) for i, x, label in rows if whole(x) is not None]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in start] for p in range(parts)]
    square = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    near = lambda v, p: min((square(cut(v, p), y), e) for e, y in enumerate(books[p]))
    for _ in range(2):
        chosen = [[near(v, p)[1] for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), c in zip(kept, chosen, strict=True) if c[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out, errors = [], {}
    for i, v, label in kept:
        found = [near(v, p) for p in range(parts)]
        error = sum(d for d, _ in found)
        errors[label] = errors.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    sha = value_dictionaries.books_sha256(np.array(books))
    return sorted(((i, c, e, errors[label], sha) for i, c, e, label in out), key=repr)


def got_codes(df):
    return sorted((tuple(r) for r in value_dictionaries.compress(df).collect()), key=repr)


@pytest.mark.parametrize("block", [8192, 30])
def test_codes_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(value_dictionaries, "BLOCK_ROWS", block)
    rows = clustered(300, 32, 5)
    assert got_codes(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute_codes(rows)


def test_codes_of_odd_rows(spark):
    rng = random.Random(6)
    vec = lambda n: [float(np.float32(rng.uniform(-1, 1))) for _ in range(n)]
    hot = vec(16)
    rows = [(k, hot, 1) for k in range(30)] + [(k, vec(16), None) for k in range(30, 60)]
    rows += [(5, vec(16), 2), (5, vec(16), 2), (None, vec(16), 3), (None, hot, None), (70, [], 1), (71, vec(20), 4)]
    rows += [(80, None, 1), (81, [None] * 16, 1), (82, [float("inf")] * 16, 1), (83, [float("nan")] * 16, 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as v", "'x' as code", "2 as error", "3 as __label")
    assert got_codes(df) == brute_codes(rows)
    assert value_dictionaries.compress(df.limit(0)).collect() == []
    assert got_codes(df.filter("vec_id = 70")) == brute_codes([(70, [], 1)])  # one empty vector


def test_codes_of_huge_components(spark):
    rows = [(k, [float(np.float32(10.0**k)), float(np.float32(-1e12))] + [0.5] * 14, k % 2) for k in range(3, 13)]
    assert got_codes(spark.createDataFrame(rows, SCHEMA)) == brute_codes(rows)
    far = [(k, [3e38 if k % 65 else -3e38] * 16, 1) for k in range(70)]
    got = value_dictionaries.compress(spark.createDataFrame(far, SCHEMA)).collect()
    assert len(got) == 70 and all(r["error"] >= 0 for r in got)


def test_decoded_vectors_have_the_error(spark):
    rows = clustered(200, 32, 7)
    kept = vectors.integer_vectors(spark.createDataFrame(rows, SCHEMA))
    books = value_dictionaries.trained_books(kept, 2)
    coded = value_dictionaries.encode(kept, books)
    near = {r["vec_id"]: r["approximate"] for r in value_dictionaries.decode(coded, books).collect()}
    for r in coded.collect():
        v = whole(rows[r["vec_id"]][1])
        assert sum((a - b) ** 2 for a, b in zip(v, near[r["vec_id"]], strict=True)) == r["error"]


def test_many_labels_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(value_dictionaries, "MOST_LABELS", 0)
    rows = [(i, x, i % 7 or None) for i, x, _ in clustered(100, 16, 8)]
    assert got_codes(spark.createDataFrame(rows, SCHEMA)) == brute_codes(rows)
