import numpy as np
from pyspark.sql import functions as F

from termloom.llm import neighbours
from termloom.llm.neighbours import Forest, nearest_neighbours
from termloom.llm.queries import op12_neighbours

SF_DIR = "/root/testdata/sf0.1"
SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, asks, keep):
    """Nearest others by brute force over distinct (id, vector) pairs."""
    usable = [(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    usable = sorted(set((i, tuple(x + 0.0 for x in v)) for i, v in usable))
    out = []
    for i, v in usable:
        if asks(i):
            others = [(-(np.array(v) * np.array(w)).sum(), j) for j, w in usable if (j, w) != (i, v) and len(v) == len(w)]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(sorted(others)[:keep], 1)]
    return sorted(out)


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], dtype=np.float64)
    of = {i: v for i, v in zip(ids.tolist(), vectors, strict=True)}
    got = {}
    for r in op12_neighbours(spark, SF_DIR).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in of if i % 20 == 0}
    found = 0
    for query, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert [(-s, j) for _, j, s in rows] == sorted((-s, j) for _, j, s in rows)
        assert all(j != query and abs(s - of[query] @ of[j]) < 1e-12 for _, j, s in rows)
        scores = vectors @ of[query]
        scores[ids == query] = -np.inf
        found += len({j for _, j, _ in rows} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert found >= 0.9 * 20 * len(got)


def test_odd_rows_are_exact_where_a_leaf_holds_all(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 3).astype(float).tolist()) for i in range(60)]  # many ties and copies
    rows += [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 2.0]), (104, [1.0, float("nan"), 2.0])]
    rows += [(105, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (20, rows[20][1]), (40, [5.0, -0.0, 0.0]), (106, [5.0, 0.0, 0.0])]
    rows += [(120, [1.0, 2.0]), (121, [2.0, 1.0]), (140, [1.0])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"class": F.lit("own"), "tile": F.lit(1), "score": F.lit(2.0)})
    for keep in (3, 20):
        got = nearest_neighbours(frame, F.col("vec_id") % 20 == 0, keep=keep)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % 20 == 0, keep)
    assert nearest_neighbours(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest_neighbours(frame, F.lit(False)).count() == 0


def test_copies_beyond_any_leaf(spark):
    rng = np.random.default_rng(2)
    other = rng.normal(size=(1500, 4))
    rows = [(i, [1.0, 1.0, 0.5, 0.25] if i % 3 else other[i].tolist()) for i in range(1500)]
    got = sorted(map(tuple, nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, recall=1.0).collect()))
    want = plain(rows, lambda i: i % 100 == 0, 20)
    # Copies are equal neighbours, so every rank has its score.
    same = [g[:2] == w[:2] and abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, want, strict=True)]
    assert np.mean(same) > 0.9
    hot = [(g, w) for g, w in zip(got, want, strict=True) if g[0] % 3]
    assert hot and all(g == w for g, w in hot)


def test_a_search_takes_leaves_by_distance_and_has_enough_rows():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(2000, 6))
    longest = np.linalg.norm(points, axis=1).max()
    forest = Forest.fit(points, 20_000, longest, trees=3)
    assert forest.depth == 6
    leaves = forest.route(points)
    everything = list(forest.search(points[:20], 10**9))
    for own, found in zip(leaves, everything, strict=False):
        assert len(set(found)) == len(found) == 3 * 64
        first = forest.search(points[:1], 3)
        assert set(found[:3]) <= {(t, leaf) for t in range(3) for leaf in range(64)} and len(next(first)) == 3
    # A query of a vector of full length starts in its own leaves.
    longest_one = int(np.argmax(np.linalg.norm(points, axis=1)))
    own = next(forest.search(points[longest_one : longest_one + 1], 3))
    assert set(own) == set(enumerate(leaves[longest_one].tolist()))
    held = np.zeros((3, 64), dtype=np.int64)
    held[0, 5] = 30
    (enough,) = forest.search(points[:1], 1, held, 21)
    assert enough[-1] == (0, 5)


def test_best_products_keep_ties_in_order():
    rng = np.random.default_rng(4)
    queries, vectors = rng.integers(-1, 2, (30, 4)).astype(float), rng.integers(-1, 2, (200, 4)).astype(float)
    least = rng.permutation(200)
    i, j, scores = neighbours._best_products(queries, vectors, least, 7)
    for q in range(30):
        want = sorted((-(queries[q] @ v), n) for v, n in zip(vectors, least, strict=True))[:7]
        assert [(-s, n) for s, n in zip(scores[i == q], least[j[i == q]], strict=True)] == want
