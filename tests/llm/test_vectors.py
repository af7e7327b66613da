import math
import random

import numpy as np

from termloom.llm.queries import op7_vector_duplicates
from termloom.llm.vectors import _PARTNERS, linked_pairs, possible_pairs, quantise, vector_duplicates

SF_DIR = "/root/testdata/sf0.001"


def plain(rows, threshold=0.9):
    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(u, v):
        u, v = ([x / max(map(abs, w)) for x in w] for w in (u, v))
        dot = sum(x * y for x, y in zip(u, v, strict=True))
        return dot / math.sqrt(sum(x * x for x in u)) / math.sqrt(sum(y * y for y in v))

    links = {i: set() for i in range(len(rows))}
    for i, (_, u) in enumerate(rows):
        for j, (_, v) in enumerate(rows[:i]):
            if usable(u) and usable(v) and len(u) == len(v) and (u == v or cosine(u, v) >= threshold):
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, (key, _) in enumerate(rows):
        seen, queue = {i}, [i]
        while queue:
            new = links[queue.pop()] - seen
            seen |= new
            queue += new
        least = min(rows[j][0] for j in seen)
        out.append((key, len(links[i]), least, key == least))
    return sorted(out)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r[0], list(r[1])) for r in table.collect()]
    got = sorted(tuple(r) for r in op7_vector_duplicates(spark, SF_DIR).collect())
    assert got == plain(rows)


def test_small_tiles_odd_vectors_and_copies(spark):
    rng = random.Random(5)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = []
    for i in range(150):
        noise = rng.choice([0.0, 0.05, 0.3])
        rows.append((i, [x + rng.gauss(0, noise) if noise else x for x in rng.choice(base)]))
    odd = [None, [], [0.0] * 8, [None] + [1.0] * 7, [math.nan] + [1.0] * 7, [math.inf] + [1.0] * 7,
           [1.0, 2.0], [2.0, 4.0], [1e-300] * 8, [1e200] * 8, [-0.0] * 8]
    rows += [(200 + i, v) for i, v in enumerate(odd)]
    rows.append(rows[0])
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS copies", "2 AS node")
    for tile_rows in (7, 4096):
        got = sorted(tuple(r) for r in vector_duplicates(frame, tile_rows=tile_rows).collect())
        assert got == plain(rows)
    assert vector_duplicates(frame.limit(0)).count() == 0


def test_bounds_lose_no_pair_near_the_threshold():
    rng = np.random.default_rng(7)
    for dimensions in (3, 64, 1500):
        left = rng.normal(size=(700, dimensions))
        right = left[rng.integers(0, 700, 300)] + rng.normal(size=(300, dimensions)) * 0.48
        left, right = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (left, right))
        got = np.concatenate([linked for _, linked in linked_pairs(left, right, 0.9)])
        cosines = left @ right.T
        clear = np.abs(cosines - 0.9) > 1e-12
        assert ((cosines >= 0.9) == got)[clear].all() and got.any()
        possible = np.concatenate([p for _, p in possible_pairs(quantise(left), quantise(right), 0.9)])
        assert possible[got].all() and possible.sum() < 1.5 * got.sum() + 50


def test_scales_and_losses_are_bounds():
    rng = np.random.default_rng(8)
    unit = rng.standard_t(2, size=(500, 40))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes, scale, lost = quantise(unit)
    assert scale.dtype == lost.dtype == np.float32 and codes.dtype == np.int8
    assert (np.linalg.norm(unit - codes * scale[:, None].astype(float), axis=1) <= lost.astype(float)).all()


def test_every_pair_of_tiles_is_named_once(spark):
    for tiles in (1, 2, 3, 8, 13):
        named = spark.range(tiles).selectExpr("id AS tile", f"{tiles}L AS tiles").selectExpr("tile", f"explode({_PARTNERS}) AS other")
        pairs = [tuple(sorted(r)) for r in named.collect()]
        assert sorted(pairs) == [(a, b) for a in range(tiles) for b in range(a, tiles)]
        assert max(r["count"] for r in named.groupBy("tile").count().collect()) <= tiles // 2 + 1
