import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontaminate import plain_words

from termloom.llm import ranked_search as rs
from termloom.llm.queries import op11_ranked_search

SF_DIR = "/root/testdata/sf0.001"


def plain_search(docs, items, keep=50):
    """``(item, rank, doc, score)`` of ``(doc, text)`` and ``(item, text)`` rows, in whole numbers."""
    counted = [(d, Counter(plain_words(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_words(text))
    out = []
    for item, words in wanted.items():
        scored = []
        for doc, count in counted:
            m = 50 + (50 * sum(count.values()) * n_docs) // terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * count[w]) // (1000 * count[w] + 20 * m))
                for w in words & count.keys()
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, n, doc, -s) for n, (s, _, _, doc) in enumerate(sorted(scored)[:keep], 1)]
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{t}.parquet").collect()] for t in ("documents", "benchmark"))
    got = sorted(map(tuple, op11_ranked_search(spark, SF_DIR).collect()), key=str)
    assert got == plain_search([d[:2] for d in docs], items)


@pytest.mark.parametrize("item_bytes", [1 << 20, 60])
def test_odd_rows(spark, monkeypatch, item_bytes):
    monkeypatch.setattr(rs, "_ITEM_BYTES", item_bytes)
    rng = random.Random(5)
    words = ["the", "The", "of", "é", "x1", "ßA", "rare", "q"]
    docs = [(i, " ".join(rng.choices(words, [40, 9, 20, 5, 4, 3, 1, 1], k=rng.randrange(1, 30)))) for i in range(200)]
    docs += [(900, None), (901, ""), (902, "... !"), (None, "the rare rare"), (None, "q"), (7, "rare"), (7, "rare"), (903, "of " * 50_000 + "rare")]
    items = [(1, "the of"), (2, "RARE, q; é!"), (2, "x1"), (3, None), (4, "unknown words"), (None, "the q"), (5, ""), (6, "the")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"n": F.lit(1), "item_id": F.lit(2), "score": F.lit("x")})
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumns({"doc_id": F.lit(1), "item": F.lit("y")})
    for keep in (4, 50):
        got = rs.ranked_search(frame, bench, keep=keep)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == plain_search(docs, items, keep)
    if item_bytes > 60:
        assert rs.ranked_search(frame.limit(0), bench).count() == rs.ranked_search(frame, bench.limit(0)).count() == 0


def random_block(rng, documents, terms, pairs):
    matrix = rng.integers(1, 100, (terms, documents)) * (rng.random((terms, documents)) < rng.random((terms, 1)))
    # Pairs that seldom meet, so that joint maxima are below the sums.
    matrix[1, matrix[0] > 0] //= 50
    term, place = np.nonzero(matrix)
    names, counts = np.unique(term, return_counts=True)
    block = rs.Block((names, np.cumsum(counts), place, matrix[term, place].astype(np.int64)), np.zeros(0), documents)
    block.pair_most, floors = rs._pair_lists(block, pairs, 5)
    return matrix, block, floors


def test_blocks_lose_no_document_at_any_floor():
    rng = np.random.default_rng(6)
    skipped = 0
    for _ in range(60):
        pairs = [(0, 1), (2, 3), (1, 4), (0, 4)]
        matrix, block, floors = random_block(rng, 80, 6, pairs)
        for (a, b), floor in zip(pairs, floors, strict=True):
            assert (matrix[a] + matrix[b] >= floor).sum() >= 5
        terms = rng.permutation(7)[: rng.integers(1, 7)]
        at = {t: n for n, t in enumerate(terms.tolist())}
        joint = [(at[a], at[b], n) for n, (a, b) in enumerate(pairs) if a in at and b in at]
        scores = sum((matrix[t] for t in terms if t < 6), np.zeros(80, dtype=np.int64))
        for floor in sorted({1, *scores.tolist(), int(scores.max()) + 1}):
            if not floor:
                continue
            places, found = rs.search_block(block, terms, joint, int(floor))
            assert places.tolist() == np.flatnonzero(scores >= floor).tolist() and (found == scores[places]).all()
            skipped += floor > scores.max()
    assert skipped


def test_pair_bounds_hold_and_are_tighter():
    assert rs.prefix_bounds([5, 7, 10], {(0, 1): 8}) == [0, 5, 8, 18]
    assert rs.prefix_bounds([5, 7, 10], {}) == [0, 5, 12, 22]
    assert rs.prefix_bounds([5, 7], {(0, 1): 0}) == [0, 5, 7]
    rng = np.random.default_rng(7)
    tighter = 0
    for _ in range(50):
        matrix, block, _ = random_block(rng, 50, 5, [(0, 1), (1, 2), (0, 3)])
        most = matrix.max(axis=1).tolist()
        pairs = {(a, b): int(m) for (a, b), m in zip([(0, 1), (1, 2), (0, 3)], block.pair_most, strict=True)}
        bounds = rs.prefix_bounds(most, pairs)
        for n in range(6):
            assert matrix[:n].sum(axis=0).max(initial=0) <= bounds[n] <= sum(most[:n])
        tighter += bounds[5] < sum(most)
    assert tighter > 25
