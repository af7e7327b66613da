import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from termloom.llm import simhash
from termloom.llm.components import connected_components
from termloom.llm.queries import op5_simhash

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b) and root(a) != root(b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {n: root(n) for n in nodes}


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    groups = plain_components(texts, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op5_simhash(spark, SF_DIR).collect()}
    assert got == {d: (f"{prints[d]:016x}", groups[d]) for d in texts}
    assert len(set(groups.values())) < len(texts)


def test_links_connect_what_is_close(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(5)]
    values = set(centres)
    for _ in range(400):
        value = rng.choice(centres)
        for _ in range(rng.randrange(5)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    signed = np.array(sorted(values), dtype=np.uint64).view(np.int64).tolist()
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    want = plain_components(signed, near)
    distinct = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for group_rows in (10, 16_384):  # keys dealt out in blocks, and whole
        links = simhash.fingerprint_links(distinct, group_rows=group_rows).collect()
        assert all(near(r["a"], r["b"]) for r in links)
        pairs = {(min(r), max(r)) for r in links}
        assert plain_components(signed, lambda a, b: (a, b) in pairs) == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    rows = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    got = {r["node"]: r["component"] for r in rows}
    assert len(rows) == len(got)
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert connected_components(none).count() == 0


def test_odd_rows(spark):
    long = "x" * 100_000 + " " + "word " * 30_000
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "A\tb"), (4, "A\tb"), (5, long), (6, long)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("own"))
    got = sorted(((r["doc_id"] or 0), r["fp"], r["component_id"]) for r in simhash.simhash_components(docs).collect())
    assert [r[2] for r in got] == [4, 1, 1, 1, 4, 4, 5, 5]
    assert [r[1] for r in got][1:4] == [0, 0, 0]
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 4, 5]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.simhash_components(empty).count() == 0
