import hashlib
import zlib

from pyspark.sql import functions as F

from termloom.llm.manifest import digest_of, fold_proof, fold_proofs, merkle_proofs
from termloom.llm.queries import op13_manifest

SF_DIR = "/root/testdata/sf0.001"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_ways(leaves):
    """The root of a list of digests, and the siblings of each of them from below."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        runs = [level[i : i + 2] for i in range(0, len(level), 2)]
        for n, place in enumerate(at):
            ways[n] += [d for i, d in enumerate(runs[place // 2]) if i != place % 2]
            at[n] = place // 2
        level = [sha(*run) for run in runs]
    return level[0], ways


def plain_manifest(rows):
    """``(tree, order, leaf)`` rows to ``(subroot, root, siblings)`` by row, in order of rows."""
    trees = {}
    for n, (tree, order, leaf) in enumerate(rows):
        trees.setdefault(tree, []).append(((order is not None, order or 0, leaf), n))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    below = {t: plain_ways([key[2] for key, _ in sorted(trees[t])]) for t in names}
    root, above = plain_ways([below[t][0] for t in names])
    out = [None] * len(rows)
    for t, top in zip(names, above, strict=True):
        for (_, n), way in zip(sorted(trees[t]), below[t][1], strict=True):
            out[n] = (below[t][0], root, "".join(way + top))
    return out


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    leaves = [plain_leaf(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs]
    want = plain_manifest([(r["lang"], r["doc_id"], leaf) for r, leaf in zip(docs, leaves, strict=True)])
    got = {r["doc_id"]: r for r in op13_manifest(spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for r, leaf, (subroot, root, way) in zip(docs, leaves, want, strict=True):
        own = got[r["doc_id"]]
        assert (own["leaf"], own["subroot"], own["root"], own["proof_sha256"]) == (leaf, subroot, root, sha(way))
        touched = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        assert own["verified"] == (not touched) == (own["folded_root"] == root)


def test_odd_rows_and_trees_of_any_size(spark):
    rows = [(t, i, f"text {i}") for t, n in (("big", 2500), ("one", 1), ("two", 2), ("", 3), (None, 5), ("é", 7)) for i in range(n)]
    rows += [("big", None, None), ("big", None, None), ("big", 7, "other"), ("big", 7, "text 7"), (None, None, "")]
    rows += [(f"small {i}", i, "x") for i in range(40)]
    # Columns that the operator itself makes are replaced, others of any name pass through.
    frame = spark.createDataFrame(rows, "lang string, doc_id bigint, text string").withColumns(
        {"row": F.lit(1), "tree": F.lit("own"), "level": F.lit(2), "siblings": F.lit("mine"), "order": F.lit(3)}
    )
    leaves = frame.withColumn("leaf", digest_of(F.col("doc_id"), F.col("text")))
    out = fold_proofs(merkle_proofs(leaves))
    assert set(frame.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    got = sorted(
        ((r["lang"], r["doc_id"], r["leaf"], r["subroot"], r["root"], bytes(r["siblings"]).hex()) for r in out.collect()), key=str
    )
    keyed = [(t, i, plain_leaf(i, x)) for t, i, x in rows]
    assert got == sorted((k + w for k, w in zip(keyed, plain_manifest(keyed), strict=True)), key=str)
    assert out.where("folded_root <> root OR folded_root IS NULL OR row <> 1 OR tree <> 'own'").isEmpty()
    for empty in (frame.limit(0), frame.where("lang = 'one'")):
        few = merkle_proofs(empty.withColumn("leaf", digest_of(F.col("text"))))
        assert few.count() == empty.count() and few.where("root <> leaf OR siblings <> X''").isEmpty()


def test_digests_tell_nulls_lengths_and_bytes(spark):
    rows = [(None, "é"), ("", None), ("a", "bc"), ("ab", "c"), ("x" * 100_000, "-")]
    frame = spark.createDataFrame(rows, "a string, b string").select("a", "b", digest_of(F.col("a"), F.col("b")).alias("d"))
    assert [r["d"] for r in frame.collect()] == [plain_leaf(*r) for r in rows]


def test_a_changed_leaf_place_or_sibling_gives_another_root():
    for size in (1, 2, 3, 6, 11):
        leaves = [sha(str(i)) for i in range(size)]
        root, ways = plain_ways(leaves)
        for place, way in enumerate(ways):
            siblings = bytes.fromhex("".join(way))
            assert fold_proof(leaves[place], place, size, siblings + b"rest") == (root, b"rest")
            assert fold_proof(sha("other"), place, size, siblings)[0] != root
            if siblings:
                assert fold_proof(leaves[place], place, size, siblings[:-1] + bytes([siblings[-1] ^ 1]))[0] != root
