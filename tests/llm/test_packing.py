import random

from pyspark.sql import functions as F

from termloom.llm.packing import BestFit, pack_documents, with_groups, with_sizes
from termloom.llm.queries import op5_simhash, op6_packing

SF_DIR = "/root/testdata/sf0.001"


def check(rows, docs, capacity=2048):
    """Every document has all its pieces, bins hold what they can and no conflict."""
    facts = {d["doc_id"]: d for d in docs}
    assert sorted({r["doc_id"] for r in rows}) == sorted(facts)
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        if r["bin"] is not None:
            bins.setdefault((r["shard"], r["bin"]), []).append(r)
    for doc_id, own in pieces.items():
        size = facts[doc_id]["n_words"] or 0
        assert sum(r["length"] for r in own) == size
        assert sorted(r["piece"] for r in own) == list(range(max(1, -(-size // capacity))))
        assert all((r["bin"] is None) == (size == 0) and r["n_pieces"] == len(own) for r in own)
    for own in bins.values():
        own.sort(key=lambda r: r["start"])
        assert own[0]["start"] == 0 and sum(r["length"] for r in own) <= capacity
        assert all(a["start"] + a["length"] == b["start"] for a, b in zip(own, own[1:]))
        for name in ("source", "cluster"):
            marks = [facts[r["doc_id"]][name] for r in own if facts[r["doc_id"]][name] is not None]
            assert len(set(marks)) == len(marks)
    return bins


def test_query(spark):
    docs = with_sizes(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()
    assert all(d["n_words"] == len((d["text"] or "").split()) for d in docs)
    packed = op6_packing(spark, SF_DIR).collect()
    bins = check(packed, docs)
    # Near-duplicates conflict as well, not only copies of the same words.
    group = {r["doc_id"]: r["component_id"] for r in op5_simhash(spark, SF_DIR).collect()}
    check(packed, [d.asDict() | {"cluster": group[d["doc_id"]]} for d in docs])
    own = {r["doc_id"]: r for r in with_groups(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()}
    assert {d: r["n_words"] for d, r in own.items()} == {d["doc_id"]: d["n_words"] for d in docs}
    by_name = {}
    for d, r in own.items():
        by_name.setdefault(r["cluster"], set()).add(d)
    assert sorted(map(min, by_name.values())) == sorted(set(group.values()))
    assert all(group[d] == min(members) for members in by_name.values() for d in members)
    hottest = max(sum(d["source"] == s for d in docs) for s in {d["source"] for d in docs})
    total = sum(d["n_words"] for d in docs)
    assert max(hottest, total / 2048) <= len(bins) <= 1.3 * max(hottest, total / 2048) + 5


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(4)
    fast, plain = BestFit(100), []
    for _ in range(3000):
        size, source, cluster = rng.randrange(1, 60), 1 << rng.randrange(6), 1 << rng.randrange(40)
        number, start = fast.place(size, source, cluster)
        fits = [(b[0], i) for i, b in enumerate(plain) if b[0] >= size and not b[1] & source and not b[2] & cluster]
        want = min(fits)[1] if fits else len(plain)
        if not fits:
            plain.append([100, 0, 0])
        assert (number, start) == (want, 100 - plain[want][0])
        plain[want] = [plain[want][0] - size, plain[want][1] | source, plain[want][2] | cluster]


def test_shards_hot_sources_and_odd_rows(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(1, 3000), f"s{rng.choice([0, 0, 0, 1, 2, 3, 4])}", f"c{rng.randrange(300)}") for i in range(600)]
    rows += [(700, 0, "s0", "c"), (701, None, None, None), (702, 5, None, None), (703, 5, None, None), (704, 1 << 20, "s0", "z")]
    docs = spark.createDataFrame(rows, "doc_id int, n_words int, source string, cluster string").withColumn("bin", F.lit("x"))
    facts = docs.collect()
    for shard_rows in (50, 8192):
        check(pack_documents(docs, shard_rows=shard_rows).collect(), facts)
    assert pack_documents(docs.limit(0)).count() == 0
    again = docs.where("doc_id = 702").unionByName(docs.where("doc_id = 702"))
    assert sorted(r["start"] for r in pack_documents(again).collect()) == [0, 5]


def test_groups_of_odd_rows(spark):
    same = "one two three four five six seven eight nine ten"
    rows = [(1, same, "a"), (2, same.upper(), "b"), (2, "quite another text altogether it is", "b"), (None, same, None),
            (3, None, "a"), (4, "", "a"), (5, same, "a"), (5, same, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "'x' AS cluster", "1 AS key")
    got = with_groups(docs).collect()
    assert len(got) == len(rows)
    copies = {r["cluster"] for r in got if r["n_words"] == 10}
    assert len(copies) == 1 and len({r["cluster"] for r in got}) == 3
    assert with_groups(docs.limit(0)).count() == 0
    packed = pack_documents(with_groups(docs)).where("bin IS NOT NULL").collect()
    assert len({(r["shard"], r["bin"]) for r in packed if r["length"] == 10}) == 5
