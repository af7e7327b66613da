"""Nearest neighbours by a forest of random-projection trees and exact reranking."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termloom.llm.staging import Stage, stage
from termloom.operators.joins import same_value

#: Vectors that a tree's leaf should hold, and sampled vectors that a split needs for its median.
_LEAF, _FEWEST = 256, 8
#: Bytes of the sample that a forest is fitted on, and of its hyperplanes, at most.
_SAMPLE_BYTES, _FOREST_BYTES = 16 << 20, 32 << 20
#: Bytes of rows, and queries, of one piece of work, and queries whose searches share a product.
_TILE_BYTES, _QUERIES, _BATCH = 16 << 20, 2048, 64
#: Queries on which the recall of a number of visits is measured.
_MEASURED = 128


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of one length, so that the largest inner product is the smallest distance."""
    scaled = vectors / longest
    missing = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
    return np.column_stack([scaled, missing])


def _lifted_queries(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    return np.column_stack([unit, np.zeros(len(unit))])


@dataclass(frozen=True)
class Forest:
    """Complete binary trees of random hyperplanes, each cut at the median of a sample.

    ``normals`` is (trees, nodes, dimensions + 1) and ``cuts`` (trees, nodes), nodes as in a heap
    with the root at 0; leaves are numbered from 0 in every tree.
    """

    normals: np.ndarray
    cuts: np.ndarray
    depth: int
    longest: float

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, longest: float, trees: int, seed: int = 0) -> Forest:
        """Trees as deep as ``rows`` vectors, the sample and the bound of bytes allow."""
        points = _lifted(sample, longest) if len(sample) else sample
        width = points.shape[1] if len(sample) else 1
        wanted = min(rows / _LEAF, len(sample) / _FEWEST, _FOREST_BYTES / (4 * trees * width))
        depth = max(0, int(np.floor(np.log2(wanted)))) if wanted > 1 else 0
        rng = np.random.default_rng(seed)
        normals = rng.normal(size=(trees, 2**depth - 1, width)).astype(np.float32)
        normals /= np.linalg.norm(normals, axis=2, keepdims=True)
        cuts = np.zeros((trees, 2**depth - 1))
        for tree in range(trees):
            groups = [np.arange(len(points))]
            for node in range(2**depth - 1):
                own = groups[node]
                along = points[own] @ normals[tree, node]
                cuts[tree, node] = np.median(along) if len(own) else 0.0
                above = along > cuts[tree, node]
                groups += [own[~above], own[above]]
                groups[node] = own[:0]
        return cls(normals, cuts, depth, longest)

    @property
    def leaves(self) -> int:
        return 2**self.depth

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree, as (vectors, trees)."""
        points = _lifted(vectors, self.longest)
        out = np.zeros((len(points), len(self.normals)), dtype=np.int32)
        for tree, (normals, cuts) in enumerate(zip(self.normals, self.cuts, strict=True)):
            node = np.zeros(len(points), dtype=np.int64)
            for _ in range(self.depth):
                along = np.einsum("ij,ij->i", points, normals[node])
                node = 2 * node + 1 + (along > cuts[node])
            out[:, tree] = node - (self.leaves - 1)
        return out

    def search(self, queries: np.ndarray, visits: int, held: np.ndarray | None = None, least: int = 0) -> Iterator[list[tuple[int, int]]]:
        """For each query the first ``visits`` leaves, as (tree, leaf), in the order of a priority
        queue that all trees share: by the squared distances to the hyperplanes crossed. More if
        they do not hold ``least`` rows by ``held``, the rows of each tree's leaves."""
        points = _lifted_queries(queries)
        trees, nodes = self.cuts.shape
        for at in range(0, len(points), _BATCH):
            part = points[at : at + _BATCH]
            away = np.einsum("qd,tnd->qtn", part, self.normals, optimize=True) - self.cuts if nodes else np.zeros((len(part), trees, 0))
            for own in away:
                yield self._leaves_of(own, visits, held, least)

    def _leaves_of(self, away: np.ndarray, visits: int, held: np.ndarray | None, least: int) -> list[tuple[int, int]]:
        inner = self.leaves - 1
        queue = [(0.0, tree, 0) for tree in range(len(self.normals))]
        found: list[tuple[int, int]] = []
        seen = np.zeros(len(self.normals), dtype=np.int64)
        # Trees hold the same rows, so only those of one tree are surely distinct.
        while queue and (len(found) < visits or seen.max() < least):
            crossed, tree, node = heapq.heappop(queue)
            while node < inner:
                distance = float(away[tree, node])
                near = 2 * node + 1 + (distance > 0)
                far = 4 * node + 3 - near
                heapq.heappush(queue, (crossed + distance * distance, tree, far))
                node = near
            found.append((tree, node - inner))
            if held is not None:
                seen[tree] += held[tree, node - inner]
        return found


def _doubles(column: pa.Array | pd.Series, kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(v, kind) for v in column]).astype(np.float64)


def exact_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products row by row, whatever rows stand beside them."""
    return (queries * vectors).sum(axis=1)


def _best(rows: np.ndarray, scores: np.ndarray, least: np.ndarray, keep: int) -> np.ndarray:
    """The places of the ``keep`` best entries of each row, equal scores by ``least``."""
    order = np.lexsort((least, -scores, rows))
    ranked = rows[order]
    starts = np.r_[0, np.flatnonzero(np.diff(ranked)) + 1]
    rank = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.r_[starts, len(ranked)]))
    return order[rank < keep]


def _best_products(queries: np.ndarray, vectors: np.ndarray, least: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of the ``keep`` best vectors of every query, exact and with ties in order."""
    products = queries @ vectors.T
    if len(vectors) > keep:
        floor = -np.partition(-products, keep - 1, axis=1)[:, keep - 1 : keep]
        # Blocked products may differ from those of single rows in the last digits.
        slack = 1e-12 * np.outer(np.linalg.norm(queries, axis=1), [np.linalg.norm(vectors, axis=1).max()])
        i, j = np.nonzero(~(products < floor - slack))
    else:
        i, j = np.nonzero(np.ones_like(products, dtype=bool))
    scores = exact_products(queries[i], vectors[j])
    top = _best(i, scores, least[j], keep)
    return i[top], j[top], scores[top]


_FOUND = "query binary, class binary, least bigint, score double"


def _compare(keep: int, kind: str):
    """The best classes of each query among the rows of the leaves that it visits in a tile."""

    def run(rows: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(probes):
            return pd.DataFrame({"query": [], "class": [], "least": [], "score": []})
        rows = rows.sort_values("leaf", kind="stable")
        leaf, least = rows["leaf"].to_numpy(), rows["least"].to_numpy()
        vectors, queries = _doubles(rows["vector"], kind), _doubles(probes["vector"], kind)
        visited = probes["leaves"].to_list()
        of_query = np.repeat(np.arange(len(visited)), [len(v) for v in visited])
        visited = np.concatenate(visited)
        order = np.argsort(visited, kind="stable")
        of_query, visited = of_query[order], visited[order]
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for own in np.unique(leaf):
            low, high = np.searchsorted(leaf, (own, own + 1))
            asking = of_query[slice(*np.searchsorted(visited, (own, own + 1)))]
            for at in range(0, len(asking), 256):
                some = asking[at : at + 256]
                i, j, scores = _best_products(queries[some], vectors[low:high], least[low:high], keep)
                parts.append((some[i], j + low, scores))
        i, j, scores = (np.concatenate(p) for p in zip(*parts, strict=True))
        top = _best(i, scores, least[j], keep)
        i, j, scores = i[top], j[top], scores[top]
        names = rows["class"].to_numpy()
        return pd.DataFrame({"query": probes["query"].to_numpy()[i], "class": names[j], "least": least[j], "score": scores})

    return run


def _ranked(rows: DataFrame, by: str, keep: int, *order: Column) -> DataFrame:
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.where(F.col("place") <= keep)


def _nearest_classes(classes: DataFrame, kind: str, dimensions: int, keep: int, trees: int, recall: float) -> DataFrame:
    """``(query, class, least, score)``: the ``keep`` best classes found for each class that asks."""
    spark = classes.sparkSession
    context = spark.sparkContext

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _doubles(batch.column(0).to_pylist(), kind) if batch.num_rows else np.zeros((0, 1))
            scale = np.abs(own).max(initial=0.0)
            longest = scale * np.sqrt(((own / scale) ** 2).sum(axis=1).max()) if scale else 0.0
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([float(longest)])], ["n", "longest"])

    sizes = classes.select("vector").mapInArrow(lengths, "n bigint, longest double").agg(F.sum("n"), F.max("longest")).first()
    total, longest = sizes[0] or 0, sizes[1] or 1.0
    hashed = F.pmod(F.xxhash64("class"), F.lit(1 << 40))
    wanted = max(1, _SAMPLE_BYTES // (8 * dimensions))
    # So many rows on average; the classes are hashed evenly.
    share = min(1.0, wanted / max(1, total))
    sample = classes.where(hashed <= int(share * (1 << 40))).select(F.xxhash64("class").alias("h"), "class", "vector").collect()
    sample = [r["vector"] for r in sorted(sample, key=lambda r: (r["h"], bytes(r["class"])))]
    forest = Forest.fit(_doubles(sample, kind) if sample else np.zeros((0, dimensions)), total, longest, trees)
    shared = context.broadcast(forest)  # bounded by _FOREST_BYTES

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                leaves = shared.value.route(_doubles(part.column(2).to_pylist(), kind))
                yield pa.record_batch([*part.columns, pa.array(list(leaves), pa.list_(pa.int32()))], [*part.schema.names, "leaves"])

    narrow = classes.select("class", "least", "vector")
    index = Stage(narrow.mapInArrow(routed, "class binary, least bigint, vector binary, leaves array<int>"))
    asks = classes.where("asks").select(F.col("class").alias("query"), "vector")
    visits = _visits_for(index.df, asks, forest, kind, keep - 1, recall)

    # Neighbouring leaves of a tree go into one tile; a leaf with too many rows into several.
    in_leaf = index.df.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count()
    counts = np.zeros((trees, forest.leaves), dtype=np.int64)
    for r in in_leaf.collect():  # as many as the forest has leaves
        counts[r["tree"], r["leaf"]] = r["count"]
    tile_rows = max(256, _TILE_BYTES // (8 * dimensions))
    tile = np.zeros_like(counts)
    pieces = np.maximum(1, -(-counts // tile_rows))
    tiles = 0
    for tree in range(trees):
        held = 0
        for leaf in range(forest.leaves):
            if held and held + counts[tree, leaf] > tile_rows:
                tiles, held = tiles + 1, 0
            tile[tree, leaf] = tiles
            if pieces[tree, leaf] > 1:
                tiles += pieces[tree, leaf]
            else:
                held += counts[tree, leaf]
        tiles += 1 if held else 0
    where = context.broadcast((tile, pieces, counts))

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, pieces, counts = where.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                queries = _doubles(part.column(1).to_pylist(), kind)
                row, goal, leaves = [], [], []
                for i, found in enumerate(shared.value.search(queries, visits, counts, keep)):
                    by_tile: dict[int, list[int]] = {}
                    for tree, leaf in found:
                        for piece in range(pieces[tree, leaf]):
                            by_tile.setdefault(int(tile[tree, leaf]) + piece, []).append(leaf)
                    row += [i] * len(by_tile)
                    goal += by_tile.keys()
                    leaves += by_tile.values()
                yield pa.record_batch(
                    [part.column(c).take(pa.array(row)) for c in (0, 1)] + [pa.array(goal, pa.int64()), pa.array(leaves, pa.list_(pa.int32()))],
                    ["query", "vector", "tile", "leaves"],
                )

    probes = Stage(asks.mapInArrow(probing, "query binary, vector binary, tile bigint, leaves array<int>"))
    # Many queries of one tile are dealt into blocks, and the tile's rows copied to each.
    blocks = probes.df.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / _QUERIES).alias("blocks"))
    blocks = F.broadcast(blocks.select(F.col("tile").alias("of"), "blocks"))  # one row a tile
    dealt = probes.df.join(blocks, F.col("tile") == F.col("of")).select(
        "query", "vector", "tile", "leaves", F.pmod(F.xxhash64("query"), F.col("blocks")).alias("block")
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, pieces, _ = where.value
        for batch in batches:
            leaves = np.array(batch.column(4).to_pylist(), dtype=np.int64).reshape(batch.num_rows, -1)
            hashed = batch.column(3).to_numpy()
            for tree in range(leaves.shape[1]):
                own = leaves[:, tree]
                goal = tile[tree, own] + hashed % pieces[tree, own]
                yield pa.record_batch([*(batch.column(c) for c in range(3)), pa.array(own.astype(np.int32)), pa.array(goal)], ["class", "least", "vector", "leaf", "tile"])

    rows = index.df.select("class", "least", "vector", F.pmod(F.xxhash64("class"), F.lit(1 << 30)).alias("h"), "leaves")
    rows = rows.mapInArrow(placed, "class binary, least bigint, vector binary, leaf int, tile bigint")
    rows = rows.join(blocks, F.col("tile") == F.col("of"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).drop("of", "blocks")
    found = rows.groupBy("tile", "block").cogroup(dealt.groupBy("tile", "block")).applyInPandas(_compare(keep, kind), _FOUND)
    found = Stage(found)
    index.drop()
    probes.drop()
    # Several trees find the same vector.
    once = found.df.repartition("query").dropDuplicates(["query", "class"])
    return _ranked(once, "query", keep, F.desc("score"), F.asc("least")).drop("place")


def _visits_for(index: DataFrame, asks: DataFrame, forest: Forest, kind: str, keep: int, recall: float) -> int:
    """The fewest leaves at which sampled queries find ``recall`` of their true neighbours.

    The queries are those with the smallest hashes; their true neighbours come from products with
    all rows, in tasks.
    """
    measured = asks.orderBy(F.xxhash64("query"), "query").limit(_MEASURED).collect()
    if not measured:
        return 1
    names, queries = [bytes(r["query"]) for r in measured], _doubles([r["vector"] for r in measured], kind)
    shared = index.sparkSession.sparkContext.broadcast((names, queries))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries = shared.value
        best = pa.table({"query": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "least": pa.array([], pa.int64()), "leaves": pa.array([], pa.list_(pa.int32()))})
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                own = part.column(0).to_pylist()
                vectors = _doubles(part.column(2).to_pylist(), kind)
                i, j, scores = _best_products(queries, vectors, part.column(1).to_numpy(), keep + 1)
                other = np.array([names[a] != own[b] for a, b in zip(i, j, strict=True)], dtype=bool)
                i, j, scores = i[other], pa.array(j[other]), scores[other]
                columns = [pa.array(i), pa.array(scores), part.column(1).take(j), part.column(3).take(j)]
                best = pa.concat_tables([best, pa.table(columns, best.schema.names).cast(best.schema)]).combine_chunks()
                best = best.take(_best(*(best.column(c).to_numpy() for c in ("query", "score", "least")), keep))
        yield from best.combine_chunks().to_batches()

    near = index.mapInArrow(exact, "query bigint, score double, least bigint, leaves array<int>")
    near = _ranked(near, "query", keep, F.desc("score"), F.asc("least")).select("query", "leaves").collect()
    everything = forest.leaves * len(forest.normals)
    order = [{leaf: n for n, leaf in enumerate(found, 1)} for found in forest.search(queries, everything)]
    needed = sorted(min(order[r["query"]][leaf] for leaf in enumerate(r["leaves"])) for r in near)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 1


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    keep: int = 20,
    trees: int = 4,
    recall: float = 0.95,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that ``queries`` tells, its nearest other rows.

    Nearness is the largest inner product, in double precision; ties go to the smaller
    ``vec_id``. Each query has ``keep`` rows, or all others if they are fewer.

    Vectors are lifted to one length and dealt to the leaves of random-projection trees. The
    trees' cuts are medians of a sample of 16 MB at most; every row is in every tree. A search
    takes leaves from a priority queue that all trees share, and every row of these leaves is
    compared exactly. The number of leaves is the least at which 128 of the queries find the
    share ``recall`` of their true neighbours, which are computed by brute force: measured
    on the data, so data without structure cost more leaves than clustered data. If
    the leaves hold too few rows, a search goes on to more leaves.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor
    do rows with a null ``vec_id``. Vectors of different lengths are never compared. Equal
    vectors are searched once, and of the copies only the ``keep`` + 1 smallest ids can matter.
    Rows that repeat an id and a vector count once; an id with two vectors is two rows.
    """
    element = vectors.schema[vector].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    usable = finite & F.exists(F.col(vector), lambda x: x != 0) & F.col(vec_id).isNotNull()
    rows = vectors.where(usable).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.coalesce(queries, F.lit(False)).alias("asks"), F.col(vector).alias("vector")
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Adding 0.0 makes negative zeros equal to zeros.
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)
            ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            own = [v.tobytes() for v in np.split(values, ends[:-1])] if batch.num_rows else []
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(own, pa.binary())], ["vec_id", "asks", "vector"])

    plain = stage(rows.mapInArrow(packed, "vec_id bigint, asks boolean, vector binary").withColumn("class", F.unhex(F.md5("vector"))))
    members = plain.groupBy("class", "vec_id").agg(F.max("asks").alias("asks"))
    classes = stage(plain.groupBy("class").agg(F.min("vec_id").alias("least"), F.max("asks").alias("asks"), F.min("vector").alias("vector")))
    size = np.dtype(kind).itemsize
    lengths = [r["n"] for r in classes.select(F.octet_length("vector").alias("n")).distinct().collect()]
    found = None
    for length in sorted(lengths):
        own = classes.where(F.octet_length("vector") == length)
        part = _nearest_classes(own, kind, length // size, keep + 1, trees, recall)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)

    smallest = _ranked(members, "class", keep + 1, F.asc("vec_id")).select(F.col("class").alias("of"), "vec_id")
    listed = found.join(smallest.hint("merge"), same_value(F.col("class"), F.col("of")))
    best = F.struct((-F.col("score")).alias("minus"), "vec_id", F.col("class").alias("of"))
    lists = _ranked(listed, "query", keep + 1, F.desc("score"), F.asc("vec_id")).groupBy("query").agg(F.array_sort(F.collect_list(best)).alias("best"))
    asking = members.where("asks").select(F.col("vec_id").alias("query_id"), F.col("class").alias("own"))
    answers = asking.join(lists.hint("merge"), same_value(F.col("own"), F.col("query")))
    others = F.slice(F.filter("best", lambda b: (b["vec_id"] != F.col("query_id")) | (b["of"] != F.col("own"))), 1, keep)
    out = answers.select("query_id", F.posexplode(others).alias("place", "b"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.minus")).alias("score"))
