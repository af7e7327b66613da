"""Near-duplicate vectors by int8 tile products with rigorous error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.components import connected_components
from termloom.llm.staging import stage
from termloom.operators.joins import same_value

#: Rounding of the products themselves, far above what float64 and exact float32 sums leave.
_SLACK = 1e-9
#: Rows of one tile that are multiplied at a time.
_STRIP = 512
#: What names a pair of tiles.
_PLACE = ["dimensions", "tile", "tile2"]
#: A tile's partners are itself and half the others, those after it around a circle, so that all
#: tiles have about as many and each pair is named once.
_PARTNERS = """transform(
    sequence(0L, tiles div 2 - if(tiles % 2 = 0 AND tile >= tiles div 2, 1L, 0L)), k -> (tile + k) % tiles)"""


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows as int8 codes, their scales, and the norms of what the codes lose.

    Scales and norms are float32, the norms rounded up, so that a bound from them holds.
    """
    scale = np.nextafter((np.abs(unit).max(axis=1) / 127).astype(np.float32), np.float32(1))
    codes = np.rint(unit / scale[:, None].astype(np.float64)).astype(np.int8)
    lost = np.linalg.norm(unit - codes * scale[:, None].astype(np.float64), axis=1)
    return codes, scale, np.nextafter(lost.astype(np.float32), np.float32(2))


def possible_pairs(left: tuple, right: tuple, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """Strips of quantised ``left`` by ``right``: True where the cosine may reach the threshold.

    With x = x' + e and y = y' + f (codes and what they lose), x.y lies within
    |x'||f| + |e||y'| + |e||f| of x'.y', so no pair that is False can be linked. Products of int8
    codes are whole numbers summed in float32, which is exact below 2**24, that is up to 1,040
    dimensions at a time.
    """
    a, a_scale, a_lost = left
    b, b_scale, b_lost = right
    a_scale, a_lost, b_scale, b_lost = (x.astype(np.float64) for x in (a_scale, a_lost, b_scale, b_lost))
    wide_b = b.astype(np.float32)
    b_norm = np.sqrt(np.einsum("ij,ij->i", wide_b, wide_b, dtype=np.float64)) * b_scale
    for start in range(0, len(a), _STRIP):
        rows = slice(start, start + _STRIP)
        wide_a = a[rows].astype(np.float32)
        a_norm = np.sqrt(np.einsum("ij,ij->i", wide_a, wide_a, dtype=np.float64)) * a_scale[rows]
        product = np.zeros((len(wide_a), len(b)), dtype=np.float32)
        for at in range(0, a.shape[1], 1024):
            part = wide_a[:, at : at + 1024] @ wide_b[:, at : at + 1024].T
            product = part if a.shape[1] <= 1024 else product.astype(np.float64) + part
        # The bound split into two outer terms: |x'||f| + |e|(|y'| + |f|), as reach of the codes' product.
        least = threshold - _SLACK - (np.outer(a_norm, b_lost) + np.outer(a_lost[rows], b_norm + b_lost))
        yield start, product * np.outer(a_scale[rows], b_scale) >= least


def linked_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """Strips of unit rows ``left`` by ``right`` as boolean matrices of cosine >= threshold, exact.

    ``possible_pairs`` are computed anew in double precision; no other pair can be linked.
    """
    for start, possible in possible_pairs(quantise(left), quantise(right), threshold):
        own = left[start : start + _STRIP]
        n = int(possible.sum())
        linked = np.zeros_like(possible)
        if n * 20 > possible.size:
            linked = (own @ right.T >= threshold) & possible
        elif n:
            i, j = np.nonzero(possible)
            linked[i, j] = np.einsum("ij,ij->i", own[i], right[j]) >= threshold
        yield start, linked


def _forest(rows: np.ndarray, columns: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links that connect the same rows (numbered below ``height``) and columns."""
    order = np.argsort(rows, kind="stable")
    rows, columns = rows[order], columns[order]
    edges = np.searchsorted(rows, np.arange(height + 1))
    left = set(columns.tolist())
    by_column: dict[int, list[int]] = {}
    for r, c in zip(rows.tolist(), columns.tolist(), strict=True):
        by_column.setdefault(c, []).append(r)
    seen_row, out_r, out_c = np.zeros(height, dtype=bool), [], []
    while left:
        queue = [left.pop()]
        while queue:
            column = queue.pop()
            for row in by_column[column]:
                if seen_row[row]:
                    continue
                seen_row[row] = True
                out_r.append(row)
                out_c.append(column)
                for other in columns[edges[row] : edges[row + 1]].tolist():
                    if other in left:
                        left.discard(other)
                        out_r.append(row)
                        out_c.append(other)
                        queue.append(other)
    return np.array(out_r, dtype=np.int64), np.array(out_c, dtype=np.int64)


def _unit(vectors: pd.Series) -> np.ndarray:
    own = np.stack([np.asarray(v, dtype="<f8") for v in vectors])
    own = own / np.abs(own).max(axis=1, keepdims=True)  # else squares of tiny or huge values are lost
    return own / np.linalg.norm(own, axis=1, keepdims=True)


def _pack_tile(tile: pd.DataFrame) -> pd.DataFrame:
    """The rows of a tile as one row: codes, scales, losses and nodes as bytes."""
    codes, scale, lost = quantise(_unit(tile["vector"]))
    return pd.DataFrame(
        {
            "tile": tile["tile"].iloc[:1].astype("int64"),
            "dimensions": [codes.shape[1]],
            "codes": [codes.tobytes()],
            "scales": [scale.astype("<f4").tobytes()],
            "lost": [lost.astype("<f4").tobytes()],
            "nodes": [tile["node"].to_numpy("<i8").tobytes()],
        }
    )


def _candidates(threshold: float):
    """The nodes of a pair of tiles that may be linked across it, with the tile they stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                sides = []
                for end in ("", "2"):
                    codes = np.frombuffer(pair["codes" + end], np.int8).reshape(-1, pair["dimensions"])
                    sides.append((codes, np.frombuffer(pair["scales" + end], "<f4"), np.frombuffer(pair["lost" + end], "<f4")))
                same = pair["tile"] == pair["tile2"]
                marked = [np.zeros(len(codes), dtype=bool) for codes, _, _ in sides]
                for start, possible in possible_pairs(*sides, threshold):
                    if same:  # each pair once; a row is no link of its own
                        possible = np.triu(possible, start + 1)
                    marked[0][start : start + len(possible)] |= possible.any(axis=1)
                    marked[1] |= possible.any(axis=0)
                if same:
                    marked = [marked[0] | marked[1]]
                for second, (own, nodes) in enumerate(zip(marked, ("nodes", "nodes2"), strict=False)):
                    found = np.frombuffer(pair[nodes], "<i8")[own]
                    place = [np.full(len(found), pair[c]) for c in ("dimensions", "tile", "tile2")]
                    columns = [*place, np.full(len(found), second), found]
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], _PLACE + ["second", "node"])

    return run


def _verify(threshold: float):
    """Link counts (``b`` null) and connecting links among the candidates of a pair of tiles."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        same = key[1] == key[2]
        # In order of the nodes, so that a task run again computes the same.
        sides = [rows[rows["second"] == n].sort_values("node") for n in ((0, 0) if same else (0, 1))]
        left, right = (_unit(side["vector"]) for side in sides)
        copies = [side["copies"].to_numpy("int64") for side in sides]
        nodes = [side["node"].to_numpy("int64") for side in sides]
        counts = [np.zeros(len(left), dtype=np.int64), np.zeros(len(right), dtype=np.int64)]
        parts = []
        for start, linked in linked_pairs(left, right, threshold):
            if same:
                linked = np.triu(linked, start + 1)
            if not linked.any():
                continue
            height = len(linked)
            counts[0][start : start + height] += linked @ copies[1]
            counts[1] += copies[0][start : start + height] @ linked
            found, columns = _forest(*np.nonzero(linked), height)
            parts.append(_out(nodes[0][found + start], nodes[1][columns], None))
        for n, own in zip(counts, nodes, strict=True):
            parts.append(_out(own[n > 0], None, n[n > 0]))
        return pd.concat(parts, ignore_index=True)

    return run


def _out(a: np.ndarray, b: np.ndarray | None, n: np.ndarray | None) -> pd.DataFrame:
    nothing = pd.array([None] * len(a), dtype="Int64")
    return pd.DataFrame({name: nothing if x is None else pd.array(x, dtype="Int64") for name, x in (("a", a), ("b", b), ("n", n))})


def vector_duplicates(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    tile_rows: int = 4096,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Two rows are linked if the cosine of their vectors, in double precision, is at least
    ``threshold``; ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest ``vec_id`` reachable and ``kept`` tells whether it is the row's own. Vectors that
    are null, empty, zero, or hold null or non-finite components link with nothing. Vectors of
    different lengths never link.

    Equal vectors are one node with a count. The nodes are dealt into tiles of about
    ``tile_rows`` and quantised once; every pair of tiles is one row of work that carries the
    codes of both, a byte a component, so a task holds two tiles and one strip of their product
    whatever the data. It names the nodes that may have a link across the pair; only these are
    sent there in full precision, and only their possible pairs are computed anew. A pair of tiles
    gives a count for each of its vectors and links that connect what is linked, never all
    links. The work is quadratic in distinct vectors, as any exact all-pairs comparison.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    groups = rows.where("vector IS NOT NULL").groupBy("vector")
    sized = groups.agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    distinct = stage(sized.withColumn("node", F.monotonically_increasing_id()))
    lengths = stage(distinct.groupBy(F.size("vector").alias("dimensions")).agg(F.count(F.lit(1)).alias("rows")))
    tiles = F.ceil(F.col("rows") / tile_rows)
    dealt = distinct.join(lengths, F.size("vector") == F.col("dimensions"))
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("node"), tiles))
    packed = stage(
        dealt.select("dimensions", "tile", "vector", "node")
        .groupBy("dimensions", "tile")
        .applyInPandas(_pack_tile, "tile bigint, dimensions int, codes binary, scales binary, lost binary, nodes binary")
    )
    second = packed.select(
        F.col("tile").alias("other"),
        F.col("dimensions").alias("dimensions2"),
        *(F.col(c).alias(f"{c}2") for c in ("codes", "scales", "lost", "nodes")),
    )
    sizes = lengths.select(F.col("dimensions").alias("of"), tiles.cast("bigint").alias("tiles"))
    names = packed.select("dimensions", "tile").join(sizes, F.col("dimensions") == F.col("of"))
    names = names.select("dimensions", "tile", F.explode(F.expr(_PARTNERS)).alias("tile2"))
    # The pairs come from equality joins.
    pairs = names.join(packed, ["dimensions", "tile"]).join(
        second, (F.col("tile2") == F.col("other")) & (F.col("dimensions") == F.col("dimensions2"))
    )
    pairs = pairs.drop("other", "dimensions2")
    pairs = pairs.repartition("dimensions", "tile", "tile2")
    wanted = "dimensions bigint, tile bigint, tile2 bigint, second bigint, node bigint"
    wanted = stage(pairs.mapInArrow(_candidates(threshold), wanted))
    full = distinct.select(F.col("node").alias("of"), "vector", "copies")
    rows_of_pairs = wanted.join(full, same_value(F.col("node"), F.col("of"))).drop("of")
    found = stage(rows_of_pairs.groupBy(*_PLACE).applyInPandas(_verify(threshold), "a bigint, b bigint, n bigint"))

    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("of")).agg(F.sum("n").alias("n"))
    labels = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    nodes = (
        distinct.join(counts, F.col("node") == F.col("of"), "left")
        .drop("of")
        .join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .select("vector", "least", "copies", "n", F.coalesce("component", "node").alias("component"))
    )
    smallest = nodes.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    nodes = nodes.join(smallest, same_value(F.col("component"), F.col("of"))).select(
        F.col("vector").alias("own"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    joined = rows.where("vector IS NOT NULL").join(nodes, same_value(F.col("vector"), F.col("own")))
    joined = joined.select("vec_id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return joined.unionByName(alone).select("vec_id", "n_links", "component_id", kept)
