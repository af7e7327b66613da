"""Merkle manifests of a dataset, with a proof for every row by pointer jumping."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from termloom.llm.staging import Stage, stage

#: Levels that one task builds over a run of 2**_LEVELS neighbouring nodes.
_LEVELS = 10
#: Leaves that share a join key at most, as a power of two; ancestors of more are copied for each such block.
_SHARED = 10
_DIGEST = 32


def digest_of(*columns: Column) -> Column:
    """SHA-256 in lower-case hex of the columns one after another.

    A null is ``-``; any other value its UTF-8 byte count, ``:`` and the value as text.
    """
    def part(column: Column) -> Column:
        text = column.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(sized, F.lit("-"))

    return F.sha2(F.concat(*(part(c) for c in columns)).cast("binary"), 256)


def _parent(*children: str) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def fold_proof(leaf: str, place: int, leaves: int, siblings: bytes) -> tuple[str, bytes]:
    """The root that a leaf and its siblings give, and the siblings that are left over."""
    at = 0
    while leaves > 1:
        if place ^ 1 < leaves:
            sibling = siblings[at : at + _DIGEST].hex()
            at += _DIGEST
            leaf = _parent(sibling, leaf) if place & 1 else _parent(leaf, sibling)
        else:
            leaf = _parent(leaf)
        place, leaves = place >> 1, (leaves + 1) >> 1
    return leaf, siblings[at:]


def _ranked(rows: DataFrame) -> DataFrame:
    """``(tree, place, leaves, leaf, row)``: the rows of each tree numbered by ``order`` and leaf.

    A range sort spreads a tree of any size over many tasks; only the rows of each tree in each
    partition are added up in order, as many as there are partitions.
    """
    tied = rows.withColumn("tied", F.monotonically_increasing_id())
    ranges = tied.repartitionByRange("tree", "order", "leaf", "tied").sortWithinPartitions("tree", "order", "leaf", "tied")
    ordered = stage(ranges.drop("order", "tied").withColumn("at", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    parts = ordered.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(
        "tree", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(whole).alias("leaves")
    )
    placed = ordered.join(bases.hint("merge"), ["tree", "part"])
    return placed.select("tree", (F.col("base") + F.col("at") - F.col("first")).alias("place"), "leaves", "leaf", "row")


def _build(base: int):
    """The nodes of ``_LEVELS`` levels over a run of neighbours, and the node on top of them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place").combine_chunks()
        tree, leaves, size = (table.column(c)[0].as_py() for c in ("tree", "leaves", "size"))
        first = table.column("place")[0].as_py()
        current = [d.hex() for d in table.column("digest").to_pylist()]
        level, start, to, digest = [], [], [], []
        for up in range(base, base + _LEVELS):
            if size == 1 and up:
                break
            level += [up] * len(current)
            start += [(first + i) << up for i in range(len(current))]
            to += [up + 1 if size > 1 else up] * len(current)
            paired = current + [""]
            digest += [bytes.fromhex(paired[i ^ 1]) for i in range(len(current))]
            if size == 1:
                break
            current = [_parent(*current[i : i + 2]) for i in range(0, len(current), 2)]
            first, size = first >> 1, (size + 1) >> 1
        else:
            up += 1
        nodes = len(level)
        own = table.column("row").chunk(0)
        own = own.slice(0, 0 if base else len(own))
        columns = {
            "tree": pa.array([tree] * (nodes + 1), pa.string()),
            "leaves": pa.array([leaves] * (nodes + 1), pa.int64()),
            "level": pa.array([*level, up], pa.int32()),
            "start": pa.array([*start, first << up], pa.int64()),
            "to": pa.array([*to, None], pa.int32()),
            "size": pa.array([None] * nodes + [size], pa.int64()),
            "digest": pa.array([*digest, bytes.fromhex(current[0])], pa.binary()),
            "row": pa.concat_arrays([own, pa.nulls(nodes + 1 - len(own), own.type)]),
        }
        return pa.table(columns)

    return run


def _forest(rows: DataFrame) -> tuple[DataFrame, DataFrame, int, list[Stage]]:
    """The nodes of the trees over ``(tree, place, leaves, leaf, row)`` with their siblings, the
    trees' roots ``(tree, leaves, digest)``, the greatest height, and the tables behind them."""
    row_type = rows.schema["row"].dataType
    schema = T.StructType(
        [T.StructField("tree", T.StringType()), T.StructField("leaves", T.LongType()), T.StructField("level", T.IntegerType()),
         T.StructField("start", T.LongType()), T.StructField("to", T.IntegerType()), T.StructField("size", T.LongType()),
         T.StructField("digest", T.BinaryType()), T.StructField("row", row_type)]
    )
    now = rows.select("tree", "leaves", F.col("leaves").alias("size"), "place", F.col("leaf").alias("digest"), "row")
    tables: list[Stage] = []
    base = 0
    while True:
        blocks = now.groupBy("tree", F.shiftright("place", _LEVELS).alias("block"))
        made = Stage(blocks.applyInArrow(_build(base), schema))
        tables.append(made)
        tops = made.df.where("size > 1")
        base += _LEVELS
        if tops.isEmpty():
            break
        now = tops.select("tree", "leaves", "size", F.shiftright("start", base).alias("place"), "digest", "row")
    whole = tables[0].df
    for table in tables[1:]:
        whole = whole.unionByName(table.df)
    most = whole.agg(F.max("leaves")).first()[0] or 1
    nodes = whole.where("to IS NOT NULL").select("tree", "leaves", "level", "start", "to", F.col("digest").alias("siblings"), "row")
    roots = whole.where("size = 1").select("tree", "leaves", "digest")
    return nodes, roots, (most - 1).bit_length(), tables


def _doubled(nodes: DataFrame, height: int, tables: list[Stage]) -> Stage:
    """The leaves, each with its siblings on the whole way to the root of its tree.

    A node at ``level`` points to its ancestor at ``to`` and holds the siblings on the way there.
    Each round joins it with that ancestor's own pointer and puts the two segments together, so
    the distance doubles. After the round of distance d only levels that 2d divides can still be
    pointed to, so the others go. An ancestor is copied for each block of 2**_SHARED leaves below
    it, so that no join key has more than these.
    """
    distance = 1
    while True:
        level = F.col("level") % (2 * distance)
        blocks = f"sequence(shiftright(start, least(level, {_SHARED})), shiftright(least(start + shiftleft(1L, level), leaves) - 1, least(level, {_SHARED})))"
        ancestors = nodes.where(level == distance).select(
            F.col("tree").alias("tree2"),
            F.col("level").alias("level2"),
            F.explode(F.expr(blocks)).alias("block2"),
            F.col("to").alias("to2"),
            F.col("siblings").alias("siblings2"),
        )
        own = nodes.where(level == 0).withColumn("block", F.expr(f"shiftright(start, least(to, {_SHARED}))"))
        met = (F.col("tree") == F.col("tree2")) & (F.col("to") == F.col("level2")) & (F.col("block") == F.col("block2"))
        following = Stage(
            own.join(ancestors.hint("merge"), met, "left").select(
                "tree",
                "leaves",
                "level",
                "start",
                F.coalesce("to2", "to").alias("to"),
                F.concat("siblings", F.coalesce("siblings2", F.lit(b""))).alias("siblings"),
                "row",
            )
        )
        for table in tables:
            table.drop()
        nodes, tables = following.df, [following]
        distance *= 2
        if distance >= height:
            return following


def _proofs(rows: DataFrame) -> tuple[DataFrame, Stage]:
    """``(tree, place, leaves, siblings, row)`` of ``(tree, order, leaf, row)`` and the trees' roots."""
    nodes, roots, height, tables = _forest(_ranked(rows))
    roots = Stage(roots)
    proofs = _doubled(nodes, height, tables).df
    return proofs.select("tree", F.col("start").alias("place"), "leaves", "siblings", "row"), roots


def merkle_proofs(rows: DataFrame, *, leaf: str = "leaf", tree: str = "lang", order: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``rows`` (default: all), and every row's way to the root.

    ``leaf`` is a digest in hex. The leaves of each value of ``tree`` ascend by ``order`` (nulls
    first); while several nodes remain, every two neighbours become the digest of their digests,
    the last one by itself if their number is odd. What remains is ``subroot``. The subroots,
    ordered by ``tree`` (null first, bytewise), give ``root`` likewise.

    Further columns: ``place`` and ``leaves`` of the row in its tree, ``tree_place`` and ``trees``
    of its subroot, and ``siblings``: the digests that a proof needs from the leaf up, 32 bytes
    each (see ``fold_proof``). Columns of these names are replaced. Rows of one ``order`` are
    ordered by leaf; equal rows are leaves of their own. No rows give no rows.

    The parts of a leaf never reach the joins. A task holds 2**10 nodes; the driver sees
    the height of the trees and nothing else.
    """
    added = ["subroot", "root", "place", "leaves", "tree_place", "trees", "siblings"]
    kept = [c for c in keep or rows.columns if c not in added]
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    entries = rows.select(
        key.alias("tree"), F.col(order).alias("order"), F.unhex(leaf).alias("leaf"), F.struct(*kept).alias("row")
    )
    proofs, roots = _proofs(stage(entries))
    of_roots = F.struct(F.col("tree").alias("name"), F.col("leaves").alias("of"), F.col("digest").alias("subroot"))
    upper = roots.df.select(F.lit("").alias("tree"), F.col("tree").alias("order"), F.col("digest").alias("leaf"), of_roots.alias("row"))
    ways, root = _proofs(upper)
    blocks = f"sequence(0L, shiftright(row.of - 1, {_SHARED}))"
    one_row = F.broadcast(root.df.select("tree", F.col("digest").alias("root")))
    ways = ways.join(one_row, "tree").select(
        F.col("row.name").alias("tree2"),
        F.explode(F.expr(blocks)).alias("block2"),
        F.lower(F.hex("row.subroot")).alias("subroot"),
        F.lower(F.hex("root")).alias("root"),
        F.col("place").alias("tree_place"),
        F.col("leaves").alias("trees"),
        F.col("siblings").alias("siblings2"),
    )
    met = (F.col("tree") == F.col("tree2")) & (F.shiftright("place", _SHARED) == F.col("block2"))
    return proofs.join(ways.hint("merge"), met).select(
        "row.*", "subroot", "root", "place", "leaves", "tree_place", "trees", F.concat("siblings", "siblings2").alias("siblings")
    )


def fold_proofs(proofs: DataFrame, *, leaf: str = "leaf", column: str = "folded_root") -> DataFrame:
    """``proofs`` with the root that the digests in ``leaf`` and each row's siblings give.

    A column of that name is replaced.
    """
    used = [F.col(c).alias(f"c{i}") for i, c in enumerate((leaf, "place", "leaves", "tree_place", "trees", "siblings"))]
    kept = [c for c in proofs.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, place, leaves, tree_place, trees, siblings in zip(*(batch.column(i).to_pylist() for i in range(1, 7)), strict=True):
                subroot, rest = fold_proof(own, place, leaves, siblings)
                out.append(fold_proof(subroot, tree_place, trees, rest)[0])
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], ["row", "folded"])

    rows = proofs.select(F.struct(*kept).alias("row"), *used)
    schema = T.StructType([rows.schema["row"], T.StructField("folded", T.StringType())])
    return rows.mapInArrow(run, schema).select("row.*", F.col("folded").alias(column))
