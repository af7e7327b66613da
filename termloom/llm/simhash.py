"""Near-duplicate documents by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.components import connected_components
from termloom.llm.staging import byte_texts, free_name, stage
from termloom.operators.joins import same_value

SEGMENT_BITS = 32


def fingerprint(text: bytes, words_per_shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text in UTF-8 as a signed number; 0 without words.

    ASCII letters are lower-cased and words are cut at ASCII white space. A bit is set if it is
    set in more than half the XXH64 values of the shingles, repeats included.
    """
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < words_per_shingle:
        hashes = [digest(b" ".join(words), seed)]
    else:
        shingles = zip(*(words[i:] for i in range(words_per_shingle)), strict=False)
        hashes = [digest(b" ".join(shingle), seed) for shingle in shingles]
    values = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):
        bits = np.unpackbits(values[at : at + (1 << 16)].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(values), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words_per_shingle: int = 3
) -> DataFrame:
    """``(doc_id, fp)`` for every row, null texts as empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words_per_shingle) for t in byte_texts(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp bigint")


def _index_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, fp)``: each segment as it is, and with each of its set bits cleared.

    Two segments that differ in one bit meet under the one without it, so the half of the ball
    of radius 1 that clears bits is enough.
    """
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        keys, owners = [], []
        for segment in range(64 // SEGMENT_BITS):
            value = (fps.view(np.uint64) >> np.uint64(segment * SEGMENT_BITS)) & np.uint64(0xFFFFFFFF)
            tag = np.uint64(segment << SEGMENT_BITS)
            keys.append(value | tag)
            owners.append(fps)
            for bit in range(SEGMENT_BITS):
                has = (value >> np.uint64(bit)) & np.uint64(1) == 1
                keys.append(value[has] ^ np.uint64(1 << bit) | tag)
                owners.append(fps[has])
        yield pa.record_batch(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))],
            ["key", "fp"],
        )


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is linked among ``fps``, fewer than there are fingerprints.

    Breadth first: a fingerprint is compared with those not yet reached only, so a dense group
    costs little more than its size.
    """
    links, left = [], fps
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            current = queue.pop()
            near = np.bitwise_count((left ^ current).view(np.uint64)) <= max_bits
            if near.any():
                found, left = left[near], left[~near]
                links.append((np.full(len(found), current), found))
                queue.extend(found)
    return links


#: Up to this many fingerprints under a key, all pairs are compared at once.
_SMALL = 8


def _links_within(keys: list[np.ndarray], fps: np.ndarray, max_bits: int):
    """Links of all groups of equal keys in sorted columns, as two arrays."""
    changed = np.zeros(len(fps), dtype=bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(changed)
    sizes = np.diff(np.append(starts, len(fps)))
    group, small = np.cumsum(changed) - 1, np.repeat(sizes <= _SMALL, sizes)
    found = []
    for lag in range(1, min(_SMALL, len(fps))):
        together = (group[lag:] == group[:-lag]) & small[lag:]
        left, right = fps[:-lag][together], fps[lag:][together]
        near = np.bitwise_count((left ^ right).view(np.uint64)) <= max_bits
        found.append((left[near], right[near]))
    for start, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
        found += _forest(fps[start : start + size], max_bits)
    if not found:
        return fps[:0], fps[:0]
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _link(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last group may go on in the next batch
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            last = np.ones(len(columns[0]), dtype=bool)
            for key in columns[:3]:
                last &= key == key[-1]
            cut = len(last) - int(last.sum())
            held = [c[cut:] for c in columns]
            a, b = _links_within([c[:cut] for c in columns[:3]], columns[3][:cut], max_bits)
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])
        if held is not None:
            a, b = _links_within(held[:3], held[3], max_bits)
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def fingerprint_links(distinct: DataFrame, *, max_bits: int = 3, group_rows: int = 16_384) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints at most ``max_bits`` apart.

    Multi-index hashing with two 32-bit segments: of two fingerprints at most 3 bits apart, one
    segment differs in one bit at most, so they meet under a key of that segment's ball of
    radius 1. Complete distances are verified under each key. A key with more than ``group_rows``
    entries is dealt out as pairs of blocks, each pair a group of its own, so no group is larger
    than two blocks and no pair is missed. Only links that connect a group are given, never all
    of its pairs.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius 1 find up to 3 differing bits")
    entries = distinct.select("fp").mapInArrow(_index_entries, "key bigint, fp bigint")
    sizes = entries.groupBy("key").count().where(F.col("count") > group_rows)
    large = stage(sizes.select("key", F.ceil(F.col("count") / group_rows).alias("blocks")))
    usual = entries.join(large, "key", "left_anti")
    usual = usual.select("key", F.lit(0).alias("low"), F.lit(0).alias("high"), "fp")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).alias("block")
    dealt = entries.join(large, "key").select("key", "fp", block, F.expr("sequence(0, blocks - 1)").alias("all"))
    dealt = dealt.select("key", "fp", "block", F.explode("all").alias("other")).select(
        "key",
        F.least("block", "other").cast("int").alias("low"),
        F.greatest("block", "other").cast("int").alias("high"),
        "fp",
    )
    groups = ["key", "low", "high"]
    sorted_entries = usual.unionByName(dealt).repartition(*groups).sortWithinPartitions(*groups)
    return sorted_entries.mapInArrow(_link(max_bits), "a bigint, b bigint")


def simhash_components(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words_per_shingle: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links between fingerprints of at
    most ``max_bits`` differing bits. Equal fingerprints are one node, so copies cost nothing.
    Null and empty texts have fingerprint 0 and are linked like any other; rows that repeat are
    all returned; a null ``doc_id`` is kept and never the smallest unless there is no other.
    """
    rows = stage(fingerprints(docs, doc_id=doc_id, text=text, words_per_shingle=words_per_shingle))
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = connected_components(fingerprint_links(distinct, max_bits=max_bits))
    labelled = distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    smallest = smallest.withColumnRenamed("component", "of")
    by_fp = labelled.join(smallest, same_value(F.col("component"), F.col("of"))).select(
        F.col("fp").alias("of"), "component_id"
    )
    return rows.join(by_fp, same_value(F.col("fp"), F.col("of"))).select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without the near-duplicates of a row with a smaller ``doc_id``.

    Of rows with the same ``doc_id`` in one group all stay or none; rows with a null ``doc_id``
    cannot be told apart and stay.
    """
    return without_others(docs, simhash_components(docs, doc_id=doc_id, text=text, **options), doc_id=doc_id)


def without_others(docs: DataFrame, groups: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is their ``component_id`` in ``groups``, or null."""
    gone = free_name(docs, "__gone")
    others = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(gone))
    # Always by sort-merge, so that the plan is the same at every size.
    return docs.join(others.distinct().hint("merge"), docs[doc_id] == F.col(gone), "left_anti")
