"""Best-fit packing of documents into bins with conflicts between documents."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.simhash import simhash_components

#: Keeps a bin's number beside its residual in one integer.
_BIN_BITS = 40


class BestFit:
    """Bins in order of residual space, each with bitmaps of its sources and clusters.

    ``place`` goes from the smallest residual that holds the piece upwards until a bin has
    neither its source nor its cluster, and opens a bin if none does.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []  # residual << _BIN_BITS | bin, ascending
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.used: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and the place in it; ``source`` and ``cluster`` are single bits, or 0 for none."""
        mask = (1 << _BIN_BITS) - 1
        for at in range(bisect_left(self.residuals, size << _BIN_BITS), len(self.residuals)):
            number = self.residuals[at] & mask
            if not (self.sources[number] & source or self.clusters[number] & cluster):
                del self.residuals[at]
                break
        else:
            number = len(self.used)
            self.sources.append(0)
            self.clusters.append(0)
            self.used.append(0)
        start = self.used[number]
        self.used[number] = start + size
        self.sources[number] |= source
        self.clusters[number] |= cluster
        left = self.capacity - self.used[number]
        if left:
            insort(self.residuals, left << _BIN_BITS | number)
        return number, start


def pack_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    size: str = "n_words",
    source: str = "source",
    cluster: str = "cluster",
    capacity: int = 2048,
    shard_rows: int = 8192,
) -> DataFrame:
    """``(doc_id, piece, n_pieces, shard, bin, start, length)``: a place for every document.

    A document longer than ``capacity`` is cut into full pieces, which are bins of their own,
    and a rest. Pieces are placed largest first. A bin holds at most one piece of a source and
    at most one of a duplicate cluster; null sources and clusters conflict with nothing. The
    conflict of sources is what makes bins of a hot source: it needs as many bins as pieces,
    so the other sources fill them up.

    Documents are dealt by a hash of their id, source and cluster into shards of about
    ``shard_rows`` rows, counted beforehand, and each shard is packed by itself, so a bin never
    spans tasks and the work of a task does not grow with the data. ``(shard, bin)`` names a
    bin. Documents of size 0 or null come back with one piece of length 0 in no bin (null).
    Rows that repeat an id are packed one by one; rows that repeat in all columns go to one shard.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)).alias("size"),
        F.col(source).cast("string").alias("source"),
        F.col(cluster).cast("string").alias("cluster"),
    )
    shards = max(1, -(-rows.where("size > 0").count() // shard_rows))
    shard = F.pmod(F.xxhash64("doc_id", "source", "cluster"), F.lit(shards)).alias("shard")
    pieces = rows.where("size > 0").select(
        "doc_id",
        shard,
        "source",
        "cluster",
        F.ceil(F.col("size") / capacity).alias("n_pieces"),
        F.explode(F.expr(f"sequence(0L, (size - 1) div {capacity})")).alias("piece"),
        "size",
    )
    pieces = pieces.withColumn("length", F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity)).drop("size")
    order = [F.col("shard"), F.desc("length"), F.col("doc_id"), F.col("piece"), F.col("source"), F.col("cluster")]
    dealt = pieces.repartition("shard").sortWithinPartitions(*order)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece bigint, n_pieces bigint, shard bigint, bin bigint, start bigint, length bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bins, bits = None, BestFit(capacity), ({}, {})
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in ("shard", "length", "source", "cluster")}
            placed = []
            for own, length, *names in zip(*columns.values(), strict=True):
                if own != now:  # the next shard
                    now, bins, bits = own, BestFit(capacity), ({}, {})
                # A bit for each source, and for each cluster, in order of appearance.
                marks = [0 if n is None else 1 << known.setdefault(n, len(known)) for n, known in zip(names, bits, strict=True)]
                placed.append(bins.place(length, *marks))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("piece"),
                    batch.column("n_pieces"),
                    batch.column("shard"),
                    pa.array([b for b, _ in placed], pa.int64()),
                    pa.array([s for _, s in placed], pa.int64()),
                    batch.column("length"),
                ],
                ["doc_id", "piece", "n_pieces", "shard", "bin", "start", "length"],
            )

    nothing = F.lit(None).cast("bigint")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    empty = rows.where("size = 0").select(
        "doc_id", zero.alias("piece"), one.alias("n_pieces"), nothing.alias("shard"),
        nothing.alias("bin"), nothing.alias("start"), zero.alias("length"),
    )
    return dealt.mapInArrow(run, schema).unionByName(empty)


def with_sizes(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` (runs without white space) and ``cluster`` (the same words)."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    plain = F.lower(F.regexp_replace(F.trim(F.col(text)), r"[ \t\n\x0B\f\r]+", " "))
    return docs.withColumns({"n_words": F.size(words).cast("bigint"), "cluster": F.md5(plain.cast("binary"))})


def with_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, source, n_words, cluster)``: ``with_sizes`` with near-duplicates as clusters.

    The cluster is the document's group of ``simhash_components``: copies of the same words, and
    texts whose fingerprints differ in few bits, in chains. Null and empty texts are one group, of size 0.
    Every row is returned, also those that repeat an id, each with the group of its own text (groups whose
    smallest rows agree in id, source and size are one cluster). Texts are read once.
    """
    sized = with_sizes(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")))
    keyed = sized.select(F.struct("doc_id", "source", "n_words").alias("key"), "text")
    groups = simhash_components(keyed, doc_id="key")
    # A group is named by its smallest row, null fields included.
    name = F.to_json("component_id", {"ignoreNullFields": "false"})
    return groups.select("doc_id.*", name.alias("cluster"))
