"""Ranked lexical search by MaxScore whose bounds know what pairs of terms score together."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from termloom.llm.decontaminate import words_of
from termloom.llm.staging import Stage, byte_texts

#: Documents of one block of the index.
_BLOCK = 4096
#: Bytes of item text that are searched for in one pass over the documents.
_ITEM_BYTES = 4 << 20
#: Terms of an item, the commonest ones, whose pairs have intersection lists.
_PAIRED = 8
#: Words whose numbers a task counts at a time.
_COUNTED = 1 << 20


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(weight: np.ndarray, tf: np.ndarray, length: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term adds to a document's score, in whole numbers."""
    m = 50 + (50 * length * documents) // max(1, terms)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


@dataclass(frozen=True)
class Workload:
    """The items of one pass: their ids, the numbers of their terms, and the pairs among these.

    ``pairs`` lists the pairs of terms with intersection lists; ``joint`` has for each item
    the places in its terms and the pair, ``(i, j, pair)``.
    """

    items: list
    terms: list[np.ndarray]
    weight: np.ndarray
    pairs: list[tuple[int, int]]
    joint: list[list[tuple[int, int, int]]]
    documents: int
    length: int

    @classmethod
    def of(cls, items: list, terms: list[np.ndarray], df: np.ndarray, documents: int, length: int) -> Workload:
        weight = np.array([term_weight(documents, int(n)) if n else 0 for n in df], dtype=np.int64)
        terms = [own[weight[own] > 0] for own in terms]
        numbers: dict[tuple[int, int], int] = {}
        joint = []
        for own in terms:
            commonest = sorted(range(len(own)), key=lambda i: (-df[own[i]], own[i]))[:_PAIRED]
            joint.append(
                [(i, j, numbers.setdefault((min(own[i], own[j]), max(own[i], own[j])), len(numbers))) for i, j in combinations(commonest, 2)]
            )
        return cls(items, terms, weight, list(numbers), joint, documents, length)


class Block:
    """The lists of some documents: each term's places and impacts, and what they score at most.

    ``pair_most`` are the greatest joint impacts of documents that hold both terms of a pair.
    """

    def __init__(self, postings: tuple[np.ndarray, ...], pair_most: np.ndarray, documents: int):
        self.terms, self.ends, self.places, self.impacts = postings
        self.pair_most, self.documents = pair_most, documents
        self.row = {t: i for i, t in enumerate(self.terms.tolist())}
        starts = np.r_[0, self.ends[:-1]]
        self.most = np.maximum.reduceat(self.impacts, starts) if len(self.terms) else np.zeros(0, dtype=np.int64)
        self._dense: dict[int, np.ndarray] = {}

    def posting(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        row = self.row[term]
        own = slice(self.ends[row - 1] if row else 0, self.ends[row])
        return self.places[own], self.impacts[own]

    def dense(self, term: int) -> np.ndarray:
        """The impacts of a term for all documents of the block."""
        if term not in self._dense:
            places, own = self.posting(term)
            self._dense[term] = np.zeros(self.documents, dtype=np.int64)
            self._dense[term][places] = own
        return self._dense[term]


def _pair_lists(block: Block, pairs: list[tuple[int, int]], keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair's documents the greatest joint impact, and the ``keep``-th greatest (0: fewer)."""
    most, floor = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
    for n, (a, b) in enumerate(pairs):
        if a not in block.row or b not in block.row:
            continue
        few, many = sorted((a, b), key=lambda t: len(block.posting(t)[0]))
        places, own = block.posting(few)
        other = block.dense(many)[places]
        both = (own + other)[other > 0]
        if len(both):
            most[n] = both.max()
        if len(both) >= keep:
            floor[n] = np.partition(both, len(both) - keep)[len(both) - keep]
    return most, floor


def prefix_bounds(most: list[int], joint: dict[tuple[int, int], int]) -> list[int]:
    """What documents score at most for the first 0, 1, 2, ... terms.

    Terms are matched to pairs one after another, each with the free earlier term that saves
    most: of the two terms of a pair a document has one, or both and then the pair's joint
    maximum at most, which can be far below the sum of their own.
    """
    out, free = [0], set()
    for i, own in enumerate(most):
        saved, mate = 0, -1
        for j in free:
            if (j, i) in joint:
                saving = own + most[j] - max(own, most[j], joint[j, i])
                if saving > saved:
                    saved, mate = saving, j
        free.add(i)
        if mate >= 0:
            free -= {i, mate}
        out.append(out[-1] + own - saved)
    return out


class Best:
    """The best documents of an item so far; ``floor`` is a score that the last of them has at least."""

    def __init__(self, keep: int, floor: int):
        self.keep, self.floor = keep, max(1, floor)
        self.score, self.null, self.doc = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        score, null, doc = np.r_[self.score, score], np.r_[self.null, null], np.r_[self.doc, doc]
        top = np.lexsort((doc, ~null, -score))[: self.keep]
        self.score, self.null, self.doc = score[top], null[top], doc[top]
        if len(top) == self.keep:
            self.floor = max(self.floor, int(self.score[-1]))


def search_block(block: Block, terms: np.ndarray, joint: list[tuple[int, int, int]], floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the documents of a block that score ``floor`` or more, by MaxScore.

    Terms are taken from the greatest maximum down. Those whose bound together stays below
    ``floor`` cannot lift a document to it by themselves, so only documents of the others are
    candidates; these are looked up in the rest while their bound allows.
    """
    has = [i for i, t in enumerate(terms.tolist()) if t in block.row]
    has.sort(key=lambda i: block.most[block.row[terms[i]]])
    most = [int(block.most[block.row[terms[i]]]) for i in has]
    at = {i: n for n, i in enumerate(has)}
    pairs = {(min(at[i], at[j]), max(at[i], at[j])): int(block.pair_most[p]) for i, j, p in joint if i in at and j in at}
    bounds = prefix_bounds(most, pairs)
    nothing = np.zeros(0, dtype=np.int64)
    if bounds[-1] < floor:
        return nothing, nothing
    essential = max(n for n, bound in enumerate(bounds) if bound < floor)
    scores = np.zeros(block.documents, dtype=np.int64)
    for n in range(essential, len(has)):
        places, own = block.posting(int(terms[has[n]]))
        scores[places] += own
    found = np.flatnonzero(scores > max(0, floor - bounds[essential] - 1))
    for n in range(essential - 1, -1, -1):
        scores[found] += block.dense(int(terms[has[n]]))[found]
        found = found[scores[found] + bounds[n] >= floor]
    found = found[scores[found] >= floor]
    return found, scores[found]


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of batches with every document's number of words, and (row, term, tf) of known terms."""
    for batch in batches:
        lengths, hits, start = [], [], 0
        words_held = 0
        for i, text in enumerate(byte_texts(batch.column(1))):
            words = words_of(text)
            ids = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))
            hits.append((i - start) * len(vocabulary) + ids[ids >= 0])
            lengths.append(len(words))
            words_held += len(words)
            if words_held >= _COUNTED or i + 1 == batch.num_rows:
                keys, tf = np.unique(np.concatenate(hits), return_counts=True)
                row, term = np.divmod(keys, max(1, len(vocabulary)))
                yield batch.slice(start, i + 1 - start), np.array(lengths, dtype=np.int64), row, term, tf
                lengths, hits, start, words_held = [], [], i + 1, 0


_FORWARD = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"


def _forward(docs: DataFrame, vocabulary) -> DataFrame:
    """Every document with words: its number of words, and how often it has which known term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lengths, row, term, tf in _counted(batches, vocabulary.value):
            ends = np.searchsorted(row, np.arange(len(lengths) + 1))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t)) for v, t in ((term, pa.int32()), (tf, pa.int64()))]
            out = pa.record_batch([part.column(0), pa.array(lengths), *lists], ["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(lengths > 0))

    return docs.mapInArrow(run, _FORWARD)


_INDEX = T.StructType(
    [T.StructField("docs", T.ArrayType(T.LongType()))]
    + [T.StructField(c, T.BinaryType()) for c in ("terms", "ends", "places", "impacts", "pair_most", "floors")]
)


def _index(forward: DataFrame, shared, keep: int) -> DataFrame:
    """Blocks of the index: term lists with impacts, pair lists as joint maxima, and floors."""

    def block_of(docs: list, lengths: list, terms: list, tfs: list) -> pa.RecordBatch:
        load: Workload = shared.value
        lengths, term, tf = np.concatenate(lengths), np.concatenate(terms), np.concatenate(tfs)
        place = term[:, 0]
        term = term[:, 1]
        used = load.weight[term] > 0
        place, term, tf = place[used], term[used], tf[used]
        own = impacts(load.weight[term], tf, lengths[place], load.documents, load.length)
        order = np.lexsort((place, term))
        place, term, own = place[order], term[order], own[order]
        names, starts = np.unique(term, return_index=True)
        ends = np.r_[starts[1:], len(term)].astype(np.int64) if len(names) else starts
        postings = (names.astype(np.int64), ends.astype(np.int64), place.astype(np.int64), own)
        block = Block(postings, np.zeros(0), len(docs))
        most, pair_floor = _pair_lists(block, load.pairs, keep)
        floors = np.zeros(len(load.weight), dtype=np.int64)
        for name in names[np.diff(np.r_[0, ends]) >= keep].tolist():
            scored = block.posting(name)[1]
            floors[name] = np.partition(scored, len(scored) - keep)[len(scored) - keep]
        packed = [names.astype("<i4"), ends.astype("<i4"), place.astype("<i4"), own.astype("<i8"), most.astype("<i8"), np.r_[floors, pair_floor].astype("<i8")]
        return pa.record_batch([pa.array([docs], pa.list_(pa.int64())), *(pa.array([p.tobytes()], pa.binary()) for p in packed)], _INDEX.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, lengths, terms, tfs = [], [], [], []
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, _BLOCK - len(docs))
                start += part.num_rows
                sizes = np.diff(part.column(2).offsets.to_numpy())
                place = np.repeat(np.arange(len(docs), len(docs) + part.num_rows), sizes)
                terms.append(np.column_stack([place, part.column(2).flatten().to_numpy()]).astype(np.int64))
                tfs.append(part.column(3).flatten().to_numpy())
                lengths.append(part.column(1).to_numpy())
                docs += part.column(0).to_pylist()
                if len(docs) == _BLOCK:
                    yield block_of(docs, lengths, terms, tfs)
                    docs, lengths, terms, tfs = [], [], [], []
        if docs:
            yield block_of(docs, lengths, terms, tfs)

    return forward.mapInArrow(run, _INDEX)


def _floors(index: DataFrame, terms: int, pairs: int) -> np.ndarray:
    """Of each term and pair the greatest ``keep``-th impact of a block, as one number each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(terms + pairs, dtype=np.int64)
        for batch in batches:
            for content in batch.column(0).to_pylist():
                np.maximum(most, np.frombuffer(content, "<i8"), out=most)
        has = np.flatnonzero(most)
        yield pa.record_batch([pa.array(has), pa.array(most[has])], ["at", "floor"])

    out = np.zeros(terms + pairs, dtype=np.int64)
    partial = index.select("floors").mapInArrow(run, "at bigint, floor bigint")
    for r in partial.groupBy("at").agg(F.max("floor").alias("floor")).collect():
        out[r["at"]] = r["floor"]
    return out


def _searched(index: DataFrame, shared, floors: np.ndarray, keep: int) -> DataFrame:
    """Each task's best documents of every item."""
    terms = len(shared.value.weight)
    first = []
    for own, joint in zip(shared.value.terms, shared.value.joint, strict=True):
        first.append(max([0, *floors[own].tolist(), *(int(floors[terms + p]) for _, _, p in joint)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load: Workload = shared.value
        best = [Best(keep, floor) for floor in first]
        for batch in batches:
            for row in batch.to_pylist():
                unpacked = (np.frombuffer(row[c], k).astype(np.int64) for c, k in (("terms", "<i4"), ("ends", "<i4"), ("places", "<i4"), ("impacts", "<i8")))
                block = Block(tuple(unpacked), np.frombuffer(row["pair_most"], "<i8"), len(row["docs"]))
                null = np.array([d is None for d in row["docs"]], dtype=bool)
                docs = np.array([d or 0 for d in row["docs"]], dtype=np.int64)
                for own, terms, joint in zip(best, load.terms, load.joint, strict=True):
                    places, scores = search_block(block, terms, joint, own.floor)
                    if len(places):
                        own.add(scores, null[places], docs[places])
        for item, own in enumerate(best):
            if len(own.score):
                columns = [pa.array([item] * len(own.score), pa.int32()), pa.array(own.doc, mask=own.null), pa.array(own.score)]
                yield pa.record_batch(columns, ["item", "doc_id", "score"])

    return index.drop("floors").mapInArrow(run, "item int, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    keep: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``keep`` best documents with a score above 0 of each item.

    Terms are lower-cased runs of ASCII letters, digits and all characters beyond ASCII, of whole
    texts. A document scores for each distinct term of an item the term's weight, which falls
    with the number of documents that have it, times a share that grows with its count and falls
    with the document's length (see ``term_weight`` and ``impacts``), in whole numbers. Equal
    scores are ranked by ``doc_id``, a null one first; rows that repeat an id are documents of
    their own. Rows of items that repeat an id are one item with the terms of all. Null texts
    have no terms; an item without known terms has no rows.

    Documents are counted once against the items' terms. Blocks of 4096 documents then become an
    index: term lists with impacts, and for each pair of the commonest terms of an item the
    greatest joint impact of a document of the block that holds both. A search skips blocks and
    documents by bounds that combine pairs and single terms, against the lowest of the best
    scores seen in its task, and at the start against a score that ``keep`` documents of some
    block are known to reach. Only scores below that are skipped, so results are exact.

    Nothing but an item's best documents of each task is shuffled. Items are dealt by hash into
    passes of about 4 MB of text, so what the driver holds and broadcasts is bounded by that and
    by the longest item.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // _ITEM_BYTES))
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    id_type = named.schema["item_id"].dataType
    out = None
    for number in range(passes):
        mine = named.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number).collect()
        words: dict[object, set[bytes]] = {}
        for r in mine:
            words.setdefault(r["item_id"], set()).update(words_of(bytes(r["text"] or b"")))
        numbers = {w: n for n, w in enumerate(sorted(set().union(*words.values())))}
        terms = [np.array(sorted(numbers[w] for w in own), dtype=np.int64) for own in words.values()]
        vocabulary = spark.sparkContext.broadcast(numbers)
        forward = Stage(_forward(texts, vocabulary))
        sizes = forward.df.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = Counter()
        for r in forward.df.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the items' terms
            df[r["term"]] = r["count"]
        load = Workload.of(list(words), terms, np.array([df[n] for n in range(len(numbers))], dtype=np.int64), sizes[0], sizes[1] or 0)
        shared = spark.sparkContext.broadcast(load)
        index = Stage(_index(forward.df, shared, keep))
        forward.drop()
        floors = _floors(index.df, len(load.weight), len(load.pairs))
        found = Stage(_searched(index.df, shared, floors, keep))
        index.drop()
        schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)])
        names = F.broadcast(spark.createDataFrame(list(enumerate(load.items)), schema))  # the items of this pass
        part = found.df.join(names, "item").select("item_id", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    return ranked.select("item_id", "rank", "doc_id", "score")
