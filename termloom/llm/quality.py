"""Quality by similarity-weighted votes of the nearest labelled latent-semantic vectors."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.labelled import sample_labelled
from termloom.llm.staging import byte_texts

#: Features by kind: shapes of words and of neighbouring words, words, and runs of 3 and of 5 bytes.
KINDS = (2048, 6144, 4096, 4096)
_STARTS = np.cumsum((0, *KINDS))
FEATURES = int(_STARTS[-1])
_RUNS = ((3, 2), (5, 3))
#: The feature of words that repeat the word before.
_REPEAT = 0
_SHAPE = bytes(
    0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x41 if 0x41 <= c <= 0x5A else 0x30 if 0x30 <= c <= 0x39 else c
    for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_BLANK = re.compile(rb"\s")
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
#: Words that a task remembers, and bytes of a text that are looked at in one go.
_REMEMBERED, _PIECE = 300_000, 1 << 20
#: Documents whose vectors are multiplied at a time, always so many.
_BLOCK = 256
#: Cosines are rounded to so many digits, so that equal ones are ties.
_DIGITS = 9
#: How fast votes fall with the cosine, and the least cosine at which they may count half.
_SHARPNESS, _LEAST = 32, 0.3


def _mixed(codes: np.ndarray) -> np.ndarray:
    codes = codes ^ (codes >> np.uint64(29))
    codes *= np.uint64(0xBF58476D1CE4E5B9)
    codes ^= codes >> np.uint64(32)
    return codes


def _bucket(codes: np.ndarray, kind: int) -> np.ndarray:
    codes, size = _mixed(codes), KINDS[kind]
    if size & (size - 1):
        codes %= np.uint64(size)
    else:
        codes &= np.uint64(size - 1)
    codes += np.uint64(_STARTS[kind])
    return codes.view(np.int64)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text cut at blanks into pieces of about ``_PIECE`` bytes, or longer unbroken ones."""
    at = 0
    while len(text) - at > _PIECE:
        blank = _BLANK.search(text, at + _PIECE)
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _run_buckets(lowered: np.ndarray) -> Iterator[np.ndarray]:
    """Features of the runs of bytes of a text in lower case, ``_PIECE`` places at a time."""
    for at in range(0, len(lowered), _PIECE):
        part = lowered[at : at + _PIECE + _RUNS[-1][0] - 1].astype(np.uint64)
        codes, size = part, 1
        for wanted, kind in _RUNS:
            while size < wanted and len(codes):
                codes = codes[:-1] * np.uint64(0x100000001B3)
                codes += part[size:]
                size += 1
            yield _bucket(codes[:_PIECE], kind)


class FeatureCounter:
    """Counts the features of whole texts and remembers the hashes of words."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.shapes: dict[bytes, int] = {}
        self.numbers = np.zeros((_REMEMBERED, 4), dtype=np.uint64)

    def _shape(self, word: bytes) -> int:
        shape = word.translate(_SHAPE)
        if (code := self.shapes.get(shape)) is None:
            code = self.shapes[shape] = zlib.crc32(_RUN.sub(rb"\1", shape))
        return code

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """Of distinct words the hashes of their shapes and in lower case, and the features of both."""
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > len(self.numbers):
            known.clear()
            self.shapes.clear()
            new = words
            if len(new) > len(self.numbers):
                self.numbers = np.zeros((len(new), 4), dtype=np.uint64)
        if new:
            codes = np.array([[self._shape(w) for w in new], [zlib.crc32(w.lower()) for w in new]], dtype=np.uint64)
            own = self.numbers[len(known) : len(known) + len(new)]
            own[:, :2] = codes.T
            own[:, 2], own[:, 3] = _bucket(codes[0], 0), _bucket(codes[1], 1)
            known.update(zip(new, range(len(known), len(known) + len(new))))
        return self.numbers[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]

    def _words(self, parts: list[bytes]) -> list[np.ndarray]:
        """The numbers of the words of each part; Arrow tells words apart, so that each is looked up once."""
        data = np.frombuffer(b" ".join(parts), np.uint8)
        kept = ~_SPACE[data]
        begins = kept.copy()
        begins[1:] &= ~kept[:-1]
        letters = data[kept]
        bounds = np.append(np.flatnonzero(begins[kept]), len(letters)).astype(np.int32)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
        words = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, buffers).dictionary_encode()
        numbers = self._numbers(words.dictionary.to_numpy(zero_copy_only=False).tolist())[words.indices.to_numpy()]
        ends = np.cumsum([len(part) + 1 for part in parts])
        return np.split(numbers, np.searchsorted(np.flatnonzero(begins), ends[:-1]))

    def buckets(self, texts: Iterable[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """The number of a text and its features, as often as they occur; long texts come in parts."""
        held: list[bytes] = []
        size, done = 0, 0
        for text in texts:
            if held and size + len(text) > _PIECE:
                yield from self._together(held, done)
                done += len(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        yield from self._together(held, done)

    def _together(self, texts: list[bytes], first: int) -> Iterator[tuple[int, np.ndarray]]:
        if not texts:
            return
        # Pieces of one long text, or one piece of each of some texts.
        groups = ([piece] for piece in _pieces(texts[0])) if len(texts) == 1 else [texts]
        before = np.zeros((0, 4), dtype=np.uint64)
        for group in groups:
            for i, numbers in enumerate(self._words(group)):
                if len(texts) > 1:
                    before = numbers[:0]
                # With the last word of the piece before.
                both = np.concatenate([before, numbers])
                shapes, lowered = both[:, 0], both[:, 1]
                pairs = shapes[:-1] * np.uint64(0x9E3779B97F4A7C15) + shapes[1:]
                repeats = np.full(int((lowered[1:] == lowered[:-1]).sum()), _REPEAT)
                own = [numbers[:, 2].astype(np.int64), _bucket(pairs, 0), numbers[:, 3].astype(np.int64), repeats]
                before = numbers[-1:] if len(numbers) else before
                if len(texts) > 1:
                    own += _run_buckets(np.frombuffer(texts[i].lower(), np.uint8))
                yield first + i, np.concatenate(own)
        if len(texts) == 1:
            for own in _run_buckets(np.frombuffer(texts[0].lower(), np.uint8)):
                yield first, own

    def many(self, texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The features of each text, ascending, and their counts."""
        for _, parts in groupby(self.buckets(texts), itemgetter(0)):
            counts = np.bincount(next(parts)[1], minlength=FEATURES)
            for _, part in parts:
                counts += np.bincount(part, minlength=FEATURES)
            has = np.flatnonzero(counts)
            yield has, counts[has]

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        return next(self.many([text]))


def without_words(text: bytes) -> bytes:
    """A text of the same outline whose letters are noise: its own in another order, or drawn evenly.

    Capitals stay capitals. Which of the two, and the order, follow from the text alone.
    """
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4").copy()
    letters = [c for c in np.unique(codes).tolist() if chr(c).isalpha()]
    capitals = [c for c in letters if chr(c).isupper()]
    small = sorted({ord(low) for c in letters if len(low := chr(c).lower()) == 1})
    seed = zlib.crc32(text)
    rng = np.random.default_rng(seed)
    for group in (capitals, sorted(set(letters) - set(capitals))):
        places = np.flatnonzero(np.isin(codes, group))
        if not len(places):
            continue
        if seed % 2:
            codes[places] = rng.permutation(codes[places])
        else:
            pool = [ord(up) for c in small if len(up := chr(c).upper()) == 1] if group is capitals else small
            codes[places] = rng.choice(np.array(pool or group, dtype=np.uint32), len(places))
    return codes.tobytes().decode("utf-32-le").encode()


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _weighted(features: np.ndarray, counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Logarithmic counts times rarity; every kind of features has the same length."""
    out = np.log1p(counts) * rarity[features]
    ends = np.searchsorted(features, _STARTS)
    for low, high in zip(ends, ends[1:]):
        length = np.sqrt((out[low:high] ** 2).sum())
        out[low:high] /= 2 * length if length else 1.0
    return out


@dataclass(frozen=True)
class NeighbourModel:
    """Feature weights, the latent directions, and the labelled vectors in them.

    ``familiar`` is the cosine at which a neighbour's vote weighs as much as the doubt.
    """

    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    familiar: float

    def latent(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.einsum("i,ij->j", _weighted(features, counts, self.rarity), self.directions[features])

    def scores(self, latent: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled texts against a doubt that counts as label 0.

        A vote weighs (cosine / ``familiar``) ** 32, the doubt as much as all neighbours do at
        ``familiar``. Equal cosines go by the order of the labelled texts.
        """
        if not len(self.labels):
            return np.full(len(latent), 0.5)
        block = np.zeros((_BLOCK, latent.shape[1]))
        out = []
        for at in range(0, len(latent), _BLOCK):
            rows = min(_BLOCK, len(latent) - at)
            block[:rows] = _unit(latent[at : at + rows])
            cosines = np.round(block @ self.vectors.T, _DIGITS)[:rows]
            k = min(self.neighbours, len(self.labels))
            floor = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
            row, label = np.nonzero(cosines >= floor)
            order = np.lexsort((label, -cosines[row, label], row))
            starts = np.searchsorted(row, np.arange(rows))
            nearest = label[order][starts[:, None] + np.arange(k)]
            weight = (np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0) / self.familiar) ** _SHARPNESS
            out.append((weight * self.labels[nearest]).sum(axis=1) / (weight.sum(axis=1) + k))
        return np.concatenate(out) if out else np.zeros(0)


def feature_frequencies(docs: DataFrame, *, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all documents each feature stands, and how many documents there are.

    Each task sends one count for each of at most ``FEATURES`` features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, seen = FeatureCounter(), np.zeros(FEATURES + 1, dtype=np.int64)
        for batch in batches:
            for _, parts in groupby(count.buckets(byte_texts(batch.column(0))), itemgetter(0)):
                has = np.zeros(FEATURES + 1, dtype=bool)
                has[FEATURES] = True  # documents
                for _, part in parts:
                    has[part] = True
                seen += has
        has = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(has), pa.array(seen[has])], ["feature", "n"])

    partial = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "feature bigint, n bigint")
    out = np.zeros(FEATURES + 1, dtype=np.int64)
    for row in partial.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        out[row["feature"]] = row["n"]
    return out[:FEATURES], int(out[FEATURES])


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
    """Sparse rows as matrices of ``_BLOCK`` rows, one after another."""
    for at in range(0, len(rows), _BLOCK):
        part = rows[at : at + _BLOCK]
        out = np.zeros((len(part), FEATURES), dtype=np.float32)
        for own, (features, values) in zip(out, part, strict=True):
            own[features] = values
        yield at, out


def _directions(rows: list[tuple[np.ndarray, np.ndarray]], rank: int, rounds: int = 6) -> np.ndarray:
    """The first ``rank`` right singular vectors as columns, by block power iteration.

    Needs one block of dense rows and a few of ``rank`` + 16 columns beside the sparse rows.
    """
    block = np.random.default_rng(0).normal(size=(FEATURES, rank + 16)).astype(np.float32)
    for _ in range(rounds):
        moved = np.zeros_like(block)
        for _, part in _dense(rows):
            moved += part.T @ (part @ block)
        block, _ = np.linalg.qr(moved)
    along = np.concatenate([part @ block for _, part in _dense(rows)]) if rows else np.zeros((1, block.shape[1]), dtype=np.float32)
    _, _, turned = np.linalg.svd(along, full_matrices=False)
    return np.ascontiguousarray((block @ turned.T)[:, :rank], dtype=np.float64)


def _familiar(vectors: np.ndarray, labels: np.ndarray, share: float) -> float:
    """The cosine with the nearest other labelled text that all but ``share`` of label 1 reach."""
    ones = np.flatnonzero(labels == 1)
    nearest = []
    for at in range(0, len(ones), _BLOCK):
        own = ones[at : at + _BLOCK]
        cosines = vectors[own] @ vectors.T
        cosines[np.arange(len(own)), own] = -1
        nearest.append(cosines.max(axis=1))
    return max(_LEAST, float(np.quantile(np.concatenate(nearest), share))) if len(ones) > 1 else _LEAST


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    learn: Column,
    label: str = "quality",
    sample_rows: int = 2048,
    rank: int = 32,
    neighbours: int = 5,
    unlike: float = 0.0005,
    doc_id: str = "doc_id",
    text: str = "text",
) -> NeighbourModel:
    """Latent-semantic vectors of at most ``sample_rows`` labelled texts, half of each label.

    Features are hashed words, runs of 3 and 5 bytes, shapes of words and of neighbouring words,
    and immediate repetitions, of whole texts, weighted by logarithms of their counts and by
    their rarity over all of ``docs``. The latent directions are the first ``rank`` singular
    vectors of the sample. Every text of label 1 also gives a vector of label 0 with its letters
    replaced by noise, so that text without words is known to be no good. ``unlike`` is the
    share of label 1 that may be so unlike the others that the doubt outweighs their votes.

    Counts are made in tasks; the driver gets rows of at most ``FEATURES`` numbers.
    """
    seen, total = feature_frequencies(docs, text=text)
    rarity = np.log((total + 1) / (seen + 1))
    sample, _ = sample_labelled(docs, labels, label=label, rows=sample_rows, learn=learn, doc_id=doc_id, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = FeatureCounter()
        for batch in batches:
            made = []
            for content, own in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                made.append((*count(content), own))
                if own:
                    made.append((*count(without_words(content)), 0))
            columns = [
                pa.array([f.astype("<u2").tobytes() for f, _, _ in made], pa.binary()),
                pa.array([n.astype("<f4").tobytes() for _, n, _ in made], pa.binary()),
                pa.array([own for *_, own in made], pa.int32()),
            ]
            yield pa.record_batch(columns, ["features", "counts", "label"])

    rows = sample.select(F.col("text").cast("binary"), "label").mapInArrow(run, "features binary, counts binary, label int")
    # Sorted, so that the model does not depend on the order in which tasks end.
    found = sorted((r["label"], bytes(r["features"]), bytes(r["counts"])) for r in rows.collect())
    weighted = []
    for _, features, counts in found:
        own = np.frombuffer(features, "<u2").astype(np.int64)
        weighted.append((own, _weighted(own, np.frombuffer(counts, "<f4").astype(np.float64), rarity).astype(np.float32)))
    directions = _directions(weighted, rank)
    vectors = [(values[:, None] * directions[own]).sum(axis=0) for own, values in weighted]
    latent = _unit(np.stack(vectors)) if vectors else np.zeros((0, directions.shape[1]))
    values = np.array([value for value, *_ in found], dtype=np.float64)
    return NeighbourModel(rarity, directions, latent, values, neighbours, _familiar(latent, values, unlike))


def score_quality(
    docs: DataFrame, model: NeighbourModel, *, text: str = "text", keep: list[str] | None = None, column: str = "score"
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with the ``column`` of scores, every row.

    Cosines with all labelled vectors are exact, in blocks of one shape, so that a score does
    not depend on what rows stand beside it. Null and empty texts have no features and score 0
    (0.5 if nothing is labelled). A column of that name is replaced.
    """
    kept = [c for c in keep or docs.columns if c != column]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES and sample_rows by rank numbers
    # Columns go by numbers meanwhile, whatever they are called.
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(f"`{text}`").cast("binary").alias("text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, count = shared.value, FeatureCounter()
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                latent = np.stack([model.latent(*made) for made in count.many(byte_texts(part.columns[-1]))])
                yield pa.record_batch([*part.columns[:-1], pa.array(model.scores(latent))], names=schema.names)

    scored = rows.mapInArrow(run, schema)
    return scored.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), F.col("score").alias(column))
