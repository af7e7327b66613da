"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.labelled import sample_labelled
from termloom.llm.staging import byte_texts

BUCKETS = 1 << 15
#: Sizes of the character n-grams of a word with its ends marked.
SIZES = (3, 4, 5)
#: Longer words, such as whole texts without blanks, are added up in chunks and not remembered.
_LONG = 64
#: Places in a word whose n-grams are made at a time.
_CHUNK = 1 << 14
#: Inputs of the softmax are scaled by this, so that small averages can matter.
_SCALE = 300.0
#: Words that a task remembers, at most.
_REMEMBERED = 300_000


def subword_chunks(word: bytes) -> Iterator[list[int]]:
    """The buckets of a word and of all its character n-grams, some thousand places at a time."""
    marked = b"<" + word + b">"
    crc = zlib.crc32
    for at in range(0, len(marked), _CHUNK):
        # Chunks overlap, so that no n-gram is lost between two of them.
        part = marked[at : at + _CHUNK + max(SIZES) - 1]
        grams = [crc(part[i : i + n]) % BUCKETS for n in SIZES for i in range(min(_CHUNK, len(part) - n + 1))]
        if at + _CHUNK >= len(marked):
            grams.append(crc(marked) % BUCKETS)
        yield grams


def subwords(word: bytes) -> list[int]:
    """All of them at once."""
    return [bucket for part in subword_chunks(word) for bucket in part]


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their weights: each word's subwords share its part of the text."""
    counts = Counter(words_of(text))
    total = sum(counts.values())
    buckets, weights = [], []
    for word, n in counts.items():
        if len(word) > _LONG:
            grams = np.zeros(BUCKETS, dtype=np.int64)
            for part in subword_chunks(word):
                grams += np.bincount(part, minlength=BUCKETS)
            has = np.flatnonzero(grams)
            buckets += has.tolist()
            weights += (grams[has] * (n / grams.sum() / total)).tolist()
            continue
        own = subwords(word)
        buckets += own
        weights += [n / len(own) / total] * len(own)
    unique, place = np.unique(np.array(buckets, dtype=np.int32), return_inverse=True)
    return unique, np.bincount(place, weights, len(unique)).astype(np.float32)


@dataclass(frozen=True)
class SubwordModel:
    """What scoring needs: the logit that each bucket adds when it is all of a text, and a bias."""

    logits: np.ndarray
    bias: float

    def word(self, word: bytes) -> float:
        total, n = 0.0, 0
        for part in subword_chunks(word):
            total += self.logits[part].sum()
            n += len(part)
        return float(total / n)


class _Adam:
    def __init__(self, parameter: np.ndarray, rate: float):
        self.parameter, self.rate = parameter, rate
        self.mean, self.square, self.step = np.zeros_like(parameter), np.zeros_like(parameter), 0

    def update(self, gradient: np.ndarray) -> None:
        self.step += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.001 * (gradient * gradient - self.square)
        size = np.sqrt(self.square / (1 - 0.999**self.step)) + 1e-8
        self.parameter -= self.rate / (1 - 0.9**self.step) * self.mean / size


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: float, *, dimensions: int = 4, epochs: int = 16, seed: int = 0
) -> SubwordModel:
    """Fit embeddings and softmax together by Adam on the texts' bags.

    Buckets are weighted by the logarithm of how few of the sample's texts have them. The bias
    is moved from the sample's mix of labels to ``share``. A sample of one label, or none, gives
    that label's constant score, or one half.
    """
    texts = len(bags)
    ones = int(labels.sum())
    if ones in (0, texts):
        return SubwordModel(np.zeros(BUCKETS), 0.0 if not texts else 4.0 if ones else -4.0)
    seen = np.zeros(BUCKETS)
    for buckets, _ in bags:
        seen[buckets] += 1
    rarity = np.log((texts + 1) / (seen + 1)).astype(np.float32)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, dimensions)).astype(np.float32)
    weights = rng.normal(0, 0.1, (dimensions, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    adams = [_Adam(p, 0.02) for p in (vectors, weights, bias)]
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(texts), -(-texts // 128)):
            row = np.repeat(np.arange(len(batch)), [len(bags[i][0]) for i in batch])
            bucket = np.concatenate([bags[i][0] for i in batch])
            share_of = np.concatenate([bags[i][1] for i in batch]) * rarity[bucket] * _SCALE
            hidden = np.stack([np.bincount(row, share_of * vectors[bucket, d], len(batch)) for d in range(dimensions)], axis=1)
            raw = hidden @ weights + bias
            soft = np.exp(raw - raw.max(axis=1, keepdims=True))
            error = soft / soft.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), labels[batch]] -= 1
            error /= len(batch)
            back = (error @ weights.T).astype(np.float32)
            moved = np.stack([np.bincount(bucket, share_of * back[row, d], BUCKETS) for d in range(dimensions)], axis=1)
            for adam, gradient in zip(adams, (moved, hidden.T @ error, error.sum(axis=0)), strict=True):
                adam.update(gradient.astype(np.float32))
    difference = weights[:, 1] - weights[:, 0]
    share = min(max(share, 1 / (2 * texts)), 1 - 1 / (2 * texts))
    moved_bias = np.log(share / (1 - share)) - np.log(ones / (texts - ones))
    logits = (vectors @ difference).astype(np.float64) * rarity * _SCALE
    return SubwordModel(logits, float(bias[1] - bias[0] + moved_bias))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, learn: Column, label: str = "toxic", sample_rows: int = 5000, doc_id: str = "doc_id", text: str = "text"
) -> SubwordModel:
    """The model of at most ``sample_rows`` labelled texts.

    Tasks turn whole texts into bags of at most ``BUCKETS`` entries, and only those reach the
    driver, so its memory is bounded by the sample whatever the texts' length.
    """
    sample, share = sample_labelled(docs, labels, label=label, rows=sample_rows, learn=learn, doc_id=doc_id, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = [bag(t) for t in byte_texts(part.column(0))]
                columns = [pa.array([x.tobytes() for x in side], pa.binary()) for side in zip(*made, strict=True)]
                yield pa.record_batch([*columns, part.column(1)], ["buckets", "weights", "label"])

    rows = sample.select(F.col("text").cast("binary"), "label").mapInArrow(run, "buckets binary, weights binary, label int")
    found = []
    for row in rows.toLocalIterator(prefetchPartitions=True):
        weights, buckets = bytes(row["weights"]), bytes(row["buckets"])
        found.append((row["label"], zlib.crc32(weights), zlib.crc32(buckets), buckets, weights))
    # So that the model does not depend on the order in which tasks end.
    found.sort(key=lambda f: f[:3])
    bags = [(np.frombuffer(b, np.int32), np.frombuffer(w, np.float32)) for *_, b, w in found]
    values = [label for label, *_ in found]
    return train(bags, np.array(values, dtype=np.int64), share)


def score_toxicity(docs: DataFrame, model: SubwordModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row: the chance of label 1 from the whole text.

    Averages are linear, so each distinct word has one number, which a task remembers. Null and
    empty texts get the score of the bias alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 32,768 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known: dict[bytes, float] = {}
        for batch in batches:
            sums = []
            for content in byte_texts(batch.column(1)):
                words = words_of(content)
                counts = Counter(words)
                long = {w: model.word(w) for w in counts if len(w) > _LONG}
                new = [w for w in counts if w not in known and w not in long]
                if len(known) + len(new) > _REMEMBERED:
                    known.clear()
                    new = [w for w in counts if w not in long]
                known.update((w, model.word(w)) for w in new)
                total = sum((long[w] if w in long else known[w]) * n for w, n in counts.items())
                sums.append(total / len(words) if words else 0.0)
            z = np.clip(np.array(sums) + model.bias, -500, 500)
            yield pa.record_batch([batch.column(0), pa.array(1 / (1 + np.exp(-z)))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
