"""Token-id files: one concatenated id array with Elias-Fano encoded document boundaries."""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termloom.llm.staging import stage

MAGIC = b"TIDS0002"
#: Magic, width of an id in bytes, documents, null document ids, smallest id, ids, shard,
#: frame of the shard, bytes of the two boundary structures; big endian.
_HEADER = struct.Struct(">8sIQQqQQQQQ")
#: Places of ids, shard and frame in it, counted from 1.
_TOTAL, _SHARD, _NUMBER = 37, 45, 53
#: Bytes of the bit vector that a block and a superblock of the directory count.
_BLOCK, _SUPERBLOCK = 32, 512
_HEAD = struct.Struct("<QIQQ")
#: Place of the r-th one in a byte, for each byte and r.
_ONES = np.array([[([b for b in range(8) if byte >> b & 1] + [0] * 8)[r] for r in range(8)] for byte in range(256)], dtype=np.uint8)


class EliasFano:
    """A non-decreasing sequence of n numbers below u in about n (2 + log2(u / n)) bits.

    The low bits stand in a packed array; the high bits are unary in a bit vector. ``select``
    finds the i-th number through a stored directory of the bit vector's ones: their number
    before each 512 bytes in 32 bits, and before each 32 bytes of these in 16 bits.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, supers: np.ndarray, blocks: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.supers, self.blocks = supers, blocks

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        if n >= 2**32:
            raise ValueError("a sequence holds fewer than 2**32 numbers")
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (values >> low_bits) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[places] = 1
        high = np.packbits(unary, bitorder="little")
        counts = np.add.reduceat(np.bitwise_count(high), np.arange(0, len(high), _BLOCK), dtype=np.int64)
        before = np.cumsum(counts) - counts
        supers = before[:: _SUPERBLOCK // _BLOCK]
        within = before - np.repeat(supers, _SUPERBLOCK // _BLOCK)[: len(before)]
        return cls(n, low_bits, low, high, supers.astype("<u4"), within.astype("<u2"))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.low_bits, len(self.low), len(self.high))
        return b"".join([head, *(x.tobytes() for x in (self.low, self.high, self.supers, self.blocks))])

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, low_bytes, high_bytes = _HEAD.unpack_from(data)
        kinds = (np.uint8, low_bytes), (np.uint8, high_bytes), ("<u4", -(-high_bytes // _SUPERBLOCK)), ("<u2", -(-high_bytes // _BLOCK))
        parts, at = [], _HEAD.size
        for kind, size in kinds:
            parts.append(np.frombuffer(data, kind, size, at))
            at += parts[-1].nbytes
        return cls(n, low_bits, *parts)

    def select(self, i: int) -> int:
        """The i-th number, from 0."""
        return int(self.select_many(np.array([i]))[0])

    def select_many(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the places ``i``; memory grows with their number, not with n."""
        i = np.asarray(i, dtype=np.int64)
        if len(i) and not (0 <= i.min() and i.max() < self.n):
            raise IndexError("no such number")
        if not len(i):
            return i
        # The last superblock, block and byte with no more ones before than asked for.
        over = np.searchsorted(self.supers, i, side="right") - 1
        rest = i - self.supers[over]
        own = (over * (_SUPERBLOCK // _BLOCK))[:, None] + np.arange(_SUPERBLOCK // _BLOCK)
        there = own < len(self.blocks)
        before = np.where(there, self.blocks[np.where(there, own, 0)], 0xFFFF)
        block = (before <= rest[:, None]).sum(axis=1) - 1
        rest -= before[np.arange(len(i)), block]
        at = (over * _SUPERBLOCK + block * _BLOCK)[:, None] + np.arange(_BLOCK)
        counts = np.bitwise_count(self.high[np.minimum(at, len(self.high) - 1)]).astype(np.int64)
        before = np.cumsum(counts, axis=1) - counts
        byte = (before <= rest[:, None]).sum(axis=1) - 1
        rest -= before[np.arange(len(i)), byte]
        byte += at[:, 0]
        places = byte * 8 + _ONES[self.high[byte], rest]
        low = np.zeros(len(i), dtype=np.int64)
        for b in range(self.low_bits):
            bit = i * self.low_bits + b
            low |= (self.low[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(np.int64) << b
        return (places - i) << self.low_bits | low


def pack_frame(doc_ids: list[int | None], ids: list[bytes], width: int, shard: int, number: int) -> bytes:
    """Documents in ascending id order, nulls first, as one frame; the sink ends it with a line feed."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    # Unsigned, as two ids can be more than 2**63 apart.
    spread = known.astype(np.uint64) - np.uint64(least & 2**64 - 1)
    if len(spread) and int(spread[-1]) >= 2**62:
        raise ValueError("document ids of a frame must lie within 2**62 of each other")
    names = EliasFano.encode(spread.astype(np.int64)).to_bytes()
    bounds = EliasFano.encode(ends).to_bytes()
    total = int(ends[-1]) if len(ends) else 0
    head = _HEADER.pack(MAGIC, width, len(ids), nulls, least, total, shard, number, len(names), len(bounds))
    return b"".join([head, names, bounds, *ids])


class Frame:
    """A frame read back; its methods decode no more than the documents asked for."""

    def __init__(self, data: bytes):
        magic, self.width, self.n, self.nulls, self.least, self.total, self.shard, self.number, a, b = _HEADER.unpack_from(data)
        size = _HEADER.size + a + b + self.total * self.width + 1
        if magic != MAGIC or len(data) != size or data[-1:] != b"\n":
            raise ValueError("not a whole frame of token ids")
        self.names = EliasFano.from_bytes(data[_HEADER.size : _HEADER.size + a])
        self.bounds = EliasFano.from_bytes(data[_HEADER.size + a : _HEADER.size + a + b])
        kind = {2: "<u2", 4: "<u4"}[self.width]
        self.ids = np.frombuffer(data, kind, self.total, _HEADER.size + a + b)

    def offsets(self, low: int, high: int) -> np.ndarray:
        """The places of the first ids of documents ``low`` to ``high - 1``, and where the last ends."""
        ends = self.bounds.select_many(np.arange(max(low - 1, 0), high))
        return ends if low else np.concatenate(([0], ends))

    def document(self, i: int) -> np.ndarray:
        start, end = self.offsets(i, i + 1)
        return self.ids[start:end]

    def doc_ids(self, low: int, high: int) -> list[int | None]:
        known = np.arange(max(low - self.nulls, 0), max(high - self.nulls, 0))
        # In Python's numbers: least may be so small that a difference overflows.
        return [None] * (high - low - len(known)) + [x + self.least for x in self.names.select_many(known).tolist()]


#: Runs of white space that are not cut into single characters.
_LONG_SPACE = re.compile(r"\s\s\s|\s\s\Z")
#: What texts with such a run contain: two blanks or line feeds, or other white space.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_SUSPECT = f"[ \n][ \n]|[{_SPACES}]"
#: Distinct pieces, and their characters, that a task remembers at most.
_REMEMBERED, _REMEMBERED_CHARS = 400_000, 16 << 20
#: Bytes of texts whose pieces are looked up together, unless one text is longer.
_TOGETHER = 4 << 20


def whole_texts(texts: pa.Array, added: Sequence[str] = ()) -> list[int]:
    """Places of the texts that cannot be cut, and of those with an ``added`` token."""
    suspect = pc.match_substring_regex(texts, _SUSPECT)
    special = pa.array(np.zeros(len(texts), dtype=bool))
    for token in added:
        special = pc.or_(special, pc.match_substring(texts, token))
    special = special.to_numpy(zero_copy_only=False)
    places = np.flatnonzero(pc.or_(suspect, special).to_numpy(zero_copy_only=False)).tolist()
    return [i for i in places if special[i] or _LONG_SPACE.search(texts[i].as_py())]


def _bytes_in(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), list(characters.encode()))


_SOLID = _bytes_in(string.ascii_letters + string.digits)
_MARK = _bytes_in(string.punctuation)
#: Second bytes of letters whose first is 0xC3.
_LATIN = np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])


def cuts_of(data: np.ndarray) -> np.ndarray:
    """Whether a text can be cut before each of its bytes.

    A byte-level encoder of this kind takes a blank together with the word after it, and of a
    run of white space before a word all but the last character first. So a text can be cut
    before each blank and around each line feed unless a run of three or more, or of two at
    the end, is to be encoded as a whole. Nor does it join marks to a letter or digit before.
    """
    cut = (data == 0x20) | (data == 0x0A)
    solid = _SOLID[data[:-1]]
    solid[1:] |= (data[:-2] == 0xC3) & _LATIN[data[1:-1]]
    cut[1:] |= (data[:-1] == 0x0A) | (solid & _MARK[data[1:]])
    return cut


def pieces_of(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces of texts, one text after another, and where each text's pieces end."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32, len(texts) + 1, texts.offset * 4)
    if ends[0] == ends[-1]:
        return pa.array([], pa.string()), np.zeros(len(texts), dtype=np.int64)
    data = data.slice(ends[0], ends[-1] - ends[0])
    ends = ends - ends[0]
    cut = cuts_of(np.frombuffer(data, np.uint8))
    cut[ends[:-1][ends[:-1] < len(cut)]] = True
    places = np.flatnonzero(cut)
    bounds = np.append(places, len(cut)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(places), pa.py_buffer(bounds), data)
    return pieces, np.searchsorted(places, ends[1:])


def byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


def piecewise(
    encode: Callable[[str], list[int]], encode_word: Callable[[str], list[int]], width: int, added: Sequence[str] = ()
):
    """An encoder of arrays of texts to bytes of ids that encodes each distinct piece once.

    Pieces are told apart by Arrow; only distinct ones of some texts are looked up.

    ``encode`` takes any text, ``encode_word`` the byte characters of a word of letters alone,
    with or without a blank before it. Texts may not be null. A text that contains one of the ``added`` tokens is
    encoded as a whole.
    """
    kind = {2: "H", 4: "I"}[width]
    table = byte_characters()
    blank = table[0x20]
    # Two generations: what is used stays, and no more than twice the limits is held.
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}
    size = 0

    def ids_of(piece: str) -> bytes:
        if not (piece[1:] if piece[0] == " " else piece).isalpha():
            return array(kind, encode(piece)).tobytes()
        mapped = piece.replace(" ", blank) if piece.isascii() else piece.encode().decode("latin-1").translate(table)
        return array(kind, encode_word(mapped)).tobytes()

    def ids_of_all(pieces: list[str]) -> list[bytes]:
        nonlocal known, older, size
        found = list(map(known.get, pieces))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        if len(known) + len(gaps) > _REMEMBERED or size > _REMEMBERED_CHARS:
            known, older, size = {}, known, 0
        for i in gaps:
            piece = pieces[i]
            ids = older.get(piece)
            found[i] = known[piece] = ids_of(piece) if ids is None else ids
            size += len(piece)
        return found

    def together(texts: pa.StringArray) -> list[bytes]:
        whole = whole_texts(texts, added)
        if whole:
            kept = np.ones(len(texts), dtype=bool)
            kept[whole] = False
            out = iter(together(texts.filter(pa.array(kept))))
            return [next(out) if cut else array(kind, encode(texts[i].as_py())).tobytes() for i, cut in enumerate(kept.tolist())]
        pieces, ends = pieces_of(texts)
        pieces = pieces.dictionary_encode()
        ids = ids_of_all(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(ids, pa.large_binary()).take(pieces.indices)
        _, offsets, data = ids.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(ids) + 1)[ends].tolist()
        data = memoryview(data or b"")
        return [data[a:b].tobytes() for a, b in pairwise([0, *bounds])]

    def run(texts: pa.Array) -> Iterator[bytes]:
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + _TOGETHER, side="right")))
            yield from together(texts.slice(at, stop - at).cast(pa.string()))
            at = stop

    return run


_LOADED: dict[str, object] = {}


def _tokenizer(path: str):
    """The tokenizer of a file, loaded once in a Python worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def _encoder(path: str, width: int):
    key = f"{path} {width}"
    if key not in _LOADED:
        tokenizer = _tokenizer(path)
        model = tokenizer.model
        _LOADED[key] = piecewise(
            lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids,
            lambda word: [token.id for token in model.tokenize(word)],
            width,
            [token.content for token in tokenizer.get_added_tokens_decoder().values()],
        )
    return _LOADED[key]


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    width: int = 2,
    frame_bytes: int = 8 << 20,
    shards: int | None = None,
) -> None:
    """Write the token ids of all texts in ascending ``doc_id`` order to files below ``path``.

    Each document is its whole text's ids and ``end_id``; a null text is ``end_id`` alone. The
    content of an added token in a text, special or not, is that token's id. Rows
    with a null ``doc_id`` come first; rows that repeat an id keep together in text order.
    ``shards`` ranges of ids (default: as many as shuffle partitions), with bounds that Spark
    samples, are dealt to tasks: texts are shuffled once, as text, and encoded
    where they are written. A frame holds about ``frame_bytes`` of ids (or one document) and is
    a file of its own. ``width`` is 2 for vocabularies up to 65,536 ids, else 4. The file is
    written by Spark's text sink, which ends each frame with a line feed, so a task that fails
    leaves nothing behind. The tokenizer must be a byte-level one that cuts words before blanks
    and never joins marks to a letter or digit before them.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered = ordered.withColumn("shard", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path, width)
        end = end_id.to_bytes(width, "little")
        held_ids: list = []
        held: list[bytes] = []
        size, shard_now, number = 0, None, 0

        def packed():
            frame = pack_frame(held_ids, held, width, shard_now, number)
            return pa.record_batch([pa.array([frame], pa.large_binary()).cast(pa.binary())], ["frame"])

        for batch in batches:
            keys, shards = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for key, own, ids in zip(keys, shards, encode(batch.column(1)), strict=True):
                if held and (own != shard_now or size + len(ids) > frame_bytes):
                    yield packed()
                    number = number + 1 if own == shard_now else 0
                    held_ids, held, size = [], [], 0
                shard_now = own
                held_ids.append(key)
                held.append(ids + end)
                size += len(ids) + width
        if held:
            yield packed()

    frames = ordered.mapInArrow(run, "frame binary").select(F.col("frame").cast("string"))
    frames.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids, shard, frame, place)`` of all documents.

    ``start`` counts the ids of all documents before, by ``select`` on the frame's boundaries; ``ids`` are the document's bytes, little
    endian in the width of the file; ``ids_crc32`` is over 32-bit ids. Frames are read whole, one
    a row. Sums over frames are taken within each shard and then over shards.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files = files.where("length > 0").select("content")
    number = lambda at: F.conv(F.hex(F.substring("content", at, 8)), 16, 10).cast("bigint")
    frames = files.select(number(_SHARD).alias("shard"), number(_NUMBER).alias("frame"), number(_TOTAL).alias("total"))
    frames = stage(frames)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = frames.groupBy("shard").agg(F.sum("total").alias("total"))
    shards = shards.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    bases = frames.withColumn("before", F.coalesce(F.sum("total").over(within), F.lit(0))).join(shards, "shard")
    bases = stage(bases.select("shard", "frame", (F.col("first") + F.col("before")).alias("base")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                frame = Frame(content)
                for low in range(0, frame.n, 4096):
                    part = range(low, min(low + 4096, frame.n))
                    offsets = frame.offsets(part.start, part.stop)
                    own = [frame.ids[a:b] for a, b in pairwise(offsets.tolist())]
                    yield pa.record_batch(
                        [
                            pa.array(frame.doc_ids(part.start, part.stop), pa.int64()),
                            pa.array(offsets[:-1]),
                            pa.array([len(x) for x in own], pa.int64()),
                            pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64()),
                            pa.array([x.tobytes() for x in own], pa.binary()),
                            pa.array([frame.shard] * len(part), pa.int64()),
                            pa.array([frame.number] * len(part), pa.int64()),
                            pa.array(list(part), pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "ids", "shard", "frame", "place"],
                    )

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary, shard bigint, frame bigint, place bigint"
    rows = files.mapInArrow(decode, schema).join(bases, ["shard", "frame"])
    columns = ["n_tokens", "ids_crc32", "ids", "shard", "frame", "place"]
    return rows.select("doc_id", (F.col("start") + F.col("base")).alias("start"), *columns)
