import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from termloom.llm.queries import op4_token_files
from termloom.llm.token_files import EliasFano, Frame, pack_frame, piecewise, read_token_files, write_token_files
from termloom.sinks import shared_folder

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(rows, tokenizer):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_brute_force(spark, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op4_token_files(spark, SF_DIR).collect())
    assert got == expected(rows, tokenizer)


ODD = ["", " ", "  a", "a  b", "a b ", "a \n b", "it's  o'clock", "x y  z", "　 q", "<|endoftext|> a", "don't\tstop now",
       "\x1c a \x85 b", "a" * 70 + " " + "b" * 3000, "12 345 é ÉÉ 漢字 🙂 🙂🙂", "a​ b ᠎ c", "word " * 50_000, "tail\n", None]


@pytest.mark.parametrize("width", [2, 4])
def test_odd_texts(spark, tokenizer, width):
    rows = [(i - 5, t) for i, t in enumerate(ODD)] + [(None, "n"), (None, "m"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS shard")
    folder = shared_folder(spark)
    write_token_files(docs, folder, PATH, width=width, frame_bytes=300, shards=3)
    got = read_token_files(spark, folder).collect()
    for r in got:
        assert r["n_tokens"] * width == len(r["ids"])
    got = sorted(got, key=lambda r: r["start"])
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == expected(rows, tokenizer)
    write_token_files(docs.limit(0), folder + "-none", PATH)
    assert read_token_files(spark, folder + "-none").count() == 0


def test_added_tokens_in_texts(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "a  b<|endoftext|>"), (3, "<|endoftext|>\n<|endoftext|> c"), (4, "<|endoftext |> d")]
    folder = shared_folder(spark)
    write_token_files(spark.createDataFrame(rows, "doc_id bigint, text string"), folder, PATH)
    got = read_token_files(spark, folder).collect()
    assert np.frombuffer(min(got)["ids"], "<u2").tolist() == [64, 220, 50256, 275, 0]
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got)
    assert got == expected(rows, Tokenizer.from_file(PATH))


def coder(tokenizer, calls):
    def encode(text):
        calls.append(text)
        return tokenizer.encode(text, add_special_tokens=False).ids

    def encode_word(word):
        calls.append(word)
        return [token.id for token in tokenizer.model.tokenize(word)]

    return piecewise(encode, encode_word, 2, ["<|endoftext|>"])


def test_each_word_is_encoded_once(tokenizer):
    texts = [f"Word{a} other{a}\nWord{b} élevé{b} été{a}" for a in (",", ".", "!?", "") for b in (";", "...", "%%%")]
    calls = []
    run = coder(tokenizer, calls)
    for part in (texts[:5], texts[5:]):
        got = list(run(pa.array(part)))
        assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in part]
    # Words without a blank, with one, marks and the line feed, whatever stands beside them.
    assert len(calls) == len(set(calls)) == 1 + 3 + 6 + 1


def test_random_texts(tokenizer):
    parts = ["a", "Ab", "é", "×", "÷", "ß", "漢", "。", "9", "12", " ", " ", "  ", "\n", "\n", "\t", "\xa0", "\x1c", "'", "'s", "'ll", ".", ",",
             "!", "-", "_", "’s", "🙂", "<|endoftext|>", "the", "of", "É", "²", "ª"]
    rng = random.Random(5)
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(6000)]
    wanted = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    for kind in (pa.string(), pa.large_string()):
        assert list(coder(tokenizer, [])(pa.array(["x", *texts, "y"], kind).slice(1, len(texts)))) == wanted


def test_elias_fano():
    rng = random.Random(2)
    for values in ([], [0], [5], [0, 0, 0], list(range(1000)), sorted(rng.randrange(1 << 40) for _ in range(700)), [7] * 600 + [1 << 50]):
        packed = EliasFano.from_bytes(EliasFano.encode(np.array(values, dtype=np.int64)).to_bytes())
        assert packed.select_many(np.arange(len(values))).tolist() == values
        assert [packed.select(i) for i in range(len(values))] == values
        with pytest.raises(IndexError):
            packed.select(len(values))
    dense = EliasFano.encode(np.cumsum(np.full(10_000, 1400)))
    assert len(dense.to_bytes()) * 8 / 10_000 < 2 + np.log2(1400) + 0.5


def test_directory_is_small_and_stored():
    rng = np.random.default_rng(3)
    for lengths in (rng.integers(0, 3, 300_000), rng.integers(1, 3000, 300_000), rng.pareto(0.7, 300_000).astype(np.int64) % 100_000):
        ends = np.cumsum(lengths)
        data = EliasFano.encode(ends).to_bytes()
        packed = EliasFano.from_bytes(data)
        assert packed.supers.nbytes + packed.blocks.nbytes <= 0.1 * len(data)
        assert packed.supers.dtype.itemsize == 4 and packed.blocks.dtype.itemsize == 2
        # Nothing else is held: the arrays are views of the stored bytes.
        assert sum(x.nbytes for x in vars(packed).values() if isinstance(x, np.ndarray)) < len(data)
        asked = rng.integers(0, len(ends), 5000)
        assert (packed.select_many(asked) == ends[asked]).all()


def test_frames_give_any_documents():
    own = [(i - 3, np.arange(i % 5, dtype="<u2").tobytes()) for i in range(9000)]
    keys = [None, None] + [key for key, _ in own]
    ids = [b"\x07\x00", b""] + [x for _, x in own]
    frame = Frame(pack_frame(keys, ids, 2, 4, 5) + b"\n")
    for low, high in ((0, 1), (0, 3), (1, 2), (2, 2), (5000, 9002)):
        assert frame.doc_ids(low, high) == keys[low:high]
        assert [frame.document(i).tobytes() for i in range(low, min(high, low + 9))] == ids[low : min(high, low + 9)]
