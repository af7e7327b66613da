"""Benchmark decontamination with a generalised suffix automaton over the test items."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.staging import Stage, byte_texts

#: ASCII letters to lower case, every other ASCII character but digits to a blank.
WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(WORD_TABLE).split()


class SuffixAutomaton:
    """All word sequences that occur in a set of items, in the making; see ``Matcher``.

    Words are numbered from 1; 0 is any word that no item has.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.sequences: list[tuple[object, list[int]]] = []
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if ids:
                self.sequences.append((item, ids))
                last = 0
                for word in ids:
                    last = self._extend(last, word)

    def _split(self, state: int, word: int) -> int:
        """The state for the sequence of ``state`` and ``word``, set apart if need be."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = len(self.next)
        self.next.append(dict(self.next[target]))
        self.length.append(self.length[state] + 1)
        self.link.append(self.link[target])
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new


_PARTS = ("link", "length", "top", "short", "first_word", "first_target", "root")


class Matcher:
    """A suffix automaton in flat arrays, with the items of a window or whole short item.

    ``window`` words count as a match; an item with fewer words matches as a whole. Of each state
    there are its suffix link, the length of its longest sequence, and its first transition; all
    transitions of the root; other transitions by state and word. ``top`` is the state that stands
    for the last ``window`` words, ``short`` the nearest state up the links where a short item ends.
    """

    def __init__(self, packed: dict):
        self.window, self.shortest = packed["window"], packed["shortest"]
        # Views give plain integers and share the memory of the arrays.
        for name in _PARTS:
            setattr(self, name, memoryview(packed[name]))
        self.vocabulary = dict(zip(packed["vocabulary"].split(b" "), range(1, len(self.root)), strict=False))
        self.others = dict(zip(packed["other_keys"].tolist(), packed["other_targets"].tolist(), strict=True))
        self.names, self.whole = packed["names"], packed["whole"]
        self.item_ends, self.item_of = packed["item_ends"], packed["item_of"]

    @staticmethod
    def pack(automaton: SuffixAutomaton, window: int) -> dict:
        """The arrays that a matcher consists of."""
        nexts, link, length = automaton.next, automaton.link, automaton.length
        states = len(nexts)
        top, short = np.zeros(states, np.int32), np.zeros(states, np.int32)
        first_word, first_target = np.zeros(states, np.int32), np.zeros(states, np.int32)
        root = np.zeros(len(automaton.vocabulary) + 1, np.int32)
        for word, target in nexts[0].items():
            root[word] = target
        keys, targets = [], []
        for state in range(1, states):
            for n, (word, target) in enumerate(nexts[state].items()):
                if n:
                    keys.append(state << 32 | word)
                    targets.append(target)
                else:
                    first_word[state], first_target[state] = word, target
        whole: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[int]] = {}
        for number, (_, ids) in enumerate(automaton.sequences):
            state = 0
            for word in ids:
                state = nexts[state][word]
            if len(ids) < window:
                whole.setdefault(state, []).append((len(ids), number))
        for state in sorted(range(1, states), key=length.__getitem__):
            up = link[state]
            short[state] = state if state in whole else short[up]
            if length[state] >= window:
                top[state] = top[up] if length[up] >= window else state
        for number, (_, ids) in enumerate(automaton.sequences):
            state = 0
            for word in ids:
                state = nexts[state][word]
                if top[state]:
                    items.setdefault(int(top[state]), set()).add(number)
        sizes = np.zeros(states + 1, np.int64)
        for state, own in items.items():
            sizes[state + 1] = len(own)
        return {
            "window": window,
            "shortest": min((min(window, len(ids)) for _, ids in automaton.sequences), default=0),
            "link": np.array(link, np.int32),
            "length": np.array(length, np.int32),
            "top": top,
            "short": short,
            "first_word": first_word,
            "first_target": first_target,
            "root": root,
            "vocabulary": b" ".join(automaton.vocabulary),
            "other_keys": np.array(keys, np.int64),
            "other_targets": np.array(targets, np.int32),
            "names": [str(item) for item, _ in automaton.sequences],
            "whole": whole,
            "item_ends": np.cumsum(sizes),
            "item_of": np.array([n for state in sorted(items) for n in sorted(items[state])], np.int32),
        }

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Intervals ``[start, end)`` of words inside matches, apart and in order, and the items."""
        if not self.shortest or len(words) < self.shortest:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0]))))
        starts, ends = edges[::2], edges[1::2]
        long_enough = ends - starts >= self.shortest
        found: list[tuple[int, int]] = []
        tops: set[int] = set()
        items: set[int] = set()
        # A word that no item has leads back to the root, so each run is streamed by itself.
        for start, end in zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True):
            self._stream(ids[start:end].tolist(), start, found, tops, items)
        for state in tops:
            items.update(self.item_of[self.item_ends[state] : self.item_ends[state + 1]].tolist())
        return _merged(found), {self.names[n] for n in items}

    def _stream(self, ids: list[int], offset: int, found: list, tops: set, items: set) -> None:
        state = length = 0
        window, link, lengths, top, short = self.window, self.link, self.length, self.top, self.short
        first_word, first_target, root, others, whole = self.first_word, self.first_target, self.root, self.others, self.whole
        for at, word in enumerate(ids, offset + 1):
            while state:
                if first_word[state] == word:
                    state = first_target[state]
                    length += 1
                    break
                target = others.get(state << 32 | word)
                if target:
                    state = target
                    length += 1
                    break
                state = link[state]
                length = lengths[state]
            else:
                state = root[word]
                length = 1 if state else 0
            if length >= window:
                tops.add(top[state])
                found.append((at - window, at))
            up = short[state]
            while up:
                for size, item in whole[up]:
                    if size <= length:
                        items.add(item)
                        found.append((at - size, at))
                up = short[link[up]]


def _merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _without(text: bytes, words: list[bytes], spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each span."""
    plain = text.translate(WORD_TABLE)
    places, at = [], 0
    for word in words:
        at = plain.index(word, at)
        places.append(at)
        at += len(word)
    out, done = [], 0
    for start, end in spans:
        out.append(text[done : places[start]])
        done = places[end - 1] + len(words[end - 1])
    return b"".join([*out, text[done:]])


def _built(items: DataFrame, window: int, most_states: int) -> tuple[DataFrame, int]:
    """``(part, packed)``: matchers over items of at most ``most_states`` states, and their number.

    Items are dealt by a hash of their id, by words in all; a word makes two states at most. Each
    matcher is built in a task of its own.
    """
    sized = items.where("text IS NOT NULL").withColumn("words", F.expr("octet_length(text) div 2 + 1"))
    most = sized.agg(F.sum("words")).first()[0] or 0
    # A word has a letter and a blank at least; most have more, so this is on the safe side.
    parts = max(1, -(-2 * most // most_states))

    def build(table: pa.Table) -> pa.Table:
        pairs = zip(table.column("item").to_pylist(), table.column("text").to_pylist(), strict=True)
        words = sorted(((str(item), item, words_of(text)) for item, text in pairs), key=lambda r: (r[0], r[2]))
        packed = Matcher.pack(SuffixAutomaton([(item, own) for _, item, own in words]), window)
        return pa.table({"packed": pa.array([pickle.dumps(packed)], pa.binary())})

    dealt = sized.select("item", "text", F.pmod(F.xxhash64("item"), F.lit(parts)).alias("part"))
    return dealt.groupBy("part").applyInArrow(build, "packed binary"), parts


_MARKS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    most_states: int = 1 << 22,
    clean_text: str | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` and ``items`` of benchmark text found.

    A window is ``window`` consecutive words of an item, or a whole shorter item. The words of
    each document run through a generalised suffix automaton that tracks the longest match;
    ``spans`` are the ``[start, end)`` word intervals inside windows, ``n_hit`` their words,
    ``items`` the ids, as sorted strings, of all items with a window in the document.
    ``clean_text`` names a column for the text without the spans.

    Columns of ``docs`` with these names are replaced; others pass through. Null texts have no
    words, and null or wordless items match nothing; items that repeat an id count once.

    Tasks build the automata, each of at most ``most_states`` states by the bytes of its items (or
    one item), as flat arrays in the shared folder. A larger benchmark is dealt by id to several,
    and the documents pass one after another, written in between, so that a worker holds one at
    a time. The driver hands them on one at a time and never builds or keeps any.
    """
    spark = docs.sparkSession
    added = ["n_words", "n_hit", "spans", "items", *([clean_text] if clean_text else [])]
    kept = [c for c in docs.columns if c not in added]
    # Columns go by numbers meanwhile, whatever they are called.
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(f"`{text}`").cast("binary").alias("text"))
    items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).cast("binary").alias("text"))
    built, parts = _built(items, window, most_states)
    matchers = Stage(built)
    before = None
    found = matchers.df.toLocalIterator()
    empty = {**Matcher.pack(SuffixAutomaton([]), window)}
    packed = next(found, None)
    number = 0
    while True:
        following = next(found, None) if packed is not None else None
        content = bytes(packed["packed"]) if packed is not None else pickle.dumps(empty)
        shared = spark.sparkContext.broadcast(content)  # bounded by most_states
        rows = _pass(rows, shared, number > 0, clean_text is not None and following is None)
        if following is None:
            break
        written = Stage(rows)
        if before:
            before.drop()
        rows, before, packed, number = written.df, written, following, number + 1
    matchers.drop()
    spans = F.transform("spans", lambda s: F.struct(s[0].alias("start"), s[1].alias("end")))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    out = [
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)),
        F.col("n_words"),
        n_hit.alias("n_hit"),
        spans.alias("spans"),
        F.array_sort("items").alias("items"),
    ]
    if clean_text:
        whole = F.col(f"c{kept.index(text)}") if text in kept else F.col("text").cast("string")
        out.append(F.when(F.size("spans") > 0, F.col("clean").cast("string")).otherwise(whole).alias(clean_text))
    return rows.select(*out)


def _pass(rows: DataFrame, packed, again: bool, clean: bool) -> DataFrame:
    """``rows`` with the marks of one matcher, added to those of earlier ones."""
    fields = [f for f in rows.schema.fields if f.name not in _MARKS.names]
    schema = T.StructType([*fields, *_MARKS.fields, *([T.StructField("clean", T.BinaryType())] if clean else [])])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(pickle.loads(packed.value))
        for batch in batches:
            earlier = zip(*(batch.column(c).to_pylist() for c in ("spans", "items")), strict=True) if again else repeat(([], []))
            counts, spans, items, cleaned = [], [], [], []
            for content, (old_spans, old_items) in zip(byte_texts(batch.column("text")), earlier, strict=False):
                words = words_of(content)
                new, hit = matcher.match(words)
                marks = _merged([*new, *map(tuple, old_spans)]) if old_spans else new
                counts.append(len(words))
                spans.append([list(s) for s in marks])
                items.append([*old_items, *hit])
                if clean:
                    cleaned.append(_without(content, words, marks) if marks else None)
            made = [
                pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                pa.array(items, pa.list_(pa.string())),
                *([pa.array(cleaned, pa.binary())] if clean else []),
            ]
            yield pa.record_batch([*(batch.column(n) for n in names), *made], names=schema.names)

    return rows.mapInArrow(run, schema)


def remove_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    max_span: int = 0,
    max_coverage: float = 0.5,
    **options,
) -> DataFrame:
    """``docs`` cleaned of benchmark text, same columns.

    A document with a span of more than ``max_span`` words loses its spans; one with more than
    ``max_coverage`` of its words in spans goes as a whole. Others stay as they are, null and empty
    texts too; rows that repeat are treated alike. Columns may have any names.
    """
    # Every column by number, so that none is in the way of the marks.
    numbered = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    own = f"c{docs.columns.index(text)}"
    marked = find_contamination(numbered, benchmark, text=own, clean_text="cleaned", **options)
    longest = F.coalesce(F.array_max(F.transform("spans", lambda s: s["end"] - s["start"])), F.lit(0))
    stays = F.col("n_hit") <= F.col("n_words") * max_coverage
    changed = F.when(longest > max_span, F.col("cleaned")).otherwise(F.col(own))
    columns = [changed.alias(c) if c == text else F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return marked.where(stays).select(*columns)
