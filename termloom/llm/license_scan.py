"""Licence texts in documents, by a positional index of rare licence words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.decontaminate import words_of
from termloom.llm.staging import byte_texts

# Phrases that name a licence, with its label. Every place of them counts.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Passages of public licences, as (label, passage, mandatory key phrases of it).
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software",
        ["hereby granted free of charge", "to deal in the software without restriction"],
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        ["apache license version 2 0"],
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version",
        ["gnu general public license"],
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
        ["gnu lesser general public license"],
    ),
    (
        "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation",
        ["gnu affero general public license"],
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright notice",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ["for any purpose with or without fee is hereby granted"],
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ["mozilla public license"],
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("epl", "made available under the terms of the Eclipse Public License 2.0", ["eclipse public license"]),
    ("apache", "Licensed under the Apache-2.0 license", ["apache 2 0"]),
    ("apache", "SPDX-License-Identifier: Apache-2.0", ["spdx license identifier apache 2 0"]),
    ("mit", "SPDX-License-Identifier: MIT", ["spdx license identifier mit"]),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause", ["spdx license identifier bsd"]),
    ("isc", "SPDX-License-Identifier: ISC", ["spdx license identifier isc"]),
    ("mpl", "SPDX-License-Identifier: MPL-2.0", ["spdx license identifier mpl 2 0"]),
    ("epl", "SPDX-License-Identifier: EPL-2.0", ["spdx license identifier epl 2 0"]),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later", ["spdx license identifier gpl"]),
    ("lgpl", "SPDX-License-Identifier: LGPL-3.0-or-later", ["spdx license identifier lgpl"]),
    ("agpl", "SPDX-License-Identifier: AGPL-3.0-or-later", ["spdx license identifier agpl"]),
    ("unlicense", "SPDX-License-Identifier: Unlicense", ["spdx license identifier unlicense"]),
    ("gpl", "licensed under the GNU GPL v3", ["gnu gpl"]),
    ("lgpl", "licensed under the GNU LGPL v3", ["gnu lgpl"]),
    ("agpl", "licensed under the GNU AGPL v3", ["gnu agpl"]),
]

# The six licences of one family, by what follows "Creative Commons" and "CC".
CREATIVE_COMMONS = {
    "cc-by": ("Attribution", "BY"),
    "cc-by-sa": ("Attribution-ShareAlike", "BY-SA"),
    "cc-by-nd": ("Attribution-NoDerivatives", "BY-ND"),
    "cc-by-nc": ("Attribution-NonCommercial", "BY-NC"),
    "cc-by-nc-sa": ("Attribution-NonCommercial-ShareAlike", "BY-NC-SA"),
    "cc-by-nc-nd": ("Attribution-NonCommercial-NoDerivatives", "BY-NC-ND"),
}
# Other ways to write a word of these names, and words that make another licence of a name.
SPELLINGS = {"NonCommercial": "Non-Commercial", "ShareAlike": "Share Alike", "NoDerivatives": "NoDerivs"}
QUALIFIERS = {
    "cc-": ["noncommercial", "non", "sharealike", "share", "noderivatives", "noderivs", "no", "nc", "sa", "nd"],
    "mit": ["0"],
}
for _label, (_name, _short) in CREATIVE_COMMONS.items():
    _other = _name
    for _word, _spelling in SPELLINGS.items():
        _other = _other.replace(_word, _spelling)
    for _written in dict.fromkeys((_name, _other)):
        _phrase = "creative commons " + _written.lower().replace("-", " ")
        TEMPLATES.append((_label, f"licensed under a Creative Commons {_written} 4.0 International License", [_phrase]))
    # The two letters alone are no licence: "under" or a version must stand beside them.
    _phrase = "cc " + _short.lower().replace("-", " ")
    TEMPLATES.append((_label, f"licensed under CC {_short}", [f"under {_phrase}"]))
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        TEMPLATES.append((_label, f"CC {_short} {_version}", [f"{_phrase} {_version.replace('.', ' ')}"]))


@dataclass
class Template:
    """A passage as word ids; ``phrases`` are its mandatory ones as (offset, ids)."""

    label: str
    ids: np.ndarray
    phrases: list[tuple[int, np.ndarray]]
    #: Rare words of the passage: id to places in it.
    anchors: dict[int, list[int]] = field(default_factory=dict)
    #: Words that must not follow the last phrase, as they make it the name of another licence.
    qualifiers: frozenset[int] = frozenset()


class LicenseIndex:
    """The positional index: rare words of all templates with their postings."""

    def __init__(self, document_counts: dict[str, int], documents: int, *, anchors: int = 6, slack: int = 3):
        texts = [*((label, phrase, [phrase]) for phrase, label in BASE_PHRASES.items()), *TEMPLATES]
        self.slack = slack
        self.vocabulary: dict[bytes, int] = {}
        qualifying = [" ".join(words) for words in QUALIFIERS.values()]
        for passage in [*(passage for _, passage, _ in texts), *qualifying]:
            for word in words_of(passage.encode()):
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        idf = {
            number: (np.log((documents + 1) / (document_counts.get(word.decode(), 0) + 1)), word)
            for word, number in self.vocabulary.items()
        }
        self.templates, self.base = [], len(BASE_PHRASES)
        for at, (label, passage, phrases) in enumerate(texts):
            ids = self._ids(words_of(passage.encode()))
            found = []
            for phrase in phrases:
                own = self._ids(words_of(phrase.encode()))
                offset = next(i for i in range(len(ids)) if np.array_equal(ids[i : i + len(own)], own))
                found.append((offset, own))
            rare = sorted(set(ids.tolist()), key=lambda n: (-idf[n][0], idf[n][1]))[: 1 if at < self.base else anchors]
            postings = {n: np.flatnonzero(ids == n).tolist() for n in rare}
            others = [w for start, words in QUALIFIERS.items() if at >= self.base and label.startswith(start) for w in words]
            not_after = frozenset(self.vocabulary[w.encode()] for w in others)
            self.templates.append(Template(label, ids, found, postings, not_after))
        rare_ids = {n for t in self.templates for n in t.anchors}
        self.rare = frozenset(w for w, n in self.vocabulary.items() if n in rare_ids)

    def _ids(self, words: list[bytes]) -> np.ndarray:
        return np.array([self.vocabulary.get(w, 0) for w in words], dtype=np.int32)

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str], set[str], float]:
        """Places of base phrases, base labels, all labels, and the best match's share."""
        places: list[int] = []
        base: set[str] = set()
        labels: set[str] = set()
        best = 0.0
        if self.rare.isdisjoint(words):
            return places, base, labels, best
        ids = self._ids(words)
        at = np.flatnonzero(ids)
        by_word = dict.fromkeys(ids[at].tolist())
        for number in by_word:
            by_word[number] = at[ids[at] == number]
        names: list[tuple[int, int, Template, int]] = []
        for n, template in enumerate(self.templates):
            starts = self._alignments(template, by_word, exact=n < self.base)
            if not len(starts):
                continue
            right, ends = self._verified(template, starts, ids, by_word, 0 if n < self.base else self.slack)
            if n < self.base:
                if right.any():
                    base.add(template.label)
                    labels.add(template.label)
                    places += starts[right].tolist()
                    best = 1.0
                continue
            size = len(template.phrases[-1][1])
            names += [(end - size, end, template, start) for start, end in zip(starts[right].tolist(), ends[right].tolist(), strict=True)]
        # Of key phrases that lie in one another the longest tells the licence.
        for low, high, template, start in names:
            if any(a <= low and high <= b and b - a > high - low and other.label != template.label for a, b, other, _ in names):
                continue
            labels.add(template.label)
            best = max(best, self._share(template, start, ids))
        return places, base, labels, best

    def _alignments(self, template: Template, by_word: dict, exact: bool) -> np.ndarray:
        """Where the template may start: relative places on which its rare words agree."""
        votes = [by_word[n] - q for n, places in template.anchors.items() if n in by_word for q in places]
        if not votes:
            return np.zeros(0, dtype=np.int64)
        if exact or len(template.anchors) == 1:
            return np.unique(np.concatenate(votes))
        starts = np.concatenate(votes)
        word = np.repeat(np.arange(len(votes)), [len(v) for v in votes])
        order = np.argsort(starts, kind="stable")
        starts, word = starts[order], word[order]
        low = np.searchsorted(starts, starts - self.slack, side="left")
        high = np.searchsorted(starts, starts + self.slack, side="right")
        need = min(2, len(template.anchors))
        agreed = [i for i in np.flatnonzero(high - low >= need) if len(set(word[low[i] : high[i]].tolist())) >= need]
        return np.unique(starts[agreed])

    def _verified(self, template: Template, starts: np.ndarray, ids: np.ndarray, by_word: dict, slack: int) -> tuple[np.ndarray, np.ndarray]:
        """Which starts have every mandatory phrase at its place, give or take ``slack`` words,
        and where the last phrase ends."""
        right, ends = np.ones(len(starts), dtype=bool), np.zeros(len(starts), dtype=np.int64)
        for offset, phrase in template.phrases:
            rarest = min(range(len(phrase)), key=lambda i: len(by_word.get(int(phrase[i]), ())))
            first = by_word.get(int(phrase[rarest]), np.zeros(0, dtype=np.int64)) - rarest
            first = first[(first >= 0) & (first + len(phrase) <= len(ids))]
            whole = np.ones(len(first), dtype=bool)
            for i, number in enumerate(phrase):
                whole &= ids[first + i] == number
            if template.qualifiers:
                after = np.minimum(first + len(phrase), len(ids) - 1)
                qualified = np.isin(ids[after], list(template.qualifiers)) & (first + len(phrase) < len(ids))
                whole &= ~qualified
            first = first[whole]
            low = np.searchsorted(first, starts + offset - slack, side="left")
            found = np.searchsorted(first, starts + offset + slack, side="right") > low
            if found.any():
                ends[found] = first[low[found]] + len(phrase)
            right &= found
        return right, ends

    def _share(self, template: Template, start: int, ids: np.ndarray) -> float:
        """The part of the template's words that stand near their places."""
        begin = max(0, start - self.slack)
        near = ids[begin : start + len(template.ids) + self.slack]
        hits = 0
        for i, number in enumerate(template.ids.tolist()):
            low = max(0, start + i - self.slack - begin)
            hits += number in near[low : max(0, start + i + self.slack + 1 - begin)]
        return hits / len(template.ids)


def _document_counts(docs: DataFrame, text: str) -> tuple[dict[str, int], int]:
    """In how many documents each licence word stands; one row a word and task is shuffled."""
    vocabulary = frozenset(LicenseIndex({}, 0).vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = dict.fromkeys(vocabulary, 0)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for content in byte_texts(batch.column(0)):
                for word in vocabulary.intersection(words_of(content)):
                    counts[word] += 1
        has = {w.decode(): n for w, n in counts.items() if n} | {"": rows}
        yield pa.record_batch([pa.array(list(has)), pa.array(list(has.values()), pa.int64())], ["word", "n"])

    counted = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "word string, n bigint")
    found = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found, found.pop("", 0)


def scan_licenses(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, base_places, base_labels, labels, score)`` of every row.

    A document's words that are among the rarest of a template (by their document frequency in
    all of ``docs``) are looked up in the index; places of different words of a template that
    agree on where it starts make a candidate, and a candidate counts if the template's key
    phrases stand where they must, are not continued by a word that makes another licence of
    them, and do not lie in a longer key phrase of another licence. Base phrases are templates of their own with one rare word
    and no slack, so every place of them is found. ``base_places`` are the words they start at,
    from 0; ``score`` is 1 with a base phrase, else the largest part of a template matched.
    Null and empty texts have no words and score 0. The index is a few hundred words.
    """
    index = LicenseIndex(*_document_counts(docs, text))
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for content in byte_texts(batch.column(1)):
                words = words_of(content)
                counts.append(len(words))
                found.append(shared.value.scan(words))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array([sorted(f[0]) for f in found], pa.list_(pa.int64())),
                    pa.array([sorted(f[1]) for f in found], pa.list_(pa.string())),
                    pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
                    pa.array([f[3] for f in found], pa.float64()),
                ],
                ["doc_id", "n_words", "base_places", "base_labels", "labels", "score"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, base_places array<bigint>, base_labels array<string>, labels array<string>, score double"
    return rows.mapInArrow(run, schema)
