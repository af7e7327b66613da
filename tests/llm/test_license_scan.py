import random
import re

import pytest
from pyspark.sql import functions as F

from termloom.llm.license_scan import BASE_PHRASES, TEMPLATES, scan_licenses
from termloom.llm.queries import op3_license_scan

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in BASE_PHRASES.items():
        own = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += found
        labels |= {label} if found else set()
    return len(words), sorted(places), sorted(labels)


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op3_license_scan(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, places, labels = plain(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(places), ",".join(labels))
        assert (r["first_word"], r["last_word"]) == ((places[0], places[-1]) if places else (None, None))
        assert set(labels) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(r["labels"])
    assert any(r["n_base"] for r in rows)


def test_templates_are_found_and_near_misses_are_not(spark):
    rows = [(i, "Some words first. " + passage + ". Some words after") for i, (_, passage, _) in enumerate(TEMPLATES)]
    rows += [
        (100, "the license of this software and the public domain, free of charge to any person"),
        (101, None), (102, ""), (103, "MIT license mit LICENSE general public license apache-license"),
        (104, "Permission is very hereby granted, free of charge, to just any person wanting to deal in the Software without "
              "restriction, including the rights"),
        (105, "word " * 60_000 + "mit license"), (105, "mit license"),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumns({"labels": F.lit(1), "score": F.lit(2)})
    got = {}
    for r in scan_licenses(docs).collect():
        got.setdefault(r["doc_id"], r)
        assert (r["n_words"], r["base_places"], r["base_labels"]) in [plain(t) for d, t in rows if d == r["doc_id"]]
    for i, (label, _, _) in enumerate(TEMPLATES):
        assert label in got[i]["labels"] and got[i]["score"] >= 0.99
    assert [got[i]["labels"] for i in (100, 101, 102)] == [[], [], []] and got[101]["score"] == 0
    assert got[103]["base_places"] == [0, 2, 4, 7] and got[103]["labels"] == ["apache", "gpl", "mit"]
    assert got[105]["labels"] == ["mit"]
    assert scan_licenses(docs.limit(0)).count() == 0


@pytest.mark.parametrize("label", sorted({label for label, _, _ in TEMPLATES}))
def test_key_phrases_are_in_their_passages(label):
    for own, passage, phrases in TEMPLATES:
        text = " ".join(WORD.findall(passage.lower()))
        assert own != label or all(f" {p} " in f" {text} " for p in phrases)


NAMED = {
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International": "cc-by-nc-sa",
    "under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.": "cc-by-nc-nd",
    "Creative Commons Attribution-NoDerivatives 4.0 International": "cc-by-nd",
    "Creative Commons Attribution-NoDerivs 4.0": "cc-by-nd",
    "Creative Commons Attribution Non-Commercial Share Alike 4.0": "cc-by-nc-sa",
    "Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
    "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa",
    "licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "CC BY-NC-ND 4.0": "cc-by-nc-nd", "CC BY-NC-SA 4.0": "cc-by-nc-sa", "CC BY-ND 4.0": "cc-by-nd", "CC BY-NC 4.0": "cc-by-nc",
    "CC BY-SA 4.0": "cc-by-sa", "licensed under CC BY 4.0": "cc-by", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: MIT-0": "", "SPDX-License-Identifier: CC-BY-NC-4.0": "cc-by-nc",
    "SPDX-License-Identifier: Apache-2.0": "apache", "SPDX-License-Identifier: LGPL-2.1-only": "lgpl",
    "Licensed under the Apache-2.0 license": "apache", "GNU GPL v3": "gpl", "GNU LGPL v3": "lgpl", "Eclipse Public License 2.0": "epl",
    "a cc by mail of a non commercial kind": "", "creative commons": "", "attribution 4.0 international": "",
}


def test_licences_that_exclude_each_other(spark):
    rng = random.Random(14)
    words = ["of", "the", "tion", "text", "license", "open"]
    rows = [(i, f"{' '.join(rng.choices(words[:3], k=n))}. {name}; {' '.join(rng.choices(words[:3], k=9))}") for n in (0, 7) for i, name in enumerate(NAMED)]
    rows += [(i, name) for i, name in enumerate(NAMED)]
    want = list(NAMED.values())
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for r in scan_licenses(docs).collect():
        assert (r["doc_id"], ",".join(r["labels"])) == (r["doc_id"], want[r["doc_id"]])
    # No two of these licences are taken for one another, whatever surrounds their passages.
    passages = [(label, passage) for label, passage, _ in TEMPLATES if label.startswith("cc-")]
    mixed = [(i, f"{' '.join(rng.choices(words, k=12))} | {passage} | {' '.join(rng.choices(words, k=12))}") for i, (_, passage) in enumerate(passages)]
    for r in scan_licenses(spark.createDataFrame(mixed, "doc_id int, text string")).collect():
        assert r["labels"] == [passages[r["doc_id"]][0]]
