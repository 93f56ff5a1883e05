"""License scan: base places against plain Python, suppression against all pairs, rules by example."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placestats.llm.license_rules import ALL
from placestats.llm.licenses import candidates, detect, scan_licenses, summary, suppressed, words_of

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(text):
    """n_words, places of base phrases, base labels."""
    words = plain_words(text)
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i : i + phrase.count(" ") + 1] == phrase.split()]
    return len(words), sorted(i for i, _ in places), sorted({label for _, label in places})


def labels(text):
    return {f["label"] for f in detect(text.encode())["found"]}


EXAMPLES = {
    "Licensed under the Apache License, Version 2.0.": {"apache", "apache-2.0"},
    "Released under the MIT License.": {"mit"},
    "This work is licensed under the GNU General Public License, version 3.": {"gpl", "gpl-3.0"},
    "GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version": {"gpl", "gpl-2.0-or-later"},
    "Licensed under CC BY-NC 4.0.": {"cc-by", "cc-by-nc-4.0"},
    "CC-BY-SA": {"cc-by", "cc-by-sa"},
    "SPDX-License-Identifier: BSD-3-Clause": {"bsd-3-clause"},
    "SPDX-License-Identifier: GPL-2.0-or-later": {"gpl-2.0-or-later"},
    "GNU Lesser General Public License v2.1": {"lgpl-2.1"},
    "the GNU Affero General Public License": {"agpl"},
    "https://creativecommons.org/licenses/by-nc-sa/4.0/": {"cc-by-nc-sa-4.0"},
    "Copyright 2020. All rights reserved.": {"proprietary"},
    "sous licence publique générale GNU": {"gpl"},
    "mit der Lizenz, gplx, maccby": set(),
}


@pytest.mark.parametrize("text", EXAMPLES)
def test_examples(text):
    assert labels(text) == EXAMPLES[text]


def test_rules():
    assert len(ALL) >= 250
    assert sum(r.base for r in ALL) == 4
    # a keyword is part of every text its rule matches, as far as the examples show
    for text in EXAMPLES:
        words = words_of(text.encode())
        tried = {r.number for r in candidates(words)}
        assert {r.number for r in ALL if r.pattern.search(words)} <= tried


def plain_suppressed(found):
    order = [(r.level, r.number) for r, _, _ in found]
    covers = lambda a, b: found[a][1] <= found[b][1] and found[a][2] >= found[b][2]
    wins = lambda a, b: found[a][1:] != found[b][1:] or order[a] < order[b]
    return [any(a != b and order[a][0] <= order[b][0] and covers(a, b) and wins(a, b) for a in range(len(found))) for b in range(len(found))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ALL), st.integers(0, 12), st.integers(0, 5)), max_size=25, unique_by=lambda t: (t[0].number, t[1])))
def test_suppression(drawn):
    found = sorted(((r, a, a + n) for r, a, n in drawn), key=lambda f: (f[1], -f[2], f[0].level, f[0].number))
    assert suppressed(found) == plain_suppressed(found)


PIECES = ["mit license", "Apache", "LICENSE", "gnu general public", "license", "cc", "BY", "by-nc 4.0", "é", "ß", "\n", ",", "x", "3", "gnu general public license version 3 only"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30))
def test_base_places(parts):
    text = " ".join(parts)
    got = detect(text.encode())
    base = [f for f in got["found"] if f["base"]]
    assert (got["n_words"], sorted(f["first"] for f in base), sorted({f["label"] for f in base})) == plain(text)
    words = plain_words(text)
    assert all(f["text"] == " ".join(words[f["first"] : f["last"] + 1]) for f in got["found"])


def test_table(spark):
    long = "word " * 300_000 + "MIT license " + "cc by " * 20_000
    texts = [(1, None), (2, ""), (3, "!!! ..."), (4, "Released under the MIT License."), (4, "Released under the MIT License."), (None, "cc by"), (6, long), (7, "İ mit LICENSE ÀB")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("scan", F.lit(1)).withColumn("Scan_", F.lit(2)).withColumn("N_words", F.lit(3)).withColumn("found", F.lit(4))
    scanned = scan_licenses(df)
    assert scanned.columns == ["doc_id", "text", "scan", "Scan_", "found", "n_words", "detections"]
    got = sorted((tuple(r) for r in summary(scanned).collect()), key=repr)
    expected = []
    for i, text in texts:
        n, places, base = plain(text)
        found = detect((text or "").encode())["found"]
        expected.append((i, n, len(places), min(places, default=None), max(places, default=None), ",".join(base), ",".join(sorted({f["label"] for f in found})), max((f["score"] for f in found), default=0.0)))
    assert got == sorted(expected, key=repr)
    assert summary(scan_licenses(df.limit(0))).count() == 0
