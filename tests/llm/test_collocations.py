"""Collocations against plain Python, with true and with forced collisions of fingerprints."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placestats.llm import collocations as module
from placestats.llm.collocations import BITS, LONGEST, collocations, count_block, cut_chunks, frequent_bitmap, same_bytes, scaled_share


def plain_pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def plain(rows, least, top=2000):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in plain_pieces(text):
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    out = []
    for (lang, *words), a in found.items():
        k = len(words)
        longer = [b for (other, *w), b in found.items() if other == lang and len(w) > k and any(w[i : i + k] == words for i in range(len(w) - k + 1))]
        if any(100 * b >= 80 * a for b in longer):
            continue
        score, cut = min((2000000 * a // (f[lang, *words[:c]] + f[lang, *words[c:]]), c) for c in range(1, k))
        out.append((lang, " ".join(words), a, f[lang, *words[:cut]], f[lang, *words[cut:]], n[lang], score))
    ranked = []
    for lang in n:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(mine[:top], 1)]
    return sorted(ranked)


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


def prose(n=400):
    rng = np.random.default_rng(5)
    words = ["a", "b", "Cé", "dd", "d", "the", "of", "x"]
    seps = [" ", "  ", "\t", " \t ", ". ", ",", "\n", "?!", "\r\n"]
    odds = [0.5, 0.15, 0.1, 0.05, 0.05, 0.05, 0.04, 0.03, 0.03]
    rows = [("".join(w + s for w, s in zip(rng.choice(words, 30), rng.choice(seps, 30, p=odds))), ["en", "fr", None][i % 3]) for i in range(n)]
    return rows + [("new york city hall is here", "en")] * 40 + [("new york", "en")] * 60


@pytest.mark.parametrize("settings_", [{}, {"chunk": 7, "block": 50}, {"mask": 0xFF << (64 - 8), "block": 900, "chunk": 100}])
def test_against_plain_python(spark, settings_):
    rows = prose()
    expected = plain(rows, 30)
    assert len(expected) > 50 and {r[0] for r in expected} == {"en", "fr", "und"}
    got = collocations(frame(spark, rows), **settings_)
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert dict(got.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")}


def test_edges(spark):
    long = "same word " * 200_000
    rows = [(None, "en"), ("", "en"), (" .,; \t", None), (long, "de"), ("z" * 3_000_000 + " tail", "de"), ("İ A\x00B \x1fc", "en"), ("x y", None), ("x y", "und")]
    got = sorted(tuple(r) for r in collocations(frame(spark, rows), least=2).collect())
    assert got == plain(rows, 2)
    assert any(r[0] == "und" and r[2] == "x y" and r[3] == 2 for r in got)
    df = frame(spark, prose(60)).withColumn("print", F.lit(1)).withColumn("id", F.lit("x")).withColumn("body", F.lit("y")).withColumn("n", F.lit(2))
    assert sorted(tuple(r) for r in collocations(df, least=5, top=7).collect()) == plain(prose(60), 5, 7)
    assert collocations(df.limit(0)).collect() == []
    assert collocations(df, least=10**6).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab .\t\né", max_size=30), min_size=1, max_size=4), st.integers(1, 5))
def test_chunks_and_counts(texts, size):
    chunks = [(i, body, begins) for i, (body, begins) in enumerate(cut_chunks([t.encode() for t in texts], size))]
    pieces = [p for t in texts for p in plain_pieces(t)]
    assert sum(c[2] for c in chunks) == sum(map(len, pieces))
    for n in range(1, LONGEST + 1):
        for mask in ((1 << 64) - 1, 0):
            prints, counts, pointers = count_block(chunks, n, "en", None, mask)
            got = Counter()
            for count, pointer in zip(counts.tolist(), pointers.tolist()):
                words = re.split(rb"[ \n]", chunks[pointer >> 16][1])
                assert (pointer & 3) + 1 == n
                at = (pointer & 0xFFFF) >> 2
                got[b" ".join(words[at : at + n]).decode()] += count
            assert got == Counter(" ".join(p[i : i + n]) for p in pieces for i in range(len(p) - n + 1))


def test_equal_runs_share_a_fingerprint():
    one = count_block([(3, b"x y z", 3)], 2, "en", None)[0]
    two = count_block([(5, b"aaaa x y\nz", 4)], 2, "en", None)[0]
    assert len(set(one.tolist()) & set(two.tolist())) == 1
    assert not set(one.tolist()) & set(count_block([(3, b"x y z", 3)], 2, "fr", None)[0].tolist())


def test_same_bytes():
    body = np.frombuffer(b"abcabdxyzxyz", np.uint8)
    a, b, size = np.array([0, 0, 6, 6]), np.array([3, 3, 9, 9]), np.array([3, 2, 3, 1])
    for at_once in (1, 2, 3, 100):
        assert same_bytes(body, a, b, size, at_once).tolist() == [False, True, True, True]


def test_bitmap(spark):
    prints = [0, 1, -1, 1 << 62, -(1 << 63), (1 << 52) + 5, 123456 << 37, (32768 << (64 - BITS)) - 1, 32768 << (64 - BITS), 32767 << (64 - BITS)]
    bits = frequent_bitmap(spark.createDataFrame([(p,) for p in prints], "print long"))
    places = {(p & ((1 << 64) - 1)) >> (64 - BITS) for p in prints}
    assert {int(i) for i in np.flatnonzero(np.unpackbits(bits, bitorder="little"))} == places


def test_exact_arithmetic(spark):
    values = [(1, 3), (2**62 - 1, 2**63 - 1), (4611686018427387904, 2**63 - 1), (30, 60), (10**18, 3 * 10**18 + 1)]
    got = spark.createDataFrame(values, "a long, b long").select("a", "b", scaled_share(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.s for r in got] == [2000000 * r.a // r.b for r in got]


def test_words_take_few_bytes_a_byte():
    import tracemalloc

    body = np.frombuffer(b"some words of a text, and then some more of them\n" * 40_000, np.uint8)
    tracemalloc.start()
    words = module.Words(body)
    found = tracemalloc.get_traced_memory()[1]
    words.hashed()
    both = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words.piece.tolist()[:12] == [0] * 11 + [1]
    assert found < 12 * len(body) and both < 36 * len(body)


def test_texts_are_cut_in_blocks():
    texts = [("en", b"a b c d e"), ("de", b"x y"), ("en", b""), ("en", b"f. g")]
    blocks = list(module.cut_rows(texts, 3, block=10))
    assert [[(lang, begins) for lang, _, begins in b] for b in blocks] == [[("en", 3), ("en", 2), ("de", 2)], [("en", 2)]]
    assert list(module.cut_rows([], 3)) == [[]]
