"""Packing: ids against the library, places without gaps or overlaps, few sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from placestats.llm.packing import best_fit, linear_groups, pack, pieces_of, places, plan, token_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")


def contents(runs):
    out = Counter()
    for run in runs:
        for length, copies in run.pieces:
            out[length] += copies * run.count
    return out


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_everything(seed):
    rng = random.Random(seed)
    counts = Counter(min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(rng.choice([1, 20, 3000])))
    runs = plan(counts, 100, groups=10)
    assert contents(runs) == counts
    assert all(0 <= r.room == 100 - sum(a * b for a, b in r.pieces) for r in runs)
    used = sum(k * v for k, v in counts.items())
    assert sum(r.count for r in runs) <= sum(r.count for r in best_fit([], counts, 100))
    assert sum(r.count for r in runs) <= 1.1 * used / 100 + 1


def test_configurations_beat_best_fit():
    counts = {46: 60, 21: 120, 12: 120}  # 46+21+21+12 fills a sequence; best fit pairs the large ones
    runs = plan(counts, 100, groups=8, small=(0.1,))
    assert contents(runs) == Counter(counts)
    assert sum(r.count for r in runs) <= sum(r.count for r in best_fit([], counts, 100))


def test_groups_have_equal_cardinality():
    groups = linear_groups({k: 10 for k in range(1, 101)}, 10)
    assert [sum(n for _, n in g) for g in groups] == [100] * 10
    assert groups[0][0][0] == 100 and groups[-1][-1][0] == 1


def test_bad_lengths():
    with pytest.raises(ValueError):
        plan({0: 1})


@pytest.mark.parametrize("total,want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)])])
def test_pieces(total, want):
    assert pieces_of(total, 8) == want


def test_places_are_a_bijection():
    counts = Counter(random.Random(4).choices(range(1, 65), k=500))
    runs = plan(counts, 64, groups=6)
    seen = set()
    for length, table in places(runs).items():
        for rank in range(counts[length]):
            row = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
            inside = rank - row[0]
            sequence, offset = row[1] + inside // row[2], row[3] + inside % row[2] * length
            cells = {(sequence, offset + i) for i in range(length)}
            assert not seen & cells
            seen |= cells
    assert len(seen) == sum(k * v for k, v in counts.items())


TEXTS = [
    None, "", " ", "a", "It's  a\n\n test ", "word " * 3000, "é日本 🙂 <|endoftext|>", "x" * 9000, "same text", "same text",
    "tab\tand\x1c odd　space", "The quick brown fox's 12345 jumps, again!",
]


def test_pack(spark):
    rows = [(i if i != 4 else None, t) for i, t in enumerate(TEXTS)] + [(8, "same text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("LENGTH", F.lit(1)).withColumn("task", F.lit("x"))
    got = pack(df.repartition(3), PATH).collect()
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, (start, length) in enumerate(pieces_of(len(ids), 2048)):
            want[i, piece, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(r.length for r in got)
    assert len(by) <= -(-used // 2048) + 2


def test_long_runs_of_white_space(spark):
    """The faster library gives up on these; the ids are those of the other."""
    texts = [c * 2_000_000 for c in (" ", "\n", "\t")] + ["word " * 10 + " " * 1_500_000 + "end"]
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for i, t in enumerate(texts):
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        want.update((i, piece, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())) for piece, (start, length) in enumerate(pieces_of(len(ids), 2048)))
    got = pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in got) == want


def test_other_tokenizer_files():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    assert token_bytes(path, 7)("Some text here") == np.array([*tok.encode("Some text here", add_special_tokens=False).ids, 7], "<u4").tobytes()


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>  y\n", "<|endoftext|><|endoftext|>z", "no such <|endoftext|", "plain words 12", "é <|endoftext|>" * 900]


def test_added_tokens_have_the_ids_of_the_library(spark, tmp_path):
    tok = Tokenizer.from_file(PATH)
    want = {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(ADDED)}
    assert want[0] == [64, 220, 50256, 275, 0]
    encode = token_bytes(PATH, 0, added_tokens=True)
    assert all(np.frombuffer(encode(t), "<u4").tolist() == want[i] for i, t in enumerate(ADDED))
    spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    pieces = {(i, p, a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for i, ids in want.items() for p, (a, n) in enumerate(pieces_of(len(ids), 2048))}
    stage = corpus_pipeline.packed(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    for found in (entry.queries()["op2_best_fit_packing"](spark, str(tmp_path)), stage):
        assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found.collect()} == pieces
