"""Byte-level BPE against the library, word by word and text by text."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
from placestats.llm.bpe import _from_blocks, _to_blocks, decode_ids, encode, heap_encode, load_ranks, mergeable, rank_table, split_pattern

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
RANKS = load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})

TEXTS = [
    None, "", " ", "  ", "\n", "a", "Hello, world!", "It's  we'll\n\n ok ", "日本語 テキスト 🙂🙂 ñandú", "x" * 300 + " y", "\x00\x1c é　z\x1c a", "a" * 128, "a" * 129,
    "٣٤ १२ ½", "tab\tand space ", " lead", "trail ", "é ü", "<|endoftext|>", "the " * 4000, "same", "same", "of  it", "'s 't'd",
]


def words(rng):
    letters = ["a", "e", "n", "t", " ", "é", "日", "🙂", "0", "!", "\n", "ß", "Ж"]
    return "".join(rng.choice(letters) for _ in range(rng.randrange(1, 40)))


def test_rank_table():
    pairs = mergeable(RANKS)
    slots, bits = rank_table(pairs)
    assert sorted(e for e in slots if e >= 0) == sorted(p * 65536 + n for p, n in pairs.items()) and len(slots) == 1 << bits


@pytest.mark.parametrize("text", [t for t in TEXTS if t])
def test_split_and_heap(text):
    parts = [m[0].encode() for m in split_pattern(PATTERN).finditer(text)]
    assert b"".join(parts) == text.encode()
    assert [i for p in parts for i in heap_encode(p, RANKS)] == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("block", [1, 50, 1 << 20])
def test_texts(spark, block):
    rng = random.Random(block)
    texts = TEXTS + [words(rng) for _ in range(100)]
    df = spark.createDataFrame([(i if i != 5 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    df = df.withColumn("IDS", F.lit("old")).withColumn("rows", F.lit(1)).withColumn("words", F.array(F.lit(2)))
    out = encode(df.repartition(2), PATH, PATTERN, block=block)
    assert out.columns == ["doc_id", "text", "rows", "words", "ids"]
    got = out.withColumn("back", decode_ids(F.col("ids"), RANKS)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == LIBRARY.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()


def test_unknown_ids(spark):
    df = spark.createDataFrame([([0, 70_000],), ([-1],), ([],)], "ids array<int>")
    assert [r.b for r in df.select(decode_ids(F.col("ids"), RANKS).alias("b")).collect()] == [None, None, b""]


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    want = []
    for d in docs:
        ids = LIBRARY.encode_ordinary(d["text"] or "")
        want.append((d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((d["text"] or "").encode()).hexdigest()))
    got = entry.queries()["op3_byte_bpe"](spark, folder)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == sorted(want)


def test_empty(spark):
    assert encode(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN).count() == 0


@pytest.mark.parametrize("kept", [0, 8, 1000])
def test_a_task_folds_a_word_once(kept):
    """Blocks bring new words only, until a new run begins; ids and decoded bytes stay right."""
    rng = random.Random(kept)
    texts = [t or "" for t in TEXTS] + [words(rng) for _ in range(50)] + ["same, of the same. 'tis x-ray's end!\"" + "z" * 200]
    batch = pa.record_batch([pa.array(range(2 * len(texts))), pa.array(texts * 2)], ["doc_id", "text"])
    ahead = pa.array([b" the", b"same", b","], pa.binary())
    blocks = list(_to_blocks(PATTERN, PATH, 400, ahead, kept)(iter([batch.slice(0, 30), batch.slice(30)])))
    encoded, runs = [], []
    for b in blocks:
        if b.column("fresh")[0].as_py() or not runs:
            runs.append([])
        new = [bytes(w) for w in b.column("words")[0].as_py()]
        runs[-1] += new
        ids = [LIBRARY.encode_ordinary(w.decode()) for w in new] + b.column("long_ids")[0].as_py()
        kept_columns = ["serial", "fresh", "rows", "word_index", "word_counts"]
        encoded.append(pa.record_batch([*map(b.column, kept_columns), pa.array([ids], pa.list_(pa.list_(pa.int32())))], [*kept_columns, "ids"]))
    assert len(blocks) > 5 and (len(runs) == 1) == (kept == 1000)
    assert all(len(run) == len(set(run)) and not {b" the", b"same", b","} & set(run) for run in runs)
    first = [LIBRARY.encode_ordinary(w.decode()) for w in ahead.to_pylist()]
    flat, bounds = np.concatenate(first).astype(np.int32), np.cumsum([0, *map(len, first)])
    fields = [("ids", pa.list_(pa.int32())), ("back", pa.binary())]
    out = pa.Table.from_batches(_from_blocks(lambda ids, data: [ids, bytes(data)], fields, flat, bounds, PATH)(iter(encoded))).to_pylist()
    assert [(r["doc_id"], r["ids"], r["back"]) for r in out] == [(i, LIBRARY.encode_ordinary(t), t.encode()) for i, t in enumerate(texts * 2)]
