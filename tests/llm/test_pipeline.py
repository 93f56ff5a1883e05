"""The pipeline against a plain Python version of its stages."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from placestats.llm.packing import pieces_of
from placestats.llm.pii import find
from placestats.llm.quality import from_moments, statistics
from placestats.llm.simhash import fingerprint_of
from placestats.session import materialize
from tests.llm.test_simhash import components

FOLDER = "/root/testdata/sf0.001"


def plain(folder):
    docs = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()}
    x = np.array([statistics(d["text"] or "") for d in docs])
    y = np.array([labels[d["doc_id"]] if d["doc_id"] in labels and zlib.crc32(str(d["doc_id"]).encode()) % 5 else -1 for d in docs])
    n = np.array([(y == k).sum() for k in (0, 1)], float)
    model = from_moments(n, np.array([x[y == k].sum(0) for k in (0, 1)]), np.array([x[y == k].T @ x[y == k] for k in (0, 1)]), 0.1, 0.01)
    good = [d for d, s in zip(docs, model.score(x)) if s >= corpus_pipeline.LEAST_QUALITY]
    exact = list({d["text"] or "": d for d in sorted(good, key=lambda d: d["doc_id"])}.values())
    exact.sort(key=lambda d: d["doc_id"])
    first = {}
    for d, c in zip(exact, components([fingerprint_of(d["text"] or "") for d in exact])):
        first.setdefault(c, d)
    return [good, exact, list(first.values())]


def test_stages(spark):
    want = plain(FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    texts = {}
    for (name, stage), rows in zip(corpus_pipeline.STAGES, [*want, want[2], None]):
        docs = materialize(stage(spark, docs, FOLDER))
        if rows is None:
            break
        assert docs.columns == columns, name
        got = docs.collect()
        assert sorted(r.doc_id for r in got) == sorted(d["doc_id"] for d in rows), name
        texts = {r.doc_id: r.text for r in got}
    originals = {d["doc_id"]: d["text"] for d in want[2]}
    real = {e[2:] for t in originals.values() for e in find(t or "")}
    assert real and not real & {e[2:] for t in texts.values() for e in find(t or "")}
    assert all(texts[i] == t for i, t in originals.items() if not find(t or ""))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = Counter()
    for i, t in texts.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for p, (start, length) in enumerate(pieces_of(len(ids), 2048)):
            pieces[i, p, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    got = docs.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    spans = defaultdict(list)
    for r in got:
        spans[r.sequence_id].append((r.offset, r.length))
    for own in spans.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    again = entry.queries()["pipeline"](spark, FOLDER).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in again) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in got)
