"""Transcript parsing: units, Viterbi against all paths, borders, recovery of hidden roles."""

import zlib
from itertools import product

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from placestats.llm import transcripts
from placestats.llm.transcripts import FEATURES, ROLES, Model, parse, units

S = len(ROLES)


@pytest.mark.parametrize(
    "text,want",
    [
        ("", [(-1, "")]),
        ("User: hi\nAssistant: hello\nthere\n\nHuman: bye", [(1, "hi"), (2, "hello\nthere"), (1, "bye")]),
        ("<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user\nHi<|im_end|>", [(0, "Be kind."), (1, "Hi")]),
        ("### Assistant:\nYes", [(2, "Yes")]),
        ("**Bot:** ok\n[Q]: why", [(2, "ok"), (1, "why")]),
        ("the user: a person\nno marker", [(-1, "the user: a person\nno marker")]),
        ("intro\nUser: x", [(-1, "intro"), (1, "x")]),
        ("A: one\nQ: two", [(2, "one"), (1, "two")]),
    ],
)
def test_units(text, want):
    assert units(text) == want


def model(seed):
    rng = np.random.default_rng(seed)
    return Model(rng.random(S) * 9, rng.random((S, S)) * 9, [rng.random((S, n)) * 9 for n in FEATURES.values()])


@pytest.mark.parametrize("seed", range(4))
def test_best_path(seed):
    m, rng = model(seed), np.random.default_rng(seed)
    scores = np.log(rng.random((6, S)))
    value = lambda p: m.start[p[0]] + scores[0, p[0]] + sum(m.move[a, b] + scores[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:])))
    want = max(product(range(S), repeat=6), key=value)
    assert tuple(m.path(scores, -1, -1)) == want
    # the same path from two runs whose border roles were settled by chaining their spans
    left, right = m.span(scores[:3], True), m.span(scores[3:], False)
    through = left[0][:, None] + right
    last = int(through.max(axis=0).argmax())
    mid = int(through[:, last].argmax())
    assert through.max() == pytest.approx(value(want))
    assert tuple([*m.path(scores[:3], -1, mid), *m.path(scores[3:], mid, last)]) == want


def conversations():
    rows = pq.read_table("/root/testdata/sf0.01/conversations.parquet").to_pylist()
    return [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows]


def test_hidden_roles_are_recovered(spark):
    rows = conversations()
    hidden = [(c, t, r if hash((c, t)) % 10 < 6 else None, x) for c, t, r, x in rows]
    got = parse(spark.createDataFrame(hidden, "conv_id long, turn long, role string, text string")).collect()
    truth = {(c, t): r for c, t, r, _ in rows}
    wrong = [r for r in got if r.marked is None and r.role != truth[r.conv_id, r.turn]]
    assert len(got) == len(rows) and len(wrong) < 0.05 * sum(r.marked is None for r in got)
    assert all(r.rendered == f"<|{r.role}|>\n{r.body}\n<|end|>" for r in got)


def plain_parse(rows):
    """The whole operator in one place: (conv, turn, text) -> roles, for transcripts without ties."""
    cut = []
    for c, t, r, x in sorted(rows, key=lambda r: r[:2]):
        for n, (mark, body) in enumerate(units(x or "")):
            cut.append([c, t, n, mark if mark >= 0 or n else transcripts.role_of(r), body])
    start, move, emit = np.zeros(S), np.zeros((S, S)), [np.zeros((S, n)) for n in FEATURES.values()]
    opens = [i == 0 or cut[i - 1][0] != u[0] for i, u in enumerate(cut)]
    seen = [transcripts.observed(u[4], o) for u, o in zip(cut, opens)]
    for i, (u, o) in enumerate(zip(cut, opens)):
        if u[3] >= 0:
            if o:
                start[u[3]] += 1
            elif cut[i - 1][3] >= 0:
                move[cut[i - 1][3], u[3]] += 1
            for f, k in enumerate(seen[i]):
                emit[f][u[3], k] += 1
    m, out = Model(start, move, emit), {}
    for c in dict.fromkeys(u[0] for u in cut):
        at = [i for i, u in enumerate(cut) if u[0] == c]
        path = m.path(m.scores(np.array([cut[i][3] for i in at]), np.array([seen[i] for i in at])), -1, -1)
        out |= {(cut[i][0], cut[i][1], cut[i][2]): ROLES[r] for i, r in zip(at, path)}
    return out


@pytest.mark.parametrize("size", [1 << 22, 3000])
def test_against_one_pass(spark, size, monkeypatch):
    """One range and many: the same counts, the same paths."""
    monkeypatch.setattr(transcripts, "RANGE", size)
    rows = [(c, t, r if c % 3 else None, x) for c, t, r, x in conversations()]
    rows += [(10**6, t, None, f"User: {t}?\nAssistant: {'so ' * (t % 90)}") for t in range(60)]
    got = parse(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.turn, r.unit): r.role for r in got} == plain_parse(rows)


def test_registered_query_recovers_hidden_roles(spark):
    rows = entry.queries()["op10_transcript_roles"](spark, "/root/testdata/sf0.01").collect()
    truth = {(c, t): r for c, t, r, _ in conversations()}
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.conv_id).encode()) % 2 == 1) for r in rows)
    hidden = [r for r in rows if r.held_out]
    assert len(hidden) > 100 and all(r.marked is None for r in hidden)
    assert sum(r.role == truth[r.conv_id, r.turn] for r in hidden) >= 0.95 * len(hidden)


def test_without_any_mark(spark):
    truth = {(c, t): r for c, t, r, _ in conversations()}
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    rows = parse(df, role=None).collect()
    right = sum(r.role == truth[r.conv_id, r.turn] for r in rows)
    assert all(r.marked is None for r in rows) and right > 0.8 * len(rows) > sum(v == "user" for v in truth.values())


def test_long_transcript_over_many_partitions(spark):
    rows = [(7, i, None if i % 5 else ROLES[1 + i % 2], f"{'ask' if i % 2 == 0 else 'answer ' * 60} {i}") for i in range(400)]
    rows += [(c, i, ROLES[1 + i % 2], "x" * (500 * (i % 2) + 5)) for c in (1, 9) for i in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("KEY", F.lit(1)).withColumn("part", F.lit(2))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = parse(df).orderBy("conv_id", "turn").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(got) == len(rows)
    assert all(r.role == ROLES[1 + r.turn % 2] for r in got)


def test_edges(spark):
    rows = [(None, 1, "user", "hi"), (None, None, None, None), (2**60 + 1, 5, "BOT", ""), (2**60 + 1, 5, "BOT", ""), (3, 1, "weird", "User: q\nBot: a\n" + "w " * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = parse(df).collect()
    assert sorted((str(r.conv_id), str(r.turn), r.unit, r.marked, r.rendered is None) for r in got) == sorted([
        ("None", "1", 0, "user", False), ("None", "None", 0, None, True), (str(2**60 + 1), "5", 0, "assistant", False), (str(2**60 + 1), "5", 0, "assistant", False),
        ("3", "1", 0, "user", False), ("3", "1", 1, "assistant", False),
    ])
    assert parse(df.limit(0)).count() == 0
    assert parse(df.select("conv_id", "turn", "text"), role=None).count() == 6
    assert transcripts.role_of(" Human ") == 1
