"""Line de-duplication against a plain pass over all windows in order."""

import random

import duckdb
from pyspark.sql import functions as F

from placestats.llm.line_dedup import drop_repeated_lines
from placestats.llm.queries import ORACLES


def plain(rows):
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None}, key=lambda x: x[:2])
    seen, out = set(), {}
    for known, i, t in order:
        lines = t.split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p : p + 3])
            if window in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(window)
        out[i if known else None, t] = ("\n".join(x for p, x in enumerate(lines) if p not in gone), len(gone))
    result, met = [], set()
    for i, t in rows:
        later = (i, t) in met
        met.add((i, t))
        if t is None:
            result.append((i, None, 0))
        elif later and t.count("\n") >= 2:
            result.append((i, "", t.count("\n") + 1))
        else:
            result.append((i, *out[i, t]))
    return result


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("POS", F.lit(1)).withColumn("hash", F.lit(1))
    df = df.withColumn("row", F.lit(2)).withColumn("Starts", F.lit(3)).withColumn("key", F.lit(4)).withColumn("whole", F.lit(5))
    out = drop_repeated_lines(df.repartition(3), count_col="n")
    assert out.columns == [*df.columns, "n"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sorted(map(str, plain(rows))) == sorted(str((r.doc_id, r.text, r.n)) for r in out.collect())


def test_random(spark):
    rng = random.Random(8)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randrange(0, 14))) for _ in range(40)]
    check(spark, list(enumerate(texts)))


def test_edges(spark):
    block = "one\ntwo\nthree\nfour"
    rows = [
        (1, block), (2, "x\n" + block + "\ny"), (3, block), (4, None), (5, ""), (6, "\n\n\n\n\n"), (7, "one\ntwo"), (8, "a"),
        (9, "\n".join(f"line {i}" for i in range(30_000))), (10, "p\nq\nr\ns"), (10, "p\nq\nr\ns"), (None, "p\nq\nr"), (11, "l\nl\nl\nl\nl\nl"),
    ]
    check(spark, rows)


def test_repeated_rows_as_in_the_sql(spark):
    """Copies of rows against the registered SQL; the rows of one id are copies, so its order is settled."""
    rows = [(1, "a\nb\nc\nd"), (1, "a\nb\nc\nd"), (None, "k\nl\nm"), (None, "k\nl\nm"), (None, "k\nl\nm"), (2, "x\na\nb\nc"), (3, "p\nq"), (3, "p\nq"), (4, None), (4, None), (5, "k\nl\nm\nn"), (5, "k\nl\nm\nn")]
    rows += [(7, "u\nv\nw\nu\nv\nw")] * 3
    df = spark.createDataFrame([r for r in rows if r[0] is not None], "doc_id long, text string")
    got = sorted(map(str, drop_repeated_lines(df.repartition(3), count_col="lines_cut").collect()))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r for r in rows if r[0] is not None])
    want = con.execute(ORACLES["op8_line_window_dedup"]).fetchall()
    assert got == sorted(f"Row(doc_id={i}, text={t!r}, lines_cut={n})" for i, t, n in want)
    check(spark, rows)


def test_copies_that_differ_elsewhere(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", "x", [1]), (1, "a\nb\nc", "y", [2]), (1, "a\nb\nc", "x", [1])], "doc_id long, text string, other string, more array<int>")
    got = sorted((r.other, r.more, r.text) for r in drop_repeated_lines(df).collect())
    assert [(o, m) for o, m, _ in got] == [("x", [1]), ("x", [1]), ("y", [2])] and sorted(t for _, _, t in got) == ["", "", "a\nb\nc"]


def test_empty(spark):
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
