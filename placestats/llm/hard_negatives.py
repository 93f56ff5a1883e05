"""Hard-negative mining by Four-Russians scoring of integer vectors.

Components become integers. For every group of eight dimensions an anchor has a table of
the 256 subset sums of its components; a candidate is kept as bit planes of its
components, eight dimensions to a byte. One look-up per plane and group gives the sum of
the anchor's components whose bit is set, and shifting and adding the planes (the highest
counts negative, as in two's complement) gives the full inner product, exact as long as
it fits 64 bits.

Rows are dealt into blocks of bounded size and anchors into blocks, too; every pair of a
row block and an anchor block is one unit of work. Blocks are dealt by the hash of the
id, not by label, so a label with a third of all rows is split like any other. Two passes
over the units: the first finds each anchor's positives among the rows of its own label,
the second its negatives in the score range of each positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placestats.session import materialize

ROW_BLOCK, ANCHOR_BLOCK = 8192, 2048
CELLS = 1 << 21  # scores held at once in one task
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """(plane, group, row) bytes of (row, dimension) integers in two's complement, lowest plane first."""
    rows, width = vectors.shape
    top = int((vectors ^ (vectors >> 63)).max(initial=0)).bit_length()  # bits without the sign
    padded = np.zeros((rows, -(-width // 8) * 8), np.int64)
    padded[:, :width] = vectors
    return np.stack([np.packbits(((padded >> b) & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(top + 1)])


def subset_tables(anchors: np.ndarray) -> np.ndarray:
    """(group, byte, anchor) sums of the components whose bits are set in the byte."""
    count, width = anchors.shape
    padded = np.zeros((-(-width // 8) * 8, count), np.int64)
    padded[:width] = anchors.T
    parts = padded.reshape(-1, 8, count)
    tables = np.zeros((len(parts), 256, count), np.int64)
    for j in range(8):
        tables[:, 1 << j : 2 << j] = tables[:, : 1 << j] + parts[:, j : j + 1]
    return tables


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(row, anchor) inner products by look-ups, shifts and adds; arithmetic is modulo 2^64."""
    total = np.zeros((planes.shape[2], tables.shape[2]), np.int64)
    for b in range(len(planes) - 1, -1, -1):
        total <<= 1
        for table, codes in zip(tables, planes[b]):
            looked = table.take(codes, axis=0)
            if b == len(planes) - 1:
                total -= looked
            else:
                total += looked
    return total


def score_range(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The integers s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


class Part:
    """The rows of one side of a unit that have one width, in order of their ids."""

    def __init__(self, data: pa.Table, width: int):
        data = data.filter(pa.compute.equal(data["d"], width)).sort_by("id")
        self.data = data
        self.ids = data["id"].to_numpy()
        self.labels = data["label"].to_numpy()
        flat = data["v"].combine_chunks()
        self.vectors = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(data), width)


def _blocks(rows: Part, anchors: Part):
    """(anchor numbers, scores of all rows with them) in pieces of bounded size."""
    step = max(1, CELLS // max(1, len(rows.ids)))
    planes = bit_planes(rows.vectors)
    for at in range(0, len(anchors.ids), step):
        yield range(at, min(at + step, len(anchors.ids))), scores(planes, subset_tables(anchors.vectors[at : at + step]))


def _widths(rows: pa.Table, anchors: pa.Table) -> list[int]:
    return sorted(set(rows["d"].unique().to_pylist()) & set(anchors["d"].unique().to_pylist()))


def _subset(part: Part, chosen: np.ndarray) -> Part:
    out = Part.__new__(Part)
    out.ids, out.labels, out.vectors = part.ids[chosen], part.labels[chosen], part.vectors[chosen]
    return out


def best_positives(rows: pa.Table, anchors: pa.Table, k: int) -> list[tuple[int, int, int]]:
    """(anchor, row, score): the k best other rows of the anchor's label in this unit."""
    found = []
    for width in _widths(rows, anchors):
        all_rows, all_anchors = Part(rows, width), Part(anchors, width)
        for label in np.unique(all_anchors.labels):
            mine, asked = (_subset(p, p.labels == label) for p in (all_rows, all_anchors))
            for numbers, got in _blocks(mine, asked):
                for column, number in enumerate(numbers):
                    anchor = int(asked.ids[number])
                    order = np.argsort(~got[:, column], kind="stable")[: k + 1]
                    order = order[mine.ids[order] != anchor][:k]
                    found += [(anchor, int(mine.ids[i]), int(got[i, column])) for i in order]
    return found


def best_negatives(rows: pa.Table, anchors: pa.Table, k: int, low: int, high: int) -> list[tuple[int, int, int, int, int]]:
    """(anchor, positive, its score, row, score): the k best rows of other labels in each positive's range in this unit."""
    found = []
    for width in _widths(rows, anchors):
        mine, asked = Part(rows, width), Part(anchors, width)
        positives = asked.data["positives"].to_pylist()
        for numbers, got in _blocks(mine, asked):
            for column, number in enumerate(numbers):
                others = np.flatnonzero(mine.labels != asked.labels[number])
                order = others[np.argsort(~got[others, column], kind="stable")]  # best first, ties by id
                falling = ~got[order, column]
                for p in positives[number]:
                    least, most = score_range(p["positive_score"], low, high)
                    start = np.searchsorted(falling, ~most, "left")
                    end = np.searchsorted(falling, ~least, "right")
                    take = order[start : min(end, start + k)]
                    found += [(int(asked.ids[number]), p["positive_id"], p["positive_score"], int(mine.ids[i]), int(got[i, column])) for i in take]
    return found


def prepared(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, d, v) of the rows that take part, one per id."""
    whole = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = whole.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    whole = whole.withColumn("v", F.transform("v", lambda x: F.floor(256 * x)))
    one = whole.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    return one.select("id", "row.label", F.size("row.v").alias("d"), "row.v")


def relabelled(label, id_):
    """The label that counts: rows with an id divisible by 7 move on by one, modulo 10."""
    return F.when(id_ % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)


def mine(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows whose id is divisible by `every`.

    Components are floor(256 * x); higher inner products come first, ties by the smaller
    id. An anchor's positives are its first other rows of the same label, all if there are
    fewer; the negatives of a positive are the first rows of other labels whose score is
    between `low` and `high` per cent of the positive's, all if there are fewer.

    Rows with a null id, label or vector or a component that is null or not finite take no
    part. Of rows that repeat an id, that of the least label, then the least vector counts.
    Anchors meet only rows of their own width; empty vectors score 0 with each other. An
    empty table gives no rows, and an anchor without positives or without rows in range
    none. Components beyond 64 bits count as the nearest 64-bit number. Other columns of
    `rows` are not read, whatever their names.
    """
    taking = prepared(rows, id_col, label_col, vector_col).withColumn("label", relabelled(F.col("label"), F.col("id")))
    taking = materialize(taking)
    n, m = taking.agg(F.count(F.lit(1)), F.count(F.when(F.col("id") % every == 0, 1))).first()
    row_blocks, anchor_blocks = max(1, -(-n // row_block)), max(1, -(-m // anchor_block))

    def place(count: int):
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def each(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = taking.select(place(row_blocks).alias("rb"), each(anchor_blocks).alias("ab"), "id", "label", "d", "v")
    anchors = taking.where(F.col("id") % every == 0)

    def units(asked: DataFrame, extra: list[str]):
        right = asked.select(each(row_blocks).alias("rb"), place(anchor_blocks).alias("ab"), "id", "label", "d", "v", *extra)
        return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab"))

    first_schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
    second_schema = pa.schema([*first_schema, ("negative_id", pa.int64()), ("negative_score", pa.int64())])

    def table(found: list[tuple], schema: pa.Schema) -> pa.Table:
        columns = zip(*found) if found else [[] for _ in schema]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def first(some: pa.Table, asked: pa.Table) -> pa.Table:
        return table(best_positives(some, asked, positives), first_schema)

    def second(some: pa.Table, asked: pa.Table) -> pa.Table:
        return table(best_negatives(some, asked, negatives, low, high), second_schema)

    near = units(anchors, []).applyInArrow(first, "anchor_id long, positive_id long, positive_score long")
    by_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("n", F.row_number().over(by_anchor)).where(F.col("n") <= positives)
    # at most `positives` entries an anchor
    lists = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = materialize(anchors.join(lists, "id"))
    far = units(asked, ["positives"]).applyInArrow(second, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    by_pair = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(by_pair)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
