"""SimHash near-duplicates: 64-bit fingerprints linked by BK-trees over pigeonhole shards.

Equal fingerprints collapse first, so copies cost one row. Distinct fingerprints are cut
into `blocks` bit blocks; two of them that differ in at most `radius` bits agree on at
least `blocks - radius` whole blocks, so every linked pair meets in some shard keyed by
that many blocks. A shard with more than `tree_rows` fingerprints is split into parts:
each part is one tree, and the trees of a shard are shipped to every part that must search
them, so a hot shard spreads over many tasks and no task holds more than two parts of it.
Trees are built and searched level by level in numpy: a child hangs on an edge keyed by
its integer distance to the parent, and a search follows only edges within the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placestats.llm.common import free_names, row_key, whole_text
from placestats.operators.cluster import connected_components
from placestats.session import materialize

WORDS, RADIUS, SEED = 4, 4, 42
BLOCKS = 6  # 15 shard keys of 20 to 22 bits each
TREE_ROWS = 2048
FRONTIER = 2_000_000  # pairs of query and tree node looked at in one step


def fingerprint_of(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the word shingles; 0 without words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = len(tokens) - words + 1
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, last, 65536):  # whole text, in steps of bounded memory
        spans = zip(starts[at : min(at + 65536, last)].tolist(), ends[at + words - 1 : min(at + 65536, last) + words - 1].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype=np.uint64)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > last, bitorder="little").view(np.uint64)[0])


def fingerprint(text, words: int = WORDS, seed: int = SEED):
    """Column of signed longs holding the SimHash bits; null counts as empty."""

    @F.pandas_udf("long")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            bits = np.fromiter((fingerprint_of(t or "", words, seed) for t in texts), np.uint64, len(texts))
            yield pd.Series(bits.view(np.int64))

    return udf(text)


def hex16(col):
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def _shard_keys(fp, radius: int, blocks: int):
    """All shard keys of a fingerprint: which blocks, and their bits."""
    if not radius < blocks <= 16:
        raise ValueError("blocks must exceed the radius and be at most 16")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in chosen)
        mask -= (1 << 64) if mask >> 63 else 0
        keys.append(F.struct(F.lit(n).alias("c"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


def _forest(fp: np.ndarray, unit: np.ndarray):
    """BK-trees, one per unit, over distinct fingerprints sorted by unit.

    Returns the root of each unit and the edges as sorted keys `parent * 128 + distance`
    with their child nodes.
    """
    first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if len(unit) else np.zeros(0, np.int64)
    head = np.repeat(first, np.diff(np.r_[first, len(unit)]))
    rows = np.setdiff1d(np.arange(len(fp)), first, assume_unique=True)
    parent = head[rows]
    keys, kids = [], []
    while len(rows):
        edge = parent * 128 + np.bitwise_count(fp[rows] ^ fp[parent])
        edge_keys, heads, group = np.unique(edge, return_index=True, return_inverse=True)
        keys.append(edge_keys)
        kids.append(rows[heads])
        below = np.ones(len(rows), bool)
        below[heads] = False
        parent, rows = rows[heads][group][below], rows[below]
    if not keys:
        return first, np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, kids = np.concatenate(keys), np.concatenate(kids)
    order = np.argsort(keys)
    return first, keys[order], kids[order]


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of linked rows in place; a label is the least row of its class."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        least = np.minimum(la, lb)
        np.minimum.at(label, la, least)
        np.minimum.at(label, lb, least)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def linked_classes(fp: np.ndarray, unit: np.ndarray, tree: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """Label rows by the classes that links between tree rows and query rows of a unit form."""
    label = np.arange(len(fp))
    tree_at, query_at = np.flatnonzero(tree), np.flatnonzero(query)
    first, keys, kids = _forest(fp[tree_at], unit[tree_at])
    if not len(first) or not len(query_at):
        return label
    units = unit[tree_at][first]
    slot = np.searchsorted(units, unit[query_at])
    known = (slot < len(units)) & (units[np.minimum(slot, len(units) - 1)] == unit[query_at])
    stack = [(query_at[known], first[slot[known]])]
    while stack:
        q, node = stack.pop()
        if len(q) > FRONTIER:
            half = len(q) // 2
            stack += [(q[:half], node[:half]), (q[half:], node[half:])]
            continue
        distance = np.bitwise_count(fp[q] ^ fp[tree_at[node]]).astype(np.int64)
        hit = (distance <= radius) & (tree_at[node] != q)
        _unite(label, q[hit], tree_at[node[hit]])
        low = np.searchsorted(keys, node * 128 + np.maximum(distance - radius, 0))
        count = np.searchsorted(keys, node * 128 + distance + radius, side="right") - low
        go = count > 0
        if go.any():
            low, count = low[go], count[go]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            stack.append((np.repeat(q[go], count), kids[np.repeat(low, count) + step]))
    return label


def _link_partition(radius: int, least_rows: int = 50_000):
    """mapInArrow function over rows (c, bits, i, j, part, fp) sorted by unit: links (a, b) that join classes."""

    def links(rows: pd.DataFrame) -> pa.RecordBatch:
        names = ["c", "bits", "i", "j"]
        values = rows[names].to_numpy()
        unit = np.cumsum(np.r_[False, (values[1:] != values[:-1]).any(axis=1)])
        fp = rows["fp"].to_numpy().view(np.uint64)
        part = rows["part"].to_numpy()
        label = linked_classes(fp, unit, part == rows["i"].to_numpy(), part == rows["j"].to_numpy(), radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            rows = batch.to_pandas()
            held = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if len(held) >= least_rows:
                last = held.iloc[-1]
                cut = int(((held["c"] == last["c"]) & (held["bits"] == last["bits"]) & (held["i"] == last["i"]) & (held["j"] == last["j"])).to_numpy().argmax())
                if cut:
                    yield links(held.iloc[:cut])
                    held = held.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield links(held)

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that connect all of them within `radius` bits.

    The links of a unit are reduced to its classes, so a dense group gives at most one
    link per row and unit; the connected components are those of all links.
    """
    keyed = distinct.select("fp", F.explode(_shard_keys(F.col("fp"), radius, blocks)).alias("k")).select("fp", "k.c", "k.bits")
    sizes = keyed.groupBy("c", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = materialize(sizes.select("c", "bits", F.ceil(F.col("n") / tree_rows).cast("int").alias("parts")))
    placed = keyed.join(sized, ["c", "bits"]).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    units = placed.select("c", "bits", "fp", "part", other.alias("o")).select(
        "c", "bits", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"), "part", "fp"
    )
    order = ["c", "bits", "i", "j", "fp"]
    dealt = units.repartition("c", "bits", "i", "j").sortWithinPartitions(*order)
    return dealt.mapInArrow(_link_partition(radius), "a long, b long")


def fingerprint_classes(distinct: DataFrame, radius: int = RADIUS, **params) -> DataFrame:
    """(fp, root) for every distinct fingerprint; a class is named by one of its members."""
    links = fingerprint_links(distinct, radius, **params)
    roots = connected_components(links, "a", "b").select(F.col("node").alias("fp"), "root")
    return distinct.select("fp").join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row per row of `docs`: id, `fp` (signed bits) and `component_id`, the least id of its class.

    A null id never names a class unless all its ids are null. Rows without words have
    fingerprint zero and link like any others. An empty table gives an empty result.
    """
    prints = materialize(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col).cast("string")).alias("fp")))
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    classes = materialize(fingerprint_classes(distinct, **params))
    least = classes.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(classes.join(least, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """`docs` with one row of each class: the least (id, content); columns stay as they are.

    Only 16-byte row keys and fingerprints are grouped; texts move once, to meet the keys
    that stay. Rows that repeat id and text fully are one document and keep one row.
    """
    key, copy = free_names(docs, "row", "copy")
    keyed = docs.withColumn(key, row_key(docs, [id_col, text_col]))
    prints = materialize(
        keyed.select(F.col(key).alias("key"), F.col(id_col).alias("doc_id"), fingerprint(whole_text(text_col)).alias("fp"))
    )
    distinct = materialize(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("least")))
    classes = fingerprint_classes(distinct, **params)
    stay = classes.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.key").alias(key))
    stay = materialize(stay)
    number = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1)))
    single = keyed.withColumn(copy, number).where(F.col(copy) == 1).drop(copy)
    return single.join(stay, key, "left_semi").select(*docs.columns)
