"""Exact de-duplication by composable polynomial fingerprints.

A text is cut into chunks of bytes. Every chunk is hashed as a polynomial in its bytes
modulo two primes (all chunks of a text at once, as one matrix product); chunk hashes
combine by shifting the left one by the length of the right one, so a huge text never
needs more than its chunks. Texts of equal length and hash form a candidate group, and
the chunks of each group are then compared byte by byte: per chunk position the least
and the greatest chunk of the group must be the same. That comparison is a map-side
combined aggregate, so a group of any size ships one chunk per position and task. A
group that fails is fingerprinted again under other bases until all groups hold equal
texts only, so a collision can neither join nor lose rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placestats.llm.common import free_names, let, whole_text
from placestats.session import materialize

CHUNK = 1 << 16  # 65,536 products below 2**39 still add up below 2**63
PRIMES = (2**31 - 1, 2**31 - 19)


class Polynomial:
    """Hash of byte strings modulo `primes` under bases drawn from `seed`."""

    def __init__(self, seed: int = 0, primes: tuple[int, ...] = PRIMES, chunk: int = CHUNK):
        rng = np.random.default_rng(seed)
        self.primes, self.chunk = primes, chunk
        self.bases = [int(rng.integers(256, max(p - 1, 257))) for p in primes]
        self.powers = []
        for p, base in zip(self.primes, self.bases):
            up = [1]
            for _ in range(chunk - 1):
                up.append(up[-1] * base % p)
            self.powers.append(np.array(up[::-1], dtype=np.uint64))

    def chunks(self, data: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
        """(hashes, length) of each chunk; whole chunks as one product."""
        whole = len(data) // self.chunk
        out: list[tuple[tuple[int, ...], int]] = []
        if whole:
            for at in range(0, whole, 64):  # bounded memory for huge texts
                block = data[at * self.chunk : min(at + 64, whole) * self.chunk].reshape(-1, self.chunk).astype(np.uint64)
                values = [(block @ w) % np.uint64(p) for w, p in zip(self.powers, self.primes)]
                out += [(tuple(int(v[i]) for v in values), self.chunk) for i in range(len(block))]
        rest = data[whole * self.chunk :]
        if len(rest) or not out:
            tail = rest.astype(np.uint64)
            out.append((tuple(int((tail * w[len(w) - len(tail) :]).sum() % np.uint64(p)) for w, p in zip(self.powers, self.primes)), len(tail)))
        return out

    def combine(self, left: tuple[tuple[int, ...], int], right: tuple[tuple[int, ...], int]) -> tuple[tuple[int, ...], int]:
        """Hash of a text from the hashes of its two halves."""
        (a, n), (b, m) = left, right
        return tuple((x * pow(base, m, p) + y) % p for x, y, base, p in zip(a, b, self.bases, self.primes)), n + m

    def key(self, data: bytes) -> bytes:
        """Length and hashes of a text as one binary value."""
        parts = self.chunks(np.frombuffer(data, dtype=np.uint8))
        total = parts[0]
        for part in parts[1:]:
            total = self.combine(total, part)
        return total[1].to_bytes(8, "big") + b"".join(h.to_bytes(8, "big") for h in total[0])


def fingerprint(text: Column, seed: int = 0, primes: tuple[int, ...] = PRIMES) -> Column:
    """Binary key of the UTF-8 bytes of a text: length, then one hash per prime."""

    @F.pandas_udf("binary")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        poly = Polynomial(seed, primes)
        for texts in parts:
            yield pd.Series([poly.key((t or "").encode("utf-8", "surrogatepass")) for t in texts], dtype=object)

    return udf(text)


def _unequal(texts: DataFrame) -> DataFrame:
    """Keys `fp` whose texts differ somewhere, from rows (fp, text), chunk by chunk."""
    data = F.encode("text", "UTF-8")

    def cut(b):
        last = F.greatest(F.ceil(F.length(b) / CHUNK) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(b, i * CHUNK + 1, F.lit(CHUNK)))

    chunks = texts.select("fp", F.posexplode(let(data, cut)).alias("pos", "chunk"))
    spans = chunks.groupBy("fp", "pos").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    return spans.where(F.col("least") != F.col("most")).select("fp").distinct()


def exact_keys(docs: DataFrame, text_col: str, primes: tuple[int, ...] = PRIMES, rounds: int = 16) -> tuple[int, DataFrame | None]:
    """Find keys that hold unequal texts; (number of rounds, collided first keys or None).

    Each round adds one fingerprint under fresh bases for the texts whose keys collided
    before. Without collisions, the usual case, one round compares all groups and ends.
    """
    base = docs.select(whole_text(text_col).alias("text")).withColumn("fp", fingerprint(F.col("text"), 0, primes))
    repeated = materialize(base.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp"))
    bad = materialize(_unequal(base.join(repeated, "fp", "left_semi")))
    if bad.isEmpty():
        return 0, None
    suspects = base.join(bad, "fp", "left_semi")
    for extra in range(1, rounds + 1):
        again = suspects.withColumn("fp", F.concat("fp", *[fingerprint(F.col("text"), s, PRIMES) for s in range(1, extra + 1)]))
        if _unequal(again).isEmpty():
            return extra, bad
    raise RuntimeError(f"texts still collide after {rounds} independent fingerprints")


def with_exact_key(docs: DataFrame, text_col: str = "text", primes: tuple[int, ...] = PRIMES, name: str = "fp") -> DataFrame:
    """`docs` with a binary column that is equal exactly for equal texts (null counts as empty)."""
    extra, bad = exact_keys(docs, text_col, primes)
    keyed = docs.withColumn(name, fingerprint(whole_text(text_col), 0, primes))
    if bad is None:
        return keyed
    more = F.concat(F.col(name), *[fingerprint(whole_text(text_col), s, PRIMES) for s in range(1, extra + 1)])
    (mark,) = free_names(keyed, "collided")
    marked = bad.select(F.col("fp").alias(name), F.lit(True).alias(mark))
    return keyed.join(marked, name, "left").withColumn(name, F.when(F.col(mark), more).otherwise(F.col(name))).drop(mark)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest id stays (a null id only if all are null); of rows that
    repeat id and text one stays. An empty table gives an empty result.
    """
    small = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = with_exact_key(small, "text", primes).select("doc_id", "fp", F.sha2(whole_text("text").cast("binary"), 256).alias("text_sha256"))
    rows = materialize(keyed.groupBy("doc_id", "fp", "text_sha256").agg(F.count(F.lit(1)).alias("copies")))
    groups = materialize(rows.groupBy("fp").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")))
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    each = rows.join(groups, "fp").select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return each.select("doc_id", "keep_id", "group_size", (first & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """`docs` with one row of each group of equal texts, that of the largest id; columns stay as they are.

    The rank is cut to one row per key before the shuffle, so a group that holds a
    third of all rows ships one row per map task.
    """
    key, rank = free_names(docs, "fp", "rank")
    keyed = with_exact_key(docs, text_col, primes, key)
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.col(id_col).desc_nulls_last()))
    return keyed.withColumn(rank, place).where(F.col(rank) == 1).select(*docs.columns)
