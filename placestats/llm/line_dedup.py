"""Line de-duplication over overlapping windows of consecutive lines, in DataFrame functions only.

Every window of `size` consecutive lines is hashed. Windows that occur again anywhere in
the corpus are found by one aggregate that also names the first occurrence; all later
occurrences mark their lines, and marked positions of overlapping windows merge. Lines
that no later occurrence covers stay, in order. Hashes and positions grow with the corpus,
so they are never broadcast: both joins shuffle on their keys at every size, and AQE
splits the hot ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.llm.common import free_names, row_key, without
from placestats.session import materialize

SIZE = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def window_hashes(lines: Column, size: int = SIZE) -> Column:
    """128-bit hash of every window of `size` consecutive lines; none for fewer lines."""
    starts = F.sequence(F.lit(1), F.size(lines) - size + 1)
    hashes = F.transform(starts, lambda i: F.unhex(F.md5(F.array_join(F.slice(lines, i, size), "\n").cast("binary"))))
    return F.when(F.size(lines) >= size, hashes)


def repeated_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(key, starts): where later occurrences of repeated windows start, by row key; null texts have no windows.

    Occurrences are ordered by (id, row key, position); a null id comes first. Rows that
    repeat id and text share their key; what their later copies lose is up to the caller.
    """
    rows = docs.select(F.col(id_col).alias("id"), row_key(docs, [id_col, text_col]).alias("key"), lines_of(F.col(text_col).cast("string")).alias("lines"))
    windows = rows.select("id", "key", F.posexplode(window_hashes(F.col("lines"), size)).alias("pos", "hash"))
    place = F.struct("id", "key", "pos")
    spread = windows.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = materialize(spread.where(F.col("first") != F.col("last")).select("hash", "first"))
    later = windows.join(repeated.hint("merge"), "hash").where(place != F.col("first"))
    return later.groupBy("key").agg(F.collect_set("pos").alias("starts"))


def copies_cut(rows: DataFrame, key: str, columns: list[str], text_col: str, size: int, number: str) -> tuple[DataFrame, DataFrame]:
    """Split off later copies of rows that share `key`: (rows that go on, later copies with their lines cut).

    All windows of a later copy occur in the first, so a text with a window loses all its
    lines. Copies are counted with a map-side combine before any of them is moved; the
    first is the one of the least content in all columns.
    """
    whole, n, first, copy = free_names(rows, "whole", "n", "first", "copy")
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1)
    repeated = materialize(counts.select(key))  # usually none; its true size decides how it is joined
    met = rows.join(repeated, key, "left_semi").withColumn(whole, row_key(rows, columns))
    alike = materialize(met.groupBy(*columns, key, whole).agg(F.count(F.lit(1)).alias(n)))
    alike = alike.join(alike.groupBy(key).agg(F.min(whole).alias(first)), key)
    each = alike.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    stays = (F.col(whole) == F.col(first)) & (F.col(copy) == 1)
    lines = F.size(lines_of(F.col(text_col)))
    lost = lines >= size
    later = each.where(~stays).withColumn(number, F.when(lost, lines).otherwise(0).cast("long"))
    later = later.withColumn(text_col, F.when(lost, F.lit("")).otherwise(F.col(text_col)))
    going = rows.join(repeated, key, "left_anti").unionByName(each.where(stays).select(*rows.columns))
    return going, later.select(*columns, number)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, count_col: str | None = None) -> DataFrame:
    """`docs` with later occurrences of repeated windows cut from `text_col`; rows and other columns stay.

    A text of fewer than `size` lines has no window and stays as it is; a text may lose all
    its lines and is then empty. Null stays null. Of rows that repeat id and text one
    counts as the first; the others repeat all its windows and lose all their lines.
    `count_col` adds the number of lines cut.
    """
    docs = without(docs, [count_col]) if count_col else docs
    columns = docs.columns
    key, starts, number = free_names(docs, "row", "starts", count_col or "lines_cut")
    marked = materialize(repeated_positions(docs, id_col, text_col, size)).select(F.col("key").alias(key), F.col("starts").alias(starts))
    # only texts with a window can lose lines; the others are not moved
    long = F.coalesce(F.col(text_col).contains("\n"), F.lit(False)) if size > 1 else F.col(text_col).isNotNull()
    met, later = copies_cut(docs.where(long).withColumn(key, row_key(docs, [id_col, text_col])), key, columns, text_col, size, number)
    met = met.join(marked.hint("merge"), key, "left")
    lines = lines_of(F.col(text_col))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + size - 1))))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    cut = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    moved = met.withColumn(number, F.when(F.col(starts).isNull(), 0).otherwise(F.size(covered)).cast("long"))
    moved = moved.withColumn(text_col, F.when(F.col(starts).isNull(), F.col(text_col)).otherwise(cut))
    still = docs.where(~long).withColumn(number, F.lit(0).cast("long"))
    wanted = [*columns, number] if count_col else columns
    return still.select(*wanted).unionByName(moved.select(*wanted)).unionByName(later.select(*wanted))
