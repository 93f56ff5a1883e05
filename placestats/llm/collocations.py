"""Phrase collocations by Rabin-Karp fingerprints.

Texts become chunks of words, at most `CHUNK` words a chunk, written once with an id. In
a task, prefix polynomials over the bytes of a block of chunks give the fingerprint of
every run of words as a difference of two prefixes. Equal runs of a block are counted
together (their bytes are compared, so one count never mixes two texts) and leave as
(fingerprint, count, pointer to an occurrence). A shuffle by fingerprint adds the counts;
what stays below the threshold ends there, without any text of it having been built.

Lengths are counted one after another, so that the shuffle of one is gone before the next
begins. A run can only be frequent if its words are, so longer runs are left out that have
a word which is not in a bitmap of the frequent words' fingerprints. The bitmap has `BITS`
bits at every size of the input; where it fills up, fewer runs are left out, with the same
result.

Pointers of frequent fingerprints then meet their chunks, one row a chunk, and counts are
added again by text. So fingerprints that collide only cost work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placestats.session import materialize, release

LONGEST = 4  # words of a phrase
CHUNK = 1 << 14  # words that begin in a chunk; a pointer has 14 bits for the word and 2 for the length
BLOCK = 1 << 19  # words that are counted together in a task
BITS = 27  # of a fingerprint, the highest, are its place in the bitmap
SPACE, BREAK = 0x20, 0x0A
#: Lower case for A to Z, tab as space, and one byte for all that ends a piece.
_FOLD = bytes(SPACE if c == 9 else BREAK if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_rng = np.random.default_rng(20261)
_VALUE = _rng.integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)  # of a byte
_BASE = 0x5851F42D4C957F2B  # 3 modulo 8: powers differ from 1 by as few factors of two as can be
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    """base^0 to base^(count - 1) modulo 2^64, by doubling."""
    out = np.ones(max(1, count), np.uint64)
    have = 1
    while have < count:
        more = min(have, count - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


class Words:
    """The words of normalised bytes: borders, pieces, prefix polynomials."""

    def __init__(self, body: np.ndarray):
        self.body = body
        inside = np.concatenate([[False], (body != SPACE) & (body != BREAK), [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        self.piece = np.searchsorted(np.flatnonzero(body == BREAK), self.start)  # breaks before the word

    def normal(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes with one separator after each word, a space within a piece; where each word then starts."""
        size = self.end - self.start
        start = np.cumsum(size + 1) - (size + 1)
        keep = np.concatenate([(self.body != SPACE) & (self.body != BREAK), [False]])
        keep[self.end] = True
        out = np.append(self.body, np.uint8(BREAK))
        last = np.append(self.piece[1:] != self.piece[:-1], True)[: len(size)]
        out[self.end] = np.where(last, BREAK, SPACE)
        return out[keep], start

    def hashed(self) -> None:
        """Prefix polynomials at the borders of the words."""
        terms = _VALUE[self.body]
        terms *= _powers(_BASE, len(self.body))
        sums = np.zeros(len(self.body) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        del terms
        self.before, self.after = sums[self.start], sums[self.end]
        self.back = _powers(_BASE_INVERSE, len(self.body) + 1)[self.start]

    def prints(self, n: int) -> np.ndarray:
        """The fingerprint of the `n` words from each word on; the last n - 1 words begin none."""
        stop = max(0, len(self.start) - n + 1)
        return (self.after[n - 1 :][:stop] - self.before[:stop]) * self.back[:stop]


def same_bytes(body: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray, at_once: int = 1 << 21) -> np.ndarray:
    """Whether the `size` bytes from `one` and from `other` on are equal, pair by pair."""
    out = np.ones(len(size), bool)
    total = np.cumsum(size)
    low = 0
    while low < len(size):
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + at_once, "right")))
        if size[low] > at_once:
            out[low] = all((body[one[low] + k : one[low] + min(k + at_once, size[low])] == body[other[low] + k : other[low] + min(k + at_once, size[low])]).all() for k in range(0, int(size[low]), at_once))
            high = low + 1
        else:
            part = size[low:high]
            first = np.cumsum(part) - part
            offset = np.arange(int(part.sum())) - np.repeat(first, part)
            differ = body[np.repeat(one[low:high], part) + offset] != body[np.repeat(other[low:high], part) + offset]
            out[low:high] = np.add.reduceat(differ, first) == 0 if len(differ) else True
        low = high
    return out


def seed(lang: str) -> np.uint64:
    """Keeps the fingerprints of languages apart."""
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def count_block(chunks: list[tuple[int, bytes, int]], n: int, lang: str, frequent: np.ndarray | None, mask: int = (1 << 64) - 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints, counts, pointers) of the runs of `n` words that begin in the chunks.

    chunks: (id, body, words that begin here). frequent: bytes of the bitmap of frequent
    words, if any. `mask` cuts fingerprints, to try collisions.
    """
    body = np.frombuffer(b"\n".join(c[1] for c in chunks), np.uint8)
    words = Words(body)
    words.hashed()
    edges = np.cumsum([0, *(len(c[1]) + 1 for c in chunks)])
    chunk = np.searchsorted(edges, words.start, "right") - 1
    number = np.arange(len(words.start)) - np.searchsorted(words.start, edges)[chunk]
    begins = number < np.array([c[2] for c in chunks], np.int64)[chunk] if chunks else np.zeros(0, bool)
    stop = max(0, len(words.start) - n + 1)
    # the last byte of a chunk parts its last word from the next chunk's, as a piece's end does
    whole = begins[:stop] & (words.piece[n - 1 :][:stop] == words.piece[:stop]) & (chunk[n - 1 :][:stop] == chunk[:stop])
    apart, cut = seed(lang), np.uint64(mask)
    if frequent is not None:
        place = ((words.prints(1) ^ apart) & cut) >> np.uint64(64 - BITS)
        likely = (frequent[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        for k in range(n):
            whole &= likely[k : stop + k]
    at = np.flatnonzero(whole)
    prints = (words.prints(n)[at] ^ apart) & cut
    order = np.argsort(prints, kind="stable")
    at, prints = at[order], prints[order]
    size = words.end[at + n - 1] - words.start[at]
    new = np.ones(len(at), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (size[1:] != size[:-1])
    same = np.flatnonzero(~new)
    new[same] = ~same_bytes(body, words.start[at[same]], words.start[at[same - 1]], size[same])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(at)))
    here = at[first]
    ids = np.array([c[0] for c in chunks], np.int64)
    pointers = (ids[chunk[here]] << 16) | (number[here] << 2) | (n - 1)
    return prints[first].view(np.int64), counts, pointers


def cut_chunks(texts: list[bytes], size: int) -> Iterator[tuple[bytes, int]]:
    """(body, words that begin here) of the words of all texts; a body shows the next `LONGEST` - 1 words, too."""
    words = Words(np.frombuffer(b"\n".join(texts).translate(_FOLD), np.uint8))
    body, start = words.normal()
    for low in range(0, len(start), size):
        high = min(low + size, len(start))
        stop = start[high + LONGEST - 1] if high + LONGEST - 1 < len(start) else len(body)
        yield body[start[low] : stop - 1].tobytes(), high - low


def cut_rows(rows: Iterable[tuple[str, bytes]], size: int, block: int = 1 << 22) -> Iterator[list[tuple[str, bytes, int]]]:
    """(lang, body, words that begin here) of texts by language, in lists of some `block` bytes: work on a batch takes many times its bytes."""
    held: dict[str, list[bytes]] = {}
    total = 0
    for lang, text in rows:
        held.setdefault(lang, []).append(text)
        total += len(text)
        if total >= block:
            yield [(lang, *c) for lang, texts in held.items() for c in cut_chunks(texts, size)]
            held, total = {}, 0
    yield [(lang, *c) for lang, texts in held.items() for c in cut_chunks(texts, size)]


def chunks_of(docs: DataFrame, text_col: str, lang_col: str, size: int = CHUNK) -> DataFrame:
    """(id, lang, body, begins): the words of all texts, written once so that ids stay."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text.alias("text"))

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((lang.as_py(), body.as_py()) for lang, body in zip(batch["lang"], batch["text"]))
            for found in cut_rows(texts, size):
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.binary(), pa.int64()))], ["lang", "body", "begins"])

    cut = rows.mapInArrow(normalise, "lang string, body binary, begins long")
    # 23 bits for the partition and 24 for the chunk in it leave 16 for the place in the chunk
    raw = F.monotonically_increasing_id()
    chunk_id = F.shiftleft(F.shiftright(raw, 33), 24).bitwiseOR(raw.bitwiseAND(F.lit((1 << 33) - 1)))
    return materialize(cut.select(chunk_id.alias("id"), "*"))


def frequent_bitmap(found: DataFrame) -> np.ndarray:
    """The bitmap of the fingerprints, `BITS` bits whatever their number; Spark builds it."""
    place = F.shiftrightunsigned("print", 64 - BITS) + 1  # these functions count from 1
    parts = found.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    width = 4096  # bytes of a part, so at most 2^(BITS - 15) parts
    for row in parts.toLocalIterator():
        out[(row.part - 1) * width : row.part * width] = np.frombuffer(bytes(row.bits), np.uint8)
    return out


def level(chunks: DataFrame, n: int, least: int, frequent: np.ndarray | None, block: int = BLOCK, mask: int = (1 << 64) - 1) -> DataFrame:
    """(print, count, pointer) of runs of `n` words whose fingerprint occurs `least` times, one row a block and text."""
    shared = None if frequent is None else chunks.sparkSession.sparkContext.broadcast(frequent.tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else np.frombuffer(shared.value, np.uint8)
        held: dict[str, list[tuple[int, bytes, int]]] = {}
        words = 0

        def flush():
            for lang, rows in held.items():
                found = count_block(rows, n, lang, bits, mask)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["print", "count", "pointer"])
            held.clear()

        for batch in batches:
            for i, lang, body, begins in zip(*(batch[c].to_pylist() for c in ("id", "lang", "body", "begins"))):
                held.setdefault(lang, []).append((i, body, begins))
                words += begins
                if words >= block:
                    yield from flush()
                    words = 0
        yield from flush()

    counted = chunks.select("id", "lang", "body", "begins").mapInArrow(count, "print long, count long, pointer long")
    total = F.sum("count").over(Window.partitionBy("print"))
    return materialize(counted.withColumn("total", total).where(F.col("total") >= least).drop("total"))


def phrase_counts(chunks: DataFrame, least: int, block: int = BLOCK, mask: int = (1 << 64) - 1) -> DataFrame:
    """(lang, phrase, k, f): all runs of 1 to `LONGEST` words that occur `least` times, exactly."""
    found = [level(chunks, 1, least, None, block, mask)]
    frequent = frequent_bitmap(found[0])
    found += [level(chunks, n, least, frequent, block, mask) for n in range(2, LONGEST + 1)]
    pointers = found[0]
    for more in found[1:]:
        pointers = pointers.unionByName(more)
    # a chunk has at most CHUNK * LONGEST places; a count is at most the words of a block, so both fit one number
    place = F.shiftleft("count", 16).bitwiseOR(F.col("pointer").bitwiseAND(F.lit(0xFFFF)))
    by_chunk = pointers.groupBy(F.shiftright("pointer", 16).alias("id")).agg(F.collect_list(place).alias("places"))
    # bodies are cut into words only behind the shuffle
    met = chunks.select("id", "lang", "body").join(by_chunk, "id").select("lang", F.split(F.col("body").cast("string"), "[ \n]", -1).alias("words"), "places")
    k = (F.col("p").bitwiseAND(F.lit(3)) + 1).cast("int")
    texts = met.select("lang", "words", F.explode("places").alias("p")).select(
        "lang",
        F.array_join(F.slice("words", (F.shiftright("p", 2).bitwiseAND(F.lit(CHUNK - 1)) + 1).cast("int"), k), " ").alias("phrase"),
        k.alias("k"),
        F.shiftright("p", 16).alias("count"),
    )
    counted = materialize(texts.groupBy("lang", "phrase", "k").agg(F.sum("count").alias("f")).where(F.col("f") >= least))
    release(*found)
    return counted


def scaled_share(a: Column, both: Column) -> Column:
    """floor(2000000 * a / both) for longs, in 38 digits."""
    return F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * a.cast("decimal(20,0)"), both.cast("decimal(20,0)"))


def part(words: Column, first: Column, count: Column) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000, covered: int = 80, chunk: int = CHUNK, block: int = BLOCK,
                 mask: int = (1 << 64) - 1, salts: int = 32) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to 4 words that occur `least` times.

    `a` counts the phrase, `l` and `r` the parts of its lowest-scoring cut, `n` all words
    of the language; score is floor(2000000 * a / (l + r)). A phrase goes if a longer one
    that occurs often enough has its words in it and `covered` per cent of its count.

    A null language counts as `und`, a null text as empty; repeated rows count each time.
    Ties of a score go by `a`, then by phrase in byte order. A table without frequent
    phrases gives no rows. Other columns are not read, whatever their names.
    """
    chunks = chunks_of(docs, text_col, lang_col, min(chunk, CHUNK))
    words = chunks.groupBy("lang").agg(F.sum("begins").alias("n"))
    counts = phrase_counts(chunks, least, block, mask)
    phrases = counts.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))
    sizes = counts.select("lang", F.col("phrase").alias("part"), "f")

    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.col("w"), F.lit(1), F.col("cut")).alias("head"), part(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    cuts = cuts.join(sizes.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(sizes.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    least_cut = F.min(F.struct(scaled_share(F.col("a"), F.col("l") + F.col("r")).alias("score"), "cut", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(least_cut.alias("c"))

    inner = phrases.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    inner = inner.withColumn("from", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    longer = inner.groupBy("lang", part(F.col("w"), F.col("from"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left")
    hundred, limit = (F.lit(x).cast("decimal(10,0)") for x in (100, covered))
    kept = kept.where(F.col("longer").isNull() | (hundred * F.col("longer").cast("decimal(20,0)") < limit * F.col("a").cast("decimal(20,0)")))

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", "a", "c.l", "c.r", "c.score", F.pmod(F.xxhash64("phrase"), F.lit(salts)).alias("salt"))
    # a hot language is cut to `top` rows per salt first
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return rows.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
