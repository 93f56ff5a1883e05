"""Byte-level BPE in Spark: ranked merges folded over the bytes of distinct words.

Documents are read in blocks. A block becomes one row: those of its distinct words (matches
of the split pattern) that no earlier block of the task had, and for every document the
numbers of its words, in order. Spark's higher-order functions then encode each of these
words, so a task encodes a word once, however small its blocks are: its bytes are folded by
merging, again and again, the neighbours whose joined bytes rank lowest in a literal rank
map, until no joined pair has a rank. The same functions decode ids by joining the binary
pieces of a literal vocabulary. Last, the documents of the block are put together from
their words. Texts are not shuffled, and memory is bounded by the block and by KEPT words.

Words that are frequent in a bounded sample of the texts are encoded once for all blocks, by
the same fold; which words these are changes the speed only, never a result.

The rank map is a literal: the rank of joined bytes is their id, and a pair of ids finds
it in one of two places of an array. The fold takes time in the square of a word's bytes,
so words of more than LONG bytes are merged by a heap, with the same result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import string
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.llm.common import let, whole_text, without

LONG = 128
NONE = 2**31 - 1  # stands for no rank
ID = 1 << 16  # ids are below
MIXERS, SHIFT = (0x45D9F3B5, 0x2C1B3C6D), 24  # odd multipliers of 31 bits: products of two ids never overflow
COMMON = 250_000  # most words that are encoded ahead
COMMON_CHARS = 64 << 20  # about as many characters are read to find them
AHEAD_TASKS = 8  # tasks that fold them
KEPT = 400_000  # words that a task keeps between blocks, about; then it begins anew
BLOCK = 1 << 20  # characters of text in a block, more only if one text is longer; Spark holds all blocks of a task at once
SEPARATOR = ","


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a .tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def mergeable(ranks: dict[bytes, int]) -> dict[int, int]:
    """Left id * ID + right id -> id, for all pairs of byte strings whose joined bytes have a rank."""
    return {
        ranks[token[:cut]] * ID + ranks[token[cut:]]: n
        for token, n in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    }


def _places(key: int, bits: int) -> tuple[int, int]:
    return tuple((key * m >> SHIFT) & ((1 << bits) - 1) for m in MIXERS)


def rank_table(pairs: dict[int, int]) -> tuple[list[int], int]:
    """Entries pair * ID + id, each in its first or second place (cuckoo hashing), and the bits of a place."""
    bits = max(4, (5 * len(pairs) // 2).bit_length())
    slots = [-1] * (1 << bits)
    for pair, n in pairs.items():
        entry, at = pair * ID + n, None
        for _ in range(500):
            first, second = _places(entry // ID, bits)
            at = second if at == first or (at is None and slots[first] >= 0 > slots[second]) else first
            slots[at], entry = entry, slots[at]
            if entry < 0:
                break
        else:
            raise ValueError("the rank table is too full")
    return slots, bits


def _literal(values: list) -> Column:
    return F.split(F.lit(SEPARATOR.join(map(str, values))), SEPARATOR, -1)


def rank_literal(ranks: dict[bytes, int]) -> tuple[Column, int]:
    """The rank map as a literal: ids of single bytes, merges of two bytes by position, all merges by hash."""
    if max(ranks.values()) >= ID - 1 or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the rank file must rank every byte and hold fewer than 65,535 strings")
    slots, bits = rank_table(mergeable(ranks))
    letters = [ranks[bytes([b])] for b in range(256)]
    two = [ranks.get(bytes([a, b]), NONE) for a in range(256) for b in range(256)]
    table = F.struct(
        _literal(slots).cast("array<bigint>").alias("slots"), _literal(letters).cast("array<int>").alias("letters"), _literal(two).cast("array<int>").alias("two")
    )
    return table, bits


def _merged(table: Column, bits: int, left: Column, right: Column) -> Column:
    """Id of two neighbours joined, NONE if their bytes have no rank."""

    def find(pair: Column) -> Column:
        mask = F.lit((1 << bits) - 1)
        entry = [F.get(table["slots"], F.shiftright(pair * F.lit(m), SHIFT).bitwiseAND(mask).cast("int")) for m in MIXERS]
        return F.coalesce(*[F.when(F.shiftright(e, 16) == pair, e.bitwiseAND(F.lit(ID - 1))) for e in entry], F.lit(NONE).cast("long"))

    return let(left * F.lit(ID) + right, find)


def _merge_step(table: Column, bits: int, state: Column) -> Column:
    """The state after merging the neighbours that rank lowest; only the two new pairs are looked up."""
    best = F.array_min(state)
    new = F.shiftright(best, 16)  # the rank of joined bytes is their id

    def apply(at: Column) -> Column:
        before, behind = (F.get(state, i).bitwiseAND(F.lit(ID - 1)) for i in (at - 2, at + 1))
        left = _merged(table, bits, before, new) * F.lit(ID) + before
        right = _merged(table, bits, new, behind) * F.lit(ID) + new
        return F.concat(F.slice(state, F.lit(1), at - 2), F.array(left, right), F.slice(state, at + 2, F.size(state)))

    return let(F.array_position(state, best).cast("int"), apply)


def encode_word(table: Column, bits: int, word: Column) -> Column:
    """Ids of one word, given as its bytes: a fold of merge steps.

    The state has a number for each part: the rank of its bytes joined with the next
    part's, then its own id. A mark at either end never merges. The least number is the
    next merge, the leftmost of equal pairs.
    """

    def fold(data: Column) -> Column:
        n = F.size(data)
        inner = F.transform(
            F.sequence(F.lit(0), n - 2),
            lambda i: F.get(table["two"], F.get(data, i) * 256 + F.get(data, i + 1)).cast("long") * F.lit(ID) + F.get(table["letters"], F.get(data, i)),
        )
        mark = F.lit(NONE).cast("long") * F.lit(ID)
        first = F.array(mark + F.lit(ID - 1))
        last = F.array(mark + F.get(table["letters"], F.get(data, n - 1)), mark + F.lit(ID - 1))
        start = F.concat(first, F.when(n > 1, inner).otherwise(F.array().cast("array<bigint>")), last)
        step = lambda state, _: F.when(F.array_min(state) < mark, _merge_step(table, bits, state)).otherwise(state)
        ids = lambda state: F.transform(F.slice(state, F.lit(2), F.size(state) - 2), lambda x: x.bitwiseAND(F.lit(ID - 1)).cast("int"))
        return F.aggregate(F.sequence(F.lit(1), n), start, step, ids)

    return F.when(F.size(word) == 0, F.array().cast("array<int>")).otherwise(fold(word))


def vocabulary_literal(ranks: dict[bytes, int]) -> Column:
    """The byte strings by id, in hexadecimal; empty for an id without one."""
    known = {n: token.hex() for token, n in ranks.items()}
    return _literal([known.get(n, "") for n in range(max(known) + 1)])


def _decoded(vocabulary: Column, ids: Column) -> Column:
    pieces = F.transform(ids, lambda i: F.get(vocabulary, i))
    bad = F.exists(pieces, lambda p: p.isNull() | (p == ""))
    return F.when(bad, F.lit(None).cast("binary")).otherwise(F.unhex(F.array_join(pieces, "")))


def decode_ids(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Bytes of an array of ids: the binary pieces of a literal vocabulary, joined. Null for an unknown id."""
    return let(vocabulary_literal(ranks), lambda vocabulary: _decoded(vocabulary, ids))


def heap_encode(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word: neighbours are merged from a heap, lowest rank and leftmost first."""
    n = len(word)
    ends, after, before, alive = [i + 1 for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def entry(i: int):
        j = after[i]
        rank = ranks.get(word[i : ends[j]]) if j < n else None
        return None if rank is None else (rank, i, ends[i], ends[j])

    heap = [e for e in map(entry, range(n)) if e]
    heapq.heapify(heap)
    while heap:
        _, i, end, to = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if not alive[i] or ends[i] != end or j >= n or ends[j] != to:
            continue
        ends[i], after[i], alive[j] = to, after[j], False
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and (e := entry(k)):
                heapq.heappush(heap, e)
    return [ranks[word[i : ends[i]]] for i in range(n) if alive[i]]


def split_pattern(pattern: str):
    """The split pattern with white space as Unicode defines it."""
    import regex

    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c != " ")
UNEVEN = f"^ | $|  | [{SPACES}]|[{SPACES}] "  # a space that starts or ends the text or touches other white space


def _steps(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _binary(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """Byte strings that lie one after the other in `data`, between bounds that begin with 0."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _bounds(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bounds of strings, beginning with 0, and their bytes."""
    _, ends, data = strings.buffers()
    ends = np.frombuffer(ends, np.int32)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int32)
    return ends - ends[0], (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[ends[0] : ends[-1]]


def _strings(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


class _Words:
    """Numbers of the distinct words of a task's blocks, and of the words of its texts.

    No match of a pattern that joins one space to what follows it crosses a single space
    between two other characters, so texts are cut there and each distinct part of a block
    is split once. Words encoded ahead have the first numbers. Words of earlier blocks keep
    theirs until there are too many; then a new run begins.
    """

    def __init__(self, pattern: str, path: str, ahead: pa.Array, kept: int):
        self.match, self.path, self.ranks, self.ahead, self.kept = split_pattern(pattern).finditer, path, {}, ahead, kept
        # a space and letters are one match, and what ASCII punctuation follows them is one more
        self.plain = r" ?\p{L}+" in pattern and r" ?[^\s\p{L}\p{N}]+" in pattern
        self.known = ahead

    def split(self, texts: pa.Array) -> tuple[bool, np.ndarray, np.ndarray, pa.Array, list[list[int]]]:
        """Is it a new run, word numbers of all texts, how many each text has, new words, ids of new long words (numbered last)."""
        fresh = len(self.known) - len(self.ahead) >= self.kept or self.known.nbytes - self.ahead.nbytes >= 32 * self.kept
        if fresh:
            self.known = self.ahead
        found, extra = [], {}  # word numbers of odd strings, and those words

        def odd(strings: Iterable[str]) -> None:
            found.extend(array("i", [extra.setdefault(m[0], len(extra)) for m in self.match(s)]) for s in strings)

        uneven = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
        starts, data = _bounds(texts)
        spaces = np.flatnonzero(data == ord(" "))
        spaces = spaces[~uneven[np.searchsorted(starts, spaces, "right") - 1]]  # the last of equal starts is that of the text with the space
        heads = np.arange(len(texts)) + np.searchsorted(spaces, starts[:-1])
        behind = np.ones(len(texts) + len(spaces), bool)
        behind[heads] = False
        cuts = np.empty(len(behind) + 1, np.int32)
        cuts[heads], cuts[:-1][behind], cuts[-1] = starts[:-1], spaces, starts[-1]
        flat = _binary(cuts, data).cast(pa.string())  # a part has its space in front
        coded, whole = (flat.filter(pa.array(which)).dictionary_encode() for which in (behind, ~behind))
        every = np.empty(len(flat), np.int64)
        every[behind] = coded.indices.to_numpy()
        every[heads] = whole.indices.to_numpy().astype(np.int64) + len(coded.dictionary)

        stems = pc.utf8_rtrim(coded.dictionary, characters=string.punctuation)
        strings, stem_strings = _strings(coded.dictionary), _strings(stems)
        plain = np.fromiter((self.plain and s[1:].isalpha() for s in stem_strings), bool, len(strings))
        tails = {}  # part -> number of the punctuation behind its letters
        for i in np.flatnonzero(plain & (pc.binary_length(stems).to_numpy() < pc.binary_length(coded.dictionary).to_numpy())).tolist():
            tails[i] = extra.setdefault(strings[i][len(stem_strings[i]) :], len(extra))
        odd(strings[i] for i in np.flatnonzero(~plain).tolist())
        odd(_strings(whole.dictionary))
        del strings, stem_strings

        spaced = stems.filter(pa.array(plain))
        distinct = pa.concat_arrays([spaced, pa.array(list(extra), pa.string())]).dictionary_encode()
        numbers, new, longs = self.number(distinct.dictionary.cast(pa.binary()))
        numbers = numbers[distinct.indices.to_numpy()]

        # the words of each part, one part after the other: one with letters, its punctuation, or those of an odd string
        with_tail, others = np.fromiter(tails, np.int64, len(tails)), np.concatenate([np.flatnonzero(~plain), len(plain) + np.arange(len(whole.dictionary))])
        sizes = np.ones(len(plain) + len(whole.dictionary), np.int64)
        sizes[with_tail], sizes[others] = 2, [len(f) for f in found]
        starts, listed = np.cumsum(sizes) - sizes, np.empty(sizes.sum(), np.int32)
        listed[starts[: len(plain)][plain]] = numbers[: len(spaced)]
        listed[starts[with_tail] + 1] = numbers[len(spaced) + np.fromiter(tails.values(), np.int64, len(tails))]
        flat_odd = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(f, np.int32) for f in found)])
        listed[np.repeat(starts[others], sizes[others]) + _steps(sizes[others])] = numbers[len(spaced) + flat_odd]

        n = sizes[every]
        counts = np.add.reduceat(n, heads) if len(heads) else n
        return fresh, listed[np.repeat(starts[every], n) + _steps(n)], counts, new, longs

    def number(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, list[list[int]]]:
        """Numbers of distinct words, the new ones of at most LONG bytes, and ids of new longer ones."""
        at = pc.index_in(words, value_set=self.known)
        missing = at.is_null().to_numpy(zero_copy_only=False)
        long = pc.binary_length(words).to_numpy() > LONG
        new, longs = (words.filter(pa.array(missing & which)) for which in (~long, long))
        numbers = at.fill_null(0).to_numpy().astype(np.int32)
        numbers[missing & ~long] = len(self.known) + np.arange(len(new))
        numbers[missing & long] = len(self.known) + len(new) + np.arange(len(longs))
        self.known = pa.concat_arrays([self.known, new, longs])
        if len(longs):
            self.ranks = self.ranks or load_ranks(self.path)
        return numbers, new, [heap_encode(w, self.ranks) for w in longs.to_pylist()]


def _letters(words: pa.Array) -> pa.Array:
    """Lists of the bytes of words."""
    ends, data = _bounds(words)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(data.astype(np.int16)))


class Ahead:
    """Words encoded ahead: their bytes, and their ids as one array with bounds."""

    def __init__(self, words: pa.Array, flat: np.ndarray, bounds: np.ndarray):
        self.words, self.flat, self.bounds = words, flat, bounds


def encode_ahead(texts: DataFrame, path: str, pattern: str, most: int = COMMON, chars: int = COMMON_CHARS) -> Ahead:
    """Encode the most frequent words of a bounded sample of the text column `__llm_text`.

    Whole texts are drawn, about `chars` characters of them; at most `most` short
    byte strings come back to the driver.
    """
    total = texts.agg(F.sum(F.length("__llm_text").cast("long"))).first()[0] or 0
    drawn = texts.where(F.rand(7) < min(1.0, chars / max(total, 1)))  # row by row, so copies do not come together

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.array([], pa.binary())
        for batch in _blocks(batches, BLOCK):
            _, index, _, new, _ = _Words(pattern, path, none, 0).split(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([_letters(new), pa.array(np.bincount(index, minlength=len(new))[: len(new)], pa.int64())], ["word", "n"])

    counts = drawn.select("__llm_text").mapInArrow(count, "word array<smallint>, n long").groupBy("word").agg(F.sum("n").alias("n"))
    often = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(most).repartition(AHEAD_TASKS)
    literal, bits = rank_literal(load_ranks(path))
    found = often.select("word", let(literal, lambda table: encode_word(table, bits, F.col("word"))).alias("ids")).toArrow()
    words, ids = (found.column(c).combine_chunks() for c in ("word", "ids"))
    spell = lambda a: (a.values.to_numpy(zero_copy_only=False), a.offsets.to_numpy())
    letters, ends = spell(words) if len(words) else (np.zeros(0, np.int16), np.zeros(1, np.int32))
    flat, bounds = spell(ids) if len(ids) else (np.zeros(0, np.int32), np.zeros(1, np.int32))
    return Ahead(_binary(ends, letters.astype(np.uint8)), flat.astype(np.int32), bounds.astype(np.int64))


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `block` characters in the last column, more only for one row."""
    held, size = [], 0
    for batch in batches:
        at = 0
        for row, n in enumerate(pc.utf8_length(batch.column(batch.num_columns - 1)).to_pylist()):
            if size and size + n > block:
                held.append(batch.slice(at, row - at))
                full, held, size, at = held, [], 0, row
                yield pa.concat_batches(full)
                del full
            size += n
        if at < batch.num_rows:
            held.append(batch.slice(at) if at == 0 else batch.take(pa.array(np.arange(at, batch.num_rows))))  # a copy holds no batch
    if held:
        yield pa.concat_batches(held)


def _to_blocks(pattern: str, path: str, block: int, ahead: pa.Array, kept: int = KEPT):
    """mapInArrow function: rows (other columns, text) to rows of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(pattern, path, ahead, kept)
        for serial, batch in enumerate(_blocks(batches, block)):
            others = batch.select(range(batch.num_columns - 1))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, others.schema) as out:
                out.write_batch(others)
            fresh, index, counts, new, longs = words.split(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([serial], pa.int32()), pa.array([fresh]), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                 pa.array([pa.compress(index.astype("<i4").tobytes(), "zstd", asbytes=True)], pa.binary()), pa.array([counts.astype("<i8").tobytes()], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(new)], pa.int32()), _letters(new)), pa.array([longs], pa.list_(pa.list_(pa.int32())))],
                ["serial", "fresh", "rows", "word_index", "word_counts", "words", "long_ids"],
            )
            del batch, others, sink, index, counts, new, longs
            pa.default_memory_pool().release_unused()

    return run


def _from_blocks(finish: Callable[[np.ndarray, memoryview | None], list], fields: list[tuple[str, pa.DataType]], flat: np.ndarray, bounds: np.ndarray, spelled: str | None):
    """mapInArrow function: encoded blocks back to rows, with the columns `finish` makes of each row's ids.

    A block brings the ids of its new words; those of earlier blocks of the task are kept
    until a new run begins. `flat` and `bounds` are the ids of the words encoded ahead.
    With the path of the ranks in `spelled`, `finish` also gets the bytes that the ids
    stand for: each distinct word is put together from the pieces of its ids.
    """

    def spell(pieces: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        made = pieces.take(pa.array(ids, pa.int32()))
        data, places = made.buffers()[2], np.frombuffer(made.buffers()[1], np.int32, len(ids) + 1)
        return _binary(places[ends], np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, first_ids, first_bytes, words, letters, expected = None, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32())), None, None, None, 0
        if spelled:
            known = {n: token for token, n in load_ranks(spelled).items()}
            pieces = pa.array([known.get(n, b"") for n in range(max(known) + 1)], pa.binary())
            first_bytes = spell(pieces, flat, bounds)
        for batch in batches:
            for at in range(batch.num_rows):
                serial, fresh, rows, index, counts, ids = (batch.column(c)[at] for c in ("serial", "fresh", "rows", "word_index", "word_counts", "ids"))
                if serial.as_py() != expected:
                    raise ValueError("the blocks of a task came out of order")
                if fresh.as_py() or expected == 0:
                    words, letters = first_ids, first_bytes
                expected += 1
                ends = ids.values.offsets.to_numpy().astype(np.int64)  # a list of ids per new word
                new = ids.values.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(np.int32)
                words = pa.concat_arrays([words, pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(new))])
                ends_of_texts = np.concatenate([[0], np.cumsum(np.frombuffer(counts.as_buffer(), "<i8"))])
                index = pa.array(np.frombuffer(pa.decompress(index.as_buffer(), 4 * int(ends_of_texts[-1]), "zstd"), "<i4"))
                taken = words.take(index)
                tokens, per_word = taken.values.to_numpy(), taken.offsets.to_numpy()
                id_ends, data, byte_ends = per_word[ends_of_texts], None, None
                if pieces is not None:
                    letters = pa.concat_arrays([letters, spell(pieces, new, ends - ends[0])])
                    text = letters.take(index)
                    byte_ends = np.frombuffer(text.buffers()[1], np.int32, len(index) + 1)[ends_of_texts]
                    data = memoryview(text.buffers()[2] or b"")
                row = 0
                with pa.ipc.open_stream(pa.py_buffer(rows.as_buffer())) as stream:
                    for part in stream:
                        made = []
                        for i in range(row, row + part.num_rows):
                            made.append(finish(tokens[id_ends[i] : id_ends[i + 1]], None if data is None else data[byte_ends[i] : byte_ends[i + 1]]))
                        row += part.num_rows
                        columns = [pa.array([m[i] for m in made], kind) for i, (_, kind) in enumerate(fields)]
                        yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *(name for name, _ in fields)])
                taken = tokens = per_word = index = text = data = made = columns = None
                pa.default_memory_pool().release_unused()

    return run


def _encoded(read: DataFrame, path: str, pattern: str, block: int, finish, fields: list[tuple[str, str, pa.DataType]], spelled: bool = False) -> DataFrame:
    """Rows whose last column is the text, with it replaced by the columns `finish` makes; fields are (name, Spark type, Arrow type)."""
    ahead = encode_ahead(read.select("__llm_text"), path, pattern)
    schema = "serial int, fresh boolean, rows binary, word_index binary, word_counts binary, words array<array<smallint>>, long_ids array<array<int>>"
    blocks = read.mapInArrow(_to_blocks(pattern, path, block, ahead.words), schema)
    literal, bits = rank_literal(load_ranks(path))
    ids = let(literal, lambda table: F.transform("words", lambda w: encode_word(table, bits, w)))
    encoded = blocks.select("serial", "fresh", "rows", "word_index", "word_counts", F.concat(ids, "long_ids").alias("ids"))
    kept = [f for f in read.schema.fields if f.name != "__llm_text"]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{name}` {kind}" for name, kind, _ in fields]
    back = _from_blocks(finish, [(name, kind) for name, _, kind in fields], ahead.flat, ahead.bounds, path if spelled else None)
    return encoded.mapInArrow(back, ", ".join(kinds))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", block: int = BLOCK) -> DataFrame:
    """`docs` with the array of ids of `text_col`; null counts as empty, an empty text has no ids.

    A column that is already named `ids_col` is replaced; rows, also repeated ones, and
    all other columns stay. An empty table gives an empty result.
    """
    docs = without(docs, [ids_col])
    read = docs.select(*docs.columns, whole_text(text_col).alias("__llm_text"))
    return _encoded(read, path, pattern, block, lambda ids, _: [ids], [(ids_col, "array<int>", pa.list_(pa.int32()))])


def encode_digest(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, n_tokens, ids_sha256 of little-endian unsigned 32-bit ids, decoded_sha256), without the texts.

    The ids are decoded by joining the binary pieces they stand for.
    """
    def finish(ids: np.ndarray, data: memoryview) -> list:
        return [len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(data).hexdigest()]

    read = docs.select(id_col, whole_text(text_col).alias("__llm_text"))
    fields = [("n_tokens", "long", pa.int64()), ("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    return _encoded(read, path, pattern, block, finish, fields, spelled=True)
