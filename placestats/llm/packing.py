"""Best-fit packing by a linear grouping scheme, decided on lengths alone.

Lengths are whole numbers up to the capacity, so the corpus is described by at most
`capacity` counts, whatever its size. From these counts the driver makes the plan:

1. large lengths are sorted and cut into groups of equal cardinality, and every length
   is rounded up to the greatest of its group, which leaves a few sizes;
2. a configuration is a multiset of these sizes that fits one sequence; column
   generation (a knapsack per step) finds the configurations and how often to use each;
3. actual documents take the places of their group's size, longest first; what the
   rounding down of the configuration counts leaves over is placed by best fit;
4. small documents go by best fit, longest first, into the room that is really left.

Sequences with the same content are one run, so every step works on runs. Documents are
then told their place by the rank among documents of their length: ranks are counted
per task, shifted by the counts of earlier tasks, and looked up in the plan.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placestats.llm.common import whole_text
from placestats.session import materialize

CAPACITY = 2048
GROUPS = 32
SMALL = (0.12, 0.25, 0.34, 0.5)  # shares of the capacity up to which a length counts as small; the best plan is taken
STEPS = 150  # most steps of column generation; the plan is valid after any of them
# fixed value: the split rule of byte-level pre-tokenizers
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"



class Run:
    """`count` sequences with the same pieces: a list of (length, copies) in order."""

    __slots__ = ("count", "pieces", "room")

    def __init__(self, count: int, pieces: list[tuple[int, int]], room: int):
        self.count, self.pieces, self.room = count, pieces, room


def linear_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Cut the sorted lengths into groups of equal cardinality: lists of (length, count), longest first.

    A length that alone fills more than a group stays together in one.
    """
    total = sum(counts.values())
    quota = max(1, -(-total // groups))
    out: list[list[tuple[int, int]]] = []
    held = quota
    for length in sorted(counts, reverse=True):
        if held >= quota:
            out.append([])
            held = 0
        out[-1].append((length, counts[length]))
        held += counts[length]
    return out


def _knapsack(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best multiset of sizes within the capacity, unlimited copies."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    order = np.flatnonzero(value > 1e-12)
    for c in range(int(sizes.min()), capacity + 1):
        fits = order[sizes[order] <= c]
        gain = best[c - sizes[fits]] + value[fits]
        best[c], took[c] = best[c - 1], -1
        if len(gain):
            k = int(gain.argmax())
            if gain[k] > best[c] + 1e-12:
                best[c], took[c] = gain[k], fits[k]
    config, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            config[took[c]] += 1
            c -= sizes[took[c]]
    return float(best[capacity]), config


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each: the optimum of the fractional problem, rounded down.

    A revised simplex over configurations as columns; each step asks a knapsack for the
    configuration that the present prices undervalue most.
    """
    n = len(sizes)
    columns = [np.where(np.arange(n) == i, capacity // sizes[i], 0) for i in range(n)]
    inverse = np.diag([1.0 / c[i] for i, c in enumerate(columns)])
    amount = inverse @ demand
    for _ in range(steps):
        price = inverse.sum(axis=0)  # every configuration costs one sequence
        worth, config = _knapsack(sizes, price, capacity)
        if worth <= 1 + 1e-7:
            break
        way = inverse @ config
        able = way > 1e-9
        ratio = np.full(n, np.inf)
        ratio[able] = amount[able] / way[able]
        out = int(ratio.argmin())
        columns[out] = config
        inverse[out] /= way[out]
        rest = np.arange(n) != out
        inverse[rest] -= np.outer(way[rest], inverse[out])
        amount = np.maximum(inverse @ demand, 0)
    return [(c, int(np.floor(a + 1e-9))) for c, a in zip(columns, amount)]


def _place(groups: list[list[tuple[int, int]]], chosen: list[tuple[np.ndarray, int]], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """Substitute actual lengths, longest first, for the rounded ones; lengths left over come back as counts."""
    left = [[list(x) for x in g] for g in groups]
    runs = []
    for config, times in chosen:
        slots = [g for g in np.flatnonzero(config) for _ in range(config[g])]
        while times:
            # as long as no slot's length runs out, all sequences of this step are alike
            use: dict[tuple[int, int], int] = defaultdict(int)
            taken: list[int] = []
            for g in slots:
                for at, (length, count) in enumerate(left[g]):
                    if count > use[g, at]:
                        use[g, at] += 1
                        taken.append(length)
                        break
            if not taken:
                break
            step = min([times, *(left[g][at][1] // n for (g, at), n in use.items() if n)])
            for (g, at), n in use.items():
                left[g][at][1] -= step * n
            runs.append(Run(step, _tally(taken), capacity - sum(taken)))
            times -= step
    return runs, {length: count for g in left for length, count in g if count}


def _tally(lengths: list[int]) -> list[tuple[int, int]]:
    out: dict[int, int] = defaultdict(int)
    for x in sorted(lengths, reverse=True):
        out[x] += 1
    return list(out.items())


def best_fit(runs: list[Run], counts: dict[int, int], capacity: int) -> list[Run]:
    """Put every length, longest first, where the least room is left; new sequences only where nothing fits."""
    open_rooms: list[int] = []
    by_room: dict[int, list[Run]] = defaultdict(list)
    done: list[Run] = []

    def put(run: Run) -> None:
        if not run.count:
            return
        if run.room <= 0:
            done.append(run)
            return
        if not by_room[run.room]:
            insort(open_rooms, run.room)
        by_room[run.room].append(run)

    for run in runs:
        put(run)
    for length in sorted(counts, reverse=True):
        need = counts[length]
        while need:
            at = bisect_left(open_rooms, length)
            if at == len(open_rooms):
                each = capacity // length
                full, rest = divmod(need, each)
                put(Run(full, [(length, each)], capacity - each * length))
                if rest:
                    put(Run(1, [(length, rest)], capacity - rest * length))
                break
            room = open_rooms[at]
            run = by_room[room].pop()
            if not by_room[room]:
                open_rooms.pop(at)
            each = room // length  # the sequence just filled stays the tightest
            full = min(run.count, need // each)
            rest = min(need - full * each, each) if full < run.count else 0
            put(Run(full, run.pieces + [(length, each)], room - each * length))
            if rest:
                put(Run(1, run.pieces + [(length, rest)], room - rest * length))
            put(Run(run.count - full - bool(rest), run.pieces, room))
            need -= full * each + rest
    return done + [r for room in open_rooms for r in by_room[room]]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: tuple[float, ...] = SMALL) -> list[Run]:
    """Runs of sequences that hold every length of `counts` (length -> number of pieces), over the best share of `small`."""
    counts = {int(k): int(v) for k, v in counts.items() if v}
    if any(not 0 < k <= capacity for k in counts):
        raise ValueError("every length must be between 1 and the capacity")
    plans = [_plan(counts, capacity, groups, int(share * capacity)) for share in small]
    return min(plans, key=lambda runs: sum(r.count for r in runs))


def _plan(counts: dict[int, int], capacity: int, groups: int, small: int) -> list[Run]:
    large = {k: v for k, v in counts.items() if small < k < capacity}
    runs = [Run(counts[capacity], [(capacity, 1)], 0)] if capacity in counts else []
    rest = {k: v for k, v in counts.items() if k <= small and k < capacity}
    if large:
        cut = linear_groups(large, groups)
        sizes = np.array([g[0][0] for g in cut])
        demand = np.array([float(sum(n for _, n in g)) for g in cut])
        filled, over = _place(cut, configurations(sizes, demand, capacity), capacity)
        runs += filled
        rest |= over
    return best_fit(runs, rest, capacity)


def places(runs: list[Run]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, copies in each sequence, offset of the first copy)."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for run in runs:
        offset = 0
        for length, copies in run.pieces:
            out[length].append((used[length], sequence, copies, offset))
            used[length] += run.count * copies
            offset += length * copies
        sequence += run.count
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def pieces_of(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; of a long one the first may be shorter."""
    if total <= capacity:
        return [(0, total)]
    head = total % capacity
    cuts = ([(0, head)] if head else []) + [(s, capacity) for s in range(head, total, capacity)]
    return cuts


def merge_ranks(tokenizer_path: str) -> dict[bytes, int] | None:
    """Byte strings and ids of a byte-level BPE file whose ids follow its merges; None for any other file."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    if not plain or model.get("type", "BPE") != "BPE" or model.get("ignore_merges"):
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): n for token, n in model["vocab"].items() if token not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"]["".join(pair)] for pair in pairs]
    return ranks if order == sorted(order) and all(bytes([b]) in ranks for b in range(256)) else None


def added_tokens_of(tokenizer_path: str) -> list[str]:
    """Literals that the file's tokenizer recognises in a text before it splits it."""
    with open(tokenizer_path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens") or []]


def token_bytes(tokenizer_path: str, end_id: int = 0, added_tokens: bool = False) -> Callable[[str], bytes]:
    """Encoder of a text to little-endian unsigned 32-bit ids, closed by `end_id`.

    With `added_tokens` the file's added tokens have their own id wherever a text holds
    them, as the library does by default; otherwise they are ordinary text. Byte-level
    files are run by the faster of two libraries that give the same ids; texts that hold
    an added token, and those it refuses, by the library of the file.
    """
    end = int(end_id).to_bytes(4, "little")
    ranks = merge_ranks(tokenizer_path)

    def by_library():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.encode_special_tokens = not added_tokens
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + end

    if ranks is None:
        return by_library()

    import tiktoken

    ids_of = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    whole = by_library()

    def fast(text: str) -> bytes:
        try:
            return (ids_of(text).astype("<u4").tobytes() if text else b"") + end
        except ValueError:  # its pattern gives up on very long runs of white space
            return whole(text)

    literals = added_tokens_of(tokenizer_path) if added_tokens else []
    return lambda text: whole(text) if any(t in text for t in literals) else fast(text)


def tokenized_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, capacity: int, end_id: int, added_tokens: bool = False) -> DataFrame:
    """Pieces of all documents with their task and their rank among the pieces of their length in that task."""
    id_type = dict(docs.dtypes)[id_col]
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, task int, nth long"

    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = token_bytes(tokenizer_path, end_id, added_tokens)
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                where, rows = [], []
                for row, data in enumerate(map(encode, part.column(1).to_pylist())):
                    for piece, (start, length) in enumerate(pieces_of(len(data) // 4, capacity)):
                        crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                        where.append(row)
                        rows.append((piece, start, length, crc, seen[length]))
                        seen[length] += 1
                piece, start, length, crc, nth = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(where)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64()), pa.array([task] * len(rows), pa.int32()), pa.array(nth, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
                )

    return docs.select(F.col(id_col), whole_text(text_col).alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = 0, groups: int = GROUPS, small: tuple[float, ...] = SMALL, added_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of `docs` is packed, also rows that repeat an id or have a null id; a null
    text counts as empty and still has its closing token. An empty table gives no rows.
    `added_tokens` gives literals of added tokens, such as <|endoftext|>, their own id.
    """
    pieces = materialize(tokenized_pieces(docs, id_col, text_col, tokenizer_path, capacity, end_id, added_tokens))
    per_task = materialize(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))
    totals = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    where = places(plan(totals, capacity, groups, small))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    # a count per length and task grows with the tasks, so it is never broadcast
    ranked = pieces.join(shifts.hint("merge"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("shift") + F.col("nth")).alias("rank")
    )
    id_type = dict(ranked.dtypes)["doc_id"]

    def locate(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                table = where[int(n)]
                row = table[np.searchsorted(table[:, 0], rank[own], side="right") - 1]
                inside = rank[own] - row[:, 0]
                sequence[own] = row[:, 1] + inside // row[:, 2]
                offset[own] = row[:, 3] + inside % row[:, 2] * n
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(locate, schema)
