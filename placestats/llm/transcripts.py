"""Transcript parsing: a hidden Markov model over marker and line features recovers roles.

Rows of a transcript are cut into units: a unit starts with each row and at each line
that opens with a speaker marker ("User:", "### Assistant", "<|im_start|>system", ...).
A unit is observed as its marker (from the line, or else from the row's own role column),
whether it opens its transcript, how long it is, and features of its lines. The
probabilities of roles following each other and of features given a role are counted over
all units with a marker, on Spark. Viterbi then finds the most likely roles of a whole
transcript, and every unit is rendered in one canonical form.

Rows are dealt by range of (transcript, position), so a transcript of any length spreads
over as many partitions as it fills. Best paths combine like matrix products in which
sums are maxima: each partition tells its best scores between all pairs of roles, these
few numbers are chained per transcript to settle the roles at the borders, and each
partition then finds its own part of the path between settled borders.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placestats.session import materialize, release

ROLES = ["system", "user", "assistant", "tool"]
# names that stand for a role in markers and role columns
NAMES = {
    "system": "system", "sys": "system", "instructions": "system", "user": "user", "human": "user", "customer": "user", "client": "user", "question": "user",
    "q": "user", "prompt": "user", "you": "user", "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant",
    "agent": "assistant", "answer": "assistant", "a": "assistant", "response": "assistant", "tool": "tool", "function": "tool", "observation": "tool",
}
LONG_NAMES = "|".join(sorted((n for n in NAMES if len(n) > 1), key=len, reverse=True))
MARKER = re.compile(
    rf"""^[ \t]*(?:
        <\|(?:im_start\|>)?(?P<angle>{LONG_NAMES})(?:\|>|[ \t]*$)[ \t]*
      | \#{{1,6}}[ \t]*(?P<head>{LONG_NAMES})[ \t]*:?[ \t]*$
      | [\[*_]{{0,3}}(?P<named>{LONG_NAMES}|q|a)[\]*_]{{0,3}}[ \t]*:[*_]{{0,2}}(?:[ \t]+|$)
    )""",
    re.VERBOSE | re.IGNORECASE,
)
CLOSER = re.compile(r"<\|(?:im_end|end|eot_id)\|>[ \t]*$")

TRUST = 0.97  # chance that a marker tells the truth
LENGTHS = [40, 120, 300, 700, 1500]  # characters that bound the classes of unit length
FEATURES = {"opens": 2, "length": len(LENGTHS) + 1, "lines": 4, "question": 2, "listing": 2, "code": 2, "please": 2}
SMOOTHING = 1.0
RANGE = 4 << 20  # characters of text in a range
ROUNDS = 4  # of counting again, where nothing is marked
# counts to start from where nothing is marked: a turn of another role follows, users ask and are brief
PRIOR_START = [2.0, 8.0, 0.5, 0.1]
PRIOR_MOVE = [[0.1, 9.0, 0.8, 0.1], [0.1, 0.5, 9.0, 0.4], [0.1, 9.0, 0.5, 0.4], [0.1, 0.5, 9.0, 0.4]]
PRIOR_HINTS = {"question": [0.1, 0.6, 0.1, 0.05], "listing": [0.1, 0.1, 0.4, 0.2], "code": [0.05, 0.1, 0.3, 0.3], "please": [0.1, 0.5, 0.1, 0.05]}


def role_of(name: str | None) -> int:
    """Number of the role a name stands for, -1 for none."""
    return ROLES.index(NAMES[key]) if (key := (name or "").strip().lower()) in NAMES else -1


def units(text: str) -> list[tuple[int, str]]:
    """(marked role or -1, body) of the units of a row's whole text; at least one."""
    out: list[tuple[int, list[str]]] = [(-1, [])]
    for line in text.split("\n"):
        m = MARKER.match(line)
        if m:
            role = role_of(m["angle"] or m["head"] or m["named"])
            rest = line[m.end() :]
            if len(out) == 1 and not any(x.strip() for x in out[0][1]):
                out[0] = (role, [rest] if rest else [])
            else:
                out.append((role, [rest] if rest else []))
        else:
            out[-1][1].append(line)
    return [(role, CLOSER.sub("", "\n".join(lines)).strip()) for role, lines in out]


def observed(body: str, opens: bool) -> list[int]:
    """Classes of the features of a unit, in the order of FEATURES."""
    lines = body.split("\n")
    listing = any(x.lstrip()[:2] in ("- ", "* ") or x.lstrip()[:1].isdigit() and x.lstrip()[1:3] in (". ", ") ") for x in lines)
    return [
        int(opens), int(np.searchsorted(LENGTHS, len(body), "right")), min(len(lines) - 1, 3), int(body.rstrip().endswith("?")), int(listing),
        int("```" in body), int(body[:20].lower().startswith(("please", "can you", "how ", "what ", "why ", "write "))),
    ]


class Model:
    """Log-probabilities: start[s], move[s, t], and emit[feature][s, class]."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]):
        logs = lambda x: np.log((x + SMOOTHING) / (x + SMOOTHING).sum(axis=-1, keepdims=True))
        self.start, self.move, self.emit = logs(start), logs(move), [logs(e) for e in emit]
        s = len(ROLES)
        truth = np.full((s, s), (1 - TRUST) / (s - 1))
        np.fill_diagonal(truth, TRUST)
        self.mark = np.vstack([np.log(truth), np.zeros(s)])  # marker -1: nothing is said

    def scores(self, marks: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log-likelihood of each unit under each role."""
        out = self.mark[marks].copy()
        for f, table in enumerate(self.emit):
            out += table[:, classes[:, f]].T
        return out

    def span(self, scores: np.ndarray, opens: bool) -> np.ndarray:
        """Best score of a run of units between the role before it (rows; one row if it opens) and its last role."""
        best = (self.start + scores[0])[None, :] if opens else self.move + scores[0][None, :]
        for row in scores[1:]:
            best = (best[:, :, None] + self.move[None]).max(axis=1) + row
        return np.repeat(best, len(ROLES), axis=0) if opens else best

    def path(self, scores: np.ndarray, before: int, last: int) -> np.ndarray:
        """Best roles of a run of units; before: role of the unit before it or -1; last: settled last role or -1."""
        best = (self.start if before < 0 else self.move[before]) + scores[0]
        back = np.zeros((len(scores), len(ROLES)), np.int8)
        for i, row in enumerate(scores[1:], 1):
            through = best[:, None] + self.move
            back[i] = through.argmax(axis=0)
            best = through.max(axis=0) + row
        roles = np.zeros(len(scores), np.int64)
        roles[-1] = int(best.argmax()) if last < 0 else last
        for i in range(len(scores) - 1, 0, -1):
            roles[i - 1] = back[i, roles[i]]
        return roles


def dealt(df: DataFrame, key: str, order: str, text: str, role: str | None) -> DataFrame:
    """Units of all rows with the partition and place that range dealing gives them, written out."""
    rows = df.select(
        F.col(key).alias("key"), F.col(order).alias("place"), F.col(text).alias("text"), (F.col(role).cast("string") if role else F.lit(None).cast("string")).alias("given")
    )
    tie = F.xxhash64("text", "given")
    sort = [F.col("key").asc_nulls_first(), F.col("place").asc_nulls_first(), tie]
    # ranges hold about as many characters at every size of the table
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()
    parts = max(1, -(-size // RANGE), min(df.sparkSession.sparkContext.defaultParallelism, n // 1000))
    placed = rows.withColumn("tie", tie).repartitionByRange(parts, *sort).sortWithinPartitions("key", "place", "tie", "text", "given")
    # from here on keys are text, which pandas keeps exact also among nulls
    plain = placed.select(F.col("key").cast("string").alias("key"), F.col("place").cast("string").alias("place"), "text", "given")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for k, place, text, given in zip(rows["key"], rows["place"], rows["text"], rows["given"]):
                for unit, (mark, body) in enumerate(units(text or "")):
                    out.append((k, place, unit, mark if mark >= 0 or unit else role_of(given), body, text is None))
            yield pd.DataFrame(out, columns=["key", "place", "unit", "mark", "body", "missing"])

    numbered = plain.mapInPandas(cut, "key string, place string, unit int, mark int, body string, missing boolean")
    return materialize(numbered.withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()))


def _same(a: pd.Series) -> np.ndarray:
    """Does each row have the key of the row before it? Null equals null."""
    codes = pd.factorize(a, use_na_sentinel=False)[0]
    return np.r_[False, codes[1:] == codes[:-1]]


def _runs(rows: pd.DataFrame) -> list[tuple[int, int]]:
    starts = np.flatnonzero(~_same(rows["key"]))
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(rows)]))


def _classes(rows: pd.DataFrame, opens: np.ndarray) -> np.ndarray:
    return np.array([observed(b, bool(o)) for b, o in zip(rows["body"], opens)], dtype=np.int64).reshape(-1, len(FEATURES))


def _borders(cut: DataFrame) -> DataFrame:
    """Per partition: does its first transcript go on from the partition before, and with what mark there? One row each."""
    edge = F.struct("seq", "key", "mark")
    ends = cut.groupBy("part").agg(F.min(edge)["key"].alias("first"), F.max(edge).alias("last"))
    before = F.lag(F.struct("last")).over(Window.orderBy("part"))  # one row per partition of the table
    goes_on = before.isNotNull() & before["last"]["key"].eqNullSafe(F.col("first"))
    return materialize(ends.select("part", goes_on.alias("goes_on"), F.coalesce(before["last"]["mark"], F.lit(-1)).alias("mark_before")))


def prior() -> Model:
    """The model to start from where no unit is marked."""
    emit = []
    for name, n in FEATURES.items():
        chance = np.array(PRIOR_HINTS[name]) if name in PRIOR_HINTS else None
        emit.append(np.full((len(ROLES), n), 1.0) if chance is None else 20 * np.column_stack([1 - chance, chance]))
    return Model(10 * np.array(PRIOR_START), 10 * np.array(PRIOR_MOVE), emit)


def fit(cut: DataFrame, borders: DataFrame) -> Model | None:
    """Counts over all marked units and all moves between marked neighbours; None where no unit is marked."""
    s = len(ROLES)

    def count(rows: pd.DataFrame, border: pd.DataFrame) -> pd.DataFrame:
        out: dict[tuple[int, int, int], int] = {}
        if len(rows):
            rows = rows.sort_values("seq")
            same, marks = _same(rows["key"]), rows["mark"].to_numpy()
            opens, earlier = ~same, np.r_[-1, marks[:-1]]
            if bool(border["goes_on"].iloc[0]):
                opens[0], earlier[0] = False, border["mark_before"].iloc[0]
            classes = _classes(rows, opens)
            for i, mark in enumerate(marks):
                if mark < 0:
                    continue
                cells = [(-1, 0, mark)] if opens[i] else [(-2, earlier[i], mark)] if earlier[i] >= 0 else []
                for cell in cells + [(f, mark, c) for f, c in enumerate(classes[i])]:
                    out[cell] = out.get(cell, 0) + 1
        return pd.DataFrame([(*map(int, k), v) for k, v in out.items()], columns=["what", "a", "b", "n"])

    counts = cut.groupBy("part").cogroup(borders.groupBy("part")).applyInPandas(count, "what int, a int, b int, n long")
    start, move, emit = np.zeros(s), np.zeros((s, s)), [np.zeros((s, n)) for n in FEATURES.values()]
    cells = counts.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()  # a few dozen cells
    for r in cells:
        (start if r.what == -1 else move[r.a] if r.what == -2 else emit[r.what][r.a])[r.b] = r.n
    return Model(start, move, emit) if cells else None


def _settle(cut: DataFrame, borders: DataFrame, model: Model) -> DataFrame:
    """(part, side, before, last): settled roles around the runs of transcripts that span partitions."""
    s = len(ROLES)

    def spans(rows: pd.DataFrame, border: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            rows = rows.sort_values("seq")
            runs, goes_on = _runs(rows), bool(border["goes_on"].iloc[0])
            for side in {0, len(runs) - 1}:
                a, b = runs[side]
                part = rows.iloc[a:b]
                opens = np.zeros(b - a, bool)
                opens[0] = not (side == 0 and goes_on)
                scores = model.scores(part["mark"].to_numpy(), _classes(part, opens))
                out.append((part["key"].iloc[0], int(rows["part"].iloc[0]), a, bool(opens[0]), model.span(scores, bool(opens[0])).ravel().tolist()))
        return pd.DataFrame(out, columns=["key", "part", "start", "opens", "span"])

    every = cut.groupBy("part").cogroup(borders.groupBy("part")).applyInPandas(spans, "key string, part int, start int, opens boolean, span array<double>")
    every = materialize(every)
    wide = every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("k"))
    chained = every.join(wide, every["key"].eqNullSafe(wide["k"]), "left_semi")

    def chain(runs: pd.DataFrame) -> pd.DataFrame:  # a row per partition that the transcript touches
        runs = runs.sort_values(["part", "start"])
        spans = [np.array(x).reshape(s, s) for x in runs["span"]]
        best, back = spans[0][0], []
        for span in spans[1:]:
            through = best[:, None] + span
            back.append(through.argmax(axis=0))
            best = through.max(axis=0)
        last = [int(best.argmax())]
        for step in reversed(back):
            last.append(int(step[last[-1]]))
        last.reverse()
        return pd.DataFrame({"part": runs["part"].to_numpy(), "start": runs["start"].to_numpy(), "before": [-1, *last[:-1]], "last": last})

    return materialize(chained.groupBy("key").applyInPandas(chain, "part int, start int, before int, last int"))


def decode(cut: DataFrame, borders: DataFrame, model: Model) -> DataFrame:
    """The units with `found`, the number of the role on the best path of their whole transcript."""
    settled = borders.join(_settle(cut, borders, model), "part", "left").select("part", "goes_on", "start", "before", "last")

    def best(rows: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return rows.assign(found=pd.Series(dtype="int32"))
        rows = rows.sort_values("seq")
        fixed = {int(a): (int(b), int(c)) for a, b, c in zip(around["start"], around["before"], around["last"]) if not pd.isna(a)}
        goes_on, roles = bool(around["goes_on"].iloc[0]), []
        for a, b in _runs(rows):
            part = rows.iloc[a:b]
            opens = np.zeros(b - a, bool)
            opens[0] = not (a == 0 and goes_on)
            before, last = fixed.get(a, (-1, -1))
            roles.append(model.path(model.scores(part["mark"].to_numpy(), _classes(part, opens)), before, last))
        return rows.assign(found=np.concatenate(roles).astype("int32"))

    schema = "key string, place string, unit int, mark int, body string, missing boolean, part int, seq long, found int"
    return cut.groupBy("part").cogroup(settled.groupBy("part")).applyInPandas(best, schema)


def parse(df: DataFrame, key: str = "conv_id", order: str = "turn", text: str = "text", role: str | None = "role") -> DataFrame:
    """One row per unit: the key and order columns, unit (from 0 in its row), marked and recovered role, body, rendered text.

    `marked` is the role that a marker or the role column names, null for none; `role` is
    the recovered one; `rendered` is null for a null text. Where no unit at all is marked,
    a fixed prior finds roles, and the counts of these are used `ROUNDS` times over. Rows
    whose key is null form one transcript, a null order comes first, ties are broken by
    content. Rows that repeat are kept. An empty table gives an empty result.
    """
    cut = dealt(df, key, order, text, role)
    borders = _borders(cut)
    model = fit(cut, borders)
    if model is None:
        model = prior()
        for _ in range(ROUNDS):
            guessed = materialize(decode(cut, borders, model).withColumn("mark", F.col("found")).drop("found"))
            model = fit(guessed, _borders(guessed)) or model
            release(guessed)
    found = decode(cut, borders, model)
    name = lambda c: F.get(F.array(*[F.lit(r) for r in ROLES]), F.when(F.col(c) >= 0, F.col(c)))
    rendered = F.when(~F.col("missing"), F.concat(F.lit("<|"), name("found"), F.lit("|>\n"), "body", F.lit("\n<|end|>")))
    kinds = dict(df.dtypes)
    ends = [F.col(new).cast(kinds[old]).alias(old) for new, old in (("key", key), ("place", order))]
    return found.select(*ends, "unit", name("mark").alias("marked"), name("found").alias("role"), "body", rendered.alias("rendered"))
