"""License scan by ordered signature rules over the words of whole texts.

A text becomes its words in lower case (A to Z only), joined by single spaces. Rules
whose keywords occur are tried; each match is a detection from its first to its last
word. A detection that another of its own or a more specific level covers is suppressed:
of two with the same words that of the more specific level stays, then that of the
earlier rule. Base detections always stay.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.llm.common import free_names, whole_text, without
from placestats.llm.license_rules import ALL, Rule

KIND = "struct<n_words: bigint, found: array<struct<label: string, rule: int, base: boolean, level: int, score: double, first: bigint, last: bigint, text: string>>>"
_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("found", pa.list_(pa.struct([
        ("label", pa.string()), ("rule", pa.int32()), ("base", pa.bool_()), ("level", pa.int32()), ("score", pa.float64()),
        ("first", pa.int64()), ("last", pa.int64()), ("text", pa.string()),
    ]))),
])
#: Digits, letters in lower case and all bytes beyond ASCII stay; the rest parts words.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: bytes) -> bytes:
    """The words of a UTF-8 text in lower case, each with a space before it and one after the last."""
    words = text.translate(_FOLD).split()
    return b" " + b" ".join(words) + b" " if words else b""


_BY_KEYWORD: dict[bytes, list[Rule]] = defaultdict(list)
for _rule in ALL:
    for _word in _rule.keywords:
        _BY_KEYWORD[_word].append(_rule)


def candidates(words: bytes) -> list[Rule]:
    """The rules with a keyword in the text, in order."""
    met = {r.number: r for keyword, rules in _BY_KEYWORD.items() if keyword in words for r in rules}
    return [met[n] for n in sorted(met)]


def suppressed(found: list[tuple[Rule, int, int]]) -> list[bool]:
    """For detections sorted by (first, -last, level, rule): whether an earlier one of no higher level covers each.

    Whatever covers a detection starts no later, so it comes before it in this order; the
    furthest end so far of every level is all that is needed.
    """
    reach: dict[int, int] = {}
    out = []
    for rule, _, last in found:
        out.append(any(level <= rule.level and end >= last for level, end in reach.items()))
        reach[rule.level] = max(reach.get(rule.level, -1), last)
    return out


def detect(text: bytes) -> dict:
    """Number of words and the detections that stay, by their place."""
    words = words_of(text)
    spans = [(rule, m.start(), m.end()) for rule in candidates(words) for m in rule.pattern.finditer(words)]
    if not spans:
        return {"n_words": max(0, words.count(b" ") - 1), "found": []}
    starts = sorted({s for _, s, _ in spans})
    numbers, at, n = [], 0, 0  # the word that begins after each start; one pass over the text
    for s in starts:
        n += words.count(b" ", at, s)
        at = s
        numbers.append(n)
    place = dict(zip(starts, numbers))
    found = [(rule, place[s], place[s] + words.count(b" ", s + 1, e), s, e) for rule, s, e in spans]
    found.sort(key=lambda f: (f[1], -f[2], f[0].level, f[0].number))
    gone = suppressed([f[:3] for f in found])
    kept = [
        {"label": r.label, "rule": r.number, "base": r.base, "level": r.level, "score": r.confidence, "first": first, "last": last, "text": words[s + 1 : e].decode("utf-8", "replace")}
        for (r, first, last, s, e), drop in zip(found, gone)
        if r.base or not drop
    ]
    return {"n_words": max(0, words.count(b" ") - 1), "found": kept}


def detections(text: Column) -> Column:
    """Struct of `n_words` and the detections `found` of a string column; null counts as empty."""

    @F.arrow_udf(KIND)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([detect(t) for t in texts.to_pylist()], _ARROW)

    return scan(F.coalesce(text.cast("binary"), F.lit(b"")))


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with `n_words` and `detections` (label, rule, base, level, score, first and last word, text) per row.

    Every row stays, repeated ones included, and so do other columns, but for earlier
    columns of the two names. Null and empty texts have no words and no detections. Texts
    are read whole, whatever their length; rows never leave their partition.
    """
    docs = without(docs, ["n_words", "detections"])
    names, (scanned,) = docs.columns, free_names(docs, "scan")
    out = docs.withColumn(scanned, detections(whole_text(text_col)))
    return out.select(*names, F.col(f"{scanned}.n_words").alias("n_words"), F.col(f"{scanned}.found").alias("detections"))


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: base places, labels and score from the detections of `scan_licenses`.

    `score` is the highest confidence of a detection, 0 without any; labels are distinct,
    sorted and joined by commas, empty without any.
    """
    base = F.filter("detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["first"])

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    return scanned.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["score"])), F.lit(0.0)).alias("score"),
    )
