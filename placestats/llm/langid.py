"""Language identification with averaged hashed subword embeddings and a linear softmax.

Subwords are the byte 3- and 4-grams of the lower-cased words, with their boundaries, each
hashed to one of `buckets` embeddings. A text is the mean of the embeddings of all its
subwords; a linear softmax over that mean gives the languages. Both are trained together
by stochastic gradient descent in numpy on a bounded sample of labelled rows. Because the
softmax input is linear in the mean, prediction folds embeddings and weights into one
table of bucket scores and streams whole texts through it in blocks of bounded memory.

The softmax is calibrated by a temperature on rows the descent has not seen, and the
score below which a prediction is rejected is the one that keeps a given share of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAMS = (3, 4)
BUCKETS = 1 << 16
WIDTH = 16
SAMPLE = 4000  # most training rows, shared out evenly among the languages
SAMPLE_CHARS = 20_000  # texts beyond this are not used for training
SAMPLE_LANGUAGES = 200  # most languages, the most frequent first
BLOCK = 1 << 20  # bytes looked at in one step
UNKNOWN = "und"

# bytes that separate words: everything in ASCII that is no letter
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[~LETTER] = 32


def prepared(text: str) -> np.ndarray:
    """Lower-cased bytes with one or more spaces between words and around them."""
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)
    return FOLD[data]


def subwords(data: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Buckets of all n-grams of prepared bytes that hold no inner space and at least two letters."""
    if len(data) < n:
        return np.zeros(0, np.int64)
    windows = len(data) - n + 1
    code = np.zeros(windows, np.uint64)
    valid = np.ones(windows, bool)
    for i in range(n):
        part = data[i : i + windows]
        code = code * np.uint64(257) + part
        if 0 < i < n - 1:
            valid &= part != 32
    code = code[valid] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
    return ((code >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def blocks(text: str) -> Iterator[np.ndarray]:
    """Prepared bytes of a whole text, block by block; a word on a cut counts as two."""
    step = BLOCK // 4
    for at in range(0, max(len(text), 1), step):
        yield prepared(text[at : at + step])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (buckets, languages): score of a bucket for each language
    bias: np.ndarray
    temperature: float
    reject_below: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, accepted) of a whole text."""
        if not text or not has_letter(text) or not self.languages:
            return UNKNOWN, 0.0, False
        total, n = np.zeros(len(self.languages)), 0
        for data in blocks(text):
            for size in GRAMS:
                own = subwords(data, size, len(self.table))
                total += self.table[own].sum(axis=0, dtype=np.float64)
                n += len(own)
        p = softmax((total / max(n, 1) + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.reject_below)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, str]], buckets: int = BUCKETS, width: int = WIDTH, epochs: int = 6, rate: float = 0.5, keep: float = 0.995, seed: int = 7) -> Model:
    """Model from (text, language) rows; texts without letters teach nothing."""
    rows = sorted((lang, text) for text, lang in rows if lang is not None and text and has_letter(text))
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return Model([], np.zeros((buckets, 0), np.float32), np.zeros(0), 1.0, 0.0)
    target = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    grams = [np.concatenate([subwords(d, n, buckets) for d in blocks(text) for n in GRAMS]) for _, text in rows]
    y = np.array([target[lang] for lang, _ in rows])
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5] if len(rows) >= 50 else order[:0]
    seen = order[len(held) :]
    # languages of few rows are drawn as often as the others
    share = 1 / np.bincount(y[seen], minlength=len(languages)).clip(1)[y[seen]]
    embed = rng.normal(0, 1 / width, (buckets, width)).astype(np.float32)
    weight, bias = np.zeros((width, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps = epochs * len(seen)
    for step, at in enumerate(rng.choice(seen, steps, p=share / share.sum())):
        own = grams[at]
        if len(own) > 256:  # a random part of the subwords of a row in each step
            own = own[rng.integers(0, len(own), 256)]
        if not len(own):
            continue
        lr = rate * (1 - step / steps)
        mean = embed[own].mean(axis=0)
        slope = softmax(mean @ weight + bias)
        slope[y[at]] -= 1
        back = weight @ slope
        weight -= lr * np.outer(mean, slope)
        bias -= lr * slope
        np.subtract.at(embed, own, lr * back / len(own) * 8)
    model = Model(languages, embed @ weight, bias.astype(np.float64), 1.0, 0.0)
    check = held if len(held) else seen
    logits = np.array([(model.table[grams[i]].mean(axis=0) if len(grams[i]) else 0) + model.bias for i in check], dtype=np.float64)
    losses = {t: -np.log(softmax(logits / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in np.geomspace(0.05, 5, 40)}
    model.temperature = float(min(losses, key=losses.get))
    model.reject_below = float(np.quantile(softmax(logits / model.temperature).max(axis=1), 1 - keep))
    return model


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE, chars: int = SAMPLE_CHARS) -> DataFrame:
    """At most `rows` texts of up to `chars` characters, drawn by hash, evenly from the most frequent languages.

    The rows of the least hashes of a language are taken. Before the rank a limit on the
    hash thins each language to about three times its share; the limit is never below the
    least hash, so each of these languages gives a row. One without a text of up to
    `chars` characters gives the first `chars` characters of its shortest texts.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    short, drawn = F.length("text") <= chars, F.xxhash64("id", "text")
    counts = picked.groupBy("lang").agg(F.count_if(short).alias("short"), F.count(F.lit(1)).alias("all"), F.min(F.when(short, drawn)).alias("least"))
    counts = counts.select("lang", "short", "least", F.when(F.col("short") > 0, F.col("short")).otherwise(F.col("all")).alias("n"))
    sizes = counts.orderBy((F.col("short") == 0).asc(), F.desc("n"), "lang").limit(SAMPLE_LANGUAGES).collect()
    if not sizes:
        return picked.select("text", "lang")
    each = min(max(rows // len(sizes), 1), 999)  # Spark cuts ranks early below 1000
    limits = {r.lang: max(hash_limit(3 * each, r.n), r.least) for r in sizes if r.short}
    long_only = [r.lang for r in sizes if not r.short]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id"))
    kept = []
    if limits:
        limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        kept.append(picked.where(short & (drawn <= limit[F.col("lang")])).withColumn("order", drawn))
    if long_only:
        long = picked.where(F.col("lang").isin(long_only)).withColumn("order", F.length("text").cast("long"))
        kept.append(long.withColumn("text", F.substring("text", 1, chars)))
    ranked = [part.withColumn("draw", rank).where(F.col("draw") <= each).select("text", "lang") for part in kept]
    return reduce(DataFrame.unionByName, ranked)


def hash_limit(wanted: int, n: int) -> int:
    """Signed 64-bit limit that about `wanted` of `n` hashes do not exceed, whatever `n` is."""
    return min(-(1 << 63) + (wanted << 64) // n, (1 << 63) - 1)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **params) -> Model:
    """Train on the bounded sample of `docs`; an empty table gives a model that knows no language."""
    return train([(r.text, r.lang) for r in sample(docs, id_col, text_col, lang_col).collect()], **params)


def identify(text: Column, model: Model) -> Column:
    """Struct (lang_pred, score, accepted) of a text column; `und` with score 0 for null or no letter."""

    @F.pandas_udf("struct<lang_pred: string, score: double, accepted: boolean>")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "accepted"])

    return udf(text)
