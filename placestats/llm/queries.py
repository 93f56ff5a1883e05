"""Registered queries of the operators of this subpackage, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op5_simhash_near_dedup")
def simhash_near_dedup(spark, folder):
    from placestats.llm.simhash import hex16, near_duplicates

    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query("op2_best_fit_packing")
def best_fit_packing(spark, folder):
    import public_tokenizers

    from placestats.llm.packing import pack

    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


def quality_model(spark, folder, vectors: DataFrame):
    """Discriminant from the labelled rows outside the held-out fifth, given (doc_id, features)."""
    from placestats.llm.quality import fit

    known = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label")).where("doc_id is not null and label is not null")
    return fit(vectors.join(known.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0), "doc_id"))


@query("op7_quality_discriminant")
def quality_discriminant(spark, folder):
    from placestats.llm.common import whole_text
    from placestats.llm.quality import features, score
    from placestats.session import materialize

    docs = table(spark, folder, "documents")
    vectors = materialize(docs.select("doc_id", features(whole_text("text")).alias("features")))
    model = quality_model(spark, folder, vectors)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out")
    scored = vectors.select("doc_id", held_out, score(F.col("features"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query(
    "op9_polynomial_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AND row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
)
def polynomial_exact_dedup(spark, folder):
    from placestats.llm.exact_dedup import duplicate_groups

    return duplicate_groups(table(spark, folder, "documents"))


SURROGATE_KEY = b"registered query"  # a real run passes a secret of its own


@query("op1_pii_surrogates")
def pii_surrogates(spark, folder):
    from placestats.llm.pii import replace_entities

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_entities(docs, SURROGATE_KEY, count_col="n_entities")


@query(
    "op8_line_window_dedup",
    """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, text, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d WHERE text IS NOT NULL),
w AS (
  SELECT *, line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS win, lead(line, 2) OVER o IS NOT NULL AS whole
  FROM l WINDOW o AS (PARTITION BY r ORDER BY pos)),
later AS (
  SELECT r, pos FROM (
    SELECT r, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS n FROM w WHERE whole) WHERE n > 1),
gone AS (SELECT DISTINCT r, pos + k AS pos FROM later CROSS JOIN (VALUES (0), (1), (2)) AS v(k)),
kept AS (
  SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.pos) AS text FROM l LEFT JOIN gone g ON g.r = l.r AND g.pos = l.pos
  WHERE g.r IS NULL GROUP BY l.r),
cut AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(c.n, 0) AS lines_cut
FROM d LEFT JOIN kept k ON k.r = d.r LEFT JOIN cut c ON c.r = d.r""",
)
def line_window_dedup(spark, folder):
    from placestats.llm.line_dedup import drop_repeated_lines

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs, count_col="lines_cut")


@query("op4_language_id")
def language_id(spark, folder):
    from placestats.llm.langid import fit, identify

    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    model = fit(docs.where(third != 1))
    found = docs.select("doc_id", F.coalesce(third == 1, F.lit(False)).alias("held_out"), identify(F.col("text"), model).alias("f"))
    return found.select("doc_id", "held_out", "f.lang_pred", "f.score", "f.accepted")


@query("op6_collision_counting_ann")
def collision_counting_ann(spark, folder):
    from placestats.llm.ann import nearest

    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.where(F.col("vec_id") % 100 == 0))


@query("op3_byte_bpe")
def byte_bpe(spark, folder):
    import public_tokenizers

    from placestats.llm.bpe import encode_digest

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode_digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op10_transcript_roles")
def transcript_roles(spark, folder):
    """Roles of all turns; in every conversation whose crc32(conv_id as text) is odd they are hidden from the operator."""
    from placestats.llm.transcripts import parse

    hidden = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 2 == 1, F.lit(False))
    turns = table(spark, folder, "conversations").withColumn("role", F.when(~hidden, F.col("role")))
    return parse(turns).select("conv_id", "turn", "unit", hidden.alias("held_out"), "marked", "role", "body", "rendered")


@query(
    "op11_four_russians_negatives",
    """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
q AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS n
  FROM p JOIN s USING (anchor_id)
  WHERE s.label <> s.own AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, n::INTEGER AS rank, negative_id, positive_score, negative_score FROM q WHERE n <= 10""",
)
def four_russians_negatives(spark, folder):
    from placestats.llm.hard_negatives import mine

    return mine(table(spark, folder, "embeddings"))


@query("op12_license_scan")
def license_scan(spark, folder):
    from placestats.llm.licenses import scan_licenses, summary

    return summary(scan_licenses(table(spark, folder, "documents").select("doc_id", "text")))


COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
runs AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places, (VALUES (1), (2), (3), (4)) v(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, phrase, k, count(*) AS f, string_split(phrase, ' ') AS w FROM runs GROUP BY lang, phrase, k HAVING count(*) >= 30),
c AS (SELECT lang, phrase, k, f AS a, w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, t.cut, x.f AS l, y.f AS r, ((2000000 * c.a::HUGEINT) // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) t
  JOIN c USING (lang, phrase)
  JOIN f x ON x.lang = t.lang AND x.phrase = array_to_string(t.w[1:t.cut], ' ')
  JOIN f y ON y.lang = t.lang AND y.phrase = array_to_string(t.w[t.cut + 1:], ' ')),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
subs AS (SELECT lang, w, a, k, size, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM c)),
longer AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer FROM subs GROUP BY ALL),
kept AS (
  SELECT lang, phrase, a, l, r, score FROM least LEFT JOIN longer USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000"""


@query("op13_phrase_collocations", COLLOCATIONS)
def phrase_collocations(spark, folder):
    from placestats.llm.collocations import collocations

    return collocations(table(spark, folder, "documents"))
