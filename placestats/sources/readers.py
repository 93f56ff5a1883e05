"""Readers for landed files. All return DataFrames; nothing is fetched."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placestats.constants import CSV_NULL_TOKENS, GREATER_CITIES, NAME_FALLBACKS
from placestats.functions.geometry import geojson_to_geom
from placestats.session import materialize


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def parse_json_pages(pages: DataFrame, text: str, fields: Sequence[str] | Mapping[str, str], records: str | None = "result.records") -> DataFrame:
    """Rows of the API pages held by a text column, one page per row.

    `records` is the dotted path of the record list inside a page, or None when a page is
    itself a list. Only `fields` are read, as text unless a mapping gives types; missing
    text becomes "" and extra members are never parsed. A page that is no JSON, or holds
    no such list, gives no rows.
    """
    kinds = dict(fields) if isinstance(fields, Mapping) else {n: "string" for n in fields}
    shape = "array<struct<" + ",".join(f"`{n}`:{k}" for n, k in kinds.items()) + ">>"
    path = records.split(".") if records else []
    for part in reversed(path):
        shape = f"struct<`{part}`:{shape}>"
    page = F.from_json(F.col(text), shape)
    if not path:  # a lone object would pass for a list of one
        page = F.when(F.ltrim(F.col(text)).startswith("["), page)
    for part in path:
        page = page[part]
    rows = pages.select(F.explode(page).alias("r")).where(F.col("r").isNotNull()).select("r.*")
    return rows.withColumns({n: F.coalesce(F.col(n), F.lit("")) for n, k in kinds.items() if k == "string"})


def read_json_pages(
    spark: SparkSession, path: str, records: str | None = "result.records", fields: Sequence[str] | Mapping[str, str] | None = None
) -> DataFrame:
    """Landed API pages as rows, a page per file; see `parse_json_pages`. Without `fields` the schema is inferred."""
    if fields is not None:
        return parse_json_pages(spark.read.text(path, wholetext=True), "value", fields, records)
    raw = spark.read.option("multiLine", True).json(path)
    return raw if records is None else raw.select(F.explode(F.col(records)).alias("r")).select("r.*")


def _blank_to_null(col: Column, null_tokens: Sequence[str]) -> Column:
    return F.when(~col.isin(list(null_tokens)), col)


def tolerant_rows(
    raw: DataFrame,
    schema: Mapping[str, str],
    null_tokens: Sequence[str] = tuple(CSV_NULL_TOKENS),
    skip_bad: bool = True,
    columns: Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Typed rows from text columns with forgiving rules.

    Values are trimmed and null tokens become null. A row whose non-empty text does not
    parse as its column's type is skipped (`skip_bad`) or keeps a null there. `columns`
    lists the target columns `raw` holds; the others of `schema` take their default or null.
    """
    held = list(columns or schema)
    texts = raw.select(*[_blank_to_null(F.trim(F.col(c)), null_tokens).alias(c) for c in held])
    typed = {c: F.col(c).try_cast(schema[c]) for c in held}
    if skip_bad:
        for c in held:
            if schema[c] != "string":
                texts = texts.where(F.col(c).isNull() | typed[c].isNotNull())
    defaults = defaults or {}
    return texts.select(*[(typed[c] if c in typed else F.lit(defaults.get(c)).cast(kind)).alias(c) for c, kind in schema.items()])


def checked_rows(
    raw: DataFrame, schema: Mapping[str, str], null_tokens: Sequence[str] = tuple(CSV_NULL_TOKENS), columns: Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """As `tolerant_rows`, with bad rows kept: `_reject` names the columns whose text does not parse, null for a good row.

    A bad value is null in its column. `keep` names columns of `raw` that stay on rejected rows.
    """
    held = list(columns or schema)
    texts = {c: _blank_to_null(F.trim(F.col(c)), null_tokens) for c in held}
    bad = [F.when(texts[c].isNotNull() & texts[c].try_cast(schema[c]).isNull(), F.lit(f"{c} is no {schema[c]}")) for c in held if schema[c] != "string"]
    reason = F.nullif(F.concat_ws("; ", *bad), F.lit("")) if bad else F.lit(None).cast("string")
    defaults = defaults or {}
    typed = [(texts[c].try_cast(kind) if c in texts else F.lit(defaults.get(c)).cast(kind)).alias(c) for c, kind in schema.items()]
    rows = raw.withColumn("_reject", reason)
    return rows.select(*typed, "_reject", *[F.when(F.col("_reject").isNotNull(), F.col(c)).alias(c) for c in keep])


def _csv_fields(lines: DataFrame, text: str, held: Sequence[str], *more: Column) -> DataFrame:
    ddl = ", ".join(f"`{c}` STRING" for c in held)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    return lines.where(F.trim(F.col(text)) != "").select(F.from_csv(F.col(text), ddl, options).alias("r"), *more).select("r.*", *[F.col("_line") for _ in more])


def parse_csv_tolerant(lines: DataFrame, text: str, schema: Mapping[str, str], columns: Sequence[str] | None = None, **rules) -> DataFrame:
    """CSV lines of a text column, without a header: short rows are padded and long rows cut, then `tolerant_rows`."""
    return tolerant_rows(_csv_fields(lines, text, list(columns or schema)), schema, columns=columns, **rules)


def parse_csv_checked(lines: DataFrame, text: str, schema: Mapping[str, str], columns: Sequence[str] | None = None, **rules) -> DataFrame:
    """CSV lines as in `parse_csv_tolerant`, then `checked_rows`; rejected rows carry their `_line`. Blank lines are no rows."""
    raw = _csv_fields(lines, text, list(columns or schema), F.col(text).alias("_line"))
    return checked_rows(raw, schema, columns=columns, keep=["_line"], **rules)


def read_csv_tolerant(
    spark: SparkSession, path: str, schema: Mapping[str, str], null_tokens: Sequence[str] = tuple(CSV_NULL_TOKENS), skip_bad: bool = True,
    header: bool = True, columns: Sequence[str] | None = None, defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """CSV files by position with forgiving rules: short rows are padded, long rows cut, the rest as `tolerant_rows`."""
    raw = (
        spark.read.schema(_strings(list(columns or schema)))
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return tolerant_rows(raw, schema, null_tokens, skip_bad, columns, defaults)


def merge_headers(row1: Sequence[str], row2: Sequence[str]) -> list[str]:
    """Two header lines as one: the lower line completes the upper one."""
    width = max(len(row1), len(row2))
    upper = [(c or "").strip() for c in row1] + [""] * (width - len(row1))
    lower = [(c or "").strip() for c in row2] + [""] * (width - len(row2))
    merged = []
    for a, b in zip(upper, lower):
        nameless = not a or a.lower().startswith("unnamed")
        if nameless:
            merged.append(b)
        elif b and b.lower() not in a.lower():
            merged.append(f"{a} {b}")
        else:
            merged.append(a)
    return merged


def sanitize_name(name: str, limit: int = 255) -> str:
    """Upper-case identifier of letters, digits and single underscores."""
    clean = re.sub("_+", "_", re.sub("[^0-9A-Za-z_]", "_", (name or "").strip())).strip("_").upper() or "COL"
    return (f"C_{clean}" if clean[0].isdigit() else clean)[:limit]


def unique_names(names: Sequence[str]) -> list[str]:
    """Repeated names get _1, _2 ... in order of appearance."""
    count: dict[str, int] = {}
    out = []
    for n in names:
        k = count.get(n, -1) + 1
        count[n] = k
        out.append(f"{n}_{k}" if k else n)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names([sanitize_name(c) for c in df.columns]))


def header_names(rows: Sequence[Sequence[str]]) -> list[str]:
    """Column names from the header lines: merged, cleaned and made unique."""
    names = list(rows[0])
    for more in rows[1:]:
        names = merge_headers(names, more)
    return unique_names([sanitize_name(n) for n in names])


def parse_multiheader_csv(
    records: DataFrame, file: str, index: str, cells: str, drop_rows: int = 8, header_lines: int = 2, null_tokens: Sequence[str] = tuple(CSV_NULL_TOKENS)
) -> DataFrame:
    """Rows of files with a preamble and several header lines; every column is text.

    `records` holds one CSV record per row: its file, its index in the file, and its cells.
    The first `drop_rows` records go, blank ones go anywhere, the next `header_lines` name
    the columns, wherever they are, the rest are rows. Only the header records of one file
    reach the driver; all files share its layout.
    """
    filled = F.exists(cells, lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")
    kept = records.select(F.col(file).alias("_f"), F.col(index).alias("_i"), F.col(cells).alias("_c")).where(filled & (F.col("_i") >= drop_rows))
    at = kept.groupBy("_f").agg(F.min("_i").alias("_0"))
    for n in range(1, header_lines):
        after = kept.join(at, "_f").where(F.col("_i") > F.col(f"_{n - 1}")).groupBy("_f").agg(F.min("_i").alias(f"_{n}"))
        at = at.join(after, "_f")
    one = at.orderBy("_f").limit(1)
    marks = [F.col(f"_{n}") for n in range(header_lines)]
    head = kept.join(one, "_f", "left_semi").join(one, "_f").where(F.col("_i").isin(*marks)).orderBy("_i").select("_c").collect()
    if len(head) < header_lines:
        raise ValueError(f"fewer than {header_lines} header lines")
    names = header_names([[c or "" for c in r["_c"]] for r in head])
    body = kept.join(at, "_f").where(F.col("_i") > marks[-1])
    return body.select(
        *[_blank_to_null(F.trim(F.get("_c", F.lit(i))), null_tokens).alias(n) for i, n in enumerate(names)],
        F.element_at(F.split("_f", "/"), -1).alias("_file_name"),
    )


def read_multiheader_csv(
    spark: SparkSession, path: str, drop_rows: int = 8, header_lines: int = 2, null_tokens: Sequence[str] = tuple(CSV_NULL_TOKENS)
) -> DataFrame:
    """CSV files with a preamble and a multi-line header; see `parse_multiheader_csv`.

    A file is one row until its records are cut, so quoted line breaks stay inside their
    record and each record has its true index; such sheets are spreadsheet exports.
    """

    def cut(batches):
        for batch in batches:
            files, numbers, rows = [], [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, cells in enumerate(csv.reader(io.StringIO(text), skipinitialspace=True)):
                    files.append(name)
                    numbers.append(i)
                    rows.append(cells)
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(numbers, pa.int64()), pa.array(rows, pa.list_(pa.string()))], ["file", "i", "cells"])

    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    records = materialize(texts.mapInArrow(cut, "file string, i long, cells array<string>"))
    return parse_multiheader_csv(records, "file", "i", "cells", drop_rows, header_lines, null_tokens)


def first_nonempty(*cols: Column) -> Column:
    """First value that is neither null nor empty, trimmed and upper-cased; else ''."""
    return F.upper(F.trim(F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))))


def parse_geojson(docs: DataFrame, text: str, props: Mapping[str, str], names: Sequence[str] = tuple(NAME_FALLBACKS), keep: Sequence[str] = ()) -> DataFrame:
    """FeatureCollection texts as rows: `keep`, feature position, name, `props` and geometry.

    `props` maps property names to types. The name is the first filled property of
    `names`. Features without a readable polygon keep a null geometry.
    """
    feature = "struct<properties:string,geometry:struct<type:string,coordinates:string>>"
    rows = docs.select(*keep, F.posexplode(F.from_json(F.col(text), f"struct<features:array<{feature}>>")["features"]).alias("pos", "f"))
    # property names differ in case only, so each is read by its exact path
    values = {n: F.get_json_object("f.properties", f"$['{n}']") for n in (*names, *props)}
    return rows.select(
        *keep,
        "pos",
        first_nonempty(*[values[n] for n in names]).alias("name"),
        *[values[n].try_cast(t).alias(n) for n, t in props.items()],
        geojson_to_geom(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("geometry"),
    )


def read_geojson(spark: SparkSession, path: str, props: Mapping[str, str], names: Sequence[str] = tuple(NAME_FALLBACKS)) -> DataFrame:
    """FeatureCollection files as rows; see `parse_geojson`."""
    return parse_geojson(spark.read.text(path, wholetext=True), "value", props, names)


def greater_cities(spark: SparkSession) -> DataFrame:
    """The fixed table of cities that have no neighbourhood layer."""
    return spark.createDataFrame(GREATER_CITIES, "name string, centroid_lat double, centroid_long double")
