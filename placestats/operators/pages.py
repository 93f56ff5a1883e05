"""Web pages to clean text, in column expressions only.

A page is cut into tokens by one pattern. A fold over the tokens keeps the stack of open
elements, as a tolerant parser does, and notes for every element its parent and the
strings it covers; it runs over pieces of the token list, so that its lists stay short on
pages of any length. Choosing the main part, cutting at a stop phrase, leaving out repeats
and marking up are expressions on those notes. A page never leaves its row.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.constants import DROPPED_CLASSES, DROPPED_TAGS, HEADING_MARKS, STOP_PHRASES
from placestats.functions.nested import let
from placestats.functions.text import normalize_blank_runs

VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
LISTS = ("ul", "ol")
PIECE = 256  # tokens folded at a time
ABOVE = 6  # levels from the first h1 to the main part

# a "<" that begins no whole tag, comment or declaration is text
STRAY = r"<(?!!--(?s:.*?)-->|!(?!--)[^>]*>|/?[a-zA-Z][^>]*>|[?/][^>]*>)"
TOKEN = (
    r"(?is)<!--.*?-->"
    r"|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
    r"""|</?[a-z](?:[^'">]++|"[^"]*+"|'[^']*+')*+>"""
    r"|<[^>]*+>|[^<]++"
)
CLASS = r"""(?is)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
REFERENCE = r"&#[xX]?[0-9a-fA-F]++;?|&[a-zA-Z][a-zA-Z0-9]*+;?|[^&]++|&"

OPEN_TYPE = "array<struct<tag:string,n:int,hidden:boolean>>"
EVENT_TYPE = "struct<n:int,tag:string,parent:int,start:int,nested:boolean,shut:array<int>,end:int,last:int,string:string>"
STATE_TYPE = f"struct<open:{OPEN_TYPE},n:int,strings:int,hidden:int,out:array<{EVENT_TYPE}>>"


def unescape(text: Column) -> Column:
    """Text with character references replaced: numbers, and names with or without a semicolon."""
    known = sorted(html5, key=lambda n: n.rstrip(";") not in html5)  # the old, most used names first
    names = F.map_from_arrays(*[F.split(F.lit("\x01".join(words)), "\x01", -1) for words in (known, [html5[n] for n in known])])

    def one(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^&#[xX]?([0-9a-fA-F]+);?$", 1)
        hexadecimal = F.lower(F.substring(part, 3, 1)) == "x"
        code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        named = F.coalesce(F.element_at(names, F.substring(part, F.lit(2), F.length(part))), part)
        return F.when(part.startswith("&#") & (digits != ""), char).when(part.startswith("&"), named).otherwise(part)

    parts = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(text)


#: white space as a text's ends know it, and the four separators of files, groups, records and units
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def tokens_of(html: Column, dropped_tags: Sequence[str], dropped_classes: Sequence[str]) -> Column:
    """Array of (kind, tag, drop, empty, text); kind is text, open, close or other."""
    raw = F.regexp_extract_all(F.regexp_replace(html, STRAY, "&lt;"), F.lit(TOKEN), F.lit(0))

    def tag_token(t: Column) -> Column:
        # patterns are slow, so each is only tried where it can matter
        held = F.when(F.lower(t).contains("class"), F.split(F.concat(*[F.regexp_extract(t, CLASS, i) for i in (1, 2, 3)]), r"\s+"))
        classed = F.coalesce(F.arrays_overlap(held, F.array(*[F.lit(c) for c in dropped_classes])), F.lit(False))

        def named(name: Column) -> Column:
            closing = t.startswith("</")
            swallowed = name.isin("script", "style") & ~closing  # with all up to its end
            kind = F.when((name == "") | swallowed, F.lit("other")).when(closing, F.lit("close")).otherwise(F.lit("open"))
            drop, empty = name.isin(list(dropped_tags)) | classed, name.isin(list(VOID_TAGS)) | t.endswith("/>")
            return F.struct(kind.alias("kind"), name.alias("tag"), drop.alias("drop"), empty.alias("empty"), F.lit(None).cast("string").alias("text"))

        return let(F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1)), named)

    def text_token(t: Column) -> Column:
        return F.struct(F.lit("text").alias("kind"), F.lit("").alias("tag"), F.lit(False).alias("drop"), F.lit(False).alias("empty"), strip(unescape(t)).alias("text"))

    def token(t: Column) -> Column:
        return F.when(t.startswith("<"), tag_token(t)).otherwise(text_token(t))

    return F.transform(raw, token)


def _event(**fields: Column) -> Column:
    kinds = {"n": "int", "tag": "string", "parent": "int", "start": "int", "nested": "boolean", "shut": "array<int>", "end": "int", "last": "int", "string": "string"}
    return F.struct(*[fields.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in kinds.items()])


def _state(open_: Column, n: Column, strings: Column, hidden: Column, out: Column) -> Column:
    return F.struct(open_.alias("open"), n.alias("n"), strings.alias("strings"), hidden.alias("hidden"), out.alias("out")).cast(STATE_TYPE)


def _step(s: Column, t: Column) -> Column:
    """The state after one token. `hidden` is the depth of the outermost dropped element, 0 where all is visible."""
    stack, n, strings, hidden, out = s["open"], s["n"], s["strings"], s["hidden"], s["out"]
    shown = (hidden == 0) & (t["text"] != "")
    text = F.when(shown, _state(stack, n, strings + 1, hidden, F.array_append(out, _event(string=t["text"])))).otherwise(s)

    unseen = t["drop"] | (hidden > 0)
    parent = F.coalesce(F.get(stack, F.size(stack) - 1)["n"], F.lit(-1))
    nested = F.exists(stack, lambda x: x["tag"].isin(*LISTS) & ~x["hidden"])
    begun = _event(
        n=n, tag=F.when(~unseen, t["tag"]), parent=parent, start=strings, nested=nested, shut=F.when(t["empty"], F.array(n)), end=strings, last=n
    )
    deeper = F.array_append(stack, F.struct(t["tag"].alias("tag"), n.alias("n"), unseen.alias("hidden"))).cast(OPEN_TYPE)
    covered = F.when(t["drop"] & (hidden == 0) & ~t["empty"], F.size(stack) + 1).otherwise(hidden)
    opened = _state(F.when(t["empty"], stack).otherwise(deeper), n + 1, strings, covered, F.array_append(out, begun))

    back = F.array_position(F.reverse(F.transform(stack, lambda x: x["tag"])), t["tag"]).cast("int")

    def close(at: Column) -> Column:
        """Ends the element at place `at` of the stack and all opened after it."""
        gone = _event(shut=F.transform(F.slice(stack, at, F.size(stack)), lambda x: x["n"]), end=strings, last=n - 1)
        return _state(F.slice(stack, F.lit(1), at - 1), n, strings, F.when(at <= hidden, 0).otherwise(hidden), F.array_append(out, gone))

    closed = F.when(back > 0, let(F.size(stack) - back + 1, close)).otherwise(s)
    return F.when(t["kind"] == "text", text).when(t["kind"] == "open", opened).when(t["kind"] == "close", closed).otherwise(s)


def outline(tokens: Column) -> Column:
    """Struct of `events` and the last `state` of the fold over all tokens."""
    empty = F.array().cast(f"array<{EVENT_TYPE}>")
    start = _state(F.array().cast(OPEN_TYPE), F.lit(0), F.lit(0), F.lit(0), empty)
    zero = F.struct(start.alias("state"), F.array().cast(f"array<array<{EVENT_TYPE}>>").alias("done"))
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0)), F.lit(PIECE)), lambda i: F.slice(tokens, i + 1, PIECE))

    def piece(acc: Column, part: Column) -> Column:
        fresh = _state(acc["state"]["open"], acc["state"]["n"], acc["state"]["strings"], acc["state"]["hidden"], empty)
        return let(F.aggregate(part, fresh, _step), lambda s: F.struct(s.alias("state"), F.array_append(acc["done"], s["out"]).alias("done")))

    return F.aggregate(pieces, zero, piece, lambda acc: F.struct(F.flatten(acc["done"]).alias("events"), acc["state"].alias("state")))


def with_elements(pages: DataFrame, html: str, dropped_tags: Sequence[str] = tuple(DROPPED_TAGS), dropped_classes: Sequence[str] = tuple(DROPPED_CLASSES)) -> DataFrame:
    """Adds `_strings` (visible texts in order) and `_elements` in document order: tag (null if hidden), parent, nested, first and end string, last element inside."""
    out = pages.withColumn("_outline", outline(tokens_of(F.coalesce(html, F.lit("")), dropped_tags, dropped_classes)))
    events, state = F.col("_outline.events"), F.col("_outline.state")
    left = _event(shut=F.transform(state["open"], lambda x: x["n"]), end=state["strings"], last=state["n"] - 1)
    shut = F.filter(F.array_append(events, left), lambda e: e["shut"].isNotNull())
    ends = F.flatten(F.transform(shut, lambda e: F.transform(e["shut"], lambda n: F.struct(n.alias("n"), e["end"].alias("end"), e["last"].alias("last")))))
    out = out.withColumns({
        "_strings": F.transform(F.filter(events, lambda e: e["string"].isNotNull()), lambda e: e["string"]),
        "_opened": F.filter(events, lambda e: e["n"].isNotNull()),
        "_ends": F.array_sort(ends),  # every element ends once, so this is in step with the elements
    })
    element = lambda o, e: F.struct(
        o["n"].alias("n"), o["tag"].alias("tag"), o["parent"].alias("parent"), o["nested"].alias("nested"), o["start"].alias("start"), e["end"].alias("end"), e["last"].alias("last")
    )
    return out.withColumn("_elements", F.zip_with("_opened", "_ends", element)).drop("_outline", "_opened", "_ends")


def main_part() -> Column:
    """Number of the article; else six levels above the first h1; else the body; else -1 for all."""
    elements = F.col("_elements")
    first = {tag: F.array_position(F.transform(elements, lambda e: e["tag"]), tag).cast("int") - 1 for tag in ("article", "h1", "body")}
    above = first["h1"]
    for _ in range(ABOVE):
        above = let(above, lambda at: F.when(at >= 0, F.get(elements, at)["parent"]).otherwise(-1))
    return F.when(first["article"] >= 0, first["article"]).when(first["h1"] >= 0, above).when(first["body"] >= 0, first["body"]).otherwise(-1)


def _text(e: Column) -> Column:
    return F.array_join(F.slice("_strings", e["start"] + 1, e["end"] - e["start"]), " ")


def with_markdown(outlined: DataFrame, name: str, stop_phrases: Sequence[str] = tuple(STOP_PHRASES)) -> DataFrame:
    """Adds the marked-up text of the main part: cut at the first element that mentions a stop phrase, repeated paragraphs and headings left out."""
    mentions = lambda text: F.lit(False) if not stop_phrases else F.exists(F.array(*[F.lit(p.lower()) for p in stop_phrases]), lambda p: F.contains(F.lower(text), p))
    out = outlined.withColumn("_main", main_part())
    last = F.when(F.col("_main") >= 0, F.get("_elements", F.col("_main"))["last"]).otherwise(F.size("_elements") - 1)
    out = out.withColumn("_scope", F.filter(F.slice("_elements", F.col("_main") + 2, F.greatest(last - F.col("_main"), F.lit(0))), lambda e: e["tag"].isNotNull()))
    stopping = F.get(F.filter("_scope", lambda e: (e["end"] > e["start"]) & mentions(_text(e))), F.lit(0))["n"]
    out = out.withColumn("_stop", F.when(mentions(F.array_join("_strings", " ")), stopping))
    out = out.withColumn("_scope", F.when(F.col("_stop").isNull(), F.col("_scope")).otherwise(F.filter("_scope", lambda e: e["n"] < F.col("_stop"))))

    marked = [*HEADING_MARKS, "p", "blockquote"]
    body = F.filter("_scope", lambda e: e["tag"].isin(marked) & (e["end"] > e["start"]))
    out = out.withColumn("_sorted", F.array_sort(F.transform(body, lambda e: F.struct(_text(e).alias("text"), e["n"].alias("n"), e["tag"].alias("tag")))))
    first = F.filter("_sorted", lambda b, i: (i == 0) | (F.get("_sorted", i - 1)["text"] != b["text"]))

    def line(b: Column) -> Column:
        mark = F.when(b["tag"] == "blockquote", F.lit("> ")).otherwise(F.lit(""))
        for tag, sign in HEADING_MARKS.items():
            mark = F.when(b["tag"] == tag, F.lit(sign + " ")).otherwise(mark)
        return F.struct(b["n"].alias("n"), F.concat(mark, b["text"], F.lit("\n")).alias("line"))

    def listed(e: Column) -> Column:
        # outermost lists do not overlap, so each element is looked at once
        own = F.filter(F.slice("_elements", e["n"] + 2, e["last"] - e["n"]), lambda i: (i["tag"] == "li") & (i["parent"] == e["n"]))
        texts = F.filter(F.transform(own, _text), lambda t: t != "")
        rows = F.transform(texts, lambda t, i: F.concat(F.when(e["tag"] == "ul", F.lit("- ")).otherwise(F.concat((i + 1).cast("string"), F.lit(". "))), t))
        return F.struct(e["n"].alias("n"), F.concat(F.array_join(rows, "\n"), F.lit("\n")).alias("line"))

    lists = F.filter("_scope", lambda e: e["tag"].isin(*LISTS) & ~e["nested"])
    lines = F.concat(F.transform(first, line), F.filter(F.transform(lists, listed), lambda x: x["line"] != "\n"))
    text = F.array_join(F.transform(F.array_sort(lines), lambda x: x["line"]), "\n")
    return out.withColumn(name, normalize_blank_runs(text)).drop("_main", "_scope", "_stop", "_sorted")


def pages_to_markdown(pages: DataFrame, html: str = "html", name: str = "markdown", stop_phrases: Sequence[str] = tuple(STOP_PHRASES)) -> DataFrame:
    """Adds the cleaned text of each page and drops its markup; a null page has an empty text."""
    return with_markdown(with_elements(pages, html).drop(html), name, stop_phrases).drop("_strings", "_elements")


ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def extract_headings(pages: DataFrame, tag: str, html: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Text of every `tag` heading with its position on the page; markup stripped."""
    found = F.regexp_extract_all(F.col(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), F.lit(1))
    rows = pages.select(*keep, F.posexplode(found).alias("pos", "_inner"))
    pieces = F.transform(F.split("_inner", r"<[^>]*>"), lambda p: F.trim(p))
    text = F.array_join(F.filter(pieces, lambda p: p != ""), "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return rows.select(*keep, "pos", text.alias("text")).where(F.col("text") != "")
