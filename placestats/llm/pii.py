"""Surrogates for personal data: keyed, consistent in type, gender, script and format.

Found entities are reduced to (kind, canonical form), so that all mentions of one entity
agree however they are written. Distinct entities of the whole corpus get a candidate from
a keyed function; a candidate is refused if it is an entity of the corpus itself, if
another entity holds it already, or if another entity drew it in the same round (the least
keyed digest wins). Refused entities draw again, and after a few rounds the candidate
grows, so the rounds end. The mapping goes back to the documents that mention the entities
and is written into their texts in each mention's own format.

Kinds: email, phone, card (with a right check digit), ip, secret, iban, national id, and
names behind a title, with later bare mentions of a name in the same text. A name is one
entity however it is used: whether it is given or a surname, and its gender, are settled by
all its mentions in the corpus. Surrogate names are made of syllables in Latin, Cyrillic
and Greek, by gender, and of letters of the same Unicode block in any other script.
Phones are numbers in North American groups, numbers that open with + or 00 and a country
code, and numbers that open with a trunk 0; an entity is the number without these, so that
both ways to write it agree. Addresses are IPv4, and IPv6 in full or in the ranges 2000::/3
and f000::/4. Texts without any trigger (a digit, one of @ = :, a key's prefix or a title)
are not moved at all.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placestats.llm.common import free_names, row_key, without
from placestats.session import materialize, release

PLAIN_ROUNDS = 6  # rounds before candidates grow
FEMALE_TITLES = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mademoiselle|Señora|Señorita|Sra|Srta|Госпожа"
MALE_TITLES = "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|Господин"
OPEN_TITLES = "Dr|Prof|Professor"
TITLES = f"{FEMALE_TITLES}|{MALE_TITLES}|{OPEN_TITLES}"
TITLE_WORDS = set(TITLES.split("|"))
NAME_WORDS, UNSPACED = 3, 4  # words of a name; letters of one in a script without spaces
#: words before a number that is a part or a version of something
NUMBERED = re.compile(r"(?i)(?:^|[^\w])(?:v|ver|version|release|build|rev|section|sec|chapter|ch|part|article|art|clause|figure|fig|table|rule|kapitel|abschnitt|artikel|section|sección|capítulo|chapitre)[.:]?\s*$|§\s*$")
SEP, HEX = r"[ ./-]", r"[0-9A-Fa-f]{1,4}"
# subscriber numbers of seven or eight digits, and of six, by groups
EIGHT = rf"(?:\d\d(?:{SEP}\d\d){{3}}|\d{{4}}{SEP}\d{{4}}|\d{{3}}{SEP}\d\d{SEP}\d\d|\d{{3}}{SEP}\d{{3,5}}|\d{{7,8}})"
SIX = rf"(?:\d\d{SEP}\d\d{SEP}\d\d|\d{{6}})"
AFTER = r"(?!\w|[.,:]\d)"
ABROAD = rf"""(?:\+(?!1[ (.-])|(?<![\w+.:/-])00(?=[1-9]))(?:
          \d{{1,3}}[ .-]?(?:\(0\)[ ]?)?(?:\(\d{{1,4}}\)|\d{{1,4}}){SEP}{EIGHT}{AFTER}
        | \d{{1,3}}[ .-]?(?:\(0\)[ ]?)?(?:\(\d{{2,5}}\)|\d{{2,5}}){SEP}{SIX}{AFTER}
        | (?=(?:[ .-]?\d){{9,15}}{AFTER})\d{{1,3}}(?:[ .-]\d{{2,12}}){{1,6}}{AFTER})"""
TRUNK = rf"""(?<![\w+.:/-])(?:(?:\(0\d{{1,4}}\)[ ]?|0\d{{1,4}}(?:[ ]?[/-][ ]?|[ ])){EIGHT}{AFTER}
        | (?:\(0\d{{2,4}}\)[ ]?|0\d{{2,4}}(?:[ ]?[/-][ ]?|[ ])){SIX}{AFTER}
        | 0[1-9](?:\.\d\d){{4}}{AFTER})"""
# full form, or shortened with a first group of the ranges in use
IPV6 = rf"""(?<![\w:.])(?:(?:{HEX}:){{7}}{HEX}
        | [23fF][0-9A-Fa-f]{{3}}(?=[0-9A-Fa-f:]*::)(?::{HEX}){{0,5}}::(?:{HEX}(?::{HEX}){{0,5}})?)(?![\w:]|\.\d)"""
TWO_DIGITS = {"20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55",
              "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98"}
KEY_PREFIXES = ["AKIA", "ASIA", *[k + c for k in ("ghp", "gho", "sk", "pk", "xoxb", "xoxa", "xoxp") for c in "-_"]]
FINDER = re.compile(
    rf"""
    (?P<email>(?<![A-Za-z0-9_%+.-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})
  | (?P<secret>\b(?:AKIA|ASIA)[A-Z0-9]{{16}}\b
      | \b(?:ghp|gho|sk|pk|xox[bap])[-_][A-Za-z0-9_-]{{16,}}
      | (?i:password|passwd|secret|token|api[_-]?key)\s{{0,8}}[=:]\s{{0,8}}["']?(?P<value>[^\s"']{{6,}}))
  | (?P<iban>\b[A-Z]{{2}}\d{{2}}(?:[ ]?[A-Z0-9]{{4}}){{3,7}}(?:[ ]?[A-Z0-9]{{1,3}})?\b)
  | (?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))
  | (?P<ip6>{IPV6})
  | (?P<abroad>{ABROAD})
  | (?P<card>(?<![\w+])(?:\d{{4}}[ -]\d{{4}}[ -]\d{{4}}[ -]\d{{1,7}}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}}|\d{{13,19}})(?!\w|\.\d))
  | (?P<national>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))
  | (?P<phone>(?<![\w+])(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)[ .-]?|\d{{2,4}}[ .-])\d{{3}}[ .-]?\d{{3,4}}(?!\w)
      | (?<![\w+])\+\d{{9,14}}(?!\w)
      | {TRUNK})
  | (?:\b(?:(?P<female>{FEMALE_TITLES})|(?P<male>{MALE_TITLES})|(?P<open>{OPEN_TITLES}))\.?[ ]+(?=\w))
    """,
    re.VERBOSE,
)

# syllables from which surrogate names of a script are made, and closing ones by gender
SYLLABLES = {
    "latin": (["ba", "be", "da", "do", "fe", "ga", "ka", "le", "li", "lo", "ma", "me", "mi", "na", "no", "ra", "ri", "ro", "sa", "ta", "ve", "vi"],
              {"f": ["lina", "rita", "dora", "nella"], "m": ["ton", "bert", "mund", "rik"], "s": ["ner", "son", "mann", "dez", "ville"]}),
    "cyrillic": (["ба", "ве", "го", "да", "же", "за", "ка", "ли", "ма", "ни", "по", "ра", "се", "та", "фе"],
                 {"f": ["лина", "рина", "дора"], "m": ["тон", "слав", "мир"], "s": ["нов", "рев", "лин"]}),
    "greek": (["βα", "γο", "δα", "ζε", "κα", "λι", "μα", "νι", "πο", "ρα", "σε", "τα"], {"f": ["λινα", "δωρα"], "m": ["τος", "νης"], "s": ["δης", "πουλος"]}),
}


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


@lru_cache(1 << 12)
def script_of(word: str) -> str:
    """Script of the first letter, as the Unicode name of the letter begins."""
    return unicodedata.name(word[0], "latin").split()[0].split("-")[0].lower()


@lru_cache(1 << 12)
def block_letters(c: str) -> str:
    """Characters of the same block, script and category; `c` itself at least."""
    base, kind, script = ord(c) & ~0xFF, unicodedata.category(c), script_of(c)
    same = [x for x in map(chr, range(base, base + 256)) if unicodedata.category(x) == kind and script_of(x) == script and x.casefold() == x]
    return "".join(same) or c


def name_words(text: str, at: int) -> list[tuple[int, int]]:
    """(start, end) of the words of a name that begins at `at`: capitalised, or of a script without case."""
    out: list[tuple[int, int]] = []
    while len(out) < NAME_WORDS and at < len(text):
        end = at
        while end < len(text) and (text[end].isalpha() or unicodedata.category(text[end])[0] == "M" or (end > at and text[end] in "'’-" and text[end + 1 : end + 2].isalpha())):
            end += 1
        word = text[at:end]
        if not word or word[0].islower() or word in TITLE_WORDS or (len(word) < 2 and word[0].isupper()):
            break
        unspaced = script_of(word) in ("cjk", "hangul", "hiragana", "katakana")
        out.append((at, min(end, at + UNSPACED) if unspaced else end))
        if unspaced or text[end : end + 1] != " ":
            break
        at = end + 1
    return out


def plain_group(mention: str) -> bool:
    """Is a number in groups, without + or brackets, rather a count than a phone number?"""
    if mention[0] in "+(0":
        return False
    groups = re.split(r"[ .-]", mention)
    if " " in mention:  # only a North American number is written so
        return not (len(groups) == 3 and [len(g) for g in groups] == [3, 3, 4] and groups[0][0] in "23456789" and groups[1][0] in "23456789")
    return groups[0][0] == "1" or len(groups[0]) != 3


def _digits(s: str) -> str:
    return "".join(str(int(c)) for c in s if c.isdigit())


def phone_number(mention: str, abroad: bool) -> str:
    """Digits of a phone number without country code and trunk 0."""
    digits = _digits(mention)
    if mention[0] == "+" or abroad:
        digits = digits[2:] if mention[0] == "0" else digits
        digits = digits[1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGITS else 3 :]
    elif len(digits) > 10 and digits[0] != "0":
        return digits[-10:]
    return digits[1:] if digits[0] == "0" else digits


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities of a whole text, in order, without overlaps."""
    out: list[tuple[int, int, str, str]] = []
    named: dict[str, str] = {}
    for m in FINDER.finditer(text):
        kind = m.lastgroup
        if m["value"]:
            start, end = m.span("value")
            out.append((start, end, "secret", m["value"]))
        elif kind in ("female", "male", "open"):
            parts = name_words(text, m.end())
            for i, (start, end) in enumerate(parts):
                word = text[start:end]
                role = "surname" if i == len(parts) - 1 else {"female": "given_f", "male": "given_m", "open": "given_n"}[kind]
                out.append((start, end, role, word.casefold()))
                named.setdefault(word, role)
                named.setdefault(word.upper(), role)
        elif m["card"]:
            if luhn_ok(digits := _digits(m["card"])):
                out.append((*m.span(), "card", digits))
        elif m["abroad"] or m["phone"]:
            if m["abroad"] or not plain_group(m[0]):
                out.append((*m.span(), "phone", phone_number(m[0], bool(m["abroad"]))))
        elif m["ip6"]:
            try:
                out.append((*m.span(), "ip", ipaddress.IPv6Address(m[0]).exploded))
            except ValueError:  # more groups than an address has
                pass
        elif m["email"]:
            out.append((*m.span(), "email", m["email"].casefold()))
        elif kind == "ip":
            if not NUMBERED.search(text, max(0, m.start() - 20), m.start()):
                out.append((*m.span(), kind, m[0]))
        elif kind in ("secret", "iban", "national"):
            out.append((*m.span(), kind, m[0].replace(" ", "") if kind == "iban" else m[0]))
    if named:
        words = sorted(named, key=len, reverse=True)
        spaced = [re.escape(w) for w in words if script_of(w) not in ("cjk", "hangul", "hiragana", "katakana")]
        other = [re.escape(w) for w in words if script_of(w) in ("cjk", "hangul", "hiragana", "katakana")]
        both = [rf"(?<![\w'’])(?:{'|'.join(spaced)})(?!\w|['’]\w)"] * bool(spaced) + other
        taken = {i for a, b, *_ in out for i in range(a, b)}
        out += [(*m.span(), named[m[0]], m[0].casefold()) for m in re.finditer("|".join(both), text) if m.start() not in taken and m.end() - 1 not in taken]
        out.sort()
    return out


def group_of(kind: str) -> str:
    """Names of all roles are one kind of entity."""
    return "name" if kind.startswith(("given", "surname")) else kind


class _Stream:
    """Endless keyed numbers."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.label, self.n, self.held = key, "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), 0, b""

    def below(self, n: int) -> int:
        if len(self.held) < 4:
            self.held = hmac.new(self.key, self.label + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n += 1
        value, self.held = int.from_bytes(self.held[:4], "big"), self.held[4:]
        return value % n


def _like(c: str, draw: _Stream, hexadecimal: bool = False) -> str:
    """A character of the same class."""
    if c.isdigit():
        return str(draw.below(10))
    if "a" <= c <= "z":
        return chr(97 + draw.below(6 if hexadecimal else 26))
    if "A" <= c <= "Z":
        return chr(65 + draw.below(6 if hexadecimal else 26))
    return c


def candidate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """Canonical form of the surrogate that an entity draws in its attempt."""
    draw = _Stream(key, kind, canon, attempt)
    extra = max(0, attempt - PLAIN_ROUNDS + 1)
    if kind == "email":
        local, _, domain = canon.partition("@")
        host = _Stream(key, "domain", domain)  # mail of one domain stays together
        *names, top = domain.split(".")
        names = ["".join(_like(c, host) for c in n) for n in names]
        grown = "".join(chr(97 + draw.below(26)) for _ in range(extra))
        return "".join(_like(c, draw) for c in local) + grown + "@" + ".".join([*names, top])
    if kind == "ip" and ":" in canon:  # the first group and empty ones stay, so that short forms stay writable
        first, *groups = canon.split(":")
        sizes = [4 if extra and g != "0000" else len(g.lstrip("0")) for g in groups]
        return ":".join([first, *[(f"{1 + draw.below(16**n - 1):x}" if n else "").zfill(4) for n in sizes]])
    if kind == "ip":
        spans = {1: (1, 9), 2: (10, 90), 3: (100, 156)}
        parts = []
        for octet in canon.split("."):
            low, n = spans[len(octet) if octet[0] != "0" else 1] if not extra else (1, 255)
            parts.append(str(low + draw.below(n)))
        return ".".join(parts)
    if kind == "card":
        body = canon[0] + "".join(str(draw.below(10)) for _ in range(len(canon) - 2 + extra))
        return next(body + str(d) for d in range(10) if luhn_ok(body + str(d)))
    if kind in ("given_f", "given_m", "given_n", "surname"):
        if script_of(canon) not in SYLLABLES:
            return "".join((letters := block_letters(c))[draw.below(len(letters))] for c in canon + canon[0] * extra)
        stems, ends = SYLLABLES[script_of(canon)]
        role = {"given_f": "f", "given_m": "m", "surname": "s"}.get(kind) or "fm"[draw.below(2)]
        return "".join(stems[draw.below(len(stems))] for _ in range(1 + draw.below(2) + extra)) + ends[role][draw.below(len(ends[role]))]
    if kind == "secret":
        keep = re.match(r"AKIA|ASIA|[a-z]{2,4}[-_]", canon)
        head = keep[0] if keep and len(canon) > 16 else ""
        body = canon[len(head) :]
        hexadecimal = bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", body))
        return head + "".join(_like(c, draw, hexadecimal) for c in body) + "".join(_like("a", draw, hexadecimal) for _ in range(extra))
    if kind == "iban":
        return canon[:2] + "".join(_like(c, draw) for c in canon[2:] + "0" * extra)
    if kind == "phone":
        return "".join(_like(c, draw) for c in "0" * extra + canon)
    return "".join(_like(c, draw) for c in canon + "0" * extra)  # national id


def written(mention: str, kind: str, surrogate: str, size: int | None = None) -> str:
    """The surrogate in the format of a mention: its case, its separators, its leading country code.

    `size` is the length of the entity's canonical form; a surrogate that has grown beyond
    it keeps its further digits, before a phone or card number and behind an IBAN.
    """
    if kind in ("phone", "card", "iban"):
        spots = [i for i, c in enumerate(mention) if (c.isalnum() if kind == "iban" else c.isdigit())]
        grown = max(0, len(surrogate) - (size or len(surrogate)))
        out = list(mention)
        inside = surrogate[: len(surrogate) - grown] if kind == "iban" else surrogate[grown:]
        first = len(mention)
        for i, c in zip(reversed(spots), reversed(inside)):
            old, first = out[i], i
            out[i] = chr(ord(old) - int(old) + int(c)) if old.isdecimal() and c.isdecimal() else c
        if kind == "iban":
            return "".join(out) + surrogate[len(inside) :]
        return "".join([*out[:first], surrogate[:grown], *out[first:]])
    if kind == "ip" and ":" in surrogate:
        groups, (head, cut, tail) = surrogate.split(":"), mention.partition("::")
        ends = tail.split(":") if tail else []

        def shown(old: list[str], new: list[str]) -> str:
            return ":".join((n.lstrip("0") or "0").zfill(len(o)) for o, n in zip(old, new))

        front = head.split(":")
        out = shown(front, groups) + cut + shown(ends, groups[8 - len(ends) :])
        return out.upper() if mention.isupper() else out
    if kind == "email" or kind.startswith(("given", "surname")):
        if mention.isupper():
            return surrogate.upper()
        return surrogate if mention[:1].islower() or kind == "email" else surrogate[:1].upper() + surrogate[1:]
    return surrogate


def replace(text: str, mapping: dict[tuple[str, str], str]) -> str:
    out, at = [], 0
    for start, end, kind, canon in find(text):
        surrogate = mapping.get((kind, canon)) or mapping[group_of(kind), canon]
        out += [text[at:start], written(text[start:end], kind, surrogate, len(canon))]
        at = end
    return "".join([*out, text[at:]])


def triggered(text: Column) -> Column:
    """Could the text hold an entity? True for every text that does; false for null."""
    literal = reduce(or_, [text.contains(t) for t in [*TITLES.split("|"), *KEY_PREFIXES]])
    return F.coalesce(text.rlike(r"[\p{Nd}@=:]") | literal, F.lit(False))


def entities(text: Column) -> Column:
    """Distinct (kind, canon) of a text, in order of appearance; none for null."""

    @F.pandas_udf("array<struct<kind: string, canon: string>>")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([[{"kind": k, "canon": c} for k, c in dict.fromkeys(x[2:] for x in find(t or ""))] for t in texts], dtype=object)

    return udf(text)


def settled_kinds(found: DataFrame) -> DataFrame:
    """(grp, canon, kind): distinct entities; a name's role is the one of most of its rows, its gender that of most with one."""
    names = F.col("kind").rlike("^given|^surname")
    counted = found.groupBy(F.when(names, F.lit("name")).otherwise(F.col("kind")).alias("grp"), "canon").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("surname", "given_f", "given_m", "given_n")]
    )
    given = F.when(F.col("given_f") + F.col("given_m") == 0, F.lit("given_n")).when(F.col("given_f") >= F.col("given_m"), F.lit("given_f")).otherwise(F.lit("given_m"))
    surname = F.col("surname") >= F.col("given_f") + F.col("given_m") + F.col("given_n")
    kind = F.when(F.col("grp") != "name", F.col("grp")).when(surname, F.lit("surname")).otherwise(given)
    return counted.select("grp", "canon", kind.alias("kind"))


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, surrogate) for distinct entities: no surrogate is an entity or used twice within a kind.

    Names are one kind, `name`, whatever their role. Candidates grow from round to round
    once the plain rounds are over, so every entity gets one in the end.
    """

    @F.pandas_udf("struct<surrogate: string, rank: string>")
    def draw(kinds: pd.Series, canons: pd.Series, attempts: pd.Series) -> pd.DataFrame:
        rows = [(candidate(key, k, c, int(a)), hmac.new(key, f"{group_of(k)}\x1f{c}".encode("utf-8", "surrogatepass"), hashlib.sha256).hexdigest()) for k, c, a in zip(kinds, canons, attempts)]
        return pd.DataFrame(rows, columns=["surrogate", "rank"])

    waiting = materialize(settled_kinds(found))
    taken = waiting.select("grp", F.col("canon").alias("surrogate"))
    settled: DataFrame | None = None
    attempt = 0
    while attempt == 0 or not waiting.isEmpty():
        drawn = materialize(waiting.withColumn("d", draw("kind", "canon", F.lit(attempt))).select("kind", "canon", "grp", "d.surrogate", "d.rank"))
        free = drawn.join(taken, ["grp", "surrogate"], "left_anti")
        first = free.groupBy("grp", "surrogate").agg(F.min(F.struct("rank", "canon")).alias("w"))
        won = materialize(first.select("grp", "w.canon", "surrogate"))
        settled = won if settled is None else settled.unionByName(won)
        after = materialize(drawn.select("grp", "canon", "kind").join(won, ["grp", "canon"], "left_anti"))
        if attempt:  # the first list of entities is still what surrogates must not meet
            release(waiting)
        release(drawn)
        waiting = after
        taken = taken.unionByName(won.select("grp", "surrogate"))
        attempt += 1
    return settled.select(F.col("grp").alias("kind"), "canon", "surrogate")


def mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, found) of the texts that hold entities, one row per distinct row key."""
    held = docs.where(triggered(F.col(text_col)))
    rows = held.select(row_key(docs, [id_col, text_col]).alias("key"), entities(F.col(text_col)).alias("found")).where("size(found) > 0")
    return rows.groupBy("key").agg(F.first("found").alias("found"))


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """`docs` with every entity in `text_col` replaced; other columns and rows stay as they are.

    `count_col` adds the number of distinct entities of the row (0 without any). Null
    texts stay null. Rows without a trigger stay where they are; the others meet their
    entities by a 128-bit key of id and text, so ids may repeat or be null.
    """
    if not key:
        raise ValueError("a key is needed")
    columns = [c for c in without(docs, [count_col or ""]).columns]
    docs = docs.select(*columns)
    held = materialize(mentions(docs, id_col, text_col))
    pairs = held.select("key", F.explode("found").alias("e")).select("key", "e.kind", "e.canon")
    mapping = materialize(assign(pairs.select("kind", "canon"), key))
    entry = F.struct("kind", "canon", "surrogate")
    group = F.when(F.col("kind").rlike("^given|^surname"), F.lit("name")).otherwise(F.col("kind"))
    named = pairs.select("key", group.alias("kind"), "canon").distinct()  # a name may have several roles in one text
    per_row = materialize(named.join(mapping, ["kind", "canon"]).groupBy("key").agg(F.collect_list(entry).alias("entries")))

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series, entries: pd.Series) -> pd.Series:
        return pd.Series([t if e is None else replace(t, {(x["kind"], x["canon"]): x["surrogate"] for x in e}) for t, e in zip(texts, entries)], dtype=object)

    trigger = triggered(F.col(text_col))
    still = docs.where(~trigger)
    row, held_here = free_names(docs, "row", "entries")
    met = docs.where(trigger).withColumn(row, row_key(docs, [id_col, text_col]))
    met = met.join(per_row.select(F.col("key").alias(row), F.col("entries").alias(held_here)), row, "left")
    moved = met.withColumn(text_col, rewrite(F.col(text_col), F.col(held_here)))
    if count_col:
        still = still.withColumn(count_col, F.lit(0).cast("long"))
        moved = moved.withColumn(count_col, F.greatest(F.size(held_here), F.lit(0)).cast("long"))
        columns = [*columns, count_col]
    return still.select(*columns).unionByName(moved.select(*columns))
