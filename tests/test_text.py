"""Text expressions, descriptions, narratives and pages on hand-written rows."""

import json

from pyspark.sql import functions as F

from placestats import constants as K
from placestats.functions import rules, text
from placestats.functions.dates import month_name
from placestats.operators.narrative import (
    describe_facility, describe_incident, describe_store, feature_collection, features, narrate, rows_as_csv, text_report,
)
from placestats.operators.pages import pages_to_markdown
from placestats.functions.geometry import wkt_to_geom

import pytest


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "fn,value,want",
    [
        (text.clean_text, "  ab ", "AB"), (text.clean_text, " ", "UNKNOWN"), (text.clean_text, None, "UNKNOWN"),
        (text.valid_zip, " 02118 ", "02118"), (text.valid_zip, "00000", "UNKNOWN"), (text.valid_zip, "2118", "UNKNOWN"),
        (text.padded_zip, None, "00000"), (text.padded_zip, "2138", "02138"), (text.padded_zip, "02138-1234", "02138"),
        (text.valid_phone, "(617) 555-0100", True), (text.valid_phone, "555-0100", False), (text.valid_phone, None, False),
        (text.clean_phone, "call", "UNKNOWN"), (text.clean_squeezed, " a \t b ", "A B"),
        (lambda c: text.humanize(c, "title"), "LOW_ACCESS", "Low Access"),
        (lambda c: text.humanize(c, "sentence"), "LOW_ACCESS", "Low access"),
        (lambda c: text.normalize_blank_runs(c), "a\r\n\n\n\nb  \t c \n", "a\n\nb c"),
        (lambda c: rules.keyword_tier(c, [(K.SEVERITY_HIGH, 1), (K.SEVERITY_MEDIUM, 2)], 3), "DRUG AND ROBBERY", 1),
        (lambda c: rules.keyword_tier(c, [(K.SEVERITY_HIGH, 1), (K.SEVERITY_MEDIUM, 2)], 3), None, 3),
        (lambda c: rules.pattern_map(c, K.FACILITY_GROUPS, "OTHER"), "research hospital", "INPATIENT / HOSPITAL"),
        (lambda c: rules.pattern_map(c, K.FACILITY_CANONICAL, F.upper(c)), "Outpt. Phys. Therapy/Speech Path. X", "OUTPATIENT PT / SPEECH PATHOLOGY"),
    ],
)
def test_text_rules(spark, fn, value, want):
    assert one(spark, value, fn) == want


def test_number_rules(spark):
    assert one(spark, 10, lambda c: rules.grade(c, K.ACCESS_TIERS, K.ACCESS_TIER_TOP, "<="), "int") == "GOOD_ACCESS"
    assert one(spark, 13, month_name, "int") == "UNKNOWN"
    assert one(spark, 2, month_name, "int") == "FEBRUARY"
    assert one(spark, 1234.5, lambda c: text.fixed(c, 0), "double") == "1234"
    assert one(spark, 1234567.0, lambda c: text.fixed(c, 0, thousands=True), "double") == "1,234,567"


def test_trend_rules(spark):
    rows = [(0.0, 0.0), (1.0, 0.0), (106.0, 100.0), (94.0, 100.0), (105.0, 100.0)]
    df = spark.createDataFrame(rows, "a double, b double").select(rules.trend_class(F.col("a"), F.col("b")).alias("t"))
    assert [r["t"] for r in df.collect()] == ["stable", "increasing", "increasing", "decreasing", "stable"]


def test_incident_text(spark):
    base = dict(
        crime_severity_label="HIGH", offense_description="ROBBERY", neighborhood_name="FENWAY", city="BOSTON", street="UNKNOWN",
        day_of_week="MONDAY", time_of_day="NIGHT", season="WINTER", month=-99, year=-99, is_shooting=True, is_violent_crime=True,
        is_property_crime=False, is_drug_related=False,
    )
    rows = [base, {**base, "street": "N/A", "month": 1, "year": 2024, "is_shooting": False}, {**base, "city": None}]
    got = [r[0] for r in describe_incident(spark.createDataFrame(rows)).select("row_description").collect()]
    assert got[0] == (
        "A HIGH severity robbery incident occurred in FENWAY, BOSTON on UNKNOWN on a MONDAY NIGHT in WINTER (UNKNOWN, -99)."
        " A shooting was involved. This was classified as a violent crime."
    )
    assert got[1].startswith("A HIGH severity robbery incident occurred in FENWAY, BOSTON on a MONDAY NIGHT in WINTER (JANUARY, 2024).")
    assert got[2] is None


def test_store_and_facility_text(spark):
    store = dict(
        store_name="ABC", store_type="MEAT_MARKET", street_address="1 MAIN", neighborhood_name="FENWAY", city="BOSTON", zip_code="02118",
        naics_category="Meat Markets", data_vintage="2021 Survey", is_essential_food_source=True, is_large_format=False,
        is_specialty_store=True, is_pharmacy_or_drug_store=False, is_convenience_type=False,
    )
    assert describe_store(spark.createDataFrame([store])).first()["row_description"] == (
        "ABC is a meat market located at 1 MAIN, FENWAY, BOSTON 02118. It is classified under Meat Markets."
        " It is considered an essential food source for the neighborhood. It is a specialty food store."
        " Data sourced from the 2021 Survey Massachusetts grocery licensing survey."
    )
    place = dict(
        facility_name="CLINIC A", facility_type="CLINIC", neighborhood_name="FENWAY", city_name="BOSTON", city="BOSTON",
        facility_type_group="OUTPATIENT / CLINIC", bed_count=12, adult_day_health_capacity=-99, is_hospital=False, is_clinic=True,
        has_valid_phone=True, is_boston_area=False,
    )
    assert describe_facility(spark.createDataFrame([place])).first()["row_description"] == (
        "CLINIC A is a clinic located in FENWAY, BOSTON. It belongs to the outpatient / clinic category. It has a bed count of 12."
        " It is classified as a clinic. A valid phone number is available for this facility."
    )


def test_narrate_with_and_without_model(spark):
    df = spark.createDataFrame([("p1",), ("p2",)], "prompt string")
    plain = narrate(df, "prompt", F.lit("fallback"), "text").collect()
    assert {r["text"] for r in plain} == {"fallback"}
    told = narrate(df, "prompt", F.lit("fallback"), "text", model=lambda ps: [p.upper() + " " for p in ps]).collect()
    assert sorted(r["text"] for r in told) == ["P1", "P2"]

    def broken(prompts):
        raise RuntimeError("no answer")

    failed = narrate(df, "prompt", F.lit("fallback"), "text", model=broken).collect()
    assert {r["text"] for r in failed} == {"fallback"}


def test_reports_are_exact_when_cut(spark):
    df = spark.range(500).select(F.format_string("n%03d", "id").alias("k"))
    whole = "\n\n".join(f"n{i:03d}" for i in range(500))
    assert text_report(df.withColumn("g", F.lit(1)), F.col("k"), ["k"], by=["g"]).first()["report"] == whole
    with pytest.raises(ValueError):
        text_report(df, F.col("k"), ["k"])
    assert text_report(df, F.col("k"), ["k"], max_chars=100).first()["report"] == whole[:100]
    csv = rows_as_csv(df.withColumn("q", F.lit('a "b", c')), ["k", "q"], 2, [F.col("k").asc()]).first()["csv"]
    assert csv == 'k,q\nn000,"a ""b"", c"\nn001,"a ""b"", c"\n'


def test_features(spark):
    rows = [("a", "POLYGON ((0 0, 1 0, 1 1, 0 0))", 3), ("b", "nonsense", 4)]
    df = spark.createDataFrame(rows, "neighborhood_name string, w string, n int").withColumn("geometry", wkt_to_geom(F.col("w")))
    feats = features(df, {"n": F.col("n"), "none": F.lit(None).cast("string")}, selected="a")
    doc = json.loads(feature_collection(feats, "neighborhood_name").first()["geojson"])
    assert len(doc["features"]) == 1
    assert doc["features"][0]["properties"] == {"n": 3, "none": None, "is_selected": True}
    assert doc["features"][0]["geometry"]["coordinates"][0][2] == [1.0, 1.0]


PAGE = """<html><head><title>t</title><script>var x = "</p>";</script></head><body><nav><p>menu</p></nav>
<article><h1>Stores &amp; more</h1><div class="box widget"><p>ad</p></div><p>First <b>bold</b><br>line</p><p>First <b>bold</b><br>line</p>
<ul><li>one</li><li>two<ul><li>inner</li></ul></li></ul><ol><li>x</li><li></li><li>y</li></ol><blockquote>said<!-- c --> so</blockquote>
<h4>Small</h4><section><p>kept?</p><p>Leave a <i>Reply</i></p></section><p>never</p></article><p>outside</p></body></html>"""


def test_page_markdown(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "plain <p>x</p> text"), (4, "<h1>a</h1><p>b<p>c</p>d")], "page_id int, html string")
    got = {r["page_id"]: r["markdown"] for r in pages_to_markdown(df).collect()}
    assert got[1] == (
        "# Stores & more\n\nFirst bold line\n\n- one\n- two inner\n\n1. x\n2. y\n\n> said so\n\n#### Small"
    )
    assert got[2] == "" and got[3] == "x"
    # an unclosed paragraph holds all that follows it, the inner one comes after
    assert got[4] == "# a\n\nb c d\n\nc"


def test_stop_marks_the_first_element_that_mentions_it(spark):
    rows = [(1, "<article><p>a</p><div><p>b</p><p>LEAVE A REPLY</p></div></article>"), (2, "<article><p>Leave a</p><p>Reply</p></article>")]
    got = {r["page_id"]: r["markdown"] for r in pages_to_markdown(spark.createDataFrame(rows, "page_id int, html string")).collect()}
    assert got == {1: "a", 2: "Leave a\n\nReply"}


ODD = [
    "", "a</>b</3>c", '<p title="x>y">z</p>', "<div/>x<br/>y<p>z</p>", "<script>a<b</script><p>c</p>",
    "<p>q</p><script>never closed <p>x", "<P CLASS='a  Widget'>q</P ><p class=widget>r</p><p class='my widget'>s</p>", "<!DOCTYPE html><p>x<?pi y>z", "<p>&am &amp &amp; &#39; &#x41; &#65 &nbsp;</p>",
    "<ul><li>a<li>b</ul><h2>x</h2><h2>x</h2><p></p></div><p>t <em>u</em>", "<b><p>x</b>y</p>z", "</p></p><p>a</p></ul>", "<nav><p>n<nav>m</nav>o</p></nav><p>p</p>",
    "<ol><li>1<ul><li>2</ul><li>3</ol><ul></ul><ul><li> </li></ul><blockquote>b<p>c</p></blockquote>", "<div><div><div><div><div><div><div><h1>t</h1></div></div></div></div></div><p>far</p></div></div>",
    "<body><header>h</header><p>x</p></body>" * 2, "<article>" + "".join(f"<p>{i % 700}</p>" for i in range(1500)) + "</article>", "<p>" + "<b>x</b> " * 700 + "</p><ul>" + "<li>y" * 600 + "</ul>",
]


def test_what_is_no_tag_is_text(spark):
    rows = {"<p>a < b <3 c": "a < b <3 c", "<p>x</arti": "x</arti", "<p>abc<p cla": "abc<p cla", "<p>x<!-- open <p>y": "x<!-- open y\n\ny"}
    df = spark.createDataFrame(list(enumerate(rows)), "page_id int, html string")
    assert [r["markdown"] for r in pages_to_markdown(df).orderBy("page_id").collect()] == list(rows.values())


def test_odd_pages_match_a_plain_tree_walk(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "page_id int, html string")
    out = pages_to_markdown(df)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["page_id"]: r["markdown"] for r in out.collect()}
    assert got == {i: plain_markdown(h) for i, h in enumerate(ODD)}


class _Node:
    def __init__(self, name, parent, classes=()):
        self.name, self.parent, self.classes, self.children = name, parent, classes, []

    def strings(self):
        for c in self.children:
            if isinstance(c, str):
                if c.strip():
                    yield c.strip()
            else:
                yield from c.strings()

    def walk(self):
        for c in self.children:
            if not isinstance(c, str):
                yield c
                yield from c.walk()


def plain_markdown(html):
    """The same cleaning over an ordinary element tree, step by step."""
    import re
    from html.parser import HTMLParser

    from placestats.operators.pages import VOID_TAGS

    root = _Node("", None)

    class Builder(HTMLParser):
        at = root

        def handle_starttag(self, tag, attrs):
            node = _Node(tag, self.at, (dict(attrs).get("class") or "").split())
            self.at.children.append(node)
            if tag not in VOID_TAGS:
                self.at = node

        def handle_endtag(self, tag):
            node = self.at
            while node is not None and node.name != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                self.at = node.parent

        def handle_data(self, data):
            self.at.children.append(data)

    builder = Builder()
    builder.feed(html)
    builder.close()

    def prune(node):
        node.children = [
            c for c in node.children
            if isinstance(c, str) or not (c.name in K.DROPPED_TAGS or set(c.classes) & set(K.DROPPED_CLASSES))
        ]
        for c in node.children:
            if not isinstance(c, str):
                prune(c)

    prune(root)
    nodes = list(root.walk())
    main = next((n for n in nodes if n.name == "article"), None)
    if main is None:
        main = next((n for n in nodes if n.name == "h1"), None)
        for _ in range(6 if main is not None else 0):
            main = main.parent or main
    if main is None:
        main = next((n for n in nodes if n.name == "body"), root)
    lines, seen = [], set()
    for n in main.walk():
        body = " ".join(n.strings())
        if any(p.lower() in body.lower() for p in K.STOP_PHRASES):
            break
        if n.name in (*K.HEADING_MARKS, "p", "blockquote"):
            if body and body not in seen:
                mark = K.HEADING_MARKS.get(n.name) or (">" if n.name == "blockquote" else "")
                lines += [f"{mark} {body}".strip(), ""]
                seen.add(body)
        elif n.name in ("ul", "ol"):
            above = n.parent
            while above is not None and above.name not in ("ul", "ol"):
                above = above.parent
            if above is None:
                texts = [" ".join(c.strings()) for c in n.children if not isinstance(c, str) and c.name == "li"]
                texts = [t for t in texts if t]
                lines += [f"{'-' if n.name == 'ul' else f'{i}.'} {t}" for i, t in enumerate(texts, 1)] + [""] * bool(texts)
    out = re.sub(r"\n{3,}", "\n\n", "\n".join(lines))
    return re.sub(r"[ \t]{2,}", " ", out).strip()


def test_pages_match_a_plain_tree_walk(spark):
    from pathlib import Path

    path = Path("/root/testdata/sf0.01/pages.parquet")
    if not path.exists():
        pytest.skip("driver tables not present")
    pages = spark.read.parquet(str(path))
    odd = spark.createDataFrame([(-1, "", PAGE), (-2, "", "<ul><li>a<li>b</ul><h2>x</h2><h2>x</h2><p></p></div><p>t <em>u</em>")], pages.schema)
    want = {r["page_id"]: plain_markdown(r["html"]) for r in pages.unionByName(odd).collect()}
    got = {r["page_id"]: r["markdown"] for r in pages_to_markdown(pages.unionByName(odd)).collect()}
    assert got == want and len(got) > 200
