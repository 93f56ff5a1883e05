"""Readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from catalog import sources
from placestats.fixtures import Tables
from placestats.functions.geometry import geom_to_wkt
from placestats.plans import locations
from placestats.sources import readers, writers


def test_json_pages_under_a_path(spark, tmp_path):
    page = {"success": True, "result": {"total": 2, "records": [{"_id": 1, "district": "A1", "extra": 5}, {"_id": 2}]}}
    (tmp_path / "p0.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "p1.json").write_text(json.dumps({"result": {"records": [{"_id": 3, "district": None}]}}))
    df = readers.read_json_pages(spark, str(tmp_path), fields={"_id": "bigint", "district": "string"})
    assert df.columns == ["_id", "district"]
    assert sorted(map(tuple, df.collect())) == [(1, "A1"), (2, ""), (3, "")]
    inferred = readers.read_json_pages(spark, str(tmp_path))
    assert "extra" in inferred.columns and inferred.count() == 3


def test_json_top_level_list(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"file_number": "1", "crime": "x", "junk": 1}, {"crime": "y"}]))
    df = readers.read_json_pages(spark, str(tmp_path), None, ["file_number", "crime"])
    assert sorted(map(tuple, df.collect())) == [("", "y"), ("1", "x")]


def test_tolerant_csv(spark, tmp_path):
    text = 'id,name,score,when\n1,  "Smith, J" ,2.5,2024-01-02\n2,NULL,,null\n3,short\n4,long,1,2024-01-03,more,cells\nx5,bad,1,\n6,"say ""hi""",oops,\n'
    (tmp_path / "a.csv").write_text(text)
    schema = {"id": "int", "name": "string", "score": "double", "when": "date"}
    rows = readers.read_csv_tolerant(spark, str(tmp_path), schema).orderBy("id").collect()
    assert [r["id"] for r in rows] == [1, 2, 3, 4]
    assert rows[0]["name"] == "Smith, J" and rows[0]["score"] == 2.5
    assert rows[1]["name"] is None and rows[1]["when"] is None
    assert rows[2]["score"] is None
    kept = readers.read_csv_tolerant(spark, str(tmp_path), schema, skip_bad=False)
    assert {r["name"]: r["score"] for r in kept.collect()}['say "hi"'] is None
    wide = readers.read_csv_tolerant(spark, str(tmp_path), {**schema, "state": "string"}, columns=list(schema), defaults={"state": "MA"})
    assert {r["state"] for r in wide.collect()} == {"MA"}


def test_header_helpers():
    assert readers.merge_headers(["Facility", "Unnamed: 1", "Bed", "Name"], ["ID", "Street", "Count", "name", "Zip"]) == [
        "Facility ID", "Street", "Bed Count", "Name", "Zip",
    ]
    assert [readers.sanitize_name(n) for n in [" City/Town ", "2nd  col", "__", "a--b__c"]] == ["CITY_TOWN", "C_2ND_COL", "COL", "A_B_C"]
    assert readers.unique_names(["A", "B", "A", "A"]) == ["A", "B", "A_1", "A_2"]


def test_multiheader_csv(spark, tmp_path):
    lines = ["junk 1", "", "junk 3", "Facility,,Bed", "", "ID,Street,Count", '1,"Main, 5",12', "", "junk 1,x,NULL", ",,"]
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    df = readers.read_multiheader_csv(spark, str(tmp_path), drop_rows=3)
    assert df.columns == ["FACILITY_ID", "STREET", "BED_COUNT", "_file_name"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "Main, 5", "12", "f.csv"), ("junk 1", "x", None, "f.csv")]
    with pytest.raises(ValueError):
        readers.read_multiheader_csv(spark, str(tmp_path), drop_rows=50)


def feature(name, ring, **props):
    return {"type": "Feature", "properties": {"name": name, **props}, "geometry": {"type": "Polygon", "coordinates": [ring]} if ring else None}


def test_geojson_and_master_locations(spark, tmp_path):
    box = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [feature(" fenway ", box, sqmiles=1.5), feature("", None, neighborhood="Port")]}
    (tmp_path / "b.geojson").write_text(json.dumps(doc))
    feats = readers.read_geojson(spark, str(tmp_path / "b.geojson"), {"sqmiles": "double"})
    rows = feats.orderBy("pos").collect()
    assert [(r["pos"], r["name"], r["sqmiles"]) for r in rows] == [(0, "FENWAY", 1.5), (1, "PORT", None)]
    shapes = spark.createDataFrame([("SALEM",)], "name string").crossJoin(feats.where("pos = 0").select("pos", "geometry"))
    master = locations.master_locations(
        [locations.neighbourhoods(feats, "BOSTON", "sqmiles"), locations.cities(spark, shapes)]
    ).orderBy("location_id").collect()
    assert [r["location_id"] for r in master] == list(range(1, 15))
    assert (master[0]["name"], master[0]["centroid_lat"], master[0]["granularity"]) == ("FENWAY", 1.0, "NEIGHBORHOOD")
    assert master[1]["centroid_lat"] == -999.0 and not master[1]["has_geometry"]
    assert master[2]["name"] == "SOMERVILLE" and master[2]["centroid_lat"] == 42.3876
    salem = [r for r in master if r["name"] == "SALEM"][0]
    assert salem["centroid_long"] == 1.0 and salem["geometry_wkt"].startswith("POLYGON ((0.0 0.0")
    assert feats.select(geom_to_wkt("geometry")).where("pos = 1").first()[0] is None


def test_writers(spark, tmp_path):
    df = spark.range(5).withColumn("name", F.lit("a,b"))
    writers.write_full_refresh(df, str(tmp_path / "t"))
    writers.write_full_refresh(df.limit(2), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    for day in ("2024-01-01 10:00:00", "2024-01-02 10:00:00"):
        writers.write_append(df, str(tmp_path / "a"), day)
    appended = spark.read.parquet(str(tmp_path / "a"))
    report = writers.load_report(appended, "_load_date", "2024-01-02", "name").first()
    assert (report["rows_total"], report["rows_today"], report["rows_filled"]) == (10, 5, 10)
    writers.write_result(df, str(tmp_path / "r"), "2024-01-01 00:00:00")
    assert "load_timestamp" in spark.read.parquet(str(tmp_path / "r")).columns
    at = writers.export(df, "csv", str(tmp_path / "x"), stamp=True)
    assert spark.read.option("header", True).option("escape", '"').csv(at).first()["name"] == "a,b"
    writers.export(df, "json", str(tmp_path / "j"))
    writers.export(df.select("name"), "text", str(tmp_path / "m"))
    with pytest.raises(ValueError):
        writers.export(df, "xlsx", str(tmp_path / "q"))


def month_rows(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))


def month_files(path):
    return {m.name: {f.name for f in m.glob("*.parquet")} for m in path.glob("event_month=*")}


def test_upsert_by_month(spark, tmp_path):
    table = writers.MonthTable(spark, str(tmp_path / "v"), "ts")
    assert table.read() is None and table.newest() is None and table.months() == []
    first = month_rows(spark, [(1, "a", "2024-01-05"), (2, "b", "2024-02-05"), (3, "c", "2024-03-05"), (4, "d", "2024-03-06"), (5, "e", None)])
    assert table.upsert(first, ["k"]) == [0, 202401, 202402, 202403]
    before = month_files(tmp_path / "v")
    # 2 stays in its month, 3 moves to a new one, 6 is new
    batch = month_rows(spark, [(2, "B", "2024-02-06"), (3, "C", "2024-05-01"), (6, "f", "2024-05-02")])
    assert table.upsert(batch, ["k"]) == [202402, 202403, 202405]
    after = month_files(tmp_path / "v")
    assert all(before[f"event_month={m}"] == after[f"event_month={m}"] for m in (0, 202401))
    assert all(before[f"event_month={m}"] != after[f"event_month={m}"] for m in (202402, 202403))
    want = [(1, "a"), (2, "B"), (3, "C"), (4, "d"), (5, "e"), (6, "f")]
    for again in (batch, batch, month_rows(spark, [])):
        table.upsert(again, ["k"])
        assert sorted((r.k, r.v) for r in table.read().collect()) == want
    assert sorted(r.k for r in table.newest().collect()) == [3, 6]
    # the only row of a month leaves it: the month goes
    table.upsert(month_rows(spark, [(1, "a", "2024-05-05")]), ["k"])
    assert table.months() == [0, 202402, 202403, 202405] and table.read().count() == 6


def test_upsert_reads_only_the_months_it_touches(spark, tmp_path):
    table = writers.MonthTable(spark, str(tmp_path / "v"), "ts")
    table.upsert(month_rows(spark, [(i, "a", f"2024-{i + 1:02d}-05") for i in range(12)]), ["k"])
    plan = table.stored().where(F.col("event_month").isin([202402]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "202402" in plan


def test_upsert_checks_keys(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    double = batch.unionByName(batch)
    with pytest.raises(Exception, match="more than once"):
        writers.upsert(first, double, ["k"]).collect()
    assert writers.upsert(first, double, ["k"], [F.col("v").desc()]).count() == 3


def test_rejected_rows(spark, tmp_path):
    lines = spark.createDataFrame([("1,x,2.5",), ("z,y,3",), ("2,,bad",), ("q,w,bad",), (" ",), ("3",), ("4,a,NULL,more",)], "line string")
    schema = {"id": "int", "name": "string", "score": "double", "state": "string"}
    rows = readers.parse_csv_checked(lines, "line", schema, columns=["id", "name", "score"], defaults={"state": "MA"})
    path = str(tmp_path / "load")
    scans = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda s: scans.add(1) or s, "string")
    counts = writers.write_checked(rows.withColumn("state", seen("state")), path)
    assert counts == {"read": 6, "accepted": 3, "rejected": 3} and scans.value == 6  # one pass
    good = writers.read_checked(spark, path, rows.schema)
    assert good.columns == list(schema)
    assert sorted(map(tuple, good.collect())) == [(1, "x", 2.5, "MA"), (3, None, None, "MA"), (4, "a", None, "MA")]
    bad = {r["_line"]: r["_reject"] for r in writers.read_checked(spark, path, rows.schema, accepted=False).collect()}
    assert bad == {"z,y,3": "id is no int", "2,,bad": "score is no double", "q,w,bad": "id is no int; score is no double"}
    assert writers.write_checked(rows.limit(0), path) == {"read": 0, "accepted": 0, "rejected": 0}
    assert writers.read_checked(spark, path, rows.schema).count() == 0


def test_bucketed_tables_need_no_exchange(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sources.profile_by_order(*sources.bucketed_orders(tables))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
