"""Domain-shaped views over the driver tables.

Each recipe is one SELECT that reads the same on Spark SQL and on DuckDB, so the
same text feeds a query and its oracle. Nulls, blanks, repeats and bad codes are
worked in by modulo. All recipes read their whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
AS_OF = "2024-02-01 00:00:00"
ORDERS_AS_OF = "2001-09-01 00:00:00"

RECIPES: dict[str, tuple[list[str], str]] = {}


def recipe(name: str, needs: list[str], sql: str) -> None:
    RECIPES[name] = (needs, sql)


recipe("fx_location", [], """
SELECT CAST(n.n_nationkey + 1 AS INT) AS location_id, n.n_name AS neighborhood_name, r.r_name AS city,
       CASE WHEN n.n_nationkey % 5 = 4 THEN 'CITY' ELSE 'NEIGHBORHOOD' END AS granularity,
       CASE WHEN n.n_nationkey % 3 = 0 THEN NULL ELSE CAST(1 + n.n_nationkey AS DOUBLE) / 4 END AS sqmiles,
       -71.35 + CAST(n.n_nationkey % 5 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS x0,
       42.2 + CAST(floor(n.n_nationkey / 5.0) AS DOUBLE) * CAST(0.07 AS DOUBLE) AS y0,
       CAST(0.1 AS DOUBLE) AS w, CAST(0.07 AS DOUBLE) AS h
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

recipe("fx_edge", ["fx_location"], """
SELECT l.location_id, e.k, l.x0 + l.w * e.ax AS x1, l.y0 + l.h * e.ay AS y1, l.x0 + l.w * e.cx AS x2, l.y0 + l.h * e.cy AS y2
FROM fx_location l JOIN (
  SELECT * FROM (VALUES
    (0,0,CAST(0 AS DOUBLE),CAST(0 AS DOUBLE),CAST(1 AS DOUBLE),CAST(0 AS DOUBLE)),(0,1,1,0,1,1),(0,2,1,1,0,1),(0,3,0,1,0,0),
    (1,0,0,0,1,0),(1,1,1,0,1,0.5),(1,2,1,0.5,0.5,0.5),(1,3,0.5,0.5,0.5,1),(1,4,0.5,1,0,1),(1,5,0,1,0,0)
  ) AS v(kind, k, ax, ay, cx, cy)) e ON e.kind = l.location_id % 2""")

recipe("fx_incident", [], """
SELECT 'I' || CAST(CAST(floor(event_id / 2.0) AS BIGINT) AS VARCHAR(20)) AS incident_number,
       CASE WHEN event_id % 5 = 0 THEN '199' ELSE CAST(100 + CAST(floor(event_id / 4.0) AS BIGINT) % 3 AS VARCHAR(10)) END AS offense_code,
       CASE event_id % 13 WHEN 0 THEN ' armed robbery ' WHEN 1 THEN 'LARCENY SHOPLIFTING' WHEN 2 THEN 'Drug possession'
            WHEN 3 THEN 'AUTO THEFT' WHEN 4 THEN 'VANDALISM' WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'AGGRAVATED ASSAULT'
            WHEN 8 THEN 'simple assault' WHEN 9 THEN 'NARCOTIC SALE' WHEN 10 THEN 'BURGLARY' WHEN 11 THEN 'TOWED VEHICLE'
            ELSE 'SICK ASSIST' END AS offense_description,
       CASE user_id % 7 WHEN 0 THEN 'a1' WHEN 1 THEN ' B2 ' WHEN 2 THEN 'C11' WHEN 3 THEN 'Z9' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'E18' END AS district,
       CASE event_id % 17 WHEN 0 THEN '1' WHEN 1 THEN 'Y' WHEN 2 THEN NULL ELSE '0' END AS shooting,
       ts AS occurred_on_date,
       CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(extract(year FROM ts) AS INT) END AS year,
       CASE WHEN event_id % 29 = 1 THEN NULL ELSE CAST(event_id % 12 + 1 AS INT) END AS month,
       CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(extract(hour FROM ts) AS INT) END AS hour,
       CASE user_id % 9 WHEN 0 THEN 'Saturday' WHEN 1 THEN ' sunday ' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'Monday' END AS day_of_week,
       CASE WHEN user_id % 6 = 0 THEN NULL ELSE CAST(user_id % 40 AS VARCHAR(10)) END AS reporting_area,
       CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'N/A' ELSE 'street ' || CAST(user_id % 50 AS VARCHAR(10)) END AS street,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE 42.2 + CAST((event_id * 7919) % 34981 AS DOUBLE) / 100000 END AS lat,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 0.0 ELSE -71.35 + CAST((event_id * 104729) % 49979 AS DOUBLE) / 100000 END AS long,
       event_id AS load_seq
FROM events""")

recipe("fx_district", [], """
SELECT * FROM (VALUES ('A1', 'DOWNTOWN'), (' b2', 'ROXBURY'), ('C11', 'DORCHESTER'), ('Z9', 'ELSEWHERE')) AS v(district_code, district_name)""")

recipe("fx_geocode", [], """
SELECT 'I' || CAST(CAST(floor(event_id / 2.0) AS BIGINT) AS VARCHAR(20)) AS incident_number,
       CASE event_id % 6 WHEN 0 THEN 'SUCCESS' WHEN 2 THEN 'SUCCESS_CACHED' ELSE 'FAILED' END AS geocode_status,
       CASE WHEN event_id % 8 = 0 THEN -999.0 ELSE 42.2 + CAST((event_id * 7907) % 34961 AS DOUBLE) / 100000 END AS lat,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE -71.35 + CAST((event_id * 104723) % 49957 AS DOUBLE) / 100000 END AS long
FROM events""")

recipe("fx_cluster_point", [], """
SELECT c_custkey AS id, CAST(c_nationkey + 1 AS INT) AS location_id,
       42.3 + CAST(c_custkey % 3 AS DOUBLE) / 100 + CASE WHEN c_custkey % 7 = 0 THEN CAST((c_custkey * 7919) % 997 AS DOUBLE) / 20000 ELSE CAST(floor(c_custkey / 3.0) % 7 AS DOUBLE) * 4 / 10000 END AS lat,
       -71.1 + CAST(c_custkey % 3 AS DOUBLE) / 100 + CASE WHEN c_custkey % 7 = 0 THEN CAST((c_custkey * 104729) % 991 AS DOUBLE) / 20000 ELSE CAST(floor(c_custkey / 21.0) % 5 AS DOUBLE) * 5 / 10000 END AS long
FROM customer""")

recipe("fx_facility", [], """
SELECT c_custkey AS facility_id, '  ' || c_name || '   ctr ' AS facility_name,
       CASE c_custkey % 9 WHEN 0 THEN 'General Hospital' WHEN 1 THEN 'Mobile/Portable Clinic Satellite' WHEN 2 THEN 'Ambulatory Surgical Ctr. A'
            WHEN 3 THEN 'Renal Dialysis (ESRD)' WHEN 4 THEN 'Home Health Agency' WHEN 5 THEN 'Hospice' WHEN 6 THEN '' WHEN 7 THEN NULL ELSE ' Nursing Home' END AS facility_type,
       CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE CAST(c_custkey % 90 AS VARCHAR(10)) || '  main   st' END AS street,
       CASE c_custkey % 8 WHEN 0 THEN 'boston' WHEN 1 THEN ' Cambridge' WHEN 2 THEN NULL WHEN 3 THEN '' WHEN 4 THEN 'AFRICA' WHEN 5 THEN 'europe ' WHEN 6 THEN 'WORCESTER' ELSE 'hyde   park' END AS city,
       CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '2138' WHEN 2 THEN '02138-1234' WHEN 3 THEN '' ELSE '02115' END AS zip_code,
       CASE c_custkey % 4 WHEN 0 THEN '(617) 555-0100' WHEN 1 THEN '555-0100' WHEN 2 THEN NULL ELSE '6175550199 x2' END AS telephone,
       CASE c_custkey % 6 WHEN 0 THEN 'Not Applicable' WHEN 1 THEN '12' WHEN 2 THEN 'n/a' WHEN 3 THEN NULL WHEN 4 THEN 'abc' ELSE '250' END AS bed_count,
       CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN ' 40 ' WHEN 2 THEN 'N/A' ELSE NULL END AS adult_day_health_capacity,
       CASE WHEN c_custkey % 10 = 0 OR c_nationkey = 7 THEN NULL ELSE CAST(c_nationkey + 1 AS INT) END AS location_id
FROM customer""")

recipe("fx_facility_geocode", ["fx_cluster_point"], """
SELECT id AS facility_id, CASE WHEN id % 13 = 0 THEN 'FAILED' ELSE 'GEOCODED' END AS geocode_status,
       CASE WHEN id % 12 = 0 THEN NULL ELSE 42.2 + CAST((id * 7919) % 36007 AS DOUBLE) / 100000 END AS lat,
       CASE WHEN id % 14 = 0 THEN NULL ELSE -71.37 + CAST((id * 104729) % 54001 AS DOUBLE) / 100000 END AS long
FROM fx_cluster_point""")

recipe("fx_store", [], """
SELECT CASE WHEN p_partkey % 41 = 0 THEN 'x' || CAST(p_partkey AS VARCHAR(20)) ELSE CAST(p_partkey AS VARCHAR(20)) END AS objectid,
       p_name AS coname, p_brand AS staddr, 'BOSTON' AS stcity,
       CASE p_partkey % 4 WHEN 0 THEN '02118' WHEN 1 THEN '00000' WHEN 2 THEN ' 02119 ' ELSE '2119' END AS zip,
       CASE p_type WHEN 'ECONOMY' THEN 'Convenience Stores' WHEN 'SMALL' THEN 'Meat Markets' WHEN 'MEDIUM' THEN 'Supermarket or Other Grocery'
            WHEN 'PROMO' THEN 'Farmers Markets' WHEN 'STANDARD' THEN ' Pharmacies & Drug Stores' ELSE 'Gas Station' END AS store_type,
       CASE p_partkey % 3 WHEN 0 THEN '2021' WHEN 1 THEN '2017' ELSE 'n/a' END AS year,
       CAST(1 + p_partkey % 25 AS INT) AS location_id
FROM part""")

recipe("fx_store_geocode", [], """
SELECT CAST(p_partkey AS INT) AS objectid, CASE WHEN p_partkey % 17 = 0 THEN 'FAILED' ELSE 'GEOCODED' END AS geocode_status,
       42.19 + CAST((p_partkey * 7919) % 997 AS DOUBLE) / 2700 AS lat,
       -71.36 + CAST((p_partkey * 104729) % 991 AS DOUBLE) / 1900 AS long
FROM part""")

recipe("fx_monthly", [], """
SELECT CAST(c.c_nationkey + 1 AS INT) AS location_id, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, count(*) AS y
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY CAST(c.c_nationkey + 1 AS INT), CAST(date_trunc('month', o.o_orderdate) AS DATE)""")

recipe("fx_heading", [], """
SELECT s_suppkey AS pos,
       'S' || CAST(s_suppkey AS VARCHAR(20)) || ' & T' || CAST(s_suppkey % 60 AS VARCHAR(20)) ||
       CASE s_suppkey % 4 WHEN 0 THEN ' (' || s_name || ' & East End)' WHEN 1 THEN ' ( whole ' || s_name || ')' WHEN 2 THEN ' & (' || s_name || ' & b & c)' ELSE ' plain' END AS text
FROM supplier""")


class Tables:
    """Driver tables and recipe views of one folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._seen: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._seen:
            if name in TABLES:
                df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                needs, sql = RECIPES[name]
                df = self.sql(sql, needs)
            self._seen[name] = df
        return self._seen[name]

    def sql(self, text: str, needs: list[str] | None = None) -> DataFrame:
        """Run SQL over the driver tables (and named recipes) as temporary views."""
        import re

        for t in {*(needs or []), *[t for t in TABLES if re.search(rf"\b{t}\b", text)]}:
            getattr(self, t).createOrReplaceTempView(t)
        return self.spark.sql(text)

    @property
    def polygons(self) -> DataFrame:
        """fx_location with the geometry its edges draw."""
        square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
        ell = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.5), (0.5, 0.5), (0.5, 1.0), (0.0, 1.0), (0.0, 0.0)]

        def ring(corners):
            pts = [
                F.struct((F.col("x0") + F.col("w") * a).alias("x"), (F.col("y0") + F.col("h") * b).alias("y"))
                for a, b in corners
            ]
            return F.array(F.array(F.array(*pts)))

        return self.fx_location.withColumn(
            "geometry", F.when(F.col("location_id") % 2 == 0, ring(square)).otherwise(ring(ell))
        )


def with_ctes(sql: str, needs: list[str], more: dict[str, str] | None = None) -> str:
    """Prefix an oracle query with the recipes it needs (and what those need)."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in RECIPES[name][0]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    ctes = [f"{n} AS ({RECIPES[n][1].strip()})" for n in order]
    ctes += [f"{n} AS ({body.strip()})" for n, body in (more or {}).items()]
    return f"WITH RECURSIVE {', '.join(ctes)}\n{sql.strip()}" if ctes else sql.strip()
