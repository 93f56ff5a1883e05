"""The whole incident analysis, end to end, over a mart whose ids repeat."""

from pyspark.sql import functions as F

from catalog import query
from catalog.clusters import node_ctes, stats_sql
from catalog.places import located_incidents
from catalog.series import seasonal_ctes
from catalog.sqltext import LOCATED, LOCATED_NEEDS, fill
from placestats import constants as K
from placestats.fixtures import AS_OF, Tables
from placestats.plans import crime

SINCE, STATS, POINTS = 2021, (0.5, 6), (0.9, 12)
_MONTHS = 30  # the events cover a few weeks, so incidents are moved back by up to this many months

ANALYSIS = {
    **LOCATED,
    "rows": f"""SELECT load_seq, incident_number, neighborhood_name, lat, long, offense_description, CAST(occurred AS DATE) AS crime_date, CAST(date_trunc('month', occurred) AS DATE) AS m
FROM (SELECT *, occurred_on_date - to_months(CAST(load_seq % {_MONTHS} AS INTEGER)) AS occurred FROM located)
WHERE valid_location AND neighborhood_name IS NOT NULL AND neighborhood_name <> 'UNKNOWN' AND occurred >= TIMESTAMP '{SINCE}-01-01' AND occurred < date_trunc('month', TIMESTAMP '{AS_OF}')""",
    "an_grid": """SELECT neighborhood_name, CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS month FROM rows GROUP BY neighborhood_name""",
    "an_all": """SELECT g.neighborhood_name, g.month, CAST(coalesce(c.y, 0) AS BIGINT) AS y, row_number() OVER (PARTITION BY g.neighborhood_name ORDER BY g.month DESC) AS back
FROM an_grid g LEFT JOIN (SELECT neighborhood_name, m, count(*) AS y FROM rows GROUP BY ALL) c ON c.neighborhood_name = g.neighborhood_name AND c.m = g.month""",
    "an_dense": "SELECT * FROM an_all WHERE neighborhood_name IN (SELECT neighborhood_name FROM an_all GROUP BY neighborhood_name HAVING count(*) >= 12)",
    **seasonal_ctes("a_", "an_dense", "neighborhood_name"),
    "an_train": """SELECT neighborhood_name, month, y FROM an_dense WHERE back > 6 AND neighborhood_name IN
(SELECT neighborhood_name FROM an_dense WHERE back > 6 GROUP BY neighborhood_name HAVING count(*) >= 12)""",
    **seasonal_ctes("t_", "an_train", "neighborhood_name"),
    "an_mape": """SELECT p.neighborhood_name, round_even(least(avg(abs((p.y - f.v) / (p.y + 1e-9))) * 100, 999.0), 2) AS train_mape
FROM an_dense p LEFT JOIN t_seasonal f ON f.neighborhood_name = p.neighborhood_name AND f.month = p.month WHERE p.back <= 6 GROUP BY p.neighborhood_name""",
    "an_forecast": """SELECT s.neighborhood_name, strftime(hi, '%Y-%m') AS last_train_date, strftime(month, '%Y-%m') AS forecast_month, step, CAST(greatest(round_even(v, 0), 0) AS INTEGER) AS forecasted_count,
CAST(greatest(round_even(v - half, 0), 0) AS INTEGER) AS lower_ci, CAST(greatest(round_even(v + half, 0), 0) AS INTEGER) AS upper_ci, 'seasonal_ar1' AS arima_order, m.train_mape
FROM a_seasonal s LEFT JOIN an_mape m ON m.neighborhood_name = s.neighborhood_name""",
    "recent_all": "SELECT * FROM rows WHERE crime_date >= (SELECT max(crime_date) - INTERVAL 12 MONTH FROM rows) AND lat IS NOT NULL AND long IS NOT NULL",
    "recent_rows": f"SELECT * FROM recent_all WHERE neighborhood_name IN (SELECT neighborhood_name FROM recent_all GROUP BY neighborhood_name HAVING count(*) >= {STATS[1]})",
    **node_ctes("h_", "recent_rows", STATS),
    "an_clusters": stats_sql("h_label", "neighborhood_name").replace(" total,", " total_crimes,").replace("n_clusters", "n_hotspot_clusters")
    .replace("clustered_pct", "hotspot_crime_share_pct").replace("noise_pct", "noise_crime_pct"),
    **node_ctes("m_", "recent_rows", POINTS),
    "an_yoy": """SELECT neighborhood_name, avg(y) FILTER (back <= 3) AS recent_avg, avg(y) FILTER (back BETWEEN 13 AND 15) AS ago, count(*) AS n_months, sum(y) AS total FROM an_all GROUP BY neighborhood_name""",
    "an_trend": """SELECT *, CASE WHEN n_months < 15 THEN 'stable' WHEN ago = 0 THEN CASE WHEN recent_avg > 0 THEN 'increasing' ELSE 'stable' END
WHEN recent_avg > ago * 1.05::DOUBLE THEN 'increasing' WHEN recent_avg < ago * 0.95::DOUBLE THEN 'decreasing' ELSE 'stable' END AS recent_trend FROM an_yoy WHERE n_months >= 3""",
}


def analysis(t: Tables, part: str):
    back = F.make_ym_interval(F.lit(0), -(F.col("load_seq") % _MONTHS).cast("int"))
    mart = located_incidents(t).withColumn("occurred_on_date", F.col("occurred_on_date") + back)
    return crime.analyse(mart, SINCE, AS_OF, stats=STATS, points=POINTS, parts=[part])[part]


@query("analysis_forecast", "SELECT * FROM an_forecast", LOCATED_NEEDS, ANALYSIS)
def _(t):
    return analysis(t, "forecast").drop("month", "forecast")


@query("analysis_clusters", "SELECT * FROM an_clusters", LOCATED_NEEDS, ANALYSIS)
def _(t):
    return analysis(t, "clusters")


@query(
    "analysis_points",
    """SELECT neighborhood_name, lat, long, cluster_id, is_noise, strftime(crime_date, '%Y-%m-%d') AS crime_date, offense_description AS crime_description FROM m_label""",
    LOCATED_NEEDS,
    ANALYSIS,
)
def _(t):
    return analysis(t, "points")


@query(
    "analysis_narratives",
    f"""SELECT f.neighborhood_name, y.recent_trend, round_even(y.recent_avg, 1) AS recent_avg_monthly, f.forecast_month, f.forecasted_count, f.train_mape, c.n_hotspot_clusters,
        {fill(K.CRIME_FALLBACK)} AS safety_narrative, CASE WHEN train_mape > 50 OR n_months < 12 OR total < 500 THEN 'LOW' ELSE 'HIGH' END AS reliability_flag
        FROM an_forecast f JOIN an_trend y ON y.neighborhood_name = f.neighborhood_name LEFT JOIN an_clusters c ON c.neighborhood_name = f.neighborhood_name WHERE f.step = 1""",
    LOCATED_NEEDS,
    ANALYSIS,
)
def _(t):
    return analysis(t, "narratives").drop("prompt")
