"""Series, forecasts and incremental loads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from placestats.operators.forecast import forecast, forecast_report
from placestats.operators.ranking import number_rows, top_per_group
from placestats.operators.series import backtest, monthly_series, yoy_recent
from placestats.operators.forecast import forecast_snaive
from placestats.sources import writers
from placestats.sources.writers import MonthTable
from placestats.streaming.incremental import monthly_from_days, run_incremental, stream_daily_counts, stream_incremental


def as_series(spark, groups):
    rows = [(g, f"{2015 + i // 12}-{i % 12 + 1:02d}-01", int(v)) for g, ys in groups.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "g string, m string, y long").select("g", F.to_date("m").alias("month"), "y")


def seasonal(n, noise=0.0, seed=0):
    rnd = np.random.default_rng(seed)
    t = np.arange(n)
    return np.round(200 + 2 * t + 40 * np.sin(2 * np.pi * t / 12) + rnd.normal(0, noise, n))


def test_series_are_gap_free(spark):
    df = spark.createDataFrame([("a", "2024-01-31 10:00:00"), ("a", "2024-04-01 00:00:00"), ("b", "2023-12-05 00:00:00")], "g string, ts string")
    rows = monthly_series(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "g", "ts").orderBy("g", "month").collect()
    assert [(r["g"], str(r["month"]), r["y"]) for r in rows] == [
        ("a", "2024-01-01", 1), ("a", "2024-02-01", 0), ("a", "2024-03-01", 0), ("a", "2024-04-01", 1), ("b", "2023-12-01", 1),
    ]


def test_yoy_needs_fifteen_months(spark):
    rows = {r["g"]: r for r in yoy_recent(as_series(spark, {"long": [10] * 3 + [5] * 9 + [20] * 3, "short": range(14)}), "g").collect()}
    assert (rows["long"]["recent_avg"], rows["long"]["prev_year_avg"], rows["long"]["recent_trend"]) == (20.0, 10.0, "increasing")
    assert rows["short"]["recent_trend"] == "stable" and rows["short"]["prev_year_avg"] == rows["short"]["recent_avg"]


def test_forecast_contract(spark):
    series = as_series(spark, {"season": seasonal(72, 4.0), "flat": [50] * 40, "young": seasonal(15, 1.0), "short": [1] * 11, "zero": [0] * 30})
    out = forecast(series, "g")
    rows = out.orderBy("g", "step").collect()
    by = {}
    for r in rows:
        by.setdefault(r["g"], []).append(r)
    assert "short" not in by and all(len(v) == 6 for v in by.values())
    assert [r["forecast_month"] for r in by["season"]] == [f"2021-{m:02d}" for m in range(1, 7)]
    t = np.arange(72, 78)
    truth = 200 + 2 * t + 40 * np.sin(2 * np.pi * t / 12)
    got = np.array([r["forecasted_count"] for r in by["season"]])
    assert np.abs(got - truth).max() < 20
    assert all(r["lower_ci"] <= r["forecasted_count"] <= r["upper_ci"] for r in rows)
    assert all(r["lower_ci"] >= 0 for r in rows)
    assert by["season"][0]["train_mape"] < 10 and by["young"][0]["train_mape"] is None
    assert {r["arima_order"] for r in rows} == {"seasonal_ar1"}
    assert {r["forecasted_count"] for r in by["flat"]} == {50} and {r["forecasted_count"] for r in by["zero"]} == {0}
    status = {r["g"]: r["status"] for r in forecast_report(series, out, "g").collect()}
    assert status == {"season": "ok", "flat": "ok", "young": "ok", "zero": "ok", "short": "short"}


def test_backtest_gate_and_cap(spark):
    series = as_series(spark, {"ok": [10] * 30, "short": [10] * 17, "spike": [5] * 30 + [0] * 6})
    rows = {r["g"]: r["train_mape"] for r in backtest(series, "g", forecast_snaive).collect()}
    assert rows == {"ok": 0.0, "short": None, "spike": 999.0}


def test_number_rows_matches_a_plain_window(spark):
    df = spark.range(1000).select(F.pmod(F.hash("id"), F.lit(3)).alias("g"), F.hash("id").alias("v"), "id")
    got = number_rows(df, ["v", "id"], ["g"], parts=5).collect()
    order = sorted(got, key=lambda r: (r["g"], r["v"], r["id"]))
    want, last, n = [], None, 0
    for r in order:
        n = n + 1 if r["g"] == last else 1
        last = r["g"]
        want.append(n)
    assert [r["rn"] for r in order] == want
    assert top_per_group(df, ["g"], [F.col("v").asc(), F.col("id").asc()], 2).count() == 6


INCIDENTS = "incident_number string, offense_code int, ts timestamp_ntz, load_seq long"
KEYS = (["incident_number", "offense_code"], ["incident_number"])


def incidents(spark, rows):
    raw = spark.createDataFrame(rows, "incident_number string, offense_code int, ts string, load_seq long")
    return raw.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


DAY1 = [("I1", 1, "2024-01-01 00:00:00", 1), ("I2", 1, "2024-01-02 00:00:00", 2), ("I2", 2, "2024-01-02 00:00:00", 3)]
DAY2 = [("I2", 1, "2024-01-03 00:00:00", 4), ("I9", 1, "2024-01-01 12:00:00", 5), ("I3", 1, "2024-01-04 00:00:00", 6)]
WANT = [("I1", 1), ("I2", 4), ("I3", 6)]  # I9 is older than the mark and is lost


def latest():
    return [F.col("load_seq").desc_nulls_last()]


def test_incremental_batch(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"), "ts")
    run_incremental(incidents(spark, DAY1), table, "ts", *KEYS, latest())
    run_incremental(incidents(spark, DAY1 + DAY2), table, "ts", *KEYS, latest())
    run_incremental(incidents(spark, DAY1 + DAY2), table, "ts", *KEYS, latest())
    assert sorted((r["incident_number"], r["load_seq"]) for r in table.read().collect()) == WANT


@pytest.mark.parametrize("lateness", [None, "10 days"])
def test_incremental_stream(spark, tmp_path, lateness):
    table = MonthTable(spark, str(tmp_path / "t"), "ts")
    landing = str(tmp_path / "landing")
    for day in (DAY1, DAY2):
        incidents(spark, day).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(INCIDENTS).parquet(landing)
        if lateness:
            stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        query = stream_incremental(stream, table, "ts", *KEYS, latest(), str(tmp_path / "progress"), lateness)
        query.awaitTermination()
    # with a lateness the second I2 / 1 counts as a repeat of the first
    want = WANT if lateness is None else [("I1", 1), ("I2", 3), ("I3", 6)]
    assert sorted((r["incident_number"], r["load_seq"]) for r in table.read().collect()) == want


def test_replayed_batch_after_a_half_written_table(spark, tmp_path, monkeypatch):
    """The write dies after the rows of a batch are in: the replay starts from the same mark and loses nothing."""
    table = MonthTable(spark, str(tmp_path / "t"), "ts")
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    run_incremental(incidents(spark, DAY1), table, "ts", *KEYS, latest())
    incidents(spark, [*DAY1, *DAY2]).coalesce(1).write.parquet(landing)
    whole = MonthTable.upsert

    def dies(self, batch, *args, **kw):
        whole(self, batch.where("load_seq = 6"), *args, **kw)  # only the newest row gets through
        raise RuntimeError("lost")

    monkeypatch.setattr(writers.MonthTable, "upsert", dies)
    with pytest.raises(Exception, match="lost"):
        stream_incremental(spark.readStream.schema(INCIDENTS).parquet(landing), table, "ts", *KEYS, latest(), progress).awaitTermination()
    monkeypatch.setattr(writers.MonthTable, "upsert", whole)
    stream_incremental(spark.readStream.schema(INCIDENTS).parquet(landing), table, "ts", *KEYS, latest(), progress).awaitTermination()
    assert sorted((r["incident_number"], r["load_seq"]) for r in table.read().collect()) == WANT


def test_daily_counts_survive_a_restart(spark, tmp_path):
    rows = [(g, f"2024-{m:02d}-{d:02d} {h:02d}:30:00") for g in ("a", "b") for m in (1, 2, 4) for d in (1, 2, 28) for h in range(m + (g == "b"))]
    df = spark.createDataFrame(rows, "g string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    landing, table = str(tmp_path / "landing"), MonthTable(spark, str(tmp_path / "days"), "day")
    for part in (df.where("month(ts) < 2 or (month(ts) = 2 and day(ts) = 1)"), df.where("month(ts) > 2 or (month(ts) = 2 and day(ts) > 1)")):
        part.coalesce(1).write.mode("append").parquet(landing)
        for _ in range(2):  # the second start finds nothing new
            stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(landing)
            stream_daily_counts(stream, table, ["g"], "ts", str(tmp_path / "progress"), "10 days").awaitTermination()
    key = lambda r: (r.g, r.month)
    assert sorted(monthly_from_days(table.read(), ["g"]).collect(), key=key) == sorted(monthly_series(df, "g", "ts").collect(), key=key)
    assert table.read().count() == 18


def test_long_tables_of_series_are_dealt_by_their_counts(spark):
    """600,000 series of one to three months: their bytes fit a few tasks, their number does not, and the dense rows meet in no join."""
    df = spark.range(600_000).select(F.col("id").alias("g"), F.explode(F.array(F.lit("2024-01-31"), F.when(F.col("id") % 2 == 0, F.lit("2024-03-01")))).alias("at"))
    series = monthly_series(df.where(F.col("at").isNotNull()).withColumn("ts", F.col("at").cast("timestamp_ntz")), "g", "ts")
    assert "Join" not in series._jdf.queryExecution().executedPlan().toString()
    placed = series.withColumn("part", F.spark_partition_id())
    got = placed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 0).alias("gaps"), F.count_distinct("part").alias("parts")).first()
    assert (got["n"], got["gaps"]) == (300_000 + 3 * 300_000, 300_000)
    assert got["parts"] >= 9
