"""Least squares in columns, unit-root decisions and order search against numpy."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from placestats.operators.forecast import forecast, forecast_order_search
from placestats.operators.linear import cholesky, moments, pick, solve
from placestats.operators.order_search import differenced, order_label, order_search, unit_root


def as_series(spark, groups):
    rows = [(g, f"{2010 + i // 12}-{i % 12 + 1:02d}-01", float(v)) for g, ys in groups.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "g string, m string, y double").select("g", F.to_date("m").alias("month"), "y")


def least_squares(x, y):
    """Fit by the normal equations with the stated ridge."""
    if x.shape[1] == 0:
        return np.zeros(0), float(y @ y), np.zeros((0, 0))
    xx = x.T @ x + np.diag(np.maximum(1e-8 * np.diag(x.T @ x), 0))
    beta = np.linalg.solve(xx, x.T @ y)
    return beta, max(0.0, float(y @ y - beta @ (x.T @ y))), np.linalg.inv(xx)


def plain_unit_root(y, max_lag=2):
    v = np.asarray(y, float) - np.mean(y)
    d = np.diff(v)
    at = np.arange(max_lag, len(d))
    if not len(at):
        return None
    full = np.column_stack([v[at], np.ones(len(at)), *[d[at - i] for i in range(1, max_lag + 1)]])
    found = []
    for lags in range(max_lag + 1):
        x = full[:, : lags + 2]
        if len(at) <= lags + 2 or not x[:, 0].any():
            continue
        beta, rss, inv = least_squares(x, d[at])
        if rss > 1e-6 * float(d[at] @ d[at]):
            found.append((len(at) * np.log(rss / len(at)) + 2 * (lags + 2), lags, beta[0] / np.sqrt(rss / (len(at) - lags - 2) * inv[0, 0])))
    if not found:
        return None
    _, lags, t = min(found)
    n = len(at)
    return lags, t, t < -2.86154 - 2.8903 / n - 4.234 / n**2 - 40.04 / n**3


def lagged(x, lag):
    return np.concatenate([np.zeros(min(lag, len(x))), x[: max(0, len(x) - lag)]])


def plain_search(y, horizon=6):
    """(p, d, q, P, Q), forecasts and their deviations."""
    y = np.asarray(y, float)
    seasonal = len(y) >= 24
    z = y[12:] - y[:-12] if seasonal else y
    root = plain_unit_root(z)
    d = 0 if root and root[2] else 1
    w = np.diff(z) if d else z
    c = w - w.mean()
    season = lambda x: lagged(x, 12) if seasonal else np.zeros(len(x))
    long = np.column_stack([lagged(c, i) for i in (1, 2, 3, 4)] + [season(c)])
    xx = long.T @ long
    xx = xx + np.diag(np.maximum(1e-8 * np.diag(xx), 1e-12))
    e = c - long @ np.linalg.solve(xx, long.T @ c)
    terms = np.column_stack([lagged(c, 1), lagged(c, 2), season(c), lagged(e, 1), lagged(e, 2), season(e)])
    found = []
    for p, q, sp, sq in product(range(3), range(3), (0, 1), (0, 1)):
        at = [*range(p), *([2] if sp else []), *range(3, 3 + q), *([5] if sq else [])]
        k = len(at)
        if (not seasonal and sp + sq) or (k and 3 * (k + 1) > len(c)):
            continue
        x = terms[:, at]
        beta = np.zeros(6)
        part, rss, _ = least_squares(x, c) if k == 0 or x.any(axis=0).all() else (np.zeros(k), float(c @ c), None)
        beta[at] = part
        a, b, s = beta[:3]
        if abs(a) + abs(b) + abs(s) < 1 if sp else (a + b < 1 and b - a < 1 and abs(b) < 1):
            found.append((len(c) * np.log(max(rss, 1e-9) / len(c)) + 2 * (k + 1), k, p, q, sp, sq, beta, rss))
    _, k, p, q, sp, sq, beta, rss = min(found, key=lambda f: f[:6])
    sigma2 = rss / max(1, len(c) - k - 1)
    past, noise = [0.0] * 12 + list(c), [0.0] * 12 + list(e)
    for _ in range(horizon):
        step = beta @ [past[-1], past[-2], past[-12], noise[-1], noise[-2], noise[-12]]
        past.append(step)
        noise.append(0.0)
    ahead = np.array(past[-horizon:]) + w.mean()
    level = z[-1] + np.cumsum(ahead) if d else ahead
    value = level + (y[len(y) - 12 :][:horizon] if seasonal else 0)
    psi = [1.0]
    for j in range(1, horizon):
        psi.append(beta[0] * psi[-1] + (beta[1] * psi[-2] if j > 1 else 0) + (beta[2 + j] if j <= 2 else 0))
    psi = np.cumsum(psi) if d else np.array(psi)
    return (p, d, q, sp, sq), value, np.sqrt(sigma2 * np.cumsum(psi**2))


def series_of(kind, n, seed):
    rng = np.random.default_rng(seed)
    noise = rng.normal(0, 5, n)
    if kind == "noise":
        return 100 + noise
    if kind == "walk":
        return 100 + np.cumsum(noise)
    if kind == "season":
        return 200 + 40 * np.sin(np.arange(n) * np.pi / 6) + 0.5 * np.arange(n) + noise
    out = np.zeros(n)
    for t in range(1, n):
        out[t] = {"ar": 0.8, "ma": 0.0}[kind] * out[t - 1] + noise[t] + (0.7 * noise[t - 1] if kind == "ma" else 0)
    return 100 + out


GROUPS = {f"{kind}{n}": np.round(series_of(kind, n, n), 3) for kind in ("noise", "walk", "season", "ar", "ma") for n in (12, 20, 24, 36, 60, 120)}


def test_solver(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(40, 5))
    df = spark.createDataFrame([(int(i % 2), *map(float, r)) for i, r in enumerate(data)], "g int, a double, b double, c double, d double, y double")
    fit = moments(df, ["g"], [F.col(x) for x in "abcd"], F.col("y"))
    index = F.array(F.lit(0), F.lit(2), F.lit(3))
    got = fit.select("g", cholesky(F.col("xx"), 0.0).alias("f"), "xx", "xy").select("g", solve(F.col("f"), F.col("xy")).alias("beta"), "f", pick(F.col("xx"), index).alias("part"))
    for r in got.collect():
        x, y = data[r.g :: 2, :4], data[r.g :: 2, 4]
        assert np.allclose(r.beta, np.linalg.lstsq(x, y, rcond=None)[0])
        assert np.allclose([c for row in r.f for c in row], np.linalg.cholesky(x.T @ x)[np.tril_indices(4)])
        assert np.allclose(r.part, (x.T @ x)[np.ix_([0, 2, 3], [0, 2, 3])])


def test_unit_root(spark):
    more = {"flat": [7] * 40, "line": list(range(40)), "short": [1, 5, 2], "one": [3], "zero": [0] * 30}
    got = {r.g: r for r in unit_root(as_series(spark, {**GROUPS, **more}), "g").collect()}
    assert set(got) == {*GROUPS, *more}
    for g, y in GROUPS.items():
        expected = plain_unit_root(y)
        assert (got[g].lags, got[g].stationary) == (expected[0], expected[2]), g
        assert got[g].statistic == pytest.approx(expected[1], rel=1e-5)
    assert all(got[g].statistic is None and not got[g].stationary for g in more)
    # three classes of long series
    assert [got[f"{k}120"].stationary for k in ("noise", "walk", "ma")] == [True, False, True]


def test_order_search(spark):
    got = {r.g: r for r in order_search(as_series(spark, GROUPS), "g").withColumn("order", order_label()).collect()}
    ahead = {}
    for r in forecast_order_search(as_series(spark, GROUPS), "g").collect():
        ahead.setdefault(r.g, {})[r.step] = r
    assert set(got) == set(GROUPS) == set(ahead)
    for g, y in GROUPS.items():
        order, value, deviation = plain_search(y)
        r = got[g]
        assert (r.p, r.d, r.q, r.sp, r.sq) == order, g
        seasonal = len(y) >= 24
        assert r.order == f"({order[0]},{order[1]},{order[2]})({order[3]},{int(seasonal)},{order[4]},{12 if seasonal else 1})"
        rows = [ahead[g][s] for s in range(1, 7)]
        assert np.allclose([x.forecast for x in rows], value, rtol=1e-6)
        assert [x.lower_ci for x in rows] == [max(0, round(v - 1.96 * s)) for v, s in zip(value, deviation)]
        assert [x.upper_ci for x in rows] == [max(0, round(v + 1.96 * s)) for v, s in zip(value, deviation)]
    assert {r.p + r.q + r.sp + r.sq for r in got.values()} >= {0, 1, 2}


def test_edges(spark):
    more = {"flat": [7] * 40, "zero": [0] * 30, "line": list(range(40)), "short": [5] * 11, "young": [3, 4] * 7, "one": [1]}
    rows = forecast(as_series(spark, more), "g", model="search").collect()
    assert {r.g for r in rows} == {"flat", "zero", "line", "young"}
    by = {g: [r.forecasted_count for r in sorted(rows, key=lambda r: r.step) if r.g == g] for g in more}
    assert by["flat"] == [7] * 6 and by["zero"] == [0] * 6 and by["line"] == [40, 41, 42, 43, 44, 45]
    assert all(r.train_mape is not None for r in rows if r.g in ("flat", "zero", "line"))
    assert all(r.lower_ci <= r.forecasted_count <= r.upper_ci for r in rows)
    assert order_search(as_series(spark, more).limit(0), "g").count() == 0


def test_stays_native(spark):
    plan = forecast_order_search(as_series(spark, {"g": GROUPS["season60"]}), "g")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert differenced(as_series(spark, {"g": GROUPS["season60"]}), "g").count() == 48
