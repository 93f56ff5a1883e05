"""Unit-root decisions and forecasts by a searched order."""

from pyspark.sql import functions as F

from catalog import query
from catalog.series import DENSE, NEEDS, series
from placestats.operators.forecast import forecast, forecast_order_search
from placestats.operators.order_search import unit_root

AREA = "(PARTITION BY location_id ORDER BY month)"
CRITICAL = "(-2.86154::DOUBLE - 2.8903::DOUBLE / n - 4.234::DOUBLE / (n * n) - 40.04::DOUBLE / (n * n * n))"


def sums(columns: list[str], target: str) -> str:
    """Moments of one area, as SQL lists."""
    xx = ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in columns) + "]" for a in columns)
    return f"[{xx}]::DOUBLE[][] AS xx, [{', '.join(f'sum({a} * {target})' for a in columns)}]::DOUBLE[] AS xy, sum({target} * {target})::DOUBLE AS yy, count(*)::DOUBLE AS n"


def solved(p: str, system: str, keys: str) -> dict[str, str]:
    """Gauss-Jordan steps on the rows `m` of `system`, which has `k` rows; ends in `{p}solved`."""
    return {
        f"{p}steps": f"""SELECT {keys}, k, 1 AS step, m FROM {system} UNION ALL SELECT {keys}, k, step + 1,
list_transform(m, lambda r, i: CASE WHEN i = step THEN list_transform(r, lambda v: v / r[step])
ELSE list_transform(r, lambda v, j: v - r[step] / m[step][step] * m[step][j]) END) FROM {p}steps WHERE step <= k""",
        f"{p}solved": f"SELECT {keys}, k, m FROM {p}steps WHERE step = k + 1",
    }


def square(index: str, right: str) -> str:
    """Rows of the normal equations at `index` with the stated ridge, and their right sides."""
    value = "xx[i][j] * CASE WHEN i = j THEN 1 + 1e-8::DOUBLE ELSE 1 END"
    return f"list_transform({index}, lambda i: list_concat(list_transform({index}, lambda j: CASE WHEN i = j THEN greatest({value}, 1e-12::DOUBLE) ELSE xx[i][j] END), {right}))"


def dotted(a: str, b: str) -> str:
    return f"coalesce(list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i])), 0)"


def root_ctes(p: str, source: str, value: str) -> dict[str, str]:
    """Ends in `{p}root`: location_id, lags, statistic, critical, stationary."""
    return {
        f"{p}v": f"SELECT location_id, month, {value} - avg({value}) OVER (PARTITION BY location_id) AS v FROM {source}",
        f"{p}l": f"SELECT *, lag(v) OVER {AREA} AS l, v - lag(v) OVER {AREA} AS dv FROM {p}v",
        f"{p}d": f"SELECT *, lag(dv) OVER {AREA} AS d1, lag(dv, 2) OVER {AREA} AS d2 FROM {p}l",
        f"{p}rm": f"SELECT location_id, {sums(['l', '1', 'd1', 'd2'], 'dv')} FROM {p}d WHERE d2 IS NOT NULL GROUP BY location_id",
        f"{p}rt": f"SELECT r.*, CAST(lags AS INTEGER) AS lags, lags + 2 AS k FROM {p}rm r, range(0, 3) t(lags) WHERE n > lags + 2",
        f"{p}rs": f"SELECT location_id, lags, k, {square('range(1, k + 1)', '[xy[i], CASE WHEN i = 1 THEN 1 ELSE 0 END]')} AS m FROM {p}rt",
        **solved(f"{p}r", f"{p}rs", "location_id, lags"),
        f"{p}rf": f"""SELECT t.location_id, t.lags, t.k, n, yy, s.m[1][t.k + 1] AS b, s.m[1][t.k + 2] AS spread,
greatest(yy - {dotted('list_transform(s.m, lambda r: r[t.k + 1])', 't.xy')}, 0) AS rss FROM {p}rt t JOIN {p}rsolved s USING (location_id, lags)""",
        f"{p}rb": f"""SELECT * FROM {p}rf WHERE rss > yy * 1e-6::DOUBLE
QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY n * ln(rss / n) + 2 * k, lags) = 1""",
        f"{p}root": f"""SELECT a.location_id, lags, b / sqrt(rss / (n - k) * spread) AS statistic, {CRITICAL} AS critical,
coalesce(b / sqrt(rss / (n - k) * spread) < {CRITICAL}, FALSE) AS stationary
FROM (SELECT DISTINCT location_id FROM {source}) a LEFT JOIN {p}rb b USING (location_id)""",
    }


def search_ctes(p: str, dense: str) -> dict[str, str]:
    """Ends in `{p}ahead` (location_id, hi, step, v, half, label)."""
    terms = ["c1", "c2", "cs", "e1", "e2", "es"]
    longs = ["c1", "c2", "c3", "c4", "cs"]
    lag = lambda c, k: f"coalesce(lag({c}, {k}) OVER {AREA}, 0)"
    season = lambda c: f"CASE WHEN seasonal THEN {lag(c, 12)} ELSE 0 END"
    index = "list_concat(range(1, p + 1), CASE WHEN sp = 1 THEN [3] ELSE [] END, range(4, 4 + q), CASE WHEN sq = 1 THEN [6] ELSE [] END)"
    return {
        f"{p}sized": f"SELECT location_id, month, y::DOUBLE AS y, count(*) OVER (PARTITION BY location_id) >= 24 AS seasonal, lag(y::DOUBLE, 12) OVER {AREA} AS ago FROM {dense}",
        f"{p}z": f"SELECT location_id, month, y, seasonal, CASE WHEN seasonal THEN y - ago ELSE y END AS z FROM {p}sized WHERE NOT seasonal OR ago IS NOT NULL",
        **root_ctes(p, f"{p}z", "z"),
        f"{p}w": f"SELECT z.*, CASE WHEN stationary THEN 0 ELSE 1 END AS d, CASE WHEN stationary THEN z ELSE z - lag(z) OVER {AREA} END AS w FROM {p}z z JOIN {p}root USING (location_id)",
        f"{p}c": f"SELECT *, avg(w) OVER (PARTITION BY location_id) AS mean, w - avg(w) OVER (PARTITION BY location_id) AS c FROM {p}w WHERE w IS NOT NULL",
        f"{p}long": f"SELECT *, {lag('c', 1)} AS c1, {lag('c', 2)} AS c2, {lag('c', 3)} AS c3, {lag('c', 4)} AS c4, {season('c')} AS cs FROM {p}c",
        f"{p}lm": f"SELECT location_id, {sums(longs, 'c')} FROM {p}long GROUP BY location_id",
        f"{p}ls": f"SELECT location_id, 5 AS k, {square('range(1, 6)', '[xy[i]]')} AS m FROM {p}lm",
        **solved(f"{p}l", f"{p}ls", "location_id"),
        f"{p}e": f"SELECT l.*, c - ({' + '.join(f'm[{i}][6] * {x}' for i, x in enumerate(longs, 1))}) AS e FROM {p}long l JOIN {p}lsolved s USING (location_id)",
        f"{p}terms": f"SELECT *, {lag('e', 1)} AS e1, {lag('e', 2)} AS e2, {season('e')} AS es FROM {p}e",
        f"{p}tm": f"""SELECT location_id, {sums(terms, 'c')}, any_value(seasonal) AS seasonal, any_value(d) AS d, any_value(mean) AS mean, max(month) AS hi,
list(y ORDER BY month) AS ys, list(c ORDER BY month) AS cs, list(e ORDER BY month) AS es, arg_max(z, month) AS zl FROM {p}terms GROUP BY location_id""",
        f"{p}try": f"""SELECT *, len(index) AS k FROM (SELECT location_id, xx, xy, yy, n, seasonal, p, q, sp, sq, {index} AS index
FROM {p}tm, range(0, 3) a(p), range(0, 3) b(q), range(0, 2) c(sp), range(0, 2) e(sq))
WHERE (seasonal OR sp + sq = 0) AND (len(index) = 0 OR 3 * (len(index) + 1) <= n)""",
        f"{p}ts": f"SELECT location_id, p, q, sp, sq, k, {square('index', '[xy[i]]')} AS m FROM {p}try",
        **solved(f"{p}t", f"{p}ts", "location_id, p, q, sp, sq"),
        f"{p}tb": f"""SELECT t.*, list_transform(s.m, lambda r: r[t.k + 1]) AS part, list_transform(index, lambda i: xy[i]) AS right_side
FROM {p}try t JOIN {p}tsolved s USING (location_id, p, q, sp, sq)""",
        f"{p}tf": f"""SELECT *, greatest(yy - {dotted('part', 'right_side')}, 0) AS rss,
list_transform(range(1, 7), lambda i: coalesce(part[list_position(index, i)], 0)) AS b FROM {p}tb""",
        f"{p}best": f"""SELECT * FROM {p}tf
WHERE CASE WHEN sp = 1 THEN abs(b[1]) + abs(b[2]) + abs(b[3]) < 1 ELSE b[1] + b[2] < 1 AND b[2] - b[1] < 1 AND abs(b[2]) < 1 END
QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY n * ln(greatest(rss, 1e-9::DOUBLE) / n) + 2 * (k + 1), k, p, q, sp, sq) = 1""",
        f"{p}go": f"""SELECT location_id, 0 AS step, list_concat(list_transform(range(12), lambda x: 0::DOUBLE), cs) AS c, list_concat(list_transform(range(12), lambda x: 0::DOUBLE), es) AS e, [1::DOUBLE] AS psi
FROM {p}tm UNION ALL SELECT g.location_id, step + 1,
list_append(c, b[1] * c[-1] + b[2] * c[-2] + b[3] * c[-12] + b[4] * e[-1] + b[5] * e[-2] + b[6] * e[-12]), list_append(e, 0),
list_append(psi, b[1] * psi[-1] + CASE WHEN step >= 1 THEN b[2] * psi[-2] ELSE 0 END + CASE step WHEN 0 THEN b[4] WHEN 1 THEN b[5] ELSE 0 END)
FROM {p}go g JOIN {p}best USING (location_id) WHERE step < 6""",
        f"{p}path": f"SELECT location_id, c[-6:] AS c, psi[1:6] AS psi FROM {p}go WHERE step = 6",
        f"{p}out": f"""SELECT m.location_id, hi, CAST(h AS INTEGER) AS step, ys, m.seasonal, m.d, zl, p, q, sp, sq, rss / greatest(b.n - k - 1, 1) AS s2,
list_transform(g.c[1:h], lambda x: x + mean) AS w, CASE WHEN m.d = 1 THEN list_transform(range(1, h + 1), lambda i: list_sum(psi[1:i])) ELSE psi[1:h] END AS ps
FROM {p}tm m JOIN {p}best b USING (location_id) JOIN {p}path g USING (location_id), range(1, 7) r(h)""",
        f"{p}ahead": f"""SELECT location_id, hi, step, CASE WHEN d = 1 THEN zl + list_sum(w) ELSE w[-1] END + CASE WHEN seasonal THEN ys[len(ys) - 12 + step] ELSE 0 END AS v,
sqrt(s2 * list_sum(list_transform(ps, lambda x: x * x))) * 1.96 AS half,
printf('(%d,%d,%d)(%d,%d,%d,%d)', p, d, q, sp, CASE WHEN seasonal THEN 1 ELSE 0 END, sq, CASE WHEN seasonal THEN 12 ELSE 1 END) AS label FROM {p}out""",
    }


def long_ctes(p: str) -> dict[str, str]:
    """Series of at least 12 months, and those still as long without their last 6."""
    return {
        f"{p}full": "SELECT * FROM dense WHERE location_id IN (SELECT location_id FROM dense GROUP BY location_id HAVING count(*) >= 12)",
        f"{p}train": """SELECT location_id, month, y FROM placed WHERE back > 6
AND location_id IN (SELECT location_id FROM placed GROUP BY location_id HAVING count(*) >= 18)""",
    }


SEARCH = {**DENSE, **long_ctes("s_"), **search_ctes("s_", "s_full")}
ERROR = {
    **SEARCH,
    **search_ctes("h_", "s_train"),
    "h_mape": """SELECT p.location_id, round_even(least(avg(abs((p.y - h.v) / (p.y + 1e-9))) * 100, 999.0), 2) AS train_mape FROM placed p
LEFT JOIN h_ahead h ON h.location_id = p.location_id AND CAST(h.hi + to_months(h.step) AS DATE) = p.month WHERE p.back <= 6 GROUP BY p.location_id""",
}
COLUMNS = """s.location_id, strftime(s.hi, '%Y-%m') AS last_train_date, strftime(s.hi + to_months(s.step), '%Y-%m') AS forecast_month, s.step,
CAST(greatest(round_even(v, 0), 0) AS INTEGER) AS forecasted_count, CAST(greatest(round_even(v - half, 0), 0) AS INTEGER) AS lower_ci,
CAST(greatest(round_even(v + half, 0), 0) AS INTEGER) AS upper_ci, label AS arima_order"""


@query("forecast_order_search", f"SELECT {COLUMNS} FROM s_ahead s", NEEDS, SEARCH)
def _(t):
    return forecast_order_search(series(t), "location_id").drop("month", "forecast")


@query("forecast_order_search_error", f"SELECT {COLUMNS}, m.train_mape FROM s_ahead s LEFT JOIN h_mape m USING (location_id)", NEEDS, ERROR)
def _(t):
    return forecast(series(t), "location_id", model="search").drop("month", "forecast")


@query(
    "stationarity",
    "SELECT location_id, lags, round(statistic, 6) AS statistic, round(critical, 6) AS critical, stationary FROM u_root",
    NEEDS,
    {**DENSE, **root_ctes("u_", "dense", "y")},
)
def _(t):
    found = unit_root(series(t), "location_id")
    return found.withColumns({c: F.round(c, 6) for c in ("statistic", "critical")})
