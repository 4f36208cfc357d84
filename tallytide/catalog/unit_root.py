"""SQL of the unit-root and level tests: normal equations by elimination, one pivot per step."""

from __future__ import annotations

from tallytide.catalog.base import LINE_ORDER_SQL

QUANTITY_SQL = f"""
{{p}}y AS (
  SELECT l_suppkey, CAST(l_quantity AS DOUBLE) AS y, row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_ORDER_SQL}) AS pos
  FROM lineitem)"""


def _regression(p: str, depth: str, level_at: str, lag_at: str) -> str:
    """``{p}step``: the cross products of 1, level, lags and step, with the first k columns eliminated."""
    return f"""
{p}z AS (
  SELECT l_suppkey, pos, 1 AS i, 1.0::DOUBLE AS v FROM {p}w JOIN {depth} USING (l_suppkey) WHERE pos > deep + 1
  UNION ALL
  SELECT l_suppkey, pos, {level_at}, prev FROM {p}w JOIN {depth} USING (l_suppkey) WHERE pos > deep + 1
  UNION ALL
  SELECT l_suppkey, a.pos, CASE WHEN k = 0 THEN deep + 3 ELSE {lag_at} END, b.w
  FROM {p}w a JOIN (SELECT l_suppkey, deep, unnest(range(0, deep + 1)) AS k FROM {depth}) l USING (l_suppkey)
       JOIN {p}w b ON b.l_suppkey = a.l_suppkey AND b.pos = a.pos - k
  WHERE a.pos > deep + 1),
{p}g AS (
  SELECT l_suppkey, a.i, b.i AS j, sum(a.v * b.v) AS g FROM {p}z a JOIN {p}z b USING (l_suppkey, pos) GROUP BY ALL),
{p}step AS (
  SELECT l_suppkey, list(r ORDER BY i) AS m, 0 AS k
  FROM (SELECT l_suppkey, i, list(g ORDER BY j) AS r FROM {p}g GROUP BY 1, 2) GROUP BY 1
  UNION ALL
  SELECT l_suppkey, list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1),
           lambda j: m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1])), k + 1
  FROM {p}step WHERE k < len(m) - 1)"""


def _steps(p: str, q: str) -> str:
    return f"""
{q}w AS (
  SELECT l_suppkey, pos, y - lag(y) OVER o AS w, lag(y) OVER o AS prev
  FROM {p}y WINDOW o AS (PARTITION BY l_suppkey ORDER BY pos))"""


def adf_sql(p: str) -> str:
    """``{p}adf`` (l_suppkey, n, adf_stat, adf_p, adf_lag) from ``{p}y`` (l_suppkey, pos from 1, y)."""
    powers = {"small": (2.1659, 1.4412, 0.038269), "large": (1.7339, 0.93202, -0.12745, -0.010368)}
    small, large = (" + ".join(f"{c} * pow(tau, {i})" for i, c in enumerate(powers[k])) for k in ("small", "large"))
    simpson = ("0.5 + z / 6000 * 0.3989422804014327 * list_sum(list_transform(range(0, 2001), lambda t: "
               "exp(-pow(z * t / 2000, 2) / 2) * CASE WHEN t IN (0, 2000) THEN 1 WHEN t % 2 = 1 THEN 4 ELSE 2 END))")
    return f"""
{p}deep AS (
  SELECT l_suppkey, n, CAST(greatest(least(ceil(12 * pow(n / 100, 0.25)), n // 2 - 2), 0) AS BIGINT) AS deep
  FROM (SELECT l_suppkey, count(*) AS n FROM {p}y GROUP BY 1) WHERE n >= 20),
{_steps(p, p)},
{_regression(p, f"{p}deep", "2", "k + 2")},
{p}best AS (
  SELECT l_suppkey, any_value(n) AS n, CAST(arg_min(k - 2, u * ln(m[len(m)][len(m)] / u) + 2 * k) AS BIGINT) AS deep
  FROM (SELECT s.*, n, n - deep - 1 AS u FROM {p}step s JOIN {p}deep USING (l_suppkey)) WHERE k >= 2 GROUP BY 1),
{_steps(p, f"{p}f_")},
{_regression(f"{p}f_", f"{p}best", "deep + 2", "k + 1")},
{p}fit AS (
  SELECT l_suppkey, n, deep, m[len(m) - 1][len(m) - 1] AS a, m[len(m) - 1][len(m)] AS b, m[len(m)][len(m)] AS c, n - 2 * deep - 3 AS freedom
  FROM {p}f_step JOIN {p}best USING (l_suppkey) WHERE k = deep + 1),
{p}tau AS (SELECT l_suppkey, n, deep, b / a / sqrt((c - b * b / a) / freedom / a) AS tau FROM {p}fit),
{p}normal AS (SELECT *, CASE WHEN tau <= -1.61 THEN {small} ELSE {large} END AS z FROM {p}tau),
{p}adf AS (
  SELECT l_suppkey, n, tau AS adf_stat, CASE WHEN tau > 2.74 THEN 1.0 WHEN tau < -18.83 THEN 0.0 ELSE {simpson} END AS adf_p,
         deep AS adf_lag
  FROM {p}normal)"""


def kpss_sql(p: str) -> str:
    """``{p}kpss`` (l_suppkey, n, kpss_lag, kpss_stat, kpss_p) from ``{p}y``."""
    return f"""
{p}d AS (
  SELECT l_suppkey, pos, y - avg(y) OVER (PARTITION BY l_suppkey) AS d, count(*) OVER (PARTITION BY l_suppkey) AS n FROM {p}y),
{p}g0 AS (SELECT l_suppkey, any_value(n) AS n, sum(d * d) / any_value(n) AS g FROM {p}d GROUP BY 1),
{p}early AS (
  SELECT l_suppkey, k, sum(a.d * b.d) / any_value(a.n) AS g
  FROM {p}d a JOIN (SELECT l_suppkey, unnest(range(1, CAST(floor(pow(n, 2.0 / 9) + 1e-9) AS BIGINT) + 1)) AS k FROM {p}g0) USING (l_suppkey)
       JOIN {p}d b USING (l_suppkey) WHERE b.pos = a.pos - k GROUP BY 1, 2),
{p}rate AS (
  SELECT l_suppkey, 2 * sum(k * e.g) / (any_value(h.g) + 2 * sum(e.g)) AS s, any_value(n) AS n, any_value(h.g) AS g
  FROM {p}early e JOIN {p}g0 h USING (l_suppkey) GROUP BY 1),
{p}lags AS (
  SELECT l_suppkey, n, g, CAST(least(floor(1.1447 * pow(s * s, 1.0 / 3) * pow(n, 1.0 / 3)), n - 1) AS BIGINT) AS m FROM {p}rate),
{p}late AS (
  SELECT l_suppkey, sum(g) AS g FROM (
    SELECT l_suppkey, k, sum(a.d * b.d) / any_value(a.n) * (1 - k / (any_value(m) + 1)) AS g
    FROM {p}d a JOIN (SELECT l_suppkey, m, unnest(range(1, m + 1)) AS k FROM {p}lags) USING (l_suppkey)
         JOIN {p}d b USING (l_suppkey) WHERE b.pos = a.pos - k GROUP BY 1, 2) GROUP BY 1),
{p}eta AS (
  SELECT l_suppkey, sum(s * s) AS e FROM (SELECT l_suppkey, sum(d) OVER (PARTITION BY l_suppkey ORDER BY pos) AS s FROM {p}d) GROUP BY 1),
{p}kpss AS (
  SELECT l_suppkey, n, m AS kpss_lag, eta AS kpss_stat,
         CASE WHEN eta <= 0.347 THEN 0.10 WHEN eta <= 0.463 THEN 0.10 - (eta - 0.347) * 0.05 / 0.116
              WHEN eta <= 0.574 THEN 0.05 - (eta - 0.463) * 0.025 / 0.111
              WHEN eta <= 0.739 THEN 0.025 - (eta - 0.574) * 0.015 / 0.165 ELSE 0.01 END AS kpss_p
  FROM (SELECT l_suppkey, l.n, m, e / (l.n * l.n * (l.g + 2 * coalesce(t.g, 0))) AS eta
        FROM {p}lags l JOIN {p}eta USING (l_suppkey) LEFT JOIN {p}late t USING (l_suppkey) WHERE l.n >= 20))"""


def stationarity_sql(p: str) -> str:
    """``{p}verdict``: both tests next to each other with the verdict."""
    return adf_sql(p) + "," + kpss_sql(p) + f""",
{p}verdict AS (
  SELECT a.*, kpss_stat, kpss_p, kpss_lag, adf_p < 0.05 AS adf_reject, kpss_p < 0.05 AS kpss_reject,
         CASE WHEN adf_p < 0.05 AND kpss_p >= 0.05 THEN 'STATIONARY' WHEN adf_p >= 0.05 AND kpss_p < 0.05 THEN 'NON-STATIONARY'
              WHEN adf_p < 0.05 THEN 'TREND-STATIONARY' ELSE 'INCONCLUSIVE' END AS verdict
  FROM {p}adf a JOIN {p}kpss USING (l_suppkey))"""


COUNTS_SQL = """
SELECT count(*) FILTER (verdict = 'STATIONARY') AS stationary,
       count(*) FILTER (verdict IN ('NON-STATIONARY', 'TREND-STATIONARY')) AS non_stationary,
       count(*) FILTER (verdict = 'INCONCLUSIVE') AS inconclusive
"""
