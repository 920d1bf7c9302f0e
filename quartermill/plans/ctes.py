"""SQL definitions of the canonical inputs, written independently of the Spark side."""

from __future__ import annotations

from quartermill.plans.catalog import cte

QUARTER = "CAST(date_trunc('quarter', {0}) + INTERVAL 2 MONTH AS DATE)"
MONTH = "CAST(date_trunc('month', {0}) AS DATE)"


def _panel(label: str, series: str) -> str:
    return f"""
  SELECT {series} AS series_id, {label.format('o_orderdate')} AS date,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


cte("panel", _panel(QUARTER, "c_mktsegment"))
cte("panel_wide", _panel(QUARTER, "c_nationkey || '|' || c_mktsegment"))
cte("panel_monthly", _panel(MONTH, "c_mktsegment"))

cte("lm", f"""
  SELECT r_name AS region, {MONTH.format('l_shipdate')} AS date,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount,
         SUM(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
         SUM(CAST(l_discount AS DECIMAL(18,2))) AS discount,
         SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned, COUNT(*) AS lines
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2""")
cte("cpi_regional", "SELECT region, date, CAST(amount AS DOUBLE) / CAST(quantity AS DOUBLE) AS cpi FROM lm", "lm")
cte("cpi_monthly", """
  SELECT date, CAST(SUM(amount) AS DOUBLE) / CAST(SUM(quantity) AS DOUBLE) AS cpi FROM lm GROUP BY date""", "lm")
cte("annual", """
  SELECT make_date(year(date), 7, 1) AS date,
         CAST(SUM(returned) AS DOUBLE) * 100 / CAST(SUM(lines) AS DOUBLE) AS unemployment_rate
  FROM lm GROUP BY 1""", "lm")
cte("interest_monthly", """
  SELECT date, CAST(SUM(discount) AS DOUBLE) * 100 / CAST(SUM(lines) AS DOUBLE) AS interest_rate_90d
  FROM lm GROUP BY date""", "lm")
cte("cpi_quarterly", "SELECT * FROM cpi_monthly WHERE month(date) IN (3, 6, 9, 12)", "cpi_monthly")
cte("annual_gap", """
  SELECT date, unemployment_rate AS v, lead(unemployment_rate) OVER (ORDER BY date) AS nv,
         coalesce(date_diff('month', date, lead(date) OVER (ORDER BY date)), 1) AS gap
  FROM annual""", "annual")
cte("annual_grid", """
  SELECT CAST(date + to_months(CAST(step AS INTEGER)) AS DATE) AS date, v + (coalesce(nv, v) - v) / gap * step AS v
  FROM (SELECT *, unnest(range(0, gap)) AS step FROM annual_gap)""", "annual_gap")
cte("unemployment_quarterly", f"""
  SELECT {QUARTER.format('date')} AS date, AVG(v) AS unemployment_rate FROM annual_grid GROUP BY 1""", "annual_grid")
cte("interest_quarterly", f"""
  SELECT {QUARTER.format('date')} AS date, AVG(interest_rate_90d) AS interest_rate_90d
  FROM interest_monthly GROUP BY 1""", "interest_monthly")
cte("merged", """
  SELECT panel.*, cpi, unemployment_rate, interest_rate_90d, CAST(NULL AS DOUBLE) AS employment_count
  FROM panel LEFT JOIN cpi_quarterly USING (date) LEFT JOIN unemployment_quarterly USING (date)
       LEFT JOIN interest_quarterly USING (date)""",
    "panel", "cpi_quarterly", "unemployment_quarterly", "interest_quarterly")
cte("industry", f"""
  SELECT {QUARTER.format('l_shipdate')} AS date, p_brand AS industry,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")


def features(source: str) -> str:
    rolls = ",\n".join(
        f"CASE WHEN count(y) OVER w{w} = {w} THEN avg(y) OVER w{w} END AS y_roll_mean_{w},"
        f"CASE WHEN count(y) OVER w{w} = {w} THEN stddev_samp(y) OVER w{w} END AS y_roll_std_{w}"
        for w in (2, 4, 8)
    )
    lags = ", ".join(f"lag(y, {k}) OVER s AS y_lag_{k}" for k in (1, 2, 4, 8))
    frames = ", ".join(f"w{w} AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
                       for w in (2, 4, 8))
    return f"""
  SELECT *, {lags}, {rolls},
         (lag(y, 1) OVER s - lag(y, 5) OVER s) / nullif(lag(y, 5) OVER s, 0) * 100 AS y_yoy_pct,
         sin(2 * pi() * month(date) / 12) AS month_sin, cos(2 * pi() * month(date) / 12) AS month_cos
  FROM {source}
  WINDOW s AS (PARTITION BY series_id ORDER BY date), {frames}"""


cte("feats", features("panel"), "panel")
cte("mfeats_base", features("merged"), "merged")
cte("mfeats", """
  SELECT *, lag(y, 1) OVER s / nullif(cpi / coalesce(first_value(cpi IGNORE NULLS) OVER whole, 1.0), 0) AS y_real,
         lag(unemployment_rate, 1) OVER s AS unemployment_rate_lag1,
         lag(unemployment_rate, 4) OVER s AS unemployment_rate_lag4,
         lag(interest_rate_90d, 1) OVER s AS interest_rate_90d_lag1, lag(interest_rate_90d, 4) OVER s AS interest_rate_90d_lag4
  FROM mfeats_base
  WINDOW s AS (PARTITION BY series_id ORDER BY date),
         whole AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "mfeats_base")
cte("featured", "SELECT * FROM feats WHERE y_lag_8 IS NOT NULL AND y_yoy_pct IS NOT NULL AND y_roll_std_8 IS NOT NULL",
    "feats")
cte("split", """
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 8 AS is_test FROM featured""", "featured")
cte("naive", "SELECT series_id, date, y, y_lag_4 AS y_hat FROM split WHERE is_test", "split")
cte("naive_dir", """
  SELECT *, CAST(CAST(sign(y - lag(y) OVER s) = sign(y_hat - lag(y_hat) OVER s) AS INTEGER) AS DOUBLE) AS same_direction
  FROM naive WINDOW s AS (PARTITION BY series_id ORDER BY date)""", "naive")
