"""DuckDB tables, as common table expressions, that the queries' SQL shares. Written from the definitions, not from the Spark plans:
the panel is a spine and a join, statistics are taken over all its days, runs are islands."""

from demandpanel.config import closures
from demandpanel.sources.testdata import CFG, SKU, STORE

END = f"DATE '{CFG.data_end}'"
D1, D2 = (f"DATE '{d}'" for d in CFG.disruption)
CUT = f"DATE '{CFG.folds[0].train_end}'"
SERIES = "PARTITION BY store_id, sku_id"
FOLDS = ", ".join(f"('{f.fold_id}', DATE '{CFG.data_start}', DATE '{f.train_end}', DATE '{f.val_start}', DATE '{f.val_end}', {f.val_days}, {f.embargo_days})" for f in CFG.folds)
CLOSED = ", ".join(f"(DATE '{d}', '{n}', 1)" for d, n in closures(*CFG.closure_years))


def sales(store: str = STORE, sku: str = SKU) -> str:
    return f"""sales AS (
  SELECT CAST({store} AS VARCHAR) AS store_id, CAST({sku} AS VARCHAR) AS sku_id, CAST(l_shipdate AS DATE) AS date,
         CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS sales
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey),
daily AS (SELECT store_id, sku_id, date, CAST(sum(sales) AS BIGINT) AS saleqty FROM sales GROUP BY ALL),
top AS (SELECT quantile_disc(saleqty, 0.999) AS q FROM daily WHERE saleqty > 0),
clean AS (SELECT store_id, sku_id, date, saleqty AS sales_raw, greatest(saleqty, 0) AS sales_clean, CAST(saleqty < 0 AS INT) AS was_negative,
  CAST(date BETWEEN {D1} AND {D2} AS INT) AS is_covid_period, CAST(date BETWEEN {D1} AND {D2} AND saleqty > q AS INT) AS is_covid_panic_spike, CAST(saleqty > {CFG.extreme} AS INT) AS is_extreme_spike FROM daily, top),
pairs AS (SELECT store_id, sku_id, min(date) AS first_date, max(date) AS last_date, date_diff('day', min(date), max(date)) + 1 AS history_days FROM clean GROUP BY ALL)"""


PANEL = sales() + f""",
spine AS (SELECT store_id, sku_id, CAST(unnest(generate_series(CAST(first_date AS TIMESTAMP), CAST({END} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM pairs),
panel AS (SELECT s.store_id, s.sku_id, s.date, c.sales_raw, c.sales_clean, coalesce(c.was_negative, 0) AS was_negative, coalesce(c.is_covid_period, 0) AS is_covid_period,
  coalesce(c.is_covid_panic_spike, 0) AS is_covid_panic_spike, coalesce(c.is_extreme_spike, 0) AS is_extreme_spike, coalesce(c.sales_clean, 0) AS sales_filled, CAST(c.date IS NOT NULL AS INT) AS is_observed, coalesce(c.sales_clean, 0) AS y
  FROM spine s LEFT JOIN clean c ON s.store_id = c.store_id AND s.sku_id = c.sku_id AND s.date = c.date)"""

CALENDAR = f"""dim AS (SELECT date, CAST(strftime(date, '%Y%m%d') AS INT) AS date_id, dayofweek(date) + 1 AS dow, CAST(strftime(date, '%U') AS INT) AS week_of_year, month(date) AS month, year(date) AS year,
  dayofweek(date) IN (0, 6) AS is_weekend, day(date) AS day_of_month, dayofyear(date) AS day_of_year, quarter(date) AS quarter, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
  CAST(date_trunc('week', date) AS DATE) + 6 AS week_end_date, ceil(day(date) / 7.0) AS week_of_month, day(date) = 1 AS is_month_start, date = last_day(date) AS is_month_end,
  day(date) = 1 AND month(date) IN (1, 4, 7, 10) AS is_quarter_start, date = last_day(date) AND month(date) IN (3, 6, 9, 12) AS is_quarter_end, dayofyear(date) = 1 AS is_year_start,
  month(date) = 12 AND day(date) = 31 AS is_year_end, day(last_day(make_date(year(date), 2, 1))) = 29 AS is_leap_year, month(date) = 2 AND day(date) = 29 AS is_feb29
  FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '{CFG.data_start}', CAST({END} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date)),
closed AS (SELECT * FROM (VALUES {CLOSED}) AS v(closure_date, closure_name, is_store_closed)),
near AS (SELECT *, CAST(days_to_next_closure <= 3 OR days_from_prev_closure <= 3 AS INT) AS is_closure_week FROM (SELECT date,
  least(coalesce((SELECT min(date_diff('day', date, closure_date)) FROM closed WHERE closure_date >= date), 60), 60) AS days_to_next_closure,
  least(coalesce((SELECT min(date_diff('day', closure_date, date)) FROM closed WHERE closure_date <= date), 60), 60) AS days_from_prev_closure FROM dim))"""

_ROWS = {n: f"({SERIES} ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (7, 14, 28)}
PAST = f"({SERIES} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

FEATURES = PANEL + ",\n" + CALENDAR + f""",
feat AS (SELECT *, coalesce(date_diff('day', last_sale_date_asof, date), 999999) AS days_since_last_sale_asof,
    CASE WHEN last_sale_date_asof IS NULL THEN date_diff('day', first_date, date) ELSE date_diff('day', last_sale_date_asof, date) - 1 END AS zero_run_length_asof
  FROM (SELECT panel.*, is_store_closed,
    {", ".join(f"lag(y, {k}) OVER s AS lag_{k}" for k in (1, 7, 14, 28, 56))},
    {", ".join(f"avg(y) OVER w{n} AS roll_mean_{n}, sum(y) OVER w{n} AS roll_sum_{n}, avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END) OVER w{n} AS nz_rate_{n}, avg(CASE WHEN y > 0 THEN y END) OVER w{n} AS roll_mean_pos_{n}" for n in (7, 28))},
    stddev_pop(y) OVER w28 AS roll_std_28, min(y) OVER w28 AS roll_min_28, max(y) OVER w28 AS roll_max_28,
    max(CASE WHEN y > 0 THEN date END) OVER past AS last_sale_date_asof, last_value(CASE WHEN y > 0 THEN y END IGNORE NULLS) OVER past AS last_sale_qty_asof,
    min(date) OVER ({SERIES}) AS first_date
    FROM panel LEFT JOIN (SELECT closure_date, is_store_closed FROM closed) ON date = closure_date
    WINDOW s AS ({SERIES} ORDER BY date), w7 AS {_ROWS[7]}, w28 AS {_ROWS[28]}, past AS {PAST})),
pred AS (SELECT *, CAST(coalesce(lag_7, 0) AS DOUBLE) AS pred_lag7, coalesce(roll_mean_28, 0) AS pred_roll28,
  CASE WHEN is_store_closed = 1 THEN 0.0 WHEN days_since_last_sale_asof <= 28 THEN coalesce(roll_mean_28, 0) ELSE coalesce(lag_7, 0) END AS pred_smart,
  CASE WHEN days_since_last_sale_asof <= 7 THEN 'D0_7' WHEN days_since_last_sale_asof <= 28 THEN 'D8_28' WHEN days_since_last_sale_asof <= 56 THEN 'D29_56' WHEN days_since_last_sale_asof <= 182 THEN 'D57_182' ELSE 'D183_PLUS' END AS dormancy_bucket FROM feat)"""


def stats(panel: str, asof: str = END, name: str = "stats") -> str:
    """Statistics over every day of the dense panel up to a day, zero runs as islands, and the tier."""
    return f"""days_{name} AS (SELECT store_id, sku_id, date, y, sum(CASE WHEN y > 0 THEN 1 ELSE 0 END) OVER ({SERIES} ORDER BY date) AS grp FROM {panel} WHERE date <= {asof}),
runs_{name} AS (SELECT store_id, sku_id, max(n) AS max_zero_run FROM (SELECT store_id, sku_id, grp, count(*) FILTER (y = 0) AS n FROM days_{name} GROUP BY ALL) GROUP BY ALL),
base_{name} AS (SELECT store_id, sku_id, min(date) AS spine_start, max(date) AS spine_end, min(date) FILTER (y > 0) AS first_sale_date, max(date) FILTER (y > 0) AS last_sale_date, count(*) AS history_days,
  count(*) FILTER (y > 0) AS n_pos, sum(y) AS sum_sales, max(y) AS max_sales, avg(y) AS avg_daily, avg(y) FILTER (y > 0) AS avg_pos, stddev_pop(y) FILTER (y > 0) AS std_pos,
  quantile_disc(CASE WHEN y > 0 THEN y END, 0.5) AS p50_pos, quantile_disc(CASE WHEN y > 0 THEN y END, 0.9) AS p90_pos FROM days_{name} GROUP BY ALL),
{name} AS (SELECT *, CASE WHEN n_pos = 0 OR days_since_last_sale > {CFG.dormant_days} THEN 'T0_EXCLUDED' WHEN history_days >= {CFG.mature_days} THEN 'T1_MATURE' WHEN history_days >= {CFG.growing_days} THEN 'T2_GROWING' ELSE 'T3_COLD_START' END AS tier_name,
  CASE WHEN n_pos = 0 THEN 'NEVER_SOLD' WHEN days_since_last_sale > {CFG.dormant_days} THEN 'DORMANT_{CFG.dormant_days}D' END AS t0_reason
  FROM (SELECT *, n_pos / history_days AS nz_rate, history_days / nullif(n_pos, 0) AS adi, pow(std_pos / avg_pos, 2) AS cv2, CAST(coalesce(history_days / nullif(n_pos, 0) >= {CFG.intermittent_adi}, false) AS INT) AS intermittent_flag,
    coalesce(date_diff('day', last_sale_date, {asof}), 0) AS last_zero_run, date_diff('day', last_sale_date, {asof}) AS days_since_last_sale FROM base_{name} JOIN runs_{name} USING (store_id, sku_id)))"""


#: Supplier x part: too many days for a panel, so its statistics come from the facts.
FINE = sales("s_suppkey", "p_partkey") + f""",
fine AS (SELECT store_id, sku_id, min(date) AS spine_start, date_diff('day', min(date), {END}) + 1 AS history_days, count(*) FILTER (sales_clean > 0) AS n_pos, coalesce(sum(sales_clean), 0) AS sum_sales,
  date_diff('day', max(date) FILTER (sales_clean > 0), {END}) AS days_since_last_sale FROM clean GROUP BY ALL),
stats AS (SELECT *, CASE WHEN n_pos = 0 OR days_since_last_sale > 182 THEN 'T0_EXCLUDED' WHEN history_days >= 728 THEN 'T1_MATURE' WHEN history_days >= 182 THEN 'T2_GROWING' ELSE 'T3_COLD_START' END AS tier_name,
  CASE WHEN n_pos = 0 THEN 'NEVER_SOLD' WHEN days_since_last_sale > 182 THEN 'DORMANT_182D' END AS t0_reason, CAST(coalesce(history_days / nullif(n_pos, 0) >= 1.32, false) AS INT) AS intermittent_flag FROM fine)"""
