"""The registered queries as SQL for DuckDB, written independently of the DataFrame code."""

from __future__ import annotations

TRAIN_END, VAL_END = 300, 330
FACTS = "id, week, center_id, meal_id, checkout_price, base_price, emailer_for_promotion, homepage_featured, num_orders"

TYPES = """types AS (
  SELECT p_type, CAST(99 + row_number() OVER (ORDER BY p_type) AS INT) AS meal_id
  FROM (SELECT DISTINCT p_type FROM part))"""


def _panel(grain: str = "supplier") -> str:
    key, extra = {
        "supplier": ("l_suppkey", ""),
        "nation": ("s_nationkey", "JOIN supplier ON l_suppkey = s_suppkey"),
        "region": (
            "n_regionkey",
            "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey",
        ),
    }[grain]
    return f"""{TYPES},
li AS (
  SELECT CAST(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) // 7 + 1 AS INT) AS week,
         CAST({key} AS BIGINT) AS center_id, p_type,
         CAST(l_quantity AS DECIMAL(18,2)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS e,
         CAST(l_discount AS DECIMAL(4,2)) AS disc, l_returnflag
  FROM lineitem JOIN part ON l_partkey = p_partkey {extra}),
weekly AS (
  SELECT week, center_id, p_type,
         CAST(sum(e * (1 - disc)) AS DOUBLE) / CAST(sum(q) AS DOUBLE) AS checkout_price,
         CAST(sum(e) AS DOUBLE) / CAST(sum(q) AS DOUBLE) AS base_price,
         CASE WHEN 1000 * sum(disc) >= 55 * count(*) THEN 1 ELSE 0 END AS emailer_for_promotion,
         CASE WHEN 10 * sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) >= 4 * count(*) THEN 1 ELSE 0 END
           AS homepage_featured,
         CAST(sum(q) AS DOUBLE) AS num_orders
  FROM li GROUP BY ALL),
panel AS (
  SELECT week * 10000000000000 + center_id * 1000 + meal_id AS id, week, center_id, meal_id, checkout_price,
         base_price, emailer_for_promotion, homepage_featured, num_orders
  FROM weekly JOIN types USING (p_type))"""


def _dims(grain: str = "supplier") -> str:
    source = {
        "supplier": "SELECT s_suppkey AS k, s_nationkey AS city, n_regionkey AS zone "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
        "nation": "SELECT n_nationkey AS k, n_nationkey AS city, n_regionkey AS zone FROM nation",
        "region": "SELECT r_regionkey AS k, r_regionkey AS city, r_regionkey AS zone FROM region",
    }[grain]
    return f"""centers AS (
  SELECT CAST(k AS BIGINT) AS center_id, CAST(500 + city AS INT) AS city_code, CAST(30 + zone % 3 AS INT) AS region_code,
         CASE WHEN k % 2 = 0 THEN 'TYPE_A' ELSE 'TYPE_B' END AS center_type, 2.5 + 0.5 * CAST(k % 25 AS DOUBLE) AS op_area
  FROM ({source})),
meals AS (
  SELECT meal_id, p_type AS category,
         CASE meal_id % 4 WHEN 0 THEN 'Indian' WHEN 1 THEN 'Italian' WHEN 2 THEN 'Continental' ELSE 'Thai' END AS cuisine
  FROM types)"""


def r(expression: str, digits: int = 6) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def rounded(names: str, digits: int = 6) -> str:
    return ", ".join(f"{r(n.strip(), digits)} AS {n.strip()}" for n in names.split(","))


def q(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


PANEL = _panel()
REGION = _panel("region")
NATION = _panel("nation")
DIMS = _dims()
DIRTY = """dirty AS (
  SELECT CASE WHEN week % 97 = 0 THEN NULL WHEN week % 89 = 0 THEN CAST(week AS BIGINT) ELSE id END AS id, week,
         center_id + CASE WHEN week % 67 = 0 THEN 1000000000 ELSE 0 END AS center_id,
         CASE WHEN week % 61 = 0 THEN 999 ELSE meal_id END AS meal_id,
         CASE WHEN week % 79 = 0 THEN 0.0 ELSE checkout_price END AS checkout_price,
         CASE WHEN week % 73 = 0 THEN -1.0 ELSE base_price END AS base_price,
         CASE WHEN week % 83 = 0 THEN 2 ELSE emailer_for_promotion END AS emailer_for_promotion, homepage_featured,
         CASE WHEN week % 71 = 0 THEN -num_orders ELSE num_orders END AS num_orders
  FROM panel)"""
PRICED = """p1 AS (
  SELECT *, greatest(0.0, base_price - checkout_price) AS discount_amount,
         greatest(0.0, base_price - checkout_price) / greatest(base_price, 0.0001) AS discount_ratio,
         checkout_price / greatest(base_price, 0.0001) AS price_ratio,
         CASE WHEN emailer_for_promotion = 1 AND homepage_featured = 1 THEN 1 ELSE 0 END AS both_promos,
         CASE WHEN emailer_for_promotion = 1 OR homepage_featured = 1 THEN 1 ELSE 0 END AS any_promo
  FROM panel),
priced AS (SELECT *, any_promo * discount_ratio AS promo_discount_synergy FROM p1)"""
CALENDAR = """((week - 1) % 52) + 1 AS week_of_year, ((week - 1) // 4) % 12 + 1 AS month_proxy,
  ((week - 1) // 13) % 4 + 1 AS quarter_proxy"""
SEASON = f"""{r("sin(2 * pi() * (((week - 1) % 52) + 1) / 52.0)")} AS sin_week_of_year,
  {r("cos(2 * pi() * (((week - 1) % 52) + 1) / 52.0)")} AS cos_week_of_year"""


def _scored(source: str = "panel") -> str:
    """All rows of a source with the median forecast learned on the training weeks."""
    return f"""med AS (
  SELECT center_id, meal_id, median(num_orders) AS gm FROM panel WHERE week <= {TRAIN_END} GROUP BY ALL),
med_all AS (SELECT coalesce(median(num_orders), 0) AS om FROM panel WHERE week <= {TRAIN_END}),
everywhere AS (
  SELECT s.*, greatest(coalesce(gm, om), 0) AS forecast_orders, num_orders AS actual_orders
  FROM {source} s LEFT JOIN med USING (center_id, meal_id) CROSS JOIN med_all),
scored AS (SELECT * FROM everywhere WHERE week > {TRAIN_END}),
test AS (SELECT * FROM scored WHERE week > {VAL_END}),
val AS (SELECT * FROM scored WHERE week <= {VAL_END})"""


SCORED = _scored()
PLAN = f"""std AS (SELECT sqrt(avg((num_orders - forecast_orders) * (num_orders - forecast_orders))) AS s FROM val),
plan AS (
  SELECT test.*, greatest(5.0, ceil(1.6449 * s)) AS safety_stock,
         forecast_orders + greatest(5.0, ceil(1.6449 * s)) AS reorder_point,
         {r("greatest(0.0, forecast_orders + greatest(5.0, ceil(1.6449 * s)))", 1)} AS recommended_preparation
  FROM test, std)"""
PLAN_COLUMNS = "week, center_id, meal_id, " + rounded(
    "forecast_orders, safety_stock, reorder_point, recommended_preparation"
)
KPIS = f"""SELECT {r("coalesce(sum(forecast_orders), 0)", 1)} AS total_forecasted_units,
  {r("coalesce(sum(recommended_preparation), 0)", 1)} AS total_recommended_preparation_units,
  {r("coalesce(sum(safety_stock), 0)", 1)} AS total_safety_stock_buffer_units,
  {r("CASE WHEN sum(forecast_orders) > 0 THEN sum(safety_stock) / greatest(sum(forecast_orders), 1) * 100 ELSE 0 END", 2)}
    AS buffer_overhead_percentage
FROM plan"""


def measures(y: str = "num_orders", p: str = "forecast_orders", names: str = "mae rmse wmape rmsle") -> str:
    p = f"greatest({p}, 0)"
    texts = {
        "mae": r(f"coalesce(avg(abs({y} - {p})), 0)", 3),
        "rmse": r(f"coalesce(sqrt(avg(({y} - {p}) * ({y} - {p}))), 0)", 3),
        "wmape": r(f"CASE WHEN sum(abs({y})) > 0 THEN sum(abs({y} - {p})) / sum(abs({y})) ELSE 0 END", 4),
        "rmsle": r(f"coalesce(sqrt(avg(power(ln(1 + {p}) - ln(1 + greatest({y}, 0)), 2))), 0)", 4),
    }
    return ", ".join(f"{texts[n]} AS {n}" for n in names.split())


def profiles(source: str, by: str = "center_id, meal_id") -> str:
    """CTEs ``numbers`` and ``profiles`` over a source with forecast, actual, any_promo (or not) and price."""
    return f"""ranked AS (
  SELECT *, num_orders - forecast_orders AS res, row_number() OVER (PARTITION BY {by} ORDER BY week DESC, id DESC) AS rn
  FROM {source}),
raw_numbers AS (
  SELECT {by}, count(*) AS n, avg(num_orders) AS demand,
         CASE WHEN count(*) >= 3 THEN avg(res) FILTER (WHERE rn <= 10) ELSE 0 END AS bias,
         CASE WHEN count(*) >= 3 THEN greatest(3.0, stddev_pop(res)) ELSE 20.0 END AS std,
         avg(num_orders) FILTER (WHERE any_promo = 1) AS pm, avg(num_orders) FILTER (WHERE any_promo = 0) AS nm,
         count(*) FILTER (WHERE any_promo = 1) AS pn, count(*) FILTER (WHERE any_promo = 0) AS nn,
         count(*) FILTER (WHERE num_orders IS NOT NULL AND checkout_price IS NOT NULL) AS pairs,
         stddev_pop(checkout_price) FILTER (WHERE num_orders IS NOT NULL) AS price_std,
         stddev_pop(num_orders) FILTER (WHERE checkout_price IS NOT NULL) AS demand_std,
         regr_slope(ln(1 + greatest(num_orders, 0)), ln(greatest(checkout_price, 1)))
           FILTER (WHERE num_orders IS NOT NULL AND checkout_price IS NOT NULL) AS slope
  FROM ranked GROUP BY {by}),
numbers AS (
  SELECT {by}, n, demand, bias, std,
         CASE WHEN pn >= 2 AND nn >= 2 AND nm > 0 THEN least(greatest(pm / nm, 0.8), 3.5) ELSE 1.25 END AS uplift,
         CASE WHEN pairs >= 5 AND price_std > 0.001 AND demand_std > 0.001 AND slope IS NOT NULL
              THEN least(greatest(slope, -4.0), 0.5) ELSE -1.2 END AS elasticity,
         greatest(5.0, ceil(1.6449 * std)) AS stock
  FROM raw_numbers),
profiles AS (
  SELECT {by}, {r("demand", 1)} AS average_weekly_demand, {r("elasticity", 2)} AS price_elasticity_estimate,
         {r("uplift", 2)} AS promo_uplift_ratio, {r("bias", 2)} AS recent_residual_bias, {r("std", 2)} AS residual_std,
         {r("stock", 1)} AS recommended_safety_stock,
         CASE WHEN std > 35 THEN 'HIGH' WHEN std > 15 THEN 'MEDIUM' ELSE 'LOW' END AS volatility_tier,
         CASE WHEN demand > 250 THEN 'HIGH' WHEN demand > 75 THEN 'MEDIUM' ELSE 'LOW' END AS volume_tier
  FROM numbers)"""


PROFILE_COLUMNS = (
    "center_id, meal_id, average_weekly_demand, price_elasticity_estimate, promo_uplift_ratio, recent_residual_bias, "
    "residual_std, recommended_safety_stock, volatility_tier, volume_tier"
)
ALL_SCORED = _scored("priced")
ALL_PROFILES = profiles("everywhere")

# The plain panel has no any_promo column; profiles without it keep the default uplift.
NO_PROMO = "unpromoted AS (SELECT *, CAST(NULL AS INT) AS any_promo FROM {0})"


def adaptive(target: str, join: str = "center_id, meal_id") -> str:
    return f"""adapted AS (
  SELECT t.*, CASE WHEN recommended_safety_stock IS NULL THEN forecast_orders
         WHEN forecast_orders IS NOT NULL THEN greatest(0, forecast_orders + 0.65 * recent_residual_bias) END AS adaptive_orders,
         coalesce(recommended_safety_stock, 15.0) AS adaptive_stock
  FROM {target} t LEFT JOIN (SELECT {join}, recent_residual_bias, recommended_safety_stock FROM profiles) USING ({join}))"""


def log(source: str, forecast: str = "forecast_orders") -> str:
    f, a = forecast, "num_orders"
    return f"""SELECT week, center_id, meal_id, {r(f, 2)} AS forecast_orders, {r(a, 2)} AS actual_orders,
  {r(f"{a} - {f}", 2)} AS error, {r(f"({a} - {f}) / greatest(1, {a}) * 100", 2)} AS percentage_error FROM {source}"""


SUMMARY = f"""SELECT CASE WHEN count(*) = 0 THEN 'EMPTY' ELSE 'ACTIVE' END AS status, count(*) AS sample_count,
  {measures("actual_orders", "forecast_orders")}, {r("avg(error)", 2)} AS mean_bias_units,
  {r("avg(CASE WHEN error > 0 THEN 1 ELSE 0 END) * 100", 2)} AS under_forecast_rate_pct,
  {r("avg(CASE WHEN error < 0 THEN 1 ELSE 0 END) * 100", 2)} AS over_forecast_rate_pct
FROM log"""


def lag(n: int) -> str:
    return f"lag(num_orders, {n}) OVER w AS num_orders_lag_{n}"


def mean(k: int) -> str:
    return (
        f"avg(num_orders) OVER (PARTITION BY center_id, meal_id ORDER BY week ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    )


def std(k: int) -> str:
    return (
        "coalesce(stddev_samp(num_orders) OVER (PARTITION BY center_id, meal_id ORDER BY week "
        f"ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING), 0)"
    )


SERIES = "WINDOW w AS (PARTITION BY center_id, meal_id ORDER BY week)"

# --- scenarios -------------------------------------------------------------------------------------

STRESSED = {
    "price_surge": "checkout_price * 1.3 AS checkout_price, price_ratio * 1.3 AS price_ratio",
    "flash_sale": "checkout_price * 0.65 AS checkout_price, least(greatest(discount_ratio + 0.35, 0), 0.9) AS discount_ratio",
    "promo_blitz": "1 AS emailer_for_promotion, 1 AS homepage_featured, 1 AS both_promos, 1 AS any_promo",
    "blackout": "0 AS emailer_for_promotion, 0 AS homepage_featured, 0 AS both_promos, 0 AS any_promo, "
    "0.0 AS promo_discount_synergy",
}
SCENARIO_COLUMNS = (
    "checkout_price, price_ratio, discount_ratio, emailer_for_promotion, homepage_featured, both_promos, any_promo, "
    "promo_discount_synergy"
)
STACK = "stack AS (" + " UNION ALL BY NAME ".join(
    ["SELECT 'base' AS scenario, * FROM priced"]
    + [f"SELECT '{name}' AS scenario, * REPLACE ({text}) FROM priced" for name, text in STRESSED.items()]
) + ")"
SCENARIO_SUMS = ", ".join(f"{r(f'sum({c.strip()})', 4)} AS {c.strip()}" for c in SCENARIO_COLUMNS.split(","))


def elastic(fit: str, score: str) -> str:
    return f"""pairs AS (
  SELECT center_id, meal_id,
         coalesce(regr_slope(ln(1 + greatest(num_orders, 0)), ln(greatest(checkout_price, 1))), 0) AS slope,
         coalesce(regr_intercept(ln(1 + greatest(num_orders, 0)), ln(greatest(checkout_price, 1))),
                  avg(ln(1 + greatest(num_orders, 0)))) AS start,
         CASE WHEN count(*) FILTER (WHERE any_promo = 1) >= 2 AND count(*) FILTER (WHERE any_promo = 0) >= 2
                   AND avg(num_orders) FILTER (WHERE any_promo = 0) > 0
              THEN least(greatest(avg(num_orders) FILTER (WHERE any_promo = 1)
                                  / avg(num_orders) FILTER (WHERE any_promo = 0), 0.8), 3.5) ELSE 1.25 END AS lift
  FROM {fit} GROUP BY ALL),
elastic AS (
  SELECT s.*, coalesce(greatest((exp(start + slope * ln(greatest(checkout_price, 1))) - 1)
                       * CASE WHEN any_promo = 1 THEN lift ELSE 1.0 END, 0), 0) AS forecast_orders
  FROM {score} s LEFT JOIN pairs USING (center_id, meal_id))"""


ELASTIC = elastic("priced", "stack")
TOTALS = f"""totals AS (
  SELECT scenario, sum(forecast_orders) AS total, sum({r("greatest(0.0, forecast_orders + 33.0)", 1)}) AS prep,
         sum(33.0) AS buffer FROM elastic GROUP BY ALL)"""
OUTCOMES = f"""facts(scenario, scenario_name, expected) AS (VALUES
  ('price_surge', 'Price Surge (+30%)', 'DOWN'), ('flash_sale', 'Flash Sale (-35% Price)', 'UP'),
  ('promo_blitz', 'Promotional Blitz (Email + Homepage)', 'UP'), ('blackout', 'Promotion Blackout', 'DOWN')),
outcomes AS (
  SELECT scenario_name, {r("base", 1)} AS baseline_total_demand, {r("total", 1)} AS stressed_total_demand,
         {r("(total - base) / greatest(1, base) * 100", 2)} AS percentage_change, {r("prep", 1)} AS recommended_prep_units,
         {r("buffer", 1)} AS buffer_overhead_units,
         NOT ((expected = 'DOWN' AND (total - base) / greatest(1, base) * 100 > 5)
              OR (expected = 'UP' AND (total - base) / greatest(1, base) * 100 < -5)) AS direction_valid
  FROM totals JOIN facts USING (scenario) CROSS JOIN (SELECT total AS base FROM totals WHERE scenario = 'base'))"""

# --- drift -----------------------------------------------------------------------------------------

DRIFT_FEATURES = (
    "checkout_price", "base_price", "discount_amount", "discount_ratio", "price_ratio", "emailer_for_promotion", "homepage_featured",
    "both_promos", "any_promo", "promo_discount_synergy", "week_of_year", "month_proxy", "quarter_proxy", "center_id", "meal_id", "num_orders",
)
SIDES = """sides AS (
  SELECT *, CASE WHEN week <= (SELECT quantile_cont(week, 0.5) FROM panel) THEN 'baseline' ELSE 'current' END AS side
  FROM (SELECT *, """ + CALENDAR + """ FROM priced))"""


def long(features=DRIFT_FEATURES) -> str:
    parts = [f"SELECT side, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM sides" for f in features]
    return "long AS (" + " UNION ALL ".join(parts) + ")"


# Quantiles by linear interpolation between neighbours, measured from the nearer one.
EDGES = """ordered AS (
  SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS k, count(*) OVER (PARTITION BY feature) AS n
  FROM long WHERE side = 'baseline'),
places AS (
  SELECT feature, (i / 10.0::DOUBLE) * (n - 1) AS pos FROM (SELECT DISTINCT feature, n FROM ordered), range(11) t(i)),
points AS (
  SELECT places.feature, CASE WHEN pos - floor(pos) < 0.5 THEN lo.v + (hi.v - lo.v) * (pos - floor(pos))
         ELSE hi.v - (hi.v - lo.v) * (1 - (pos - floor(pos))) END AS point
  FROM places JOIN ordered lo ON lo.feature = places.feature AND lo.k = floor(pos)
  JOIN ordered hi ON hi.feature = places.feature AND hi.k = ceil(pos)),
edges AS (SELECT feature, list_sort(list(DISTINCT point)) AS e FROM points GROUP BY feature),
binned AS (
  SELECT long.feature, side, len(list_filter(e[2:len(e) - 1], lambda x: x <= v)) AS bin, count(*) AS n, len(any_value(e)) AS m
  FROM long JOIN edges USING (feature) GROUP BY ALL),
shares AS (
  SELECT feature, bin, any_value(m) AS m,
    greatest(coalesce(sum(n) FILTER (WHERE side = 'baseline'), 0) / (SELECT count(*) FROM sides WHERE side = 'baseline'), 1e-4) AS ex,
    greatest(coalesce(sum(n) FILTER (WHERE side = 'current'), 0) / (SELECT count(*) FROM sides WHERE side = 'current'), 1e-4) AS ac
  FROM binned GROUP BY feature, bin),
psi AS (
  SELECT feature, CASE WHEN max(m) < 2 THEN 0.0 ELSE least(greatest(sum((ac - ex) * ln(ac / ex)), 0), 10) END AS psi
  FROM shares GROUP BY feature)"""
KS = """steps AS (
  SELECT DISTINCT feature, v,
    sum(CASE WHEN side = 'baseline' THEN 1 ELSE 0 END) OVER (PARTITION BY feature ORDER BY v) AS ub,
    sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) OVER (PARTITION BY feature ORDER BY v) AS uc FROM long),
sizes AS (
  SELECT feature, CAST(count(*) FILTER (WHERE side = 'baseline') AS DOUBLE) AS n,
         CAST(count(*) FILTER (WHERE side = 'current') AS DOUBLE) AS m FROM long GROUP BY feature),
ks AS (
  SELECT feature, max(abs(ub / n - uc / m)) AS ks_statistic, max(abs(ub / n - uc / m)) * sqrt(any_value(n * m / (n + m))) AS reach
  FROM steps JOIN sizes USING (feature) GROUP BY feature),
ks_p AS (
  SELECT feature, ks_statistic, CASE WHEN reach < 0.2 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
         lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * reach * reach))), 0), 1) END AS ks_p_value
  FROM ks)"""
DRIFT = """drift AS (
  SELECT feature, psi, ks_statistic, ks_p_value, psi >= 0.2 OR (ks_p_value < 0.01 AND ks_statistic > 0.15) AS is_drifted,
         CASE WHEN NOT (psi >= 0.2 OR (ks_p_value < 0.01 AND ks_statistic > 0.15)) THEN 'NONE'
              WHEN psi >= 0.25 THEN 'HIGH' ELSE 'LOW' END AS severity
  FROM psi JOIN ks_p USING (feature))"""
DRIFT_CTES = (PANEL, PRICED, SIDES, long(), EDGES, KS, DRIFT)
RATIO = f"""ratio AS (
  SELECT var_pop(num_orders - forecast_orders) FILTER (WHERE week > {VAL_END})
         / nullif(var_pop(num_orders - forecast_orders) FILTER (WHERE week <= {VAL_END}), 0) AS residual_variance_ratio
  FROM scored)"""

# --- folds -----------------------------------------------------------------------------------------


def _folds(expanding: bool = True, source: str = "panel") -> str:
    start = "lo" if expanding else "greatest(lo, hi - (3 - i) * w - w - 50 + 1)"
    return f"""facts0 AS (SELECT min(week) AS lo, max(week) AS hi, count(DISTINCT week) AS k FROM {source}),
width AS (SELECT *, CASE WHEN k < 80 THEN greatest(2, floor((k - 50) / 3.0)) ELSE 10 END AS w FROM facts0),
folds AS (
  SELECT CAST(i AS INT) AS fold_index, CAST({start} AS INT) AS train_start,
         CAST(hi - (3 - i) * w - w AS INT) AS train_end, CAST(hi - (3 - i) * w - w + 1 AS INT) AS test_start,
         CAST(hi - (3 - i) * w AS INT) AS test_end
  FROM width, (VALUES (1), (2), (3)) AS t(i))"""


def _fold_predictions(source: str = "panel") -> str:
    return f"""tr AS (SELECT fold_index, p.* FROM {source} p JOIN folds ON week BETWEEN train_start AND train_end),
fm AS (SELECT fold_index, center_id, meal_id, median(num_orders) AS gm FROM tr GROUP BY ALL),
fo AS (SELECT fold_index, median(num_orders) AS om, count(*) AS train_samples FROM tr GROUP BY ALL),
pred AS (
  SELECT p.*, fold_index, greatest(coalesce(gm, om), 0) AS forecast_orders
  FROM {source} p JOIN folds ON week BETWEEN test_start AND test_end JOIN fo USING (fold_index)
  LEFT JOIN fm USING (fold_index, center_id, meal_id))"""


FOLDS = (_folds(), _fold_predictions())


def fold_scores(expanding: bool = True) -> str:
    return q(
        PANEL,
        _folds(expanding),
        _fold_predictions(),
        select=f"""SELECT fold_index, train_start, train_end, test_start, test_end, train_samples,
  count(*) AS test_samples, {measures()}
FROM pred JOIN folds USING (fold_index) JOIN fo USING (fold_index) GROUP BY ALL""",
    )


WIDE = "wide AS (SELECT * FROM panel LEFT JOIN centers USING (center_id) LEFT JOIN meals USING (meal_id))"


def slices(source: str) -> str:
    dims = ("center_type", "category", "cuisine", "emailer_for_promotion", "homepage_featured")
    parts = [
        f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS slice, count(*) AS sample_count, {measures()} "
        f"FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) >= 5"
        for c in dims
    ]
    return " UNION ALL ".join(parts)


GAPS = """{0} AS (
  SELECT * REPLACE (CASE WHEN week % 11 <> 0 THEN num_orders END AS num_orders,
                    CASE WHEN week % 11 <> 0 THEN actual_orders END AS actual_orders,
                    CASE WHEN week % 13 <> 0 THEN checkout_price END AS checkout_price,
                    CASE WHEN week % 17 <> 0 THEN forecast_orders END AS forecast_orders) FROM {1})"""

# Ridge of log1p(num_orders) on two features: 2 x 2 normal equations of the centred columns, solved by determinants.
LINEAR = f"""means AS (SELECT avg(checkout_price) AS mx, avg(any_promo) AS mz, avg(ln(1 + num_orders)) AS my FROM priced WHERE week <= {TRAIN_END}),
grams AS (
  SELECT any_value(mx) AS mx, any_value(mz) AS mz, any_value(my) AS my, 1.001 * sum((checkout_price - mx) ** 2) AS xx,
         1.001 * sum((any_promo - mz) ** 2) AS zz, sum((checkout_price - mx) * (any_promo - mz)) AS xz,
         sum((checkout_price - mx) * (ln(1 + num_orders) - my)) AS xy, sum((any_promo - mz) * (ln(1 + num_orders) - my)) AS zy
  FROM priced, means WHERE week <= {TRAIN_END}),
slopes AS (SELECT mx, mz, my, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM grams),
parts AS (
  SELECT week, center_id, meal_id, 'checkout_price' AS feature, (checkout_price - mx) * bx AS contribution FROM priced, slopes
  UNION ALL SELECT week, center_id, meal_id, 'any_promo', (any_promo - mz) * bz FROM priced, slopes)"""

# --- policies --------------------------------------------------------------------------------------

POLICIES = """policies(service_level, z, pos) AS (VALUES (0.8::DOUBLE, 0.8416::DOUBLE, 0), (0.85, 1.0364, 1),
  (0.9, 1.2816, 2), (0.95, 1.6449, 3), (0.98, 2.0537, 4), (0.99, 2.3263, 5)),
replay AS (
  SELECT t.week, t.center_id, t.meal_id, service_level, z, pos, num_orders AS a,
         forecast_orders + greatest(5.0, ceil(z * 25.0)) AS prepared,
         least(num_orders, forecast_orders + greatest(5.0, ceil(z * 25.0))) AS fulfilled,
         greatest(0.0, num_orders - forecast_orders - greatest(5.0, ceil(z * 25.0))) AS stockout,
         greatest(0.0, forecast_orders + greatest(5.0, ceil(z * 25.0)) - num_orders) * 0.3 AS wasted,
         greatest(0.0, forecast_orders + greatest(5.0, ceil(z * 25.0)) - num_orders) AS unneeded
  FROM test t, policies WHERE num_orders IS NOT NULL AND forecast_orders IS NOT NULL)"""
WASTED = "CAST(sum(unneeded) AS DECIMAL(26, 6)) * 0.3"
REPLAY = f"""SELECT service_level, {r("any_value(z)", 3)} AS z_score,
  (SELECT count(*) FROM test WHERE num_orders IS NULL OR forecast_orders IS NULL) AS unscored_rows, {r("sum(a)", 1)} AS total_demand_units,
  {r("sum(prepared)", 1)} AS total_prepared_units, {r("sum(fulfilled)", 1)} AS total_fulfilled_units,
  {r("sum(stockout)", 1)} AS total_stockout_units, {r(WASTED, 1)} AS total_wasted_units,
  {r("count(*) FILTER (WHERE a > prepared) / count(*) * 100", 2)} AS stockout_event_rate,
  {r("CASE WHEN sum(a) > 0 THEN sum(fulfilled) / greatest(1, sum(a)) * 100 ELSE 100 END", 2)} AS fill_rate_percentage,
  {r(WASTED + " * 5", 2)} AS estimated_holding_cost, {r("sum(stockout) * 160", 2)} AS estimated_stockout_loss,
  {r(WASTED + " * 5 + sum(stockout) * 160", 2)} AS total_operational_cost
FROM replay GROUP BY service_level"""

# --- stream ----------------------------------------------------------------------------------------

STREAM = (
    PANEL,
    PRICED,
    ALL_SCORED,
    f"batches AS (SELECT *, (week - {VAL_END + 1}) // 7 AS b FROM test)",
    profiles("batches", "b, center_id, meal_id"),
    adaptive("batches", "b, center_id, meal_id"),
)

VIOLATIONS = """SELECT 'train' AS "table", 'pk_null' AS "check", 'id' AS "column", count(*) FILTER (WHERE id IS NULL) AS violations FROM dirty
UNION ALL SELECT 'train', 'pk_duplicate', 'id', count(id) - count(DISTINCT id) FROM dirty
UNION ALL SELECT 'train', 'not_binary', 'emailer_for_promotion', count(*) FILTER (WHERE emailer_for_promotion NOT IN (0, 1)) FROM dirty
UNION ALL SELECT 'train', 'not_binary', 'homepage_featured', count(*) FILTER (WHERE homepage_featured NOT IN (0, 1)) FROM dirty
UNION ALL SELECT 'train', 'not_positive', 'checkout_price', count(*) FILTER (WHERE checkout_price <= 0) FROM dirty
UNION ALL SELECT 'train', 'not_positive', 'base_price', count(*) FILTER (WHERE base_price <= 0) FROM dirty
UNION ALL SELECT 'train', 'negative', 'num_orders', count(*) FILTER (WHERE num_orders < 0) FROM dirty"""
LINKS = """SELECT 'train' AS "table", 'foreign_key' AS "check", 'center_id' AS "column", count(DISTINCT center_id) AS violations
FROM dirty ANTI JOIN centers USING (center_id)
UNION ALL SELECT 'train', 'foreign_key', 'meal_id', count(DISTINCT meal_id) FROM dirty ANTI JOIN meals USING (meal_id)"""
OTHER_TABLES = """SELECT 'centers' AS "table", 'pk_null' AS "check", 'center_id' AS "column", count(*) FILTER (WHERE center_id IS NULL) AS violations FROM centers
UNION ALL SELECT 'centers', 'pk_duplicate', 'center_id', count(center_id) - count(DISTINCT center_id) FROM centers
UNION ALL SELECT 'centers', 'not_positive', 'op_area', count(*) FILTER (WHERE op_area <= 0) FROM centers
UNION ALL SELECT 'meals', 'pk_null', 'meal_id', count(*) FILTER (WHERE meal_id IS NULL) FROM meals
UNION ALL SELECT 'meals', 'pk_duplicate', 'meal_id', count(meal_id) - count(DISTINCT meal_id) FROM meals"""


def one_check(*checks: str) -> str:
    listed = ", ".join(f"'{c}'" for c in checks)
    return q(PANEL, DIRTY, select=f'SELECT "check", "column", violations FROM ({VIOLATIONS}) WHERE "check" IN ({listed})')


def column_check(train: str) -> str:
    return q(
        PANEL,
        DIMS,
        select=f"""SELECT 'train' AS "table", count(*) AS n, '{train}' AS "columns" FROM panel
UNION ALL SELECT 'centers', count(*), '' FROM centers UNION ALL SELECT 'meals', count(*), '' FROM meals""",
    )


def stressed(name: str) -> str:
    return q(
        PANEL,
        PRICED,
        select=f"SELECT center_id, meal_id, {SCENARIO_SUMS} FROM (SELECT * REPLACE ({STRESSED[name]}) FROM priced) GROUP BY ALL",
    )


SPLIT_SUMMARY = 'count(*) AS n, min(week) AS first_week, max(week) AS last_week, sum(num_orders) AS units'
ENRICHED = "id, center_type, city_code, region_code, op_area, category, cuisine, num_orders"
LAGS = ", ".join(lag(n) for n in (1, 2, 3, 4, 5, 10))
CODE_COLUMNS = ("center_type", "category", "cuisine", "city_code", "region_code")
CODES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(v AS VARCHAR) AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code "
    f"FROM (SELECT DISTINCT {c} AS v FROM wide WHERE {c} IS NOT NULL)"
    for c in CODE_COLUMNS
)


def code(c: str, source: str = "wide") -> str:
    return f"(SELECT DISTINCT {c}, dense_rank() OVER (ORDER BY {c}) - 1 AS {c}_code FROM {source})"


def histogram(value: str, scale: str) -> str:
    return f"""SELECT '{scale}' AS scale, bin, {r("lo + bin * w")} AS low, {r("lo + (bin + 1) * w")} AS high, count(v) AS "rows"
FROM (SELECT CAST(i AS INT) AS bin, lo, w FROM range(40) t(i), (SELECT min({value}) AS lo, (max({value}) - min({value})) / 40 AS w FROM panel))
LEFT JOIN (SELECT {value} AS v, CAST(least(39, floor(({value} - (SELECT min({value}) FROM panel))
  / (SELECT (max({value}) - min({value})) / 40 FROM panel))) AS INT) AS bin FROM panel) USING (bin) GROUP BY bin, lo, w"""


def compare(gain_over: str, parts: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{name}' AS model, {measures()} FROM {source}" for name, source in parts.items())
    return f"""SELECT model, mae, rmse, wmape, rmsle, CAST(round(CASE WHEN base > 0 THEN (base - wmape) / base * 100 ELSE 0 END, 2) AS DOUBLE) AS gain_pct
FROM ({rows}) CROSS JOIN (SELECT wmape AS base FROM ({rows}) WHERE model = '{gain_over}')"""


ELASTIC_SPLIT = (
    PANEL,
    PRICED,
    ALL_SCORED,
    f"train_part AS (SELECT * FROM priced WHERE week <= {TRAIN_END})",
    f"test_part AS (SELECT * FROM priced WHERE week > {VAL_END})",
    elastic("train_part", "test_part"),
)

FEATURE_CODES = "\n".join(f"LEFT JOIN {code(c)} USING ({c})" for c in CODE_COLUMNS)
HISTORY_LAGS = ", ".join(f"num_orders_lag_{n}" for n in (1, 2, 3, 4, 5, 10))
HISTORY_LAGS_OF = ", ".join(lag(n) for n in (1, 2, 3, 4, 5, 10))
HISTORY_NAMES = ", ".join(f"num_orders_roll_{s}_{k}" for k in (3, 5, 10) for s in ("mean", "std"))
HISTORY_ROLLS = ", ".join(f"{mean(k)} AS num_orders_roll_mean_{k}, {std(k)} AS num_orders_roll_std_{k}" for k in (3, 5, 10))


def _frame(impute: bool = True) -> str:
    def filled(expression: str) -> str:
        return f"coalesce({expression}, 0)" if impute else expression

    return q(
        PANEL,
        DIMS,
        PRICED.replace("FROM panel)", "FROM wide)", 1).replace("p1 AS", WIDE + ",\np1 AS", 1),
        select=f"""SELECT id, week, center_id, meal_id, emailer_for_promotion, homepage_featured,
  {rounded("checkout_price, base_price, op_area, discount_amount, discount_ratio, price_ratio, promo_discount_synergy", 4)},
  {r("checkout_price / greatest(avg(checkout_price) OVER (PARTITION BY meal_id), 0.0001)", 4)} AS meal_rel_price,
  both_promos, any_promo, {CALENDAR},
  {r("sin(2 * pi() * (((week - 1) % 52) + 1) / 52.0)", 4)} AS sin_week_of_year,
  {r("cos(2 * pi() * (((week - 1) % 52) + 1) / 52.0)", 4)} AS cos_week_of_year,
  {", ".join(filled(f"lag(num_orders, {n}) OVER w") + f" AS num_orders_lag_{n}" for n in (1, 2, 3, 4, 5, 10))},
  {", ".join(f"{r(filled(mean(k)), 4)} AS num_orders_roll_mean_{k}" for k in (3, 5, 10))},
  {", ".join(f"{r(std(k), 4)} AS num_orders_roll_std_{k}" for k in (3, 5, 10))},
  {", ".join(f"CAST(coalesce({c}_code, -1) AS INT) AS {c}" for c in CODE_COLUMNS)}
FROM priced
{FEATURE_CODES}
{SERIES}""",
    )


FEATURE_FRAME = _frame()

ORACLES: dict[str, str] = {
    # sources and sinks
    "load_tables": q(PANEL, select=f"SELECT {FACTS} FROM panel"),
    "read_features": q(
        PANEL,
        PRICED,
        select=f"""SELECT week, center_id, meal_id, {r("price_ratio")} AS price_ratio, {HISTORY_LAGS}, {rounded(HISTORY_NAMES)}
FROM (SELECT *, {HISTORY_LAGS_OF}, {HISTORY_ROLLS} FROM priced {SERIES})""",
    ),
    "write_metrics": q(PANEL, SCORED, PLAN, select=f"SELECT * FROM (SELECT {measures()} FROM test), ({KPIS})"),
    "write_codes": q(PANEL, DIMS, WIDE, select=CODES),
    "write_features": q(
        PANEL,
        select=f"""SELECT CAST((week - 1) // 52 AS INT) AS week_bucket, count(*) AS n, sum(num_orders) AS units,
  {", ".join(f"count({c}) AS {c}" for c in f"{HISTORY_LAGS}, {HISTORY_NAMES}".split(", "))}
FROM (SELECT *, {HISTORY_LAGS_OF}, {HISTORY_ROLLS} FROM panel {SERIES}) GROUP BY 1""",
    ),
    "read_plan": q(PANEL, SCORED, PLAN, select=f"SELECT {PLAN_COLUMNS} FROM plan"),
    "write_plan": q(
        PANEL,
        SCORED,
        PLAN,
        select=f"""SELECT meal_id, count(*) AS n, {r("sum(forecast_orders)")} AS forecast_orders,
  {r("sum(recommended_preparation)")} AS recommended_preparation FROM plan GROUP BY meal_id""",
    ),
    "feedback_export": q(
        PANEL,
        SCORED,
        select=f"SELECT CAST(1 AS BIGINT) AS batch_id, * FROM ({log('val')}) UNION ALL SELECT 2, * FROM ({log('test')})",
    ),
    # validation
    "check_required_columns": column_check("num_orders"),
    "check_extra_columns": column_check("surplus"),
    "check_columns_legacy": column_check("missing required columns: [''num_orders'']"),
    "check_pk_null": one_check("pk_null"),
    "check_pk_duplicates": q(
        PANEL,
        DIRTY,
        select="SELECT id, count(*) - 1 AS duplicates FROM dirty WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1",
    ),
    "check_binary_domain": q(
        PANEL,
        DIRTY,
        select='SELECT emailer_for_promotion AS value, count(*) AS "rows" FROM dirty WHERE emailer_for_promotion NOT IN (0, 1) GROUP BY 1',
    ),
    "check_positive": one_check("not_positive"),
    "check_non_negative": one_check("negative"),
    "check_foreign_keys": q(PANEL, DIMS, DIRTY, select=LINKS),
    "violation_report": q(PANEL, DIMS, DIRTY, select=f"{VIOLATIONS} UNION ALL {OTHER_TABLES} UNION ALL {LINKS}"),
    # projections and filters
    "time_split": q(
        PANEL,
        select=f"""SELECT CASE WHEN week <= {TRAIN_END} THEN 'train' WHEN week <= {VAL_END} THEN 'validation' ELSE 'test' END AS split,
  {SPLIT_SUMMARY} FROM panel GROUP BY 1""",
    ),
    "select_features": _frame(impute=False).replace("SELECT id, week,", "SELECT week,"),
    "dashboard_filter": q(
        PANEL,
        select=f"""SELECT id, week, center_id, meal_id, {rounded("checkout_price, base_price, num_orders")},
  emailer_for_promotion, homepage_featured FROM panel WHERE center_id = 7 AND meal_id = 103""",
    ),
    "fold_filter": q(
        PANEL,
        select=f"""SELECT id, week, center_id, meal_id, {rounded("checkout_price, base_price, num_orders")},
  emailer_for_promotion, homepage_featured FROM panel WHERE week BETWEEN 329 AND 338""",
    ),
    "half_split": q(PANEL, PRICED, SIDES, select=f"SELECT side, {SPLIT_SUMMARY} FROM sides GROUP BY side"),
    "impute_zero": q(
        PANEL,
        select="SELECT id, "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in HISTORY_LAGS.split(", "))
        + ", "
        + ", ".join(f"{r(f'coalesce({c}, 0)')} AS {c}" for c in HISTORY_NAMES.split(", "))
        + f" FROM (SELECT id, {HISTORY_LAGS_OF}, {HISTORY_ROLLS} FROM panel {SERIES})",
    ),
    "distinct_values": q(
        PANEL,
        select="""SELECT DISTINCT 'center_id' AS "column", center_id AS value FROM panel
UNION ALL SELECT DISTINCT 'meal_id', CAST(meal_id AS BIGINT) FROM panel
UNION ALL SELECT DISTINCT 'week', CAST(week AS BIGINT) FROM panel""",
    ),
    # joins
    "enrich_left": q(
        PANEL,
        DIMS,
        DIRTY,
        select=f"""SELECT {ENRICHED} FROM dirty LEFT JOIN centers USING (center_id) LEFT JOIN meals USING (meal_id)""",
    ),
    "enrich_inner": q(
        PANEL,
        DIMS,
        DIRTY,
        select=f"SELECT {ENRICHED} FROM dirty JOIN centers USING (center_id) JOIN meals USING (meal_id)",
    ),
    "baseline_lookup": q(PANEL, SCORED, select="SELECT week, center_id, meal_id, forecast_orders FROM test"),
    "profile_lookup": q(
        PANEL,
        SCORED,
        NO_PROMO.format("val"),
        profiles("unpromoted"),
        adaptive("test"),
        select=f"SELECT week, center_id, meal_id, {rounded('adaptive_orders, adaptive_stock')} FROM adapted",
    ),
    "fold_range_join": q(
        PANEL,
        _folds(),
        select="""SELECT 'train' AS part, fold_index, count(*) AS n, sum(num_orders) AS units
FROM panel JOIN folds ON week BETWEEN train_start AND train_end GROUP BY ALL
UNION ALL SELECT 'test', fold_index, count(*), sum(num_orders) FROM panel JOIN folds ON week BETWEEN test_start AND test_end GROUP BY ALL""",
    ),
    "policy_cross_join": q(
        PANEL,
        SCORED,
        POLICIES,
        select=f"SELECT week, center_id, meal_id, service_level, {rounded('prepared, fulfilled, stockout, wasted')} FROM replay",
    ),
    "scenario_cross_join": q(
        PANEL,
        PRICED,
        STACK,
        select=f"SELECT scenario, center_id, meal_id, {SCENARIO_SUMS} FROM stack GROUP BY scenario, center_id, meal_id",
    ),
    "category_lookup": q(
        PANEL,
        DIMS,
        WIDE,
        "early AS (SELECT * FROM wide WHERE week <= 2)",
        select="SELECT id, "
        + ", ".join(f"CAST(coalesce({c}_code, -1) AS INT) AS {c}" for c in CODE_COLUMNS)
        + " FROM wide "
        + " ".join(f"LEFT JOIN {code(c, 'early')} USING ({c})" for c in CODE_COLUMNS),
    ),
    "fk_anti_join": q(
        PANEL, DIMS, DIRTY, select="SELECT DISTINCT center_id AS key FROM dirty ANTI JOIN centers USING (center_id)"
    ),
    # aggregations
    "group_median_fit": q(PANEL, SCORED, select="SELECT center_id, meal_id, gm AS group_median FROM med"),
    "group_median_long_groups": q(REGION, SCORED, select="SELECT center_id, meal_id, gm AS group_median FROM med"),
    "overall_median": q(PANEL, SCORED, select="SELECT om AS overall_median FROM med_all"),
    "price_quantiles_long_groups": q(
        PANEL,
        select=f"""SELECT meal_id, CAST(i AS INT) AS decile, {r("qs[i + 1]")} AS price
FROM (SELECT meal_id, quantile_cont(checkout_price, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS qs FROM panel GROUP BY 1),
  range(11) t(i)""",
    ),
    "baseline_forecast": q(PANEL, SCORED, select="SELECT id, forecast_orders FROM everywhere"),
    "metric_wmape": q(
        PANEL,
        SCORED,
        select=f"SELECT meal_id, {r('sum(abs(num_orders - forecast_orders)) / sum(abs(num_orders))')} AS wmape FROM test GROUP BY meal_id",
    ),
    "metric_rmsle": q(
        PANEL,
        SCORED,
        select=f"SELECT meal_id, {r('sqrt(avg(power(ln(1 + forecast_orders) - ln(1 + num_orders), 2)))')} AS rmsle FROM test GROUP BY meal_id",
    ),
    "metric_suite": q(PANEL, SCORED, select=f"SELECT center_id, {measures()} FROM test GROUP BY center_id"),
    "evaluate_model": q(PANEL, SCORED, select=f"SELECT {measures()} FROM test"),
    "residual_rmse": q(PANEL, SCORED, PLAN, select=f"SELECT {r('s')} AS residual_rmse FROM std"),
    "inventory_kpis": q(PANEL, SCORED, PLAN, select=KPIS),
    "sliced_metrics": q(PANEL, DIMS, WIDE, _scored("wide"), select=slices("test")),
    "fold_metrics": fold_scores(),
    "overall_backtest_metrics": q(PANEL, *FOLDS, select=f"SELECT {measures()} FROM pred"),
    "policy_replay": q(PANEL, SCORED, POLICIES, select=REPLAY),
    "policy_replay_gaps": q(PANEL, SCORED.replace("test AS (", "whole_test AS ("), GAPS.format("test", "whole_test"), POLICIES, select=REPLAY),
    "sku_profile_gaps": q(
        PANEL, PRICED, ALL_SCORED, GAPS.format("gappy", "everywhere"), profiles("gappy"), select=f"SELECT {PROFILE_COLUMNS} FROM profiles"
    ),
    "adaptive_correction_gaps": q(
        PANEL,
        SCORED,
        GAPS.format("gappy", "scored"),
        f"unpromoted AS (SELECT *, CAST(NULL AS INT) AS any_promo FROM gappy WHERE week <= {VAL_END})",
        profiles("unpromoted"),
        f"later AS (SELECT * FROM gappy WHERE week > {VAL_END})",
        adaptive("later"),
        select=f"SELECT week, center_id, meal_id, {rounded('adaptive_orders, adaptive_stock')} FROM adapted",
    ),
    "optimal_policy": q(
        PANEL,
        SCORED,
        POLICIES,
        select="""SELECT coalesce(arg_min(service_level, row(cost, pos)), 0.95) AS optimal_service_level
FROM (SELECT service_level, pos, sum(wasted) * 5 + sum(stockout) * 160 AS cost FROM replay GROUP BY ALL)""",
    ),
    "sku_profile": q(PANEL, PRICED, ALL_SCORED, ALL_PROFILES, select=f"SELECT {PROFILE_COLUMNS} FROM profiles"),
    "residual_bias": q(
        PANEL, PRICED, ALL_SCORED, ALL_PROFILES, select=f"SELECT center_id, meal_id, {rounded('bias, std')} FROM numbers"
    ),
    "promo_uplift": q(
        PANEL, PRICED, ALL_SCORED, ALL_PROFILES, select=f"SELECT center_id, meal_id, {rounded('uplift')} FROM numbers"
    ),
    "price_elasticity": q(
        PANEL, PRICED, ALL_SCORED, ALL_PROFILES, select=f"SELECT center_id, meal_id, {rounded('elasticity')} FROM numbers"
    ),
    "profile_tiers": q(
        PANEL,
        PRICED,
        ALL_SCORED,
        ALL_PROFILES,
        select="SELECT volatility_tier, volume_tier, count(*) AS pairs FROM profiles GROUP BY ALL",
    ),
    "profile_safety_stock": q(
        PANEL, PRICED, ALL_SCORED, ALL_PROFILES, select="SELECT center_id, meal_id, recommended_safety_stock FROM profiles"
    ),
    "feedback_summary_newest": q(
        PANEL,
        SCORED,
        f"""log AS (SELECT * FROM (SELECT 1 AS batch_id, * FROM ({log('val')}) UNION ALL SELECT 2, * FROM ({log('test')}))
ORDER BY batch_id DESC, week DESC, center_id DESC, meal_id DESC LIMIT 4000)""",
        select=SUMMARY,
    ),
    "feedback_summary": q(PANEL, SCORED, f"log AS ({log('scored')})", select=SUMMARY),
    "weekly_totals": q(
        PANEL,
        SCORED,
        PLAN,
        select="SELECT week, "
        + ", ".join(f"{r(f'sum({c})')} AS {c}" for c in ("actual_orders", "forecast_orders", "recommended_preparation"))
        + " FROM plan GROUP BY week",
    ),
    "weekly_network_demand": q(PANEL, select="SELECT week, sum(num_orders) AS num_orders FROM panel GROUP BY week"),
    "promo_combo_mean": q(
        PANEL,
        select=f"""SELECT emailer_for_promotion, homepage_featured, {r("avg(num_orders)")} AS mean_orders
FROM panel GROUP BY emailer_for_promotion, homepage_featured""",
    ),
    "demand_histogram": q(
        PANEL, select=f"{histogram('num_orders', 'raw')} UNION ALL {histogram('ln(1 + num_orders)', 'log')}"
    ),
    "demand_skewness": q(
        PANEL,
        select=f"SELECT {r('skewness(num_orders)')} AS raw_skewness, {r('skewness(ln(1 + num_orders))')} AS log_skewness FROM panel",
    ),
    "prediction_total": q(
        PANEL,
        PRICED,
        STACK,
        ELASTIC,
        select=f"SELECT scenario, {r('sum(forecast_orders)', 3)} AS total FROM elastic GROUP BY scenario",
    ),
    # windows
    "lag_features": q(PANEL, select=f"SELECT id, {LAGS} FROM panel {SERIES}"),
    "lag_features_long_series": q(REGION, select=f"SELECT id, {LAGS} FROM panel {SERIES}"),
    "rolling_mean": q(
        PANEL,
        select="SELECT id, " + ", ".join(f"{r(mean(k))} AS num_orders_roll_mean_{k}" for k in (3, 5, 10)) + " FROM panel",
    ),
    "rolling_std": q(
        PANEL,
        select="SELECT id, " + ", ".join(f"{r(std(k), 4)} AS num_orders_roll_std_{k}" for k in (3, 5, 10)) + " FROM panel",
    ),
    "rolling_long_series": q(
        REGION,
        select=f"SELECT id, {r(mean(10), 4)} AS num_orders_roll_mean_10, {r(std(5), 4)} AS num_orders_roll_std_5 FROM panel",
    ),
    "meal_rel_price": q(
        PANEL,
        select=f"SELECT id, {r('checkout_price / greatest(avg(checkout_price) OVER (PARTITION BY meal_id), 0.0001)')} AS meal_rel_price FROM panel",
    ),
    "category_codes": q(PANEL, DIMS, WIDE, select=CODES),
    "ks_cumulative": q(
        PANEL,
        PRICED,
        SIDES,
        long(("checkout_price", "num_orders")),
        KS,
        select=f"""SELECT feature, {r("v", 9)} AS value, CAST(ub AS BIGINT) AS upto_baseline_rows, CAST(uc AS BIGINT) AS upto_current_rows
FROM steps""",
    ),
    "trailing_rank": q(
        PANEL,
        select="""SELECT week, center_id, meal_id, CAST(rank AS INT) AS rank, num_orders FROM (
  SELECT *, row_number() OVER (PARTITION BY center_id, meal_id ORDER BY week DESC, id DESC) AS rank FROM panel) WHERE rank <= 10""",
    ),
    # sorts and limits
    "panel_sort": q(PANEL, select="SELECT week, center_id, meal_id, num_orders FROM panel ORDER BY center_id, meal_id, week"),
    "plan_head": q(PANEL, SCORED, PLAN, select=f"SELECT {PLAN_COLUMNS} FROM plan ORDER BY week, center_id, meal_id LIMIT 20"),
    "profiles_head": q(
        PANEL,
        PRICED,
        ALL_SCORED,
        ALL_PROFILES,
        select=f"SELECT {PROFILE_COLUMNS} FROM profiles ORDER BY center_id, meal_id LIMIT 10",
    ),
    "last_n_history": q(
        PANEL,
        SCORED,
        select=f"""SELECT * FROM (SELECT CAST(1 AS BIGINT) AS batch_id, * FROM ({log('val')}) UNION ALL SELECT 2, * FROM ({log('test')}))
ORDER BY batch_id DESC, week DESC, center_id DESC, meal_id DESC LIMIT 500""",
    ),
    "unmapped_sample": q(
        PANEL,
        DIMS,
        DIRTY,
        select="SELECT DISTINCT center_id AS key FROM dirty ANTI JOIN centers USING (center_id) ORDER BY key LIMIT 5",
    ),
    "psi_top15_banded": q(
        *DRIFT_CTES,
        select=f"""SELECT feature, {r("psi")} AS psi,
  CASE WHEN psi >= 0.2 THEN 'red' WHEN psi >= 0.1 THEN 'amber' ELSE 'green' END AS band FROM drift ORDER BY feature LIMIT 15""",
    ),
    # set operations
    "concat_folds": q(PANEL, *FOLDS, select="SELECT week, center_id, meal_id, fold_index, forecast_orders FROM pred"),
    "key_difference": q(
        PANEL, DIMS, DIRTY, select="SELECT meal_id AS key FROM dirty EXCEPT SELECT meal_id FROM meals"
    ),
    "append_feedback": q(
        PANEL,
        SCORED,
        select=f"""SELECT CAST(CASE WHEN week > {VAL_END} THEN 2 ELSE 1 END AS BIGINT) AS batch_id, count(*) AS n,
  sum(num_orders) AS units FROM scored GROUP BY 1""",
    ),
    "scenario_union": q(
        PANEL, PRICED, STACK, ELASTIC, TOTALS, select=f"SELECT scenario, {rounded('total, prep, buffer', 3)} FROM totals"
    ),
    # scalar expressions
    "price_features": q(
        PANEL,
        DIRTY,
        select=f"""SELECT id, {r("greatest(0.0, base_price - checkout_price)", 4)} AS discount_amount,
  {r("greatest(0.0, base_price - checkout_price) / greatest(base_price, 0.0001)", 4)} AS discount_ratio,
  {r("checkout_price / greatest(base_price, 0.0001)", 4)} AS price_ratio FROM dirty""",
    ),
    "promo_features": q(
        PANEL, PRICED, select=f"SELECT id, both_promos, any_promo, {rounded('promo_discount_synergy')} FROM priced"
    ),
    "calendar_features": q(PANEL, select=f"SELECT id, {CALENDAR} FROM panel"),
    "cyclical_encoding": q(PANEL, select=f"SELECT id, {SEASON} FROM panel"),
    "naive_discount_ratio": q(
        PANEL, select=f"SELECT id, {r('(base_price - checkout_price) / base_price')} AS discount_ratio FROM panel"
    ),
    "log_target": q(
        PANEL,
        select=f"SELECT id, {r('ln(1 + num_orders)')} AS y, {r('greatest(exp(ln(1 + num_orders)) - 1, 0)')} AS back FROM panel",
    ),
    "z_score": q(
        PANEL,
        PRICED,
        "levels AS (SELECT id, round(0.75 + discount_ratio * 2.5, 3) AS level FROM priced)",
        select="""SELECT id, level, CASE round(CAST(level AS DECIMAL(38,10)), 2) WHEN 0.80 THEN 0.8416 WHEN 0.85 THEN 1.0364 WHEN 0.90 THEN 1.2816
  WHEN 0.95 THEN 1.6449 WHEN 0.98 THEN 2.0537 WHEN 0.99 THEN 2.3263
  ELSE CASE WHEN level >= 0.99 THEN 2.3263 WHEN level <= 0.80 THEN 0.8416 ELSE 1.6449 END END::DOUBLE AS z FROM levels""",
    ),
    "safety_stock": q(PANEL, select=f"SELECT id, greatest(5.0, ceil(1.6449 * {std(10)})) AS safety_stock FROM panel"),
    "recommend_row": q(
        PANEL,
        SCORED,
        "stocked AS (SELECT *, greatest(5.0, ceil(1.6449 * sqrt(2) * num_orders / 4)) AS ss FROM test)",
        select=f"""SELECT week, center_id, meal_id, {r("forecast_orders", 2)} AS forecast_demand, {r("ss", 2)} AS safety_stock,
  {r("greatest(0, forecast_orders + ss - num_orders)", 2)} AS recommended_preparation, {r("forecast_orders * 2 + ss", 2)} AS reorder_point
FROM stocked""",
    ),
    "inventory_plan": q(PANEL, SCORED, PLAN, select=f"SELECT {PLAN_COLUMNS} FROM plan"),
    "adaptive_correction": q(
        PANEL,
        SCORED,
        NO_PROMO.format("test"),
        profiles("unpromoted"),
        adaptive("test"),
        select=f"SELECT week, center_id, meal_id, {rounded('adaptive_orders, adaptive_stock')} FROM adapted",
    ),
    "feedback_record": q(PANEL, SCORED, select=log("test")),
    **{f"scenario_{name}": stressed(name) for name in STRESSED},
    "scenario_outcome": q(PANEL, PRICED, STACK, ELASTIC, TOTALS, OUTCOMES, select="SELECT * FROM outcomes"),
    "stress_verdict": q(
        PANEL,
        PRICED,
        STACK,
        ELASTIC,
        TOTALS,
        OUTCOMES,
        select="""SELECT CASE WHEN bool_and(direction_valid)
  THEN 'PASSED: Model behaves consistently with economic and operational dynamics.'
  ELSE 'CAUTION: Some scenario responses violated theoretical directions.' END AS summary_verdict FROM outcomes""",
    ),
    "replay_timeline": q(
        PANEL,
        SCORED,
        select="SELECT week, center_id, meal_id, forecast_orders, actual_orders, forecast_orders + 42.0 AS recommended_95 FROM test",
    ),
    "improvement_pct": q(
        PANEL,
        SCORED,
        NO_PROMO.format("test"),
        profiles("unpromoted"),
        adaptive("test"),
        select=f"""SELECT champion_wmape, adaptive_wmape,
  {r("CASE WHEN champion_wmape > 0 THEN (champion_wmape - adaptive_wmape) / champion_wmape * 100 ELSE 0 END", 2)} AS improvement_pct
FROM (SELECT wmape AS champion_wmape FROM (SELECT {measures(names="wmape")} FROM test)),
  (SELECT wmape AS adaptive_wmape FROM (SELECT {measures(p="adaptive_orders", names="wmape")} FROM adapted))""",
    ),
    # drift
    "psi": q(*DRIFT_CTES, select=f"SELECT feature, {r('psi')} AS psi FROM psi"),
    "psi_long_groups": q(*DRIFT_CTES, select=f"SELECT feature, {r('psi')} AS psi FROM psi"),
    "ks_statistic": q(*DRIFT_CTES, select=f"SELECT feature, {r('ks_statistic')} AS ks_statistic FROM ks"),
    "ks_p_value": q(*DRIFT_CTES, select=f"SELECT feature, {r('ks_p_value')} AS ks_p_value FROM ks_p"),
    "feature_drift": q(
        *DRIFT_CTES,
        select=f"SELECT feature, {rounded('psi, ks_statistic, ks_p_value')}, is_drifted, severity FROM drift",
    ),
    "target_drift": q(
        *DRIFT_CTES, select=f"SELECT {r('ks_p_value')} AS target_p_value FROM ks_p WHERE feature = 'num_orders'"
    ),
    "residual_variance_ratio": q(
        PANEL, SCORED, RATIO, select=f"SELECT {r('residual_variance_ratio')} AS residual_variance_ratio FROM ratio"
    ),
    "drift_report": q(
        *DRIFT_CTES,
        select=f"""SELECT CASE WHEN drifted_features / greatest(1, features) > 0.35 THEN 'CRITICAL_DRIFT'
  WHEN drifted_features / greatest(1, features) > 0.15 OR target_p_value < 0.01 THEN 'MODERATE_DRIFT' ELSE 'HEALTHY' END AS status,
  drifted_features, features, {rounded("target_p_value", 4)}, CAST(NULL AS DOUBLE) AS residual_variance_ratio,
  feature AS name, {r("psi", 4)} AS psi, {r("ks_statistic", 4)} AS ks_stat, {r("ks_p_value", 4)} AS p_value, is_drifted, severity
FROM drift, (SELECT count(*) FILTER (WHERE is_drifted) AS drifted_features, count(*) AS features FROM drift),
  (SELECT ks_p_value AS target_p_value FROM ks_p WHERE feature = 'num_orders')""",
    ),
    "random_sample": q(
        PANEL,
        select=f"SELECT id, {rounded('checkout_price, num_orders')} FROM panel ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id LIMIT 1000",
    ),
    "model_persistence": q(
        _panel("nation"),
        select=f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS negative, CAST(0 AS BIGINT) AS differing FROM panel WHERE week > {VAL_END}",
    ),
    "drift_status": q(
        *DRIFT_CTES,
        SCORED,
        RATIO,
        select=f"""SELECT CASE WHEN drifted_features / greatest(1, features) > 0.35 OR coalesce(residual_variance_ratio > 1.8, FALSE) THEN 'CRITICAL_DRIFT'
  WHEN drifted_features / greatest(1, features) > 0.15 OR target_p_value < 0.01 THEN 'MODERATE_DRIFT' ELSE 'HEALTHY' END AS status,
  drifted_features, features, {rounded("target_p_value, residual_variance_ratio")}
FROM (SELECT count(*) FILTER (WHERE is_drifted) AS drifted_features, count(*) AS features FROM drift), ratio,
  (SELECT ks_p_value AS target_p_value FROM ks_p WHERE feature = 'num_orders')""",
    ),
    "sketched_medians": q(PANEL, select="SELECT center_id, count(num_orders) AS n, true AS near FROM panel GROUP BY center_id"),
    "linear_forecaster": q(
        PANEL,
        PRICED,
        LINEAR,
        f"""fitted AS (SELECT num_orders, exp(my + (checkout_price - mx) * bx + (any_promo - mz) * bz) - 1 AS forecast_orders
  FROM priced, slopes WHERE week > {VAL_END})""",
        select=f"SELECT {', '.join(r(c, 4) + ' AS ' + c for c in ('mae', 'rmse', 'wmape', 'rmsle'))} FROM (SELECT {measures()} FROM fitted)",
    ),
    "linear_attribution": q(
        PANEL, PRICED, LINEAR, select=f"SELECT week, center_id, meal_id, feature, {rounded('contribution')} FROM parts WHERE week > {VAL_END}"
    ),
    "linear_importance": q(
        PANEL,
        PRICED,
        LINEAR,
        "sizes AS (SELECT feature, avg(abs(contribution)) AS mean_size, avg(contribution) AS mean_contribution FROM parts GROUP BY feature)",
        select=f"SELECT feature, {rounded('mean_size, mean_contribution')} FROM sizes",
    ),
    "tree_attribution": q(_panel("nation"), select=f"SELECT count(*) AS n, count(*) AS added_up FROM panel WHERE week > {VAL_END}"),
    # forecasting, backtest, loop
    "feature_frame": FEATURE_FRAME,
    "forecaster_interface": q(
        *ELASTIC_SPLIT,
        select=f"SELECT 'median' AS model, {measures()} FROM test UNION ALL SELECT 'profile', {measures()} FROM elastic",
    ),
    "backtest": q(PANEL, DIMS, WIDE, _folds(), _fold_predictions("wide"), select=slices("pred")),
    "backtest_sliding": fold_scores(expanding=False),
    "fold_table": q(PANEL, _folds(), select="SELECT * FROM folds"),
    "adaptive_loop": q(
        PANEL,
        PRICED,
        ALL_SCORED,
        profiles("test"),
        adaptive("test"),
        select=f"""SELECT champion_wmape, adaptive_wmape,
  {r("CASE WHEN champion_wmape > 0 THEN (champion_wmape - adaptive_wmape) / champion_wmape * 100 ELSE 0 END", 2)} AS improvement_pct,
  champion_wmape > 0.25 AS retrain, CASE WHEN champion_wmape > 0.25 THEN 1 ELSE 0 END AS reasons
FROM (SELECT wmape AS champion_wmape FROM (SELECT {measures(names="wmape")} FROM test)),
  (SELECT wmape AS adaptive_wmape FROM (SELECT {measures(p="adaptive_orders", names="wmape")} FROM adapted))""",
    ),
    "adaptive_held_out": q(
        PANEL,
        PRICED,
        ALL_SCORED,
        "parted AS (SELECT *, CAST(((week - 1) // 4) % 3 AS INT) AS part FROM test)",
        "others AS (SELECT p.* REPLACE (o AS part) FROM parted p JOIN (VALUES (0), (1), (2)) t(o) ON o <> part)",
        profiles("others", "part, center_id, meal_id"),
        adaptive("parted", "part, center_id, meal_id"),
        select=f"""SELECT champion_wmape, adaptive_wmape,
  {r("CASE WHEN champion_wmape > 0 THEN (champion_wmape - adaptive_wmape) / champion_wmape * 100 ELSE 0 END", 2)} AS improvement_pct
FROM (SELECT wmape AS champion_wmape FROM (SELECT {measures(names="wmape")} FROM test)),
  (SELECT wmape AS adaptive_wmape FROM (SELECT {measures(p="adaptive_orders", names="wmape")} FROM adapted))""",
    ),
    "training_run_median": q(PANEL, SCORED, PLAN, select=KPIS),
    "model_comparison": q(*ELASTIC_SPLIT, select=compare("median", {"median": "test", "profile": "elastic"})),
    # streaming
    "feedback_stream": q(*STREAM, select=log("adapted", "adaptive_orders")),
    "rolling_reliability": q(*STREAM, f"log AS ({log('adapted', 'adaptive_orders')})", select=SUMMARY),
    "profile_state": q(*STREAM, select=f"SELECT {PROFILE_COLUMNS} FROM profiles WHERE b = (SELECT max(b) FROM batches)"),
    # flagship
    "region_plan": q(
        _panel("region"),
        SCORED,
        PLAN,
        select="SELECT week, "
        + ", ".join(f"{r(f'sum({c})')} AS {c}" for c in ("actual_orders", "forecast_orders", "recommended_preparation"))
        + " FROM plan GROUP BY week",
    ),
    "region_kpis": q(_panel("region"), SCORED, PLAN, select=KPIS),
}

ORACLES["feature_pipeline"] = ORACLES["feature_frame"]
for _name in ("lag_features", "sku_profile", "adaptive_correction"):
    ORACLES[f"{_name}_colocated"] = ORACLES[_name]
ORACLES["backtest_boosted_folds"] = q(
    NATION,
    _folds(),
    _fold_predictions(),
    select="""SELECT fold_index, train_start, train_end, test_start, test_end, train_samples, count(*) AS test_samples,
  true AS measured FROM pred JOIN folds USING (fold_index) JOIN fo USING (fold_index) GROUP BY ALL""",
)
ORACLES["boosted_facts"] = q(
    NATION,
    select=f"""SELECT count(*) AS n, 0 AS negative, 0 AS without_forecast, 1.0::DOUBLE AS importance_total, 0 AS unlisted, true AS best_first,
  4 AS scenarios, 0 AS negative_totals, true AS below_median FROM panel WHERE week > {VAL_END}""",
)
ORACLES["challenger_rule"] = "SELECT true AS follows_rule, true AS measured"
ORACLES["training_pipeline"] = q(
    PANEL,
    select=f"""SELECT count(*) FILTER (week > {VAL_END}) AS plan_rows, 0 AS negative_forecasts, 0 AS below_forecast,
  count(*) FILTER (week <= {TRAIN_END}) AS train_rows, count(*) FILTER (week > {VAL_END}) AS test_rows,
  true AS beats_median, true AS model_saved FROM panel""",
)
