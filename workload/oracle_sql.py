"""The registered queries as SQL text over the given tables.

Each text stands alone: a prefix of common table expressions maps the given tables onto the retail
star, the rest is the question. Amounts are rounded as DECIMAL and leave as DOUBLE.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

STAR = """
dim_product AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
         CAST(p_retailprice AS DECIMAL(12,2)) AS list_price,
         CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.60 AS DECIMAL(3,2)) AS unit_cost
  FROM part),
dim_customer AS (
  SELECT c_custkey AS customer_id, r_name AS region, n_name AS country, c_mktsegment AS customer_segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
fact_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderdate AS order_ts, o_orderpriority AS channel,
         CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'O' THEN 'RETURNED' WHEN 'F' THEN 'COMPLETED' END AS order_status
  FROM orders),
fact_order_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
         CAST(p_retailprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS unit_price,
         CAST(l_quantity AS INT) * CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount
  FROM lineitem JOIN part ON l_partkey = p_partkey),
lines AS (
  SELECT i.order_id, o.order_date, o.channel, o.order_status, o.customer_id, i.product_id, d.product_name,
         d.category, d.subcategory, i.quantity, i.unit_price, d.unit_cost, i.discount_amount,
         i.quantity * i.unit_price AS line_revenue,
         i.quantity * (i.unit_price - d.unit_cost) AS line_profit,
         i.quantity * d.unit_cost AS line_cost
  FROM fact_order_items i JOIN fact_orders o USING (order_id) JOIN dim_product d USING (product_id)),
sales AS (SELECT * FROM lines WHERE order_status <> 'CANCELLED'),
categories AS (
  SELECT * FROM (VALUES (0,'ECONOMY'),(1,'LARGE'),(2,'MEDIUM'),(3,'PROMO'),(4,'SMALL'),(5,'STANDARD')) v(n, category)),
channels AS (
  SELECT * FROM (VALUES (0,'Paid Search'),(1,'Paid Social'),(2,'Email'),(3,'Display')) v(n, channel)),
campaigns AS (
  SELECT c.category, CAST(ts AS DATE) AS start_date, h.channel,
         COALESCE(SUM(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'click'), 0) AS spend_usd,
         CAST(COUNT(*) FILTER (event_type = 'view') AS BIGINT) AS impressions,
         CAST(COUNT(*) FILTER (event_type = 'click') AS BIGINT) AS clicks,
         CAST(COUNT(*) FILTER (event_type = 'purchase') AS BIGINT) AS conversions,
         COALESCE(SUM(CAST(value AS DECIMAL(12,2))) FILTER (event_type = 'purchase'), 0) AS attributed_revenue_usd
  FROM events JOIN categories c ON c.n = user_id % 6 JOIN channels h ON h.n = hour(ts) // 6
  GROUP BY ALL),
marketing AS (
  SELECT category || ' ' || CAST(start_date AS VARCHAR) || ' ' || channel AS campaign_name, *,
         ROUND(CAST(attributed_revenue_usd AS DOUBLE) / CAST(spend_usd AS DOUBLE), 3) AS campaign_roi
  FROM campaigns WHERE spend_usd > 0),
history AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, category, SUM(line_revenue) AS revenue
  FROM sales GROUP BY 1, category
  HAVING last_day(month) <= (SELECT MAX(order_date) FROM sales)),
recent AS (
  SELECT category, AVG(revenue) AS recent_average FROM history WHERE month >= DATE '2001-05-01' GROUP BY category),
months AS (
  SELECT * FROM (VALUES (0, DATE '2001-08-01'), (1, DATE '2001-09-01'), (2, DATE '2001-10-01')) v(m, forecast_month)),
faults AS (
  SELECT * FROM (VALUES (0, 'ECONOMY', 0.1e0, 0.95e0, 1.05e0), (1, 'LARGE', 8.0e0, 1.05e0, 1.15e0),
                        (2, 'MEDIUM', -0.1e0, 1.05e0, 0.95e0), (3, 'PROMO', 1.0e0, -4.0e0, 6.0e0),
                        (4, 'SMALL', 1.0e0, 0.95e0, 1.05e0), (5, 'STANDARD', 0.9e0, 0.95e0, 1.05e0)) v(k, category, factor, low, high)),
forecasts AS (
  SELECT 8001 + k * 3 + m AS forecast_id, category, forecast_month,
         ROUND(recent_average * factor, 2) AS forecast_revenue_usd,
         ROUND(ROUND(recent_average * factor, 2) * low, 2) AS lower_bound_usd,
         ROUND(ROUND(recent_average * factor, 2) * high, 2) AS upper_bound_usd
  FROM recent JOIN faults USING (category) CROSS JOIN months),
sums AS (
  SELECT category, SUM(line_revenue) AS revenue, SUM(line_profit) AS profit, SUM(quantity) AS units,
         COUNT(*) AS n, SUM(line_revenue) FILTER (order_date <= DATE '1995-03-31') AS r_first,
         SUM(line_revenue) FILTER (order_date BETWEEN DATE '2001-05-01' AND DATE '2001-07-31') AS r_last
  FROM sales GROUP BY category),
spend AS (
  SELECT category, SUM(spend_usd) AS spend, SUM(attributed_revenue_usd) AS attributed
  FROM marketing GROUP BY category)
"""


def add(name: str, body: str, *tables: str) -> None:
    """Register a query; ``tables`` are further common table expressions."""
    SQL[name] = "WITH " + ",\n".join([STAR.strip(), *[t.strip() for t in tables]]) + "\n" + body.strip()


def pct(a: str, b: str, digits: int, scale: int = 100) -> str:
    return f"ROUND({scale}e0 * (CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)), {digits})"


def amount(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND({expr}, {digits}) AS DOUBLE)"


def whole(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


# --- Sources, ingestion, storage --------------------------------------------------------------

add("load_audit", """
SELECT COALESCE(table_name, 'TOTAL') AS table_name, CAST(SUM(row_count) AS BIGINT) AS row_count,
       CASE WHEN GROUPING(table_name) = 1 THEN 'TOTAL' ELSE MAX(status) END AS status
FROM (SELECT 'dim_product' AS table_name, COUNT(*) AS row_count, 'LOADED' AS status FROM dim_product
      UNION ALL SELECT 'dim_customer', COUNT(*), 'LOADED' FROM dim_customer
      UNION ALL SELECT 'fact_orders', COUNT(*), 'LOADED' FROM fact_orders
      UNION ALL SELECT 'fact_order_items', COUNT(*), 'LOADED' FROM fact_order_items
      UNION ALL SELECT 'fact_marketing_campaigns', COUNT(*), 'LOADED' FROM campaigns
      UNION ALL SELECT 'fact_sales_forecast', COUNT(*), 'LOADED' FROM forecasts
      UNION ALL SELECT 'fact_returns', NULL, 'MISSING')
GROUP BY ROLLUP (table_name)""")

add("csv_orders", """
SELECT order_id, CAST(customer_id AS INT) AS customer_id, order_date, strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts,
       CASE WHEN order_id % 4 <> 0 THEN channel END AS channel, order_status,
       CASE WHEN order_id % 3 = 0 THEN CAST(CAST(customer_id % 50 / 4e0 AS DECIMAL(10,2)) AS DOUBLE) END AS shipping_cost
FROM fact_orders""")

ORDERS = """
SELECT order_id, customer_id, order_date, strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts, channel, order_status"""
MARK = "(SELECT MAX(order_ts) FROM fact_orders WHERE order_date < DATE '2000-01-01')"
add("extract_since", f"{ORDERS} FROM fact_orders WHERE order_ts > {MARK}")
add("extract_with_overlap", f"{ORDERS} FROM fact_orders WHERE order_ts > {MARK} - INTERVAL 10 DAY")

VERSIONS = """
versions AS (
  SELECT *, 0 AS is_update FROM fact_orders WHERE order_date < DATE '2001-01-01'
  UNION ALL SELECT *, 1 FROM fact_orders WHERE order_date >= DATE '2000-07-01'
  UNION ALL SELECT order_id, customer_id, order_date, order_ts + INTERVAL 1 HOUR, channel, 'RETURNED', 1
            FROM fact_orders WHERE order_date >= DATE '2000-07-01'
  UNION ALL SELECT order_id, customer_id, order_date, order_ts + INTERVAL 2 HOUR, channel, 'COMPLETED', 1
            FROM fact_orders WHERE order_date >= DATE '2000-07-01' AND channel = '1-URGENT'
  UNION ALL SELECT order_id, customer_id, order_date, order_ts - INTERVAL 1 HOUR, channel, 'CANCELLED', 1
            FROM fact_orders WHERE order_date < DATE '1996-01-01')"""

for merged in ("upsert_orders", "latest_orders", "merged_orders"):
    add(merged, f"""{ORDERS} FROM (SELECT * FROM versions
QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_ts DESC, is_update DESC) = 1)""", VERSIONS)

add("ingested_orders", f"{ORDERS} FROM fact_orders")
add("compacted_orders", f"{ORDERS} FROM fact_orders WHERE order_date < DATE '2002-01-01'")

add("ingested_deletions", """
SELECT 'dim_product' AS table_name, CAST(product_id AS BIGINT) AS key, category AS value FROM dim_product
WHERE product_id % 7 <> 0 OR product_id % 14 = 0
UNION ALL SELECT 'dim_customer', customer_id, region FROM dim_customer WHERE customer_id % 7 <> 0 OR customer_id % 14 = 0
UNION ALL SELECT 'fact_orders', order_id, order_status FROM fact_orders WHERE order_id % 7 <> 0""")

add("streamed_orders", """
SELECT order_id, CAST(customer_id AS INT) AS customer_id, order_date,
       CASE WHEN order_date < DATE '1998-01-01' AND order_id % 3 = 0
            THEN regexp_replace(strftime(order_ts, '%Y-%m-%d %H:%M:%S'), '00:00:00$', '12:00:00')
            ELSE strftime(order_ts, '%Y-%m-%d %H:%M:%S') END AS order_ts, channel,
       CASE WHEN order_date < DATE '1998-01-01' AND order_id % 3 = 0 THEN 'RETURNED' ELSE order_status END AS order_status
FROM fact_orders WHERE order_date < DATE '1998-01-01' OR order_id % 50 <> 0""")

add("streamed_rejects", """
SELECT order_id || ',' || customer_id || ',' || order_date || ',no time,' || channel || ',' || order_status || ',' AS line
FROM fact_orders WHERE order_date >= DATE '1998-01-01' AND order_id % 50 = 0""")

add("ingested_tables", """
SELECT 'dim_product' AS table_name, category AS value, COUNT(*) AS row_count FROM dim_product GROUP BY ALL
UNION ALL SELECT 'dim_customer', region, COUNT(*) FROM dim_customer GROUP BY ALL
UNION ALL SELECT 'fact_orders', order_status, COUNT(*) FROM fact_orders GROUP BY ALL
UNION ALL SELECT 'fact_order_items', order_id || '-' || product_id, 1 FROM fact_order_items GROUP BY order_id, product_id
UNION ALL SELECT 'fact_marketing_campaigns', category, COUNT(*) FROM campaigns GROUP BY ALL
UNION ALL SELECT 'fact_sales_forecast', category, COUNT(*) FROM forecasts GROUP BY ALL""")

# --- Silver -----------------------------------------------------------------------------------

add("sales_lines", """
SELECT order_id, order_date, channel, order_status, customer_id, product_id, product_name, category,
       subcategory, quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost,
       CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(line_revenue AS DOUBLE) AS line_revenue,
       CAST(line_profit AS DOUBLE) AS line_profit
FROM sales""")

add("sales_without_status", """
SELECT order_status, COUNT(*) AS lines FROM sales WHERE customer_id % 10 <> 0 GROUP BY order_status""")

add("order_lines", """
SELECT order_id, product_id, order_status, quantity, CAST(line_revenue AS DOUBLE) AS line_revenue,
       CAST(line_profit AS DOUBLE) AS line_profit, CAST(line_cost AS DOUBLE) AS line_cost
FROM lines""")

add("sales_with_customer", """
SELECT order_id, customer_id, category, region, country, customer_segment,
       CAST(line_revenue AS DOUBLE) AS line_revenue
FROM sales JOIN dim_customer USING (customer_id)""")

add("silver_marketing", """
SELECT campaign_name, category, channel, start_date, CAST(spend_usd AS DOUBLE) AS spend_usd, impressions,
       clicks, conversions, CAST(attributed_revenue_usd AS DOUBLE) AS attributed_revenue_usd, campaign_roi
FROM marketing""")

add("returned_preview", """
SELECT order_id, product_name, quantity, CAST(line_revenue AS DOUBLE) AS line_revenue
FROM sales WHERE order_status = 'RETURNED' AND category = 'PROMO'""")

add("spring_orders", f"""{ORDERS} FROM fact_orders
WHERE order_date BETWEEN DATE '2000-03-01' AND DATE '2000-05-31'""")

DAILY = f"""
daily AS (
  SELECT order_date, category, ROUND(SUM(line_revenue), 2) AS daily_revenue,
         ROUND(SUM(line_profit), 2) AS daily_profit, {whole('SUM(quantity)')} AS daily_units,
         {whole('COUNT(DISTINCT order_id)')} AS orders
  FROM sales GROUP BY ALL)"""
DAILY_COLUMNS = """
order_date, category, CAST(daily_revenue AS DOUBLE) AS daily_revenue,
CAST(daily_profit AS DOUBLE) AS daily_profit, daily_units, orders"""

add("last_90_days", f"""
SELECT {DAILY_COLUMNS} FROM daily
WHERE order_date > (SELECT MAX(order_date) FROM sales) - INTERVAL 90 DAY""", DAILY)

add("last_6_months", f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, category, {amount('SUM(line_revenue)')} AS revenue
FROM sales
WHERE date_trunc('month', order_date) >= (SELECT date_trunc('month', MAX(order_date)) FROM sales) - INTERVAL 5 MONTH
GROUP BY ALL""")

# --- Gold -------------------------------------------------------------------------------------

for performance in ("category_performance", "stored_category_performance"):
    add(performance, f"""
SELECT category, {amount('revenue')} AS total_revenue, {amount('profit')} AS total_profit,
       {whole('units')} AS units_sold, n AS order_lines, {pct('profit', 'revenue', 1)} AS profit_margin_pct,
       {amount('spend')} AS marketing_spend, {amount('attributed')} AS marketing_attributed_revenue,
       {pct('attributed', 'spend', 2, 1)} AS marketing_roi
FROM sums LEFT JOIN spend USING (category)""")

for stored in ("daily_revenue", "stored_daily_revenue"):
    add(stored, f"SELECT {DAILY_COLUMNS} FROM daily", DAILY)

add("refreshed_daily_revenue", f"""
SELECT order_date, category, {amount('SUM(line_revenue)')} AS daily_revenue, {amount('SUM(line_profit)')} AS daily_profit,
       {whole('SUM(quantity)')} AS daily_units, {whole('COUNT(DISTINCT order_id)')} AS orders
FROM sales WHERE order_date NOT BETWEEN DATE '2001-06-05' AND DATE '2001-06-25' GROUP BY order_date, category""")

add("sales_of_heavy_keys", f"""
SELECT order_id, product_id, o.customer_id, d.category, quantity, {amount('quantity * unit_price', 4)} AS line_revenue
FROM (SELECT CASE WHEN order_id % 3 = 0 THEN 3 ELSE order_id END AS order_id,
             CASE WHEN order_id % 3 = 1 THEN 7 ELSE product_id END AS product_id, quantity, unit_price
      FROM fact_order_items) JOIN fact_orders o USING (order_id) JOIN dim_product d USING (product_id)""")

add("product_history", f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, product_id, {amount('SUM(line_revenue)')} AS revenue
FROM sales GROUP BY 1, product_id HAVING last_day(month) <= (SELECT MAX(order_date) FROM sales)""")

LEFT_OVER = """
left_over AS (
  SELECT * FROM sales WHERE order_date NOT BETWEEN DATE '2001-06-05' AND DATE '2001-06-25' AND order_date < DATE '2001-07-01')"""
add("refreshed_category_performance", f"""
SELECT category, {amount('SUM(line_revenue)')} AS total_revenue, {amount('SUM(line_profit)')} AS total_profit,
       {whole('SUM(quantity)')} AS units_sold, COUNT(*) AS order_lines,
       {pct('SUM(line_profit)', 'SUM(line_revenue)', 1)} AS profit_margin_pct,
       {amount('ANY_VALUE(spend)')} AS marketing_spend, {amount('ANY_VALUE(attributed)')} AS marketing_attributed_revenue,
       {pct('ANY_VALUE(attributed)', 'ANY_VALUE(spend)', 2, 1)} AS marketing_roi
FROM left_over LEFT JOIN spend USING (category) GROUP BY category""", LEFT_OVER)

add("refreshed_order_counts", """
SELECT 'day and category' AS grain, order_date AS period, category, COUNT(DISTINCT order_id) AS orders
FROM left_over GROUP BY order_date, category
UNION ALL SELECT 'month and category', CAST(date_trunc('month', order_date) AS DATE), category, COUNT(DISTINCT order_id)
FROM left_over GROUP BY ALL
UNION ALL SELECT 'category', NULL, category, COUNT(DISTINCT order_id) FROM left_over GROUP BY category
UNION ALL SELECT 'total', NULL, NULL, COUNT(DISTINCT order_id) FROM left_over""", LEFT_OVER)

for dimension in ("category", "channel"):
    add(f"marketing_by_{dimension}", f"""
SELECT {dimension}, COUNT(*) AS campaigns, {amount('SUM(spend_usd)', 0)} AS total_spend,
       {amount('SUM(attributed_revenue_usd)', 0)} AS total_attributed,
       {pct('SUM(attributed_revenue_usd)', 'SUM(spend_usd)', 2, 1)} AS blended_roi
FROM marketing GROUP BY {dimension}""")

add("status_counts", "SELECT order_status, COUNT(*) AS lines FROM sales GROUP BY order_status")

add("overall_kpis", f"""
SELECT {amount('SUM(line_revenue)')} AS total_revenue, {amount('SUM(line_cost)')} AS total_cost,
       {amount('SUM(line_profit)')} AS total_profit, {pct('SUM(line_profit)', 'SUM(line_revenue)', 1)} AS overall_margin_pct,
       {amount('SUM(line_revenue) - SUM(line_cost) - SUM(line_profit)')} AS profit_identity
FROM sales""")

add("date_coverage", """
SELECT MIN(order_date) AS first_day, MAX(order_date) AS last_day, COUNT(DISTINCT order_date) AS distinct_days
FROM sales""")

add("rough_peek", f"""
SELECT category, {amount('SUM(line_revenue)', 0)} AS gross_revenue_usd, {whole('SUM(quantity)')} AS units_sold
FROM sales GROUP BY category""")

# --- Business questions -----------------------------------------------------------------------

KPIS = f"""
{amount('SUM(line_revenue)')} AS total_revenue, {amount('SUM(line_profit)')} AS total_profit,
{pct('SUM(line_profit)', 'SUM(line_revenue)', 1)} AS profit_margin_pct, {whole('SUM(quantity)')} AS units_sold,
COUNT(*) AS order_lines, {pct('SUM(line_revenue)', 'COUNT(*)', 2, 1)} AS avg_line_value"""

add("kpi_category", f"SELECT category, {KPIS} FROM sales GROUP BY category")
add("kpi_channel", f"SELECT channel, {KPIS} FROM sales GROUP BY channel")
add("kpi_region_country",
    f"SELECT region, country, {KPIS} FROM sales JOIN dim_customer USING (customer_id) GROUP BY region, country")
add("kpi_segment",
    f"SELECT customer_segment, {KPIS} FROM sales JOIN dim_customer USING (customer_id) GROUP BY customer_segment")

add("categories_by_revenue", f"SELECT category, {KPIS} FROM sales GROUP BY category ORDER BY total_revenue DESC, category LIMIT 3")
add("countries_by_region", f"""
SELECT region, country, {KPIS} FROM sales JOIN dim_customer USING (customer_id) GROUP BY region, country
ORDER BY region, total_profit DESC, country LIMIT 7""")

add("rank_categories", f"""
SELECT category, {amount('profit')} AS total_profit, RANK() OVER (ORDER BY ROUND(profit, 2) DESC) AS rank FROM sums""")

add("rank_disagreement", f"""
SELECT *, units_rank <> profit_rank AS disagrees
FROM (SELECT category, {whole('units')} AS units_sold, {amount('profit')} AS total_profit,
             RANK() OVER (ORDER BY units DESC) AS units_rank,
             RANK() OVER (ORDER BY ROUND(profit, 2) DESC) AS profit_rank FROM sums)""")

add("rank_customers", f"""
SELECT customer_id, {whole('SUM(quantity)')} AS units, RANK() OVER (ORDER BY SUM(quantity) DESC) AS units_rank
FROM sales GROUP BY customer_id""")

add("monthly_trend", f"""
SELECT category, month, CAST(revenue AS DOUBLE) AS revenue, CAST(before AS DOUBLE) AS previous_revenue,
       {pct('revenue - before', 'before', 1)} AS growth_pct
FROM (SELECT *, LAG(revenue) OVER (PARTITION BY category ORDER BY month) AS before
      FROM (SELECT category, CAST(date_trunc('month', order_date) AS DATE) AS month,
                   ROUND(SUM(line_revenue), 2) AS revenue
            FROM sales GROUP BY ALL))""")

add("discount_depth", f"""
SELECT category, {amount('SUM(discount_amount)')} AS total_discount,
       {pct('SUM(discount_amount)', 'SUM(line_revenue) + SUM(discount_amount)', 2)} AS discount_pct,
       {pct('COUNT(*) FILTER (discount_amount > 0)', 'COUNT(*)', 2)} AS promo_line_pct
FROM sales GROUP BY category""")

add("status_rates", f"""
SELECT category, COUNT(*) AS order_lines, COUNT(*) FILTER (order_status = 'RETURNED') AS returned_lines,
       COUNT(*) FILTER (order_status = 'CANCELLED') AS cancelled_lines,
       {pct("COUNT(*) FILTER (order_status = 'RETURNED')", 'COUNT(*)', 2)} AS return_rate_pct,
       {pct("COUNT(*) FILTER (order_status = 'CANCELLED')", 'COUNT(*)', 2)} AS cancel_rate_pct
FROM lines GROUP BY category""")

for name, dimension in (("marketing_funnel", "category"), ("marketing_funnel_channel", "channel")):
    add(name, f"""
SELECT {dimension}, {whole('SUM(impressions)')} AS impressions, {whole('SUM(clicks)')} AS clicks,
       {whole('SUM(conversions)')} AS conversions, {amount('SUM(spend_usd)')} AS spend_usd,
       {pct('SUM(clicks)', 'SUM(impressions)', 3)} AS ctr_pct, {pct('SUM(conversions)', 'SUM(clicks)', 3)} AS cvr_pct,
       {pct('SUM(spend_usd)', 'SUM(conversions)', 2, 1)} AS cost_per_conversion
FROM marketing GROUP BY {dimension}""")

PRODUCTS = f"""
product_sums AS (
  SELECT product_id, product_name, category, {amount('SUM(line_revenue)')} AS revenue,
         {amount('SUM(line_profit)')} AS profit, {whole('SUM(quantity)')} AS units
  FROM sales GROUP BY ALL)"""
add("product_performance", "SELECT * FROM product_sums", PRODUCTS)
add("top_products", "SELECT * FROM product_sums ORDER BY profit DESC, product_id LIMIT 5", PRODUCTS)
add("top_customers", f"""
SELECT customer_id, {amount('SUM(line_revenue)')} AS revenue FROM sales GROUP BY customer_id
ORDER BY revenue DESC, customer_id LIMIT 10""")

add("leaders", """
SELECT best_margin_category, best_profit_category, best_margin_category = best_profit_category AS same_category
FROM (SELECT arg_max(category, CAST(profit AS DOUBLE) / CAST(revenue AS DOUBLE)) AS best_margin_category,
             arg_max(category, profit) AS best_profit_category FROM sums)""")

add("shop_overview", """
SELECT COUNT(DISTINCT order_id) AS orders, COUNT(*) AS order_lines, MIN(order_date) AS first_day,
       MAX(order_date) AS last_day, string_agg(DISTINCT category, ', ' ORDER BY category) AS categories
FROM sales""")

add("forecast_by_category", """
SELECT category, ROUND(AVG(forecast_revenue_usd), 0) AS forecast, ROUND(AVG(lower_bound_usd), 0) AS lower_bound,
       ROUND(AVG(upper_bound_usd), 0) AS upper_bound
FROM forecasts GROUP BY category""")

BUSINESS = f"""
business AS (
  SELECT order_date, {amount('SUM(line_revenue)')} AS revenue, {amount('SUM(line_profit)')} AS profit,
         {pct('SUM(line_profit)', 'SUM(line_revenue)', 1)} AS operating_margin_pct
  FROM sales GROUP BY order_date)"""
add("daily_business", "SELECT * FROM business", BUSINESS)
add("latest_margin", "SELECT order_date, operating_margin_pct FROM business ORDER BY order_date DESC LIMIT 1", BUSINESS)
add("margin_alert", "SELECT * FROM business WHERE operating_margin_pct < 36.5", BUSINESS)

add("category_decision", f"""
SELECT category, {amount('profit', 0)} AS profit, {amount('revenue', 0)} AS revenue,
       {pct('profit', 'revenue', 1)} AS profit_margin_pct, {whole('units')} AS units_sold,
       {pct('attributed', 'spend', 2, 1)} AS marketing_roi
FROM sums LEFT JOIN spend USING (category)""")

# --- Metric views -----------------------------------------------------------------------------

DIMENSIONS = {
    "Category": "category", "Channel": "channel", "Subcategory": "subcategory", "Product": "product_name",
    "Order Date": "order_date", "Order Month": "CAST(date_trunc('month', order_date) AS DATE)",
}
MEASURES = {
    "Total Revenue": amount("SUM(line_revenue)"),
    "Total Cost": amount("SUM(line_cost)"),
    "Total Profit": amount("SUM(line_profit)"),
    "Profit Margin Pct": pct("SUM(line_profit)", "SUM(line_revenue)", 4),
    "Units Sold": whole("SUM(quantity)"),
    # Exact half-up rounding to 4 places in whole numbers; DOUBLE division can fall below a half.
    "Avg Order Line Value": "CAST((2 * CAST(SUM(line_revenue) * 10000 AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE)"
                            " / 10000e0",
}


def metrics(by: list[str], names: list[str] | None = None, where: str = "", flat: bool = False) -> str:
    def label(name: str) -> str:
        return '"' + (name.replace(" ", "_") if flat else name) + '"'

    columns = [f"{DIMENSIONS[d]} AS {label(d)}" for d in by]
    columns += [f"{MEASURES[m]} AS {label(m)}" for m in names or MEASURES]
    group = f" GROUP BY {', '.join(DIMENSIONS[d] for d in by)}" if by else ""
    return f"SELECT {', '.join(columns)} FROM sales {where}{group}"


add("metrics_sales_flat", metrics(list(DIMENSIONS), flat=True))
add("metrics_sales_by_category", metrics(["Category"]))
add("metrics_sales_by_month", metrics(["Order Month", "Channel"]))
add("metrics_sales_sliced", metrics(["Subcategory"], where="""
WHERE category IN ('LARGE', 'SMALL') AND channel = '5-LOW'
  AND order_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'""")
    + ' ORDER BY "Total Profit" DESC, "Subcategory" LIMIT 3')
add("metrics_routed_by_category", metrics(["Category"], where="""
WHERE channel IN ('5-LOW', '2-HIGH') AND order_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"""))
add("metrics_routed_by_subcategory", metrics(["Subcategory"], where="WHERE channel = '5-LOW'"))
add("metrics_overall", metrics([]))

MARKETING_MEASURES = f"""
CAST(SUM(spend_usd) AS DOUBLE) AS "Marketing Spend", CAST(SUM(attributed_revenue_usd) AS DOUBLE) AS "Attributed Revenue",
{pct('SUM(attributed_revenue_usd)', 'SUM(spend_usd)', 4, 1)} AS "Marketing ROI",
{whole('SUM(conversions)')} AS "Conversions" """
add("metrics_marketing", f'SELECT category AS "Category", {MARKETING_MEASURES} FROM marketing GROUP BY category')
add("metrics_marketing_flat", f"""
SELECT "Category", "Marketing Channel" AS "Marketing_Channel", "Marketing Spend" AS "Marketing_Spend",
       "Attributed Revenue" AS "Attributed_Revenue", "Marketing ROI" AS "Marketing_ROI", "Conversions"
FROM (SELECT category AS "Category", channel AS "Marketing Channel", {MARKETING_MEASURES}
      FROM marketing GROUP BY category, channel)""")
add("metrics_ratio_only", f"""
SELECT channel AS "Marketing Channel", {pct('SUM(attributed_revenue_usd)', 'SUM(spend_usd)', 4, 1)} AS "Marketing ROI"
FROM marketing GROUP BY channel""")
add("metrics_formatted", f"""
SELECT category AS "Category", '$' || format('{{:,.2f}}', {amount('revenue')}) AS "Total Revenue",
       {whole('units')} AS "Units Sold" FROM sums""")
add("drill_across_views", f"""
SELECT COALESCE(s.category, m.category) AS "Category", {amount('s.profit')} AS "Total Profit",
       {whole('s.units')} AS "Units Sold", m.roi AS "Marketing ROI", m.conversions AS "Conversions"
FROM sums s FULL JOIN (
  SELECT category, {pct('SUM(attributed_revenue_usd)', 'SUM(spend_usd)', 4, 1)} AS roi,
         {whole('SUM(conversions)')} AS conversions
  FROM marketing GROUP BY category) m ON s.category = m.category""")

# --- Time series and forecasts ----------------------------------------------------------------

add("monthly_history", f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, category, {amount('SUM(line_revenue)')} AS revenue
FROM sales GROUP BY ALL""")


add("viewed_monthly_history", f"SELECT month, category, {amount('revenue')} AS revenue FROM history")


def line_fit(points: str, group: str) -> str:
    """Least-squares line and residual spread per group of (x, y) points."""
    return f"""
fit AS (
  SELECT {group}, MAX(t) AS last_t, COUNT(*) AS n, AVG(y) AS ym, AVG(x) AS xm, COALESCE(regr_slope(y, x), 0) AS b,
         MAX(x) - MIN(x) + 1 AS span,
         CASE WHEN COUNT(*) > 2 THEN
           sqrt(greatest(regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x), 0) / (COUNT(*) - 2))
         ELSE 0 END AS spread
  FROM {points} GROUP BY {group})"""


MONTH_POINTS = """
points AS (
  SELECT category, month AS t, (year(month) - 1970) * 12 + month(month) - 1 AS x, CAST(revenue AS DOUBLE) AS y
  FROM history)"""
MONTH_FIT = line_fit("points", "category")
TREND = """
trend AS (
  SELECT category, forecast_month, ym + b * ((year(forecast_month) - 1970) * 12 + month(forecast_month) - 1 - xm) AS p,
         spread
  FROM fit CROSS JOIN months)"""

add("forecast_trend", """
SELECT category, forecast_month AS month, ROUND(p, 2) AS revenue_forecast,
       ROUND(p - 1.96e0 * spread, 2) AS revenue_lower, ROUND(p + 1.96e0 * spread, 2) AS revenue_upper, 'line' AS model
FROM trend""", MONTH_POINTS, MONTH_FIT, TREND)

add("forecast_to_month_end", """
SELECT category, forecast_month AS month, ROUND(p, 2) AS revenue_forecast,
       ROUND(p - 1.96e0 * spread, 2) AS revenue_lower, ROUND(p + 1.96e0 * spread, 2) AS revenue_upper, 'line' AS model
FROM trend WHERE forecast_month <= DATE '2001-09-30'""", MONTH_POINTS, MONTH_FIT, TREND)

add("forecast_quarters", """
SELECT category, quarter, ROUND(p, 2) AS revenue_forecast, ROUND(p - 1.96e0 * spread, 2) AS revenue_lower,
       ROUND(p + 1.96e0 * spread, 2) AS revenue_upper, model
FROM (SELECT f.category, CAST(f.q AS DATE) AS quarter, f.line + COALESCE(s.shift, 0) AS p, f.spread,
             CASE WHEN f.span >= 8 THEN 'line and season' ELSE 'line' END AS model
      FROM (SELECT category, u.q, spread, span, ym + b * ((year(u.q) - 1970) * 4 + quarter(u.q) - 1 - xm) AS line
            FROM fit, unnest(generate_series(CAST(last_t AS TIMESTAMP) + INTERVAL 3 MONTH, TIMESTAMP '2002-06-30', INTERVAL 3 MONTH)) u(q)) f
      LEFT JOIN (SELECT category, quarter(t) AS season, AVG(y - (ym + b * (x - xm))) AS shift
                 FROM points JOIN fit USING (category) WHERE span >= 8 GROUP BY ALL) s
             ON s.category = f.category AND s.season = quarter(f.q))""", """
points AS (
  SELECT category, q AS t, (year(q) - 1970) * 4 + quarter(q) - 1 AS x, CAST(SUM(line_revenue) AS DOUBLE) AS y
  FROM (SELECT category, CAST(date_trunc('quarter', order_date) AS DATE) AS q, line_revenue FROM sales)
  GROUP BY category, q
  HAVING CAST(q + INTERVAL 3 MONTH AS DATE) <= (SELECT MAX(order_date) + 1 FROM sales))""", line_fit("points", "category"))

add("forecast_seasonal", """
SELECT category, month, ROUND(p, 2) AS revenue_forecast, ROUND(p - 1.96e0 * spread, 2) AS revenue_lower,
       ROUND(p + 1.96e0 * spread, 2) AS revenue_upper, model
FROM (SELECT f.category, CAST(f.month AS DATE) AS month, f.line + COALESCE(s.shift, 0) AS p, f.spread,
             CASE WHEN f.span >= 24 THEN 'line and season' ELSE 'line' END AS model
      FROM (SELECT category, u.month, spread, span,
                   ym + b * ((year(u.month) - 1970) * 12 + month(u.month) - 1 - xm) AS line
            FROM fit, unnest(generate_series(TIMESTAMP '2001-08-01', TIMESTAMP '2002-07-01', INTERVAL 1 MONTH)) u(month)) f
      LEFT JOIN (SELECT category, month(t) AS season, AVG(y - (ym + b * (x - xm))) AS shift
                 FROM points JOIN fit USING (category) WHERE span >= 24 GROUP BY ALL) s
             ON s.category = f.category AND s.season = month(f.month))""", MONTH_POINTS, MONTH_FIT)

add("forecast_weekly_by_product_line", """
SELECT subcategory, week, ROUND(p, 2) AS revenue_forecast, ROUND(p - 1.96e0 * spread, 2) AS revenue_lower,
       ROUND(p + 1.96e0 * spread, 2) AS revenue_upper, 'line' AS model
FROM (SELECT subcategory, CAST(w.week AS DATE) AS week, spread,
             ym + b * ((CAST(w.week AS DATE) - DATE '1970-01-01') // 7 - xm) AS p
      FROM fit, unnest(generate_series(CAST(last_t AS TIMESTAMP) + INTERVAL 7 DAY, TIMESTAMP '2001-09-27', INTERVAL 7 DAY)) w(week))
""", """
points AS (
  SELECT subcategory, DATE '1970-01-01' + CAST(week * 7 AS INT) AS t, week AS x, CAST(SUM(line_revenue) AS DOUBLE) AS y
  FROM (SELECT subcategory, (order_date - DATE '1970-01-01') // 7 AS week, line_revenue FROM sales)
  GROUP BY subcategory, week HAVING week * 7 + 6 <= (SELECT MAX(order_date) - DATE '1970-01-01' FROM sales))""",
    line_fit("points", "subcategory"))

add("baseline_forecast", f"""
SELECT category, forecast_month, {amount('recent_average')} AS forecast_revenue,
       ROUND(CAST(recent_average AS DOUBLE) * 0.9e0, 2) AS lower_bound,
       ROUND(CAST(recent_average AS DOUBLE) * 1.1e0, 2) AS upper_bound
FROM recent CROSS JOIN months""")

GROWTH = "ROUND((CAST({last} AS DOUBLE) / CAST({first} AS DOUBLE) - 1) * 100, {digits})"
add("growth", f"""
SELECT category, {amount('r_first')} AS first_revenue, {amount('r_last')} AS last_revenue,
       {GROWTH.format(first='r_first', last='r_last', digits=1)} AS growth_pct
FROM sums""")

SEASON = """
quarters AS (
  SELECT category, CAST(date_trunc('quarter', order_date) AS DATE) AS q, SUM(line_revenue) AS revenue
  FROM sales GROUP BY ALL),
season AS (
  SELECT category, COUNT(*) AS full_quarters,
         ROUND(100e0 * ((CAST(SUM(revenue) FILTER (quarter(q) = 4) AS DOUBLE) / COUNT(*) FILTER (quarter(q) = 4))
                        / (CAST(SUM(revenue) AS DOUBLE) / COUNT(*))), 1) AS q_index
  FROM quarters, (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM sales)
  WHERE q >= lo AND q + INTERVAL 3 MONTH <= hi + INTERVAL 1 DAY
  GROUP BY category)"""
add("seasonality_index", "SELECT * FROM season", SEASON)

# Texts that a reader of the report looks for.
ANOMALY = """
CASE WHEN forecast_revenue_usd < 0 THEN 'IMPOSSIBLE: negative revenue'
     WHEN lower_bound_usd > forecast_revenue_usd THEN 'BROKEN: lower bound above point forecast'
     WHEN upper_bound_usd - lower_bound_usd > 3 * abs(forecast_revenue_usd) THEN 'SUSPECT: uncertainty band absurdly wide'
END"""
add("forecast_anomalies", f"""
SELECT * FROM (SELECT category, forecast_month, forecast_revenue_usd, lower_bound_usd, upper_bound_usd,
                      {ANOMALY} AS anomaly FROM forecasts)
WHERE anomaly IS NOT NULL""")

COMPARISON = """
comparison AS (
  SELECT category, recent_monthly_actual, own_forecast, other_forecast, other_lower, other_upper,
         ROUND(other_forecast - own_forecast, 0) AS other_minus_own,
         ROUND(100 * ((other_forecast - recent_monthly_actual) / NULLIF(recent_monthly_actual, 0)), 0) AS other_vs_actual_pct
  FROM (SELECT category, CAST(ROUND(recent_average, 0) AS DOUBLE) AS recent_monthly_actual FROM recent)
  JOIN (SELECT category, ROUND(AVG(ROUND(p, 2)), 0) AS own_forecast FROM trend GROUP BY category) USING (category)
  JOIN (SELECT category, ROUND(AVG(forecast_revenue_usd), 0) AS other_forecast,
               ROUND(AVG(lower_bound_usd), 0) AS other_lower, ROUND(AVG(upper_bound_usd), 0) AS other_upper
        FROM forecasts GROUP BY category) USING (category))"""
FORECAST = (MONTH_POINTS, MONTH_FIT, TREND)
add("compare_forecasts", "SELECT * FROM comparison", *FORECAST, COMPARISON)
add("swing_anomalies", "SELECT * FROM comparison WHERE abs(other_vs_actual_pct) > 50", *FORECAST, COMPARISON)
add("forecast_disagreement", """
SELECT category, abs(other_minus_own) AS disagreement, RANK() OVER (ORDER BY abs(other_minus_own) DESC) AS place
FROM comparison""", *FORECAST, COMPARISON)

add("missing_dates", """
SELECT CAST(d AS DATE) AS missing_date
FROM (SELECT unnest(generate_series(CAST(MIN(order_date) AS TIMESTAMP), CAST(MAX(order_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d
      FROM sales)
WHERE CAST(d AS DATE) NOT IN (SELECT order_date FROM sales)""")

# --- Quality ----------------------------------------------------------------------------------

add("cancelled_leak", "SELECT COUNT(*) AS bad_rows FROM sales WHERE order_status = 'CANCELLED'")
add("row_parity", """
SELECT a AS actual_rows, e AS expected_rows, a = e AS same
FROM (SELECT COUNT(*) AS a FROM sales),
     (SELECT COUNT(*) AS e FROM fact_order_items JOIN fact_orders USING (order_id) WHERE order_status <> 'CANCELLED')""")
add("computed_violations", """
SELECT COUNT(*) AS bad_rows FROM sales
WHERE ROUND(line_revenue, 2) <> ROUND(unit_price * quantity, 2)
   OR ROUND(line_profit, 2) <> ROUND((unit_price - unit_cost) * quantity, 2)""")

add("reconcile_gold", f"""
SELECT category, {amount('revenue')} AS left_value, {amount('revenue')} AS right_value,
       {amount('ROUND(revenue, 2) - revenue')} AS difference FROM sums""")
add("reconcile_daily", f"""
SELECT category, CAST(d.v AS DOUBLE) AS left_value, {amount('s.revenue')} AS right_value,
       {amount('d.v - ROUND(s.revenue, 2)')} AS difference
FROM (SELECT category, SUM(daily_revenue) AS v FROM daily GROUP BY category) d FULL JOIN sums s USING (category)""", DAILY)
add("reconcile_metric", f"""
SELECT category, {amount('profit')} AS left_value, {amount('profit')} AS right_value, 0e0 AS difference FROM sums""")
add("reconcile_planted_gap", f"""
SELECT category, {amount('a')} AS left_value, {amount('b')} AS right_value, {amount('ROUND(a, 2) - ROUND(b, 2)')} AS difference
FROM (SELECT category, SUM(line_revenue) AS a,
             SUM(line_revenue) FILTER (category <> 'PROMO' OR channel <> '5-LOW') AS b FROM sales GROUP BY category)""")
add("profit_identity", f"""
SELECT {amount('SUM(line_revenue) - SUM(line_cost) - SUM(line_profit)')} AS difference,
       abs(SUM(line_revenue) - SUM(line_cost) - SUM(line_profit)) < 1 AS holds FROM sales""")


def key_check(fact: str, dimension: str, key: str) -> str:
    return f"""
SELECT '{key}' AS key_column,
       (SELECT COUNT(*) FROM {fact} WHERE {key} NOT IN (SELECT {key} FROM {dimension})) AS orphan_rows,
       (SELECT COUNT(*) FROM (SELECT {key} FROM {dimension} GROUP BY {key} HAVING COUNT(*) > 1)) AS duplicate_keys"""


add("key_checks", " UNION ALL ".join([
    key_check("fact_order_items", "fact_orders", "order_id"),
    key_check("fact_order_items", "dim_product", "product_id"),
    key_check("fact_orders", "dim_customer", "customer_id")]))
add("orphan_lines", key_check("fact_order_items", "one_year", "order_id"),
    "one_year AS (SELECT * FROM fact_orders WHERE year(order_date) = 1998)")

add("table_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS column_type, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count,
       COUNT(DISTINCT {c}) AS distinct_count, CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value
FROM fact_orders"""
    for c, t in (("order_id", "bigint"), ("customer_id", "bigint"), ("order_date", "date"), ("order_ts", "timestamp_ntz"),
                 ("channel", "string"),
                 ("order_status", "string"))))

add("roi_range", """
SELECT MIN(campaign_roi) AS min_value, MAX(campaign_roi) AS max_value,
       COUNT(*) FILTER (campaign_roi NOT BETWEEN 1.5 AND 5.0) AS outside_rows FROM marketing""")
add("category_coverage",
    "SELECT DISTINCT category FROM dim_product WHERE category NOT IN (SELECT category FROM marketing)")
add("customers_without_sales",
    "SELECT customer_id FROM dim_customer WHERE customer_id NOT IN (SELECT customer_id FROM sales)")

# --- Decision ---------------------------------------------------------------------------------

SUMMARY = f"""
summary AS (
  SELECT category, {amount('revenue', 0)} AS revenue, {amount('profit', 0)} AS profit,
         COALESCE({pct('profit', 'revenue', 1)}, 0) AS margin_pct, {whole('units')} AS units,
         CASE WHEN COALESCE(r_first, 0) = 0 THEN 0
              ELSE {GROWTH.format(first='r_first', last='COALESCE(r_last, 0)', digits=0)} END AS growth_pct,
         COALESCE({pct('attributed', 'spend', 1, 1)}, 0) AS marketing_roi
  FROM sums LEFT JOIN spend USING (category))"""
RESEARCH = """
tagged AS (
  SELECT c.category, user_id, event_type, day(ts) AS d, hour(ts) AS h, CAST(value AS DECIMAL(12,2)) AS amount
  FROM events JOIN categories c ON c.n = user_id % 6),
buyers AS (
  SELECT category, COUNT(*) AS n, COUNT(*) FILTER (purchases >= 2) AS again
  FROM (SELECT category, user_id, COUNT(*) AS purchases FROM tagged WHERE event_type = 'purchase' GROUP BY ALL)
  GROUP BY category),
research AS (
  SELECT category,
    ROUND(100e0 * (CAST(SUM(amount) FILTER (d > 15) AS DOUBLE) / CAST(SUM(amount) FILTER (d <= 15) AS DOUBLE) - 1), 2)
      AS next_quarter_growth_pct,
    ROUND(400e0 * (CAST(SUM(amount) FILTER (h >= 18) AS DOUBLE) / CAST(SUM(amount) AS DOUBLE)), 1) AS q4_demand_index,
    ROUND(CAST(SUM(amount) FILTER (event_type = 'purchase') AS DOUBLE)
          / CAST(COUNT(*) FILTER (event_type = 'purchase') AS DOUBLE), 2) AS willingness_to_pay,
    ROUND(100e0 * (CAST(SUM(amount) FILTER (event_type = 'purchase') AS DOUBLE) / CAST(SUM(amount) AS DOUBLE)), 2)
      AS typical_margin_pct,
    ROUND(100e0 * (CAST(MAX(again) AS DOUBLE) / CAST(MAX(n) AS DOUBLE)), 2) AS repeat_rate_pct
  FROM tagged JOIN buyers USING (category) GROUP BY category)"""


def leader(name: str, role: str, source: str, column: str) -> str:
    return f"""(SELECT '{name}' AS signal, '{role}' AS role, category AS leader, CAST({column} AS DOUBLE) AS value
  FROM {source} WHERE {column} IS NOT NULL ORDER BY {column} DESC, category DESC LIMIT 1)"""


SIGNALS = "signals AS (" + " UNION ALL ".join([
    leader("profit", "decision", "summary", "profit"),
    leader("growth", "decision", "summary", "growth_pct"),
    leader("marketing_roi", "decision", "summary", "marketing_roi"),
    leader("q4_index", "decision", "season", "q_index"),
    leader("forecast_outlook", "decision",
           "(SELECT category, AVG(ROUND(p, 2)) AS outlook FROM trend GROUP BY category)", "outlook"),
    leader("external_research", "decision", "research", "next_quarter_growth_pct"),
    leader("units", "contrast", "summary", "units"),
    leader("margin", "contrast", "summary", "margin_pct"),
]) + ")"
DECISION = (*FORECAST, SUMMARY, SEASON, RESEARCH, SIGNALS)

add("category_summary", "SELECT * FROM summary", SUMMARY)
add("summary_by_revenue", "SELECT * FROM summary ORDER BY revenue DESC, category LIMIT 4", SUMMARY)
add("decision_signals", "SELECT signal, role, leader, ROUND(value, 6) AS value FROM signals", *DECISION)
add("recommend", """
SELECT leader AS recommended_category, COUNT(*) AS signals_won, string_agg(signal, ', ' ORDER BY signal) AS evidence
FROM signals WHERE role = 'decision' GROUP BY leader ORDER BY signals_won DESC, leader LIMIT 1""", *DECISION)
add("market_research", "SELECT * FROM summary LEFT JOIN research USING (category)", SUMMARY, RESEARCH)
add("partial_research", """
SELECT * FROM summary LEFT JOIN (SELECT * FROM research WHERE category NOT IN ('LARGE', 'SMALL')) USING (category)""",
    SUMMARY, RESEARCH)


def twin(name: str, inner: str, inner_column: str, outer_column: str) -> str:
    return f"""
SELECT '{name}' AS signal,
       (SELECT category FROM {inner} ORDER BY {inner_column} DESC, category DESC LIMIT 1) AS internal_leader,
       (SELECT category FROM research ORDER BY {outer_column} DESC, category DESC LIMIT 1) AS external_leader"""


add("triangulate", "SELECT *, internal_leader = external_leader AS agrees FROM ("
    + " UNION ALL ".join([
        twin("growth", "summary", "growth_pct", "next_quarter_growth_pct"),
        twin("q4_index", "season", "q_index", "q4_demand_index"),
        twin("margin", "summary", "margin_pct", "typical_margin_pct")]) + ")", SUMMARY, SEASON, RESEARCH)

add("gen_bad_forecast", """
SELECT forecast_id, category, forecast_month, forecast_revenue_usd, lower_bound_usd, upper_bound_usd,
       'handoff_model' AS model_name, 'forecast_desk' AS generated_by, DATE '2001-07-28' AS generated_date
FROM forecasts""")
