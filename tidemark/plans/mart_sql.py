"""The SQL of the marts, which other queries build on."""

from __future__ import annotations

from tidemark.plans.registry import REVENUE, day_part_sql, mean, r, total

STAGED_EVENTS = f"""SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS event_date,
  CAST(hour(ts) AS INTEGER) AS event_hour, CAST(isodow(ts) AS INTEGER) AS iso_weekday, {day_part_sql("ts")} AS day_part
  FROM events"""

DAILY_EVENTS = f"""SELECT CAST(ts AS DATE) AS event_date, CAST(min(isodow(ts)) AS INTEGER) AS iso_weekday,
  count(*) AS n_events, {total("value")} AS total_value, {r(mean("value"), 2)} AS avg_value, max(ts) AS last_ts
  FROM events GROUP BY 1"""

ENRICHED = f"""SELECT l.*, CAST(l.l_shipdate AS DATE) AS ship_date, {REVENUE} AS revenue,
  o.o_custkey, coalesce(o.o_orderpriority, 'Unknown') AS priority, o.o_orderdate,
  coalesce(cn.n_name, 'Unknown') AS customer_nation, coalesce(cr.r_name, 'Unknown') AS customer_region,
  coalesce(c.c_mktsegment, 'Unknown') AS segment,
  coalesce(sn.n_name, 'Unknown') AS supplier_nation, coalesce(sr.r_name, 'Unknown') AS supplier_region,
  coalesce(p.p_brand, 'Unknown') AS brand
  FROM lineitem l LEFT JOIN orders o ON l_orderkey = o_orderkey
  LEFT JOIN customer c ON o_custkey = c_custkey
  LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  LEFT JOIN supplier s ON l_suppkey = s_suppkey
  LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey
  LEFT JOIN part p ON l_partkey = p_partkey"""

AVG_REVENUE = f"CAST(sum({REVENUE}) AS DOUBLE) / count(*)"

DAILY_REVENUE = f"""WITH daily AS (
  SELECT CAST(l_shipdate AS DATE) AS ship_date, CAST(min(isodow(l_shipdate)) AS INTEGER) AS iso_weekday,
    count(*) AS lines, {total("l_quantity", 0)} AS quantity, {total("l_extendedprice")} AS gross_revenue,
    CAST(round(sum({REVENUE}), 2) AS DOUBLE) AS total_revenue,
    {r(AVG_REVENUE, 2)} AS avg_revenue_per_line,
    {r(mean("CASE WHEN l_discount > 0 THEN l_discount END"), 4)} AS avg_discount_given,
    {r(f"CAST(sum({REVENUE}) AS DOUBLE) / {total('l_quantity', 0)}", 2)} AS revenue_per_unit
  FROM lineitem GROUP BY 1)
SELECT *,
  {r('''CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) OVER w AS DOUBLE) / count(*) OVER w''', 2)} AS revenue_7d_avg,
  lines - lag(lines) OVER (ORDER BY ship_date) AS lines_vs_prev_day,
  CAST(rank() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank
FROM daily WINDOW w AS (ORDER BY ship_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

HOURLY = f"""SELECT event_hour, day_part, count(*) AS n_events,
  {r("CAST(count(*) AS DOUBLE) / count(DISTINCT event_date)", 1)} AS avg_events_per_day,
  {r(mean("value"), 2)} AS avg_value,
  {r(mean("CASE WHEN event_type = 'purchase' THEN value END"), 2)} AS avg_purchase
  FROM ({STAGED_EVENTS}) GROUP BY 1, 2"""

FLOWS = f"""SELECT md5(customer_region || '-' || supplier_region) AS flow_key, customer_region, supplier_region,
  count(*) AS lines, {r(mean("l_quantity", 0), 2)} AS avg_quantity,
  {r("CAST(sum(revenue) AS DOUBLE) / count(*)", 2)} AS avg_revenue,
  CAST(round(sum(revenue), 2) AS DOUBLE) AS total_revenue
  FROM ({ENRICHED}) GROUP BY customer_region, supplier_region HAVING count(*) >= 25"""

MIX = f"""SELECT o_orderpriority, count(*) AS n_orders, {r(mean("o_totalprice"), 2)} AS avg_price,
  {total("o_totalprice")} AS total_price,
  {r("count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()", 2)} AS pct_of_orders
  FROM orders GROUP BY o_orderpriority"""

TOP_NATIONS = f"""SELECT * FROM (SELECT coalesce(r_name, 'Unknown') AS region, coalesce(n_name, 'Unknown') AS nation,
  count(*) AS n_orders, {total("o_totalprice")} AS total_price,
  CAST(rank() OVER (PARTITION BY coalesce(r_name, 'Unknown') ORDER BY count(*) DESC) AS INTEGER) AS region_rank
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  WHERE coalesce(r_name, 'Unknown') NOT IN ('Unknown', 'N/A') GROUP BY 1, 2) WHERE region_rank <= 3"""

BORDER = f"""SELECT customer_region,
  CASE WHEN customer_nation = 'Unknown' OR supplier_nation = 'Unknown' THEN 'unknown'
       WHEN customer_nation = supplier_nation THEN 'domestic'
       WHEN customer_region = supplier_region THEN 'same region' ELSE 'cross region' END AS direction,
  count(*) AS lines, {r(mean("l_quantity", 0), 2)} AS avg_quantity, {r(mean("l_extendedprice"), 2)} AS avg_price,
  {r("CAST(sum(revenue) AS DOUBLE) / count(*)", 2)} AS avg_revenue
  FROM ({ENRICHED}) GROUP BY 1, 2"""

NATION_DIMENSION = f"""SELECT n_nationkey AS nation_id, n_name AS nation, r_name AS region,
  n_name LIKE '%$_0' ESCAPE '$' AS is_first,
  coalesce(p.n, 0) AS orders_placed, coalesce(s.n, 0) AS lines_supplied,
  coalesce(s.revenue, 0) AS revenue_supplied
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) p
    ON n_nationkey = p.c_nationkey
  LEFT JOIN (SELECT s_nationkey, count(*) AS n, CAST(round(sum({REVENUE}), 2) AS DOUBLE) AS revenue
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1) s ON n_nationkey = s.s_nationkey"""

USER_DAYS = f"""SELECT CAST(ts AS DATE) AS event_date, user_id, count(*) AS n_events, {total("value")} AS total_value
  FROM events GROUP BY 1, 2"""

ZSCORES = f"""SELECT event_date, n_events, total_value,
  {r("(total_value - avg(total_value) OVER ()) / stddev_samp(total_value) OVER ()", 3)} AS value_zscore
  FROM ({DAILY_EVENTS})"""

BUSIEST = f"""SELECT event_type, day_part, user_id, count(*) AS n_events, {r(mean("value"), 2)} AS avg_value
  FROM ({STAGED_EVENTS}) GROUP BY 1, 2, 3 HAVING count(*) >= 5
  ORDER BY n_events DESC, event_type, day_part, user_id LIMIT 20"""
