"""Independent SQL (DuckDB dialect) for every registered query.

The fixture views are repeated as CTEs over the base driver tables, then each
query is written directly in SQL.  Prices are compared as DOUBLE, keys as
BIGINT, averages as ``CAST(SUM(x) AS DOUBLE) / COUNT(x)``.
"""

from __future__ import annotations

FIXTURE_CTES = """
rf_dim_settlement AS (
  SELECT CAST(n_nationkey AS BIGINT) AS settlement_key,
         lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS ekatte,
         n_name AS settlement_name
  FROM nation),
rf_dim_company AS (
  SELECT CAST(r_regionkey AS BIGINT) AS company_key,
         CAST(CAST(r_regionkey AS BIGINT) + 100000000 AS VARCHAR) AS uic,
         r_name AS company_name
  FROM region),
rf_dim_store AS (
  SELECT CAST(s_suppkey AS BIGINT) AS store_key, s_name AS store_name,
         CASE WHEN s_suppkey % 11 <> 10 THEN CAST(s_nationkey AS BIGINT) END AS settlement_key,
         CAST(s_suppkey % 5 AS BIGINT) AS company_key
  FROM supplier),
rf_dim_category AS (
  SELECT n AS category_key, CAST(n AS VARCHAR) AS category_code,
         CASE WHEN n > 20 THEN '(unknown:' || CAST(n AS VARCHAR) || ')' ELSE p_brand END AS category_name
  FROM (SELECT DISTINCT p_brand, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS n FROM part) b),
rf_dim_product AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_key, CAST(p_partkey AS VARCHAR) AS product_code,
         p_name AS product_name
  FROM part),
rf_dim_file AS (
  SELECT CAST(o_orderkey AS BIGINT) AS file_key,
         o_orderpriority || '_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
         CAST(o_orderdate AS DATE) AS zip_date
  FROM orders WHERE o_orderkey % 7 <> 0),
rf_dim_date AS (
  SELECT CAST(y AS BIGINT) AS date_key, make_date(y, 1, 1) AS date
  FROM (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem) d),
rf_fact AS (
  SELECT CAST(year(l_shipdate) AS BIGINT) AS date_key,
         CAST(l_suppkey AS BIGINT) AS store_key,
         CAST(l_orderkey AS BIGINT) AS file_key,
         CAST(split_part(p_brand, '#', 2) AS BIGINT) AS category_key,
         CAST(l_partkey AS BIGINT) AS product_key,
         CASE WHEN l_quantity <> 50
              THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(12,4)) END AS retail_price,
         CAST(CASE WHEN CAST(l_discount AS DECIMAL(4,2)) = 0 THEN NULL
                   WHEN CAST(l_discount AS DECIMAL(4,2)) = 0.01 THEN 0
                   WHEN CAST(l_discount AS DECIMAL(4,2)) = 0.02
                        THEN CAST(l_extendedprice AS DECIMAL(12,2)) * 1.05
                   ELSE CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              END AS DECIMAL(12,4)) AS promo_price,
         l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount
  FROM lineitem JOIN part ON l_partkey = p_partkey),
rf_dates AS (
  SELECT date_key, row_number() OVER (ORDER BY date_key DESC) AS rn
  FROM (SELECT DISTINCT date_key FROM rf_fact) d),
rf_prior AS (
  SELECT f.store_key, f.category_key, f.product_key, f.retail_price, f.promo_price, d.rn,
         row_number() OVER (PARTITION BY f.date_key, f.store_key, f.category_key, f.product_key
                            ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC,
                                     l_extendedprice DESC, l_discount DESC) AS k
  FROM rf_fact f JOIN rf_dates d ON f.date_key = d.date_key
  WHERE d.rn IN (2, 3)),
rf_lookback AS (
  SELECT c.date_key, c.store_key, c.file_key, c.category_key, c.product_key,
         c.retail_price, c.promo_price,
         p1.retail_price AS retail_price_day1, p1.promo_price AS promo_price_day1,
         p2.retail_price AS retail_price_day2, p2.promo_price AS promo_price_day2
  FROM rf_fact c
  JOIN rf_dates d ON c.date_key = d.date_key AND d.rn = 1
  LEFT JOIN rf_prior p1 ON p1.rn = 2 AND p1.k = 1 AND p1.store_key = c.store_key
       AND p1.category_key = c.category_key AND p1.product_key = c.product_key
  LEFT JOIN rf_prior p2 ON p2.rn = 3 AND p2.k = 1 AND p2.store_key = c.store_key
       AND p2.category_key = c.category_key AND p2.product_key = c.product_key),
rf_projection AS (
  SELECT f.date_key, s.settlement_key, f.category_key, s.company_key, f.store_key, f.file_key,
         f.product_key, fl.file_name, p.product_name, c.category_name, st.settlement_name,
         s.store_name, co.company_name, f.retail_price, f.promo_price,
         COALESCE(CASE WHEN f.promo_price IS NOT NULL AND f.promo_price > 0
                       THEN LEAST(f.retail_price, f.promo_price) ELSE f.retail_price END,
                  f.retail_price) AS price
  FROM rf_lookback f
  JOIN rf_dim_product p ON p.product_key = f.product_key
  JOIN rf_dim_category c ON c.category_key = f.category_key
  JOIN rf_dim_store s ON s.store_key = f.store_key
  JOIN rf_dim_company co ON co.company_key = s.company_key
  JOIN rf_dim_settlement st ON st.settlement_key = s.settlement_key
  LEFT JOIN rf_dim_file fl ON fl.file_key = f.file_key)
"""


def with_fixtures(body: str) -> str:
    return "WITH " + FIXTURE_CTES.strip() + "\n" + body.strip()


def zero_filled(retail: str, promo: str) -> str:
    return (f"CASE WHEN {promo} IS NOT NULL AND {promo} > 0 "
            f"THEN LEAST(COALESCE({retail}, 0), {promo}) ELSE COALESCE({retail}, 0) END")


def avg(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DOUBLE) / COUNT({expr})"
