"""Oracle SQL (DuckDB) for the ingest chain on raw records derived from lineitem.

The raw records, the cleaning rules, first-seen numbering and key resolution
are written directly in SQL with window functions, independent of the Spark
implementation (which uses aggregations, a distributed numbering and joins).
"""

from __future__ import annotations

POS = "zip_date, file_seq, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount"


def _clean(x: str) -> str:
    return f"trim(trim({x}), '\"')"


def _norm_plain(p: str) -> str:
    t = f"trim({p})"
    sig = f"ltrim({t}, '0')"
    return (f"CASE WHEN {t} = '' THEN {t} WHEN NOT regexp_full_match({t}, '[0-9]+') THEN {t} "
            f"WHEN {sig} = '' THEN '00000' WHEN length({sig}) < 5 THEN lpad({sig}, 5, '0') "
            f"ELSE {sig} END")


def _normalize(x: str) -> str:
    t = f"trim({x})"
    return (f"CASE WHEN {t} = '' THEN '' WHEN strpos({t}, '-') > 0 THEN "
            f"({_norm_plain(f'split_part({t}, chr(45), 1)')}) || '-' || substr({t}, strpos({t}, '-') + 1) "
            f"ELSE {_norm_plain(t)} END")


def _zfill5(e: str) -> str:
    return (f"CASE WHEN length({e}) >= 5 THEN {e} "
            f"WHEN {e} LIKE '-%' OR {e} LIKE '+%' THEN substr({e}, 1, 1) || lpad(substr({e}, 2), 4, '0') "
            f"ELSE lpad({e}, 5, '0') END")


def _price(x: str) -> str:
    cleaned = f"replace({_clean(x)}, ',', '.')"
    # A text is a price if the engine reads it as a float once digit groups are closed up.
    return f"CASE WHEN TRY_CAST(replace({cleaned}, '_', '') AS DOUBLE) IS NOT NULL THEN {cleaned} ELSE '' END"


def typed_price(x: str) -> str:
    return f"TRY_CAST(replace(NULLIF(trim({x}), ''), '_', '') AS DECIMAL(12,4))"


def _stem(f: str) -> str:
    return f"CASE WHEN suffix({f}, '.csv') THEN substr({f}, 1, length({f}) - 4) ELSE {f} END"


def _company(f: str) -> tuple[str, str]:
    s = _stem(f)
    name = f"CASE WHEN strpos({s}, '_') > 0 THEN regexp_extract({s}, '^(.*)_([^_]*)$', 1) ELSE {s} END"
    uic = f"CASE WHEN strpos({s}, '_') > 0 THEN regexp_extract({s}, '^(.*)_([^_]*)$', 2) ELSE '' END"
    return name, uic


_CO_NAME, _CO_UIC = _company("file_name")

INGEST_CTES = f"""
raw_j AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber,
         l.l_quantity, l.l_extendedprice, l.l_discount,
         s.s_name, p.p_name, p.p_partkey, p.p_brand,
         l.l_suppkey % 5 AS c, l.l_linenumber % 4 AS m,
         CAST(s.s_nationkey AS VARCHAR) AS n, lpad(CAST(s.s_nationkey AS VARCHAR), 5, '0') AS n5,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS ptxt,
         CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              AS DECIMAL(12,2)) AS VARCHAR) AS promo_txt,
         CAST(l.l_discount AS DECIMAL(4,2)) AS disc,
         strftime(l.l_shipdate, '%Y-%m') || '-01' AS zip_date
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey),
raw AS (
  SELECT zip_date, c AS file_seq,
         CASE WHEN c = 4 THEN 'Chain' || CAST(c AS VARCHAR) || '.csv'
              ELSE 'Chain' || CAST(c AS VARCHAR) || '_' || CAST(c + 100000000 AS VARCHAR) || '.csv' END AS file_name,
         CASE WHEN c IN (1, 3) THEN ';' ELSE ',' END AS delimiter,
         CASE WHEN l_linenumber = 7 THEN 6 ELSE 7 END AS n_fields,
         CASE WHEN m = 0 THEN n WHEN m = 1 THEN '0' || n5 WHEN m = 2 THEN n5 || '-04' ELSE 'X' || n END AS settlement_code,
         CASE WHEN l_linenumber % 3 = 0 THEN ' "' || s_name || '" ' ELSE s_name END AS store_name,
         p_name AS product_name, CAST(p_partkey AS VARCHAR) AS product_code,
         CASE WHEN l_linenumber <> 6 THEN CAST(CAST(split_part(p_brand, '#', 2) AS BIGINT) AS VARCHAR)
              WHEN l_orderkey % 6 = 0 THEN '' WHEN l_orderkey % 6 = 1 THEN '-1'
              WHEN l_orderkey % 6 = 2 THEN '0' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 5, '0')
              WHEN l_orderkey % 6 = 3 THEN '63' || lpad(CAST(l_partkey % 100 AS VARCHAR), 4, '0')
              WHEN l_orderkey % 6 = 4 THEN 'n.a.' ELSE '150' END AS category_code,
         CASE WHEN m = 0 THEN ptxt WHEN m = 1 THEN replace(ptxt, '.', ',') WHEN m = 2 THEN '"' || ptxt || '"'
              WHEN l_quantity % 2 = 0 THEN '' WHEN l_quantity % 10 = 1 THEN '123456789.5'
              WHEN l_quantity % 10 = 3 THEN '1_000' ELSE 'n/a' END AS retail_price,
         CASE WHEN disc = 0 THEN '' WHEN m % 2 = 1 THEN replace(promo_txt, '.', ',') ELSE promo_txt END AS promo_price,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount
  FROM raw_j),
conf AS (
  SELECT zip_date, file_seq, file_name, delimiter,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
         {_normalize(_clean('settlement_code'))} AS ekatte,
         {_clean('store_name')} AS store_name,
         {_clean('product_name')} AS product_name,
         {_clean('product_code')} AS product_code,
         {_clean('category_code')} AS category_code,
         {_price('retail_price')} AS retail_text,
         {_price('promo_price')} AS promo_text,
         {_CO_NAME} AS company_name, {_CO_UIC} AS uic
  FROM raw WHERE n_fields >= 7),
mem AS (
  SELECT DISTINCT zip_date, file_seq, file_name, delimiter, {_CO_NAME} AS company_name, {_CO_UIC} AS uic
  FROM raw),
nom_s AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code, n_name AS name FROM nation
  UNION ALL
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') || '-04', n_name || ' district' FROM nation
  WHERE n_nationkey % 2 = 0),
nom_c AS (
  SELECT DISTINCT CAST(CAST(split_part(p_brand, '#', 2) AS BIGINT) AS VARCHAR) AS code, p_brand AS name
  FROM part WHERE CAST(split_part(p_brand, '#', 2) AS BIGINT) <= 20),
res_s AS (
  SELECT e.ekatte, COALESCE(l1.name, l2.name, l3.name, '(unknown:' || e.ekatte || ')') AS settlement_name
  FROM (SELECT DISTINCT ekatte FROM conf) e
  LEFT JOIN nom_s l1 ON l1.code = e.ekatte
  LEFT JOIN nom_s l2 ON l2.code = {_zfill5('e.ekatte')}
  LEFT JOIN nom_s l3 ON l3.code = CASE WHEN ltrim(e.ekatte, '0') = '' THEN e.ekatte ELSE ltrim(e.ekatte, '0') END),
res_c AS (
  SELECT e.category_code, COALESCE(l.name, '(unknown:' || e.category_code || ')') AS category_name
  FROM (SELECT DISTINCT category_code FROM conf) e LEFT JOIN nom_c l ON l.code = e.category_code),
d_company AS (
  SELECT row_number() OVER (ORDER BY zip_date, file_seq) AS company_key, uic, company_name
  FROM (SELECT *, row_number() OVER (PARTITION BY uic ORDER BY zip_date, file_seq) AS rn FROM mem) x
  WHERE rn = 1),
d_file AS (
  SELECT row_number() OVER (ORDER BY zip_date, file_seq) AS file_key, file_name,
         CAST(zip_date AS DATE) AS zip_date
  FROM mem),
d_date AS (
  SELECT row_number() OVER (ORDER BY zip_date) AS date_key, CAST(zip_date AS DATE) AS date,
         CAST(year(CAST(zip_date AS DATE)) AS INTEGER) AS year,
         CAST(month(CAST(zip_date AS DATE)) AS INTEGER) AS month,
         CAST(day(CAST(zip_date AS DATE)) AS INTEGER) AS day,
         CAST(isodow(CAST(zip_date AS DATE)) - 1 AS INTEGER) AS weekday
  FROM (SELECT DISTINCT zip_date FROM conf) x),
d_settlement AS (
  SELECT row_number() OVER (ORDER BY {POS}) AS settlement_key, x.ekatte, r.settlement_name
  FROM (SELECT *, row_number() OVER (PARTITION BY ekatte ORDER BY {POS}) AS rn FROM conf) x
  JOIN res_s r ON r.ekatte = x.ekatte
  WHERE rn = 1),
d_category AS (
  SELECT row_number() OVER (ORDER BY {POS}) AS category_key, x.category_code, r.category_name
  FROM (SELECT *, row_number() OVER (PARTITION BY category_code ORDER BY {POS}) AS rn FROM conf) x
  JOIN res_c r ON r.category_code = x.category_code
  WHERE rn = 1),
d_product AS (
  SELECT row_number() OVER (ORDER BY {POS}) AS product_key, product_code, product_name
  FROM (SELECT *, row_number() OVER (PARTITION BY product_code, product_name ORDER BY {POS}) AS rn
        FROM conf) x
  WHERE rn = 1),
conf_k AS (
  SELECT c.*, s.settlement_key, co.company_key
  FROM conf c JOIN d_settlement s ON s.ekatte = c.ekatte JOIN d_company co ON co.uic = c.uic),
d_store AS (
  SELECT row_number() OVER (ORDER BY {POS}) AS store_key, store_name, settlement_key, company_key
  FROM (SELECT *, row_number() OVER (PARTITION BY store_name, settlement_key, company_key
                                     ORDER BY {POS}) AS rn FROM conf_k) x
  WHERE rn = 1),
i_fact AS (
  SELECT d.date_key, st.store_key, f.file_key, ca.category_key, p.product_key,
         {typed_price('c.retail_text')} AS retail_price, {typed_price('c.promo_text')} AS promo_price,
         c.zip_date
  FROM conf_k c
  JOIN d_date d ON d.date = CAST(c.zip_date AS DATE)
  JOIN d_store st ON st.store_name = c.store_name AND st.settlement_key = c.settlement_key
       AND st.company_key = c.company_key
  JOIN d_file f ON f.file_name = c.file_name AND f.zip_date = CAST(c.zip_date AS DATE)
  JOIN d_category ca ON ca.category_code = c.category_code
  JOIN d_product p ON p.product_code = c.product_code AND p.product_name = c.product_name)
"""


def with_ingest(body: str) -> str:
    return "WITH " + INGEST_CTES.strip() + "\n" + body.strip()


CONFORM_SQL = with_ingest("""
SELECT zip_date, file_name, ekatte, store_name, product_name, product_code, category_code,
       retail_text, promo_text, company_name, uic
FROM conf""")

DIM_SQL = {
    "company": "SELECT CAST(company_key AS BIGINT) AS company_key, uic, company_name FROM d_company",
    "file": "SELECT CAST(file_key AS BIGINT) AS file_key, file_name, zip_date FROM d_file",
    "date": "SELECT CAST(date_key AS BIGINT) AS date_key, date, year, month, day, weekday FROM d_date",
    "settlement": ("SELECT CAST(settlement_key AS BIGINT) AS settlement_key, ekatte, settlement_name "
                   "FROM d_settlement"),
    "category": ("SELECT CAST(category_key AS BIGINT) AS category_key, category_code, category_name "
                 "FROM d_category"),
    "product": "SELECT CAST(product_key AS BIGINT) AS product_key, product_code, product_name FROM d_product",
    "store": ("SELECT CAST(store_key AS BIGINT) AS store_key, store_name, CAST(settlement_key AS BIGINT) "
              "AS settlement_key, CAST(company_key AS BIGINT) AS company_key FROM d_store"),
}

FACT_SQL = with_ingest("""
SELECT CAST(date_key AS BIGINT) AS date_key, CAST(store_key AS BIGINT) AS store_key,
       CAST(file_key AS BIGINT) AS file_key, CAST(category_key AS BIGINT) AS category_key,
       CAST(product_key AS BIGINT) AS product_key,
       CAST(retail_price AS DOUBLE) AS retail_price, CAST(promo_price AS DOUBLE) AS promo_price,
       zip_date
FROM i_fact""")

_UNTYPED = " + ".join(f"CASE WHEN trim(c.{x}) <> '' AND {typed_price('c.' + x)} IS NULL THEN 1 ELSE 0 END"
                     for x in ("retail_text", "promo_text"))

QUALITY_SQL = with_ingest(f"""
SELECT a.zip_date,
       CAST(COALESCE(r.total_rows, 0) AS BIGINT) AS total_rows,
       CAST(COALESCE(r.null_prices, 0) AS BIGINT) AS null_prices,
       CAST(COALESCE(r.unknown_settlements, 0) AS BIGINT) AS unknown_settlements,
       CAST(COALESCE(r.unknown_categories, 0) AS BIGINT) AS unknown_categories,
       CAST(COALESCE(f.delimiter_anomalies, 0) AS BIGINT) AS delimiter_anomalies,
       CAST(COALESCE(r.untyped_prices, 0) AS BIGINT) AS untyped_prices
FROM (SELECT DISTINCT zip_date FROM raw) a
LEFT JOIN (
  SELECT c.zip_date, COUNT(*) AS total_rows,
         COUNT(*) FILTER (WHERE c.retail_text = '') AS null_prices,
         COUNT(*) FILTER (WHERE starts_with(s.settlement_name, '(unknown:')) AS unknown_settlements,
         COUNT(*) FILTER (WHERE starts_with(k.category_name, '(unknown:')) AS unknown_categories,
         SUM({_UNTYPED}) AS untyped_prices
  FROM conf c JOIN res_s s ON s.ekatte = c.ekatte JOIN res_c k ON k.category_code = c.category_code
  GROUP BY c.zip_date) r ON r.zip_date = a.zip_date
LEFT JOIN (
  SELECT zip_date, COUNT(*) FILTER (WHERE delimiter = ';') AS delimiter_anomalies
  FROM mem GROUP BY zip_date) f ON f.zip_date = a.zip_date""")
