"""Registered queries of the text lookback loader and the external target.

The stored text is made from all of lineitem: some cells are padded, blank or
faulty by rule, so that every reason of a reject occurs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfline.plans.catalog import register
from shelfline.plans.catalog_more import _CUSTOMER_STORES, _customer_stores
from shelfline.plans.oracle import with_fixtures
from shelfline.session import ensure_checkpoint_dir
from shelfline.sources import external
from shelfline.sources import fixtures as X
from shelfline.sources import lookback_text as TL


def _folder(spark, label):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def text_cells(spark, sf):
    """Lineitem as text cells of a lookback, with faults by quantity and order."""
    li = X.table(spark, sf, "lineitem")
    qty = F.col("l_quantity").cast("int")
    text = lambda c: F.col(c).cast("bigint").cast("string")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    return li.select(
        F.year("l_shipdate").cast("string").alias("date_key"),
        F.concat(F.lit(" "), text("l_suppkey"), F.lit(" ")).alias("store_key"),
        F.when(F.col("l_orderkey") % 7 != 0, text("l_orderkey")).alias("file_key"),
        F.when(qty == 50, F.concat(F.lit("x"), text("l_linenumber"))).otherwise(text("l_linenumber")).alias("category_key"),
        F.when(qty == 49, F.concat(F.lit("9" * 20), text("l_partkey"))).otherwise(text("l_partkey")).alias("product_key"),
        F.when(qty == 48, F.lit("abc")).otherwise(price).alias("retail_price"),
        F.when(qty == 47, F.lit("1e12")).when(qty == 46, F.lit("nan"))
         .when(F.col("l_discount") != 0, price).alias("promo_price"),
        F.lit(None).cast("string").alias("retail_price_day1"),
        F.concat(F.lit("+"), price).alias("promo_price_day1"),
        F.concat(price, F.lit("346")).alias("retail_price_day2"),
        F.lit("  ").alias("promo_price_day2"))


def _loaded(spark, sf):
    path = _folder(spark, "lookback-text")
    text_cells(spark, sf).write.option("header", True).option("ignoreTrailingWhiteSpace", False).option(
        "ignoreLeadingWhiteSpace", False).csv(path)
    return TL.load(spark, path, _folder(spark, "lookback-staged"))


_GOOD = "CAST(l_quantity AS INTEGER) NOT BETWEEN 46 AND 50 AND l_orderkey % 7 <> 0"


@register("load_typed_lookback", f"""
SELECT CAST(year(l_shipdate) AS BIGINT) AS date_key, CAST(l_suppkey AS BIGINT) AS store_key, CAST(l_orderkey AS BIGINT) AS file_key,
       CAST(l_linenumber AS BIGINT) AS category_key, CAST(l_partkey AS BIGINT) AS product_key,
       CAST(price AS DOUBLE) AS retail_price, CASE WHEN l_discount <> 0 THEN CAST(price AS DOUBLE) END AS promo_price,
       CAST(NULL AS DOUBLE) AS retail_price_day1, CAST(price AS DOUBLE) AS promo_price_day1,
       CAST(CAST(price + 0.0035 AS DECIMAL(12,4)) AS DOUBLE) AS retail_price_day2, CAST(NULL AS DOUBLE) AS promo_price_day2
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem) l WHERE {_GOOD}""")
def _rows(spark, sf):
    return _loaded(spark, sf)[0]


@register("load_typed_lookback_rejects", """
SELECT "column", reason, COUNT(*) AS cells, COUNT(*) AS records FROM (
  SELECT 'file_key' AS "column", 'missing' AS reason FROM lineitem WHERE l_orderkey % 7 = 0
  UNION ALL SELECT 'category_key', 'not a whole number' FROM lineitem WHERE l_quantity = 50
  UNION ALL SELECT 'product_key', 'out of range' FROM lineitem WHERE l_quantity = 49
  UNION ALL SELECT 'retail_price', 'not a number' FROM lineitem WHERE l_quantity = 48
  UNION ALL SELECT 'promo_price', 'out of range' FROM lineitem WHERE l_quantity = 47
  UNION ALL SELECT 'promo_price', 'not finite' FROM lineitem WHERE l_quantity = 46) f GROUP BY 1, 2""")
def _rejects(spark, sf):
    rejects = _loaded(spark, sf)[1]
    return rejects.groupBy("column", "reason").agg(
        F.count("*").alias("cells"), F.countDistinct("file", "record").alias("records"))


@register("upsert_external_target", with_fixtures("," + _CUSTOMER_STORES + """
SELECT store_key, store_name, settlement_key, company_key FROM rf_dim_store
UNION ALL
SELECT store_key, store_name, settlement_key, company_key FROM cust_st
WHERE store_key NOT IN (SELECT store_key FROM rf_dim_store)"""))
def _external(spark, sf):
    path = _folder(spark, "target")
    before, after = _customer_stores(spark, sf), X.dim_store(spark, sf)
    external.upsert_into(before, path, "day1")
    external.upsert_into(after, path, "day2")
    external.upsert_into(before, path, "day1")  # repeated under its name: changes nothing
    return external.read_target(spark, path, after.select(*before.columns).schema, "store_key")
