"""Denormalised browse projection and the store snowflake.

Settlement and company are reached only through the store.  The small
dimensions are joined to the store first (one row per store), so the large
lookback joins a single pre-joined store frame instead of three dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions.prices import effective_price
from shelfline.operators.joins import SizedFrame
from shelfline.sources.warehouse import Star


def store_snowflake(star: Star, settlement_how: str = "inner",
                    company_how: str = "inner") -> SizedFrame:
    """Stores with company and settlement attributes, one row per store.

    Store keys are unique, company and settlement keys are unique in their
    dimensions, so the result has at most as many rows as ``dim_store``: its
    size bound is the store count.
    """
    store = star.dims["store"]
    s = store.df.select("store_key", "store_name", "settlement_key", "company_key")
    s = s.join(star.dim_for_join("company").select("company_key", "company_name"),
               "company_key", company_how)
    s = s.join(star.dim_for_join("settlement").select("settlement_key", "settlement_name"),
               "settlement_key", settlement_how)
    return SizedFrame(s, rows=store.rows)


def star_projection(lookback: DataFrame, star: Star) -> DataFrame:
    """Lookback joined to every dimension (inner, file left) plus ``price``.

    Inner joins: a store without settlement or company loses its rows, as in
    the serving projection.
    """
    stores = store_snowflake(star).for_join()
    f = (lookback
         .join(star.dim_for_join("product").select("product_key", "product_name"), "product_key")
         .join(star.dim_for_join("category").select("category_key", "category_name"), "category_key")
         .join(stores, "store_key")
         .join(star.dim_for_join("file").select("file_key", "file_name"), "file_key", "left"))
    return f.select(
        *[F.col(c) for c in schemas.PROJECTION_COLUMNS[:-1]],
        effective_price().alias("price"),
    )
