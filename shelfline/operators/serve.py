"""Serving-side merges and prunes.

* ``upsert`` - insert or replace whole rows by primary key; target rows absent
  from the source stay.  A NULL in the source overwrites (row presence, not
  ``coalesce``).  Expressed as ``source UNION (target ANTI source)``.
* ``retained_date_keys`` / ``prune_dim_date`` - keep the dates of the serving
  window; an empty window leaves the dimension unchanged.
* ``prune_dim_category`` - keep categories referenced by the lookback; an
  empty lookback leaves the dimension unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    cols = target.columns
    src = source.select(*cols)
    kept = target.join(src.select(key), key, "left_anti")
    return src.unionByName(kept.select(*cols))


def upsert_counts(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: source rows that insert a new key / replace an existing one."""
    t = target.select(F.col(key).alias("_k"), F.lit(True).alias("_in_target"))
    s = source.select(key).join(t, source[key] == t["_k"], "left")
    return s.agg(F.count_if(F.col("_in_target").isNull()).alias("inserted"),
                 F.count_if(F.col("_in_target")).alias("updated"))


def _is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def retained_date_keys(dim_date: DataFrame, retained_dates: DataFrame) -> DataFrame:
    """date_key of dim_date rows whose ISO date text is one of ``retained_dates.zip_date``."""
    text = F.date_format("date", "yyyy-MM-dd")
    r = retained_dates.select(F.col("zip_date").alias("_d"))
    return (dim_date.withColumn("_t", text).join(r, F.col("_t") == F.col("_d"), "left_semi")
                    .select("date_key"))


def prune_dim_date(dim_date: DataFrame, retained_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, deleted rows); an empty key set keeps everything."""
    if _is_empty(retained_keys):
        return dim_date, dim_date.limit(0)
    return (dim_date.join(retained_keys, "date_key", "left_semi"),
            dim_date.join(retained_keys, "date_key", "left_anti"))


def prune_dim_category(dim_category: DataFrame, lookback: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, deleted rows); an empty lookback keeps everything."""
    used = lookback.select("category_key").distinct()
    if _is_empty(used):
        return dim_category, dim_category.limit(0)
    return (dim_category.join(used, "category_key", "left_semi"),
            dim_category.join(used, "category_key", "left_anti"))
