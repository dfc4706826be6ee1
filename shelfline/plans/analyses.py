"""Documented analyses: pipeline statistics, unknown-category audit and
column-swap evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import conform as C

NOT_BUILT = "not built"


def pipeline_stats(archive_dates: DataFrame, fact_dates: DataFrame) -> DataFrame:
    """One row: archive count, first/last archive date, fact partitions, newest fact date.

    One aggregation over the two tagged date lists (no join).
    """
    tagged = (archive_dates.select("zip_date").distinct().withColumn("_a", F.lit(True))
              .unionByName(fact_dates.select("zip_date").distinct().withColumn("_a", F.lit(False))))
    a = F.when(F.col("_a"), F.col("zip_date"))
    f = F.when(~F.col("_a"), F.col("zip_date"))
    return tagged.agg(
        F.count(a).alias("archives"), F.min(a).alias("first_archive"),
        F.max(a).alias("last_archive"), F.count(f).alias("fact_partitions"),
        F.coalesce(F.max(f), F.lit(NOT_BUILT)).alias("newest_fact"))


def failure_group(code: str | Column) -> Column:
    """Failure group of an unknown category code (documented classification)."""
    c = F.col(code) if isinstance(code, str) else code
    return (F.when(c == "", "empty").when(c == "-1", "sentinel")
             .when(c.rlike(r"^0[0-9]{5}$"), "swapped_zero_padded")
             .when(c.rlike(r"^63[0-9]{4}$"), "swapped_63")
             .when(c.rlike(r"^[0-9]+$"), "out_of_range")
             .otherwise("non_numeric"))


def unknown_category_audit(dim_category: DataFrame, fact: DataFrame) -> DataFrame:
    """Unknown categories per failure group, with the fact rows they carry."""
    per_cat = fact.groupBy("category_key").agg(F.count(F.lit(1)).alias("n"))
    unknown = dim_category.filter(C.is_unknown("category_name"))
    j = unknown.join(per_cat, "category_key", "left")
    return (j.groupBy(failure_group("category_code").alias("failure_group"))
             .agg(F.count(F.lit(1)).alias("categories"),
                  F.sum(F.coalesce("n", F.lit(0))).cast("bigint").alias("rows_affected")))


def column_swap_detection(fact: DataFrame, dim_category: DataFrame, dim_product: DataFrame,
                          dim_file: DataFrame) -> DataFrame:
    """Files whose unknown category codes are product codes (swapped columns)."""
    codes = dim_product.select(F.col("product_code").alias("category_code")).distinct()
    suspect = (dim_category.filter(C.is_unknown("category_name"))
               .join(codes, "category_code", "left_semi").select("category_key"))
    hits = fact.join(suspect, "category_key", "left_semi").groupBy("file_key").agg(
        F.count(F.lit(1)).alias("rows_swapped"))
    return (hits.join(dim_file.select("file_key", "file_name", "zip_date"), "file_key")
                .select("file_name", "zip_date", "rows_swapped"))
