"""Indexes beside the browse projection, written when a serving version is published.

* ``summary``: one row per combination of the selectors' keys, with counts and
  price sums.  Selectors and grouped prices without a name or price filter are
  aggregates of it, with the same values; a date's rows can be replaced.
* ``pages``: the projection in browse order, cut into numbered ranges, and
  ``page_counts``, the rows of each range.  A typed page number becomes the few
  ranges that hold it.
* ``trigrams``: (three letters, product name) of the distinct product names.  A
  name pattern becomes the names that hold all its trigrams; the pattern is
  then checked on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.prices import positive_promo

SELECTORS = ("date_key", "settlement_key", "settlement_name", "category_key", "category_name", "company_key", "company_name",
             "store_key", "store_name")
PAGE_ORDER = ("product_name", "store_name", "product_key", "store_key", "file_key", "retail_price", "promo_price")
RANGE_ROWS = 100_000
# A range is a task, a folder and a few hundred sampled rows at the driver: on tables with more rows the ranges
# get longer instead of more.
MAX_RANGES = 1000
# Names up to which a name search is a filter on the scan, and beyond which it is a join.
LISTED_NAMES = 1000


# ---------------------------------------------------------------------------
# Selector summary
# ---------------------------------------------------------------------------

def build_summary(projection: DataFrame) -> DataFrame:
    """(selector keys and names, rows, sums, counts, least, greatest) of price and positive promo."""
    promo = positive_promo()
    return projection.groupBy(*SELECTORS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("price").alias("price_sum"), F.count("price").alias("price_n"),
        F.min("price").alias("price_least"), F.max("price").alias("price_most"),
        F.sum(promo).alias("promo_sum"), F.count(promo).alias("promo_n"),
        F.min(promo).alias("promo_least"), F.max(promo).alias("promo_most"))


def replace_dates(summary: DataFrame, part: DataFrame, dates: list) -> DataFrame:
    """The summary with all rows of ``dates`` taken from ``part`` (none there: the date is gone)."""
    return summary.filter(~F.col("date_key").isin(list(dates))).unionByName(part.filter(F.col("date_key").isin(list(dates))))


def grouped_from_summary(summary: DataFrame, groups: list) -> DataFrame:
    """The grouped prices of ``queries.grouped_prices`` from (filtered) summary rows.

    Sums of decimal sums are exact, so averages have the same bits.
    """
    def avg(name):
        return F.sum(f"{name}_sum").cast("double") / F.sum(f"{name}_n")

    return summary.groupBy(*groups).agg(
        avg("price").alias("price_avg"), F.min("price_least").alias("price_min"), F.max("price_most").alias("price_max"),
        F.when(F.sum("promo_n") > 0, avg("promo")).alias("promo_avg"), F.min("promo_least").alias("promo_min"),
        F.max("promo_most").alias("promo_max"))


# ---------------------------------------------------------------------------
# Pages
# ---------------------------------------------------------------------------

def page_order() -> list:
    return [F.col(c).asc_nulls_last() for c in PAGE_ORDER]


def ranked_projection(projection: DataFrame, rows: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The projection with ``range_id``: ranges of about ``range_rows`` rows (``MAX_RANGES`` at most, of more rows
    where that is too few), numbered in browse order."""
    ranges = min(max(1, -(-rows // range_rows)), MAX_RANGES)
    ordered = projection.repartitionByRange(ranges, *page_order()).sortWithinPartitions(*page_order())
    return ordered.withColumn("range_id", F.spark_partition_id())


def pages_schema(projection: DataFrame) -> T.StructType:
    """Stated when the ranges are read: a partitioned table without rows has no file to infer it from."""
    return T.StructType([*projection.schema.fields, T.StructField("range_id", T.IntegerType())])


def write_pages(projection: DataFrame, path: str, counts_path: str, range_rows: int = RANGE_ROWS) -> None:
    """Write the ranges, each a partition of the table, and their row counts."""
    spark = projection.sparkSession
    ranked_projection(projection, projection.count(), range_rows).write.mode("errorifexists").partitionBy("range_id").parquet(path)
    counts = spark.read.schema(pages_schema(projection)).parquet(path).groupBy("range_id").agg(F.count(F.lit(1)).alias("rows"))
    counts.coalesce(1).write.mode("errorifexists").parquet(counts_path)


def ranges_of_page(counts: DataFrame, offset: int, limit: int) -> tuple[list[int], int]:
    """Ranges that hold rows ``offset`` to ``offset + limit``, and the rows of earlier ranges.

    ``counts`` is one row per range, so the prefix sum is over as many rows as
    there are ranges; at most ``limit`` ranges are told to the driver.
    """
    before = F.expr("sum(rows) OVER (ORDER BY range_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - rows")
    placed = counts.filter("rows > 0").withColumn("before", before)
    here = placed.filter((F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset))
    found = here.orderBy("range_id").collect()
    return [r["range_id"] for r in found], found[0]["before"] if found else 0


# ---------------------------------------------------------------------------
# Trigrams
# ---------------------------------------------------------------------------

def build_trigrams(products: DataFrame, name: str = "product_name") -> DataFrame:
    """(trigram, name): the distinct runs of three characters of every distinct name, small letters."""
    names = products.select(F.col(name).alias("name")).filter(F.col("name").isNotNull()).distinct()
    low = names.withColumn("low", F.lower("name")).filter(F.length("low") > 2)
    return low.select("name", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("low") - 2), lambda i: F.substring("low", i, F.lit(3))))).alias("trigram")).select("trigram", "name")


def write_trigrams(products: DataFrame, path: str) -> None:
    """Sorted by trigram, so that a search reads the row groups of its trigrams."""
    build_trigrams(products).hint("rebalance", "trigram").sortWithinPartitions("trigram", "name").write.mode("errorifexists").parquet(path)


def literal_runs(pattern: str, escape: str = "\\") -> list[str]:
    """The runs of plain characters between a LIKE pattern's wildcards."""
    runs, run, at = [], "", 0
    while at < len(pattern):
        c = pattern[at]
        if c == escape and at + 1 < len(pattern):
            at += 1
            run += pattern[at]
        elif c in "%_":
            runs.append(run)
            run = ""
        else:
            run += c
        at += 1
    return [r for r in (*runs, run) if r]


def pattern_trigrams(pattern: str) -> list[str]:
    """All trigrams that a name must hold to match; empty where the pattern is too short to tell."""
    return sorted({r[i: i + 3] for r in literal_runs(pattern) for i in range(len(r) - 2)})


def names_with(trigrams: DataFrame, wanted: list[str]) -> DataFrame:
    """Names that hold all of the trigrams: counts per name, no sets."""
    hits = trigrams.filter(F.col("trigram").isin(wanted)).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return hits.filter(F.col("n") == len(wanted)).select("name")
