"""Day-over-day price lookback.

For the newest fact partition D, every D row (duplicates kept) gets the
retail/promo pair its (store, category, product) had on D-1 and D-2, where
D-1/D-2 are the previous *available* partitions, not calendar days.  When a
key occurs several times on a prior day, the last row in file order wins.

Plan: the prior days are reduced to one row per key with ``max_by`` (map-side
partial aggregation, so a hot key is collapsed before the shuffle; with the
packed bigint position the buffers are fixed-width and aggregate by hash),
then left joined to D.  Only the three partition dates are read; with a
date-partitioned fact that is partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.sources.warehouse import Star

LOOKBACK_DAYS = 2  # D-1 and D-2


def latest_dates(fact: DataFrame, n: int = 3, date_col: str = "zip_date") -> DataFrame:
    """The ``n`` newest partition dates, ascending (fewer when fewer exist)."""
    newest = fact.select(F.col(date_col).alias(date_col)).distinct().orderBy(F.col(date_col).desc()).limit(n)
    return newest.orderBy(F.col(date_col).asc())


def processed_dates(star: Star) -> DataFrame:
    """Partition dates of a star: the processed ones where it knows them (also
    those without rows), else the dates of the facts."""
    return star.fact if star.dates is None else star.dates.withColumnRenamed("zip_date", star.partition_col)


def latest_date(fact: DataFrame, date_col: str = "zip_date") -> DataFrame:
    """One row: the newest partition date, NULL when there is none."""
    return fact.agg(F.max(date_col).alias("latest_date"))


def _last_on(day, date_col: str, column: str):
    """``column`` of the last row (highest position) on ``day``.

    One ``max_by`` per price keeps the aggregation buffers fixed-width, so a
    packed bigint position aggregates by hash; the position is unique per
    row, so both prices come from the same row.
    """
    return F.max_by(F.col(column), F.when(F.col(date_col) == F.lit(day), F.col("pos")))


def lookback_for_dates(fact: DataFrame, dates: list, date_col: str,
                       keys: list[str] = schemas.PRICE_KEY) -> DataFrame:
    """Lookback rows for D = ``dates[-1]`` with D-1/D-2 taken from ``dates``."""
    current, priors = dates[-1], list(reversed(dates[:-1]))[:LOOKBACK_DAYS]
    cur = fact.filter(F.col(date_col) == F.lit(current))
    out_cols = [F.col(c) for c in schemas.FACT_COLUMNS]
    if priors:
        prior = (fact.filter(F.col(date_col).isin(priors))
                     .groupBy(*keys)
                     .agg(*[_last_on(d, date_col, c).alias(f"d{i + 1}_{c}")
                            for i, d in enumerate(priors)
                            for c in ("retail_price", "promo_price")]))
        cur = cur.join(prior, keys, "left")
    for i in range(LOOKBACK_DAYS):
        name = f"d{i + 1}"
        if i < len(priors):
            out_cols += [F.col(f"{name}_retail_price").alias(f"retail_price_day{i + 1}"),
                         F.col(f"{name}_promo_price").alias(f"promo_price_day{i + 1}")]
        else:
            out_cols += [F.lit(None).cast(schemas.PRICE).alias(f"retail_price_day{i + 1}"),
                         F.lit(None).cast(schemas.PRICE).alias(f"promo_price_day{i + 1}")]
    return cur.select(*out_cols)


def build_lookback(star: Star) -> DataFrame:
    """The lookback table of a star (empty when the fact has no partitions).

    The newest three partition dates are fetched to the driver (at most three
    scalars) so they become literal filters that prune partitions.
    """
    source = processed_dates(star)
    dates = [r[0] for r in latest_dates(source, LOOKBACK_DAYS + 1, star.partition_col).collect()]
    if not dates:
        spark = star.fact.sparkSession
        empty = star.fact.limit(0).select(*[F.col(c) for c in schemas.FACT_COLUMNS])
        for c in schemas.LOOKBACK_COLUMNS[len(schemas.FACT_COLUMNS):]:
            empty = empty.withColumn(c, F.lit(None).cast(schemas.PRICE))
        return spark.createDataFrame([], empty.schema)
    return lookback_for_dates(star.fact, dates, star.partition_col)
