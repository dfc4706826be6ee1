"""The parameterised question library: browse rows, grouped prices,
cross-filter options, reports and lookups.

Every function returns a DataFrame.  Optional filters are composed only when
their argument is given, so Catalyst sees plain equality predicates that reach
the Parquet scan; nothing is built as a SQL string.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shelfline.functions.prices import (
    effective_price,
    effective_price_zero_filled,
    positive_promo,
    price_columns_for_offset,
)
from shelfline.operators.lookback import build_lookback, latest_date, latest_dates, processed_dates
from shelfline.operators import serving_index as ix
from shelfline.operators.projection import star_projection, store_snowflake
from shelfline.sources.warehouse import Star

BROWSE_PAGE_SIZE = 100

# The grouping dimensions the grouped view accepts.
GROUP_DIMENSIONS = ("settlement_name", "category_name", "company_name", "store_name", "date_key")
# Order of the browse page.
BROWSE_ORDER = ("product_name", "store_name", "product_key", "store_key", "file_key")
BROWSE_COLUMNS = ("file_name", "product_name", "category_name", "settlement_name",
                  "store_name", "company_name", "retail_price", "promo_price", "price")
OPTION_DIMENSIONS = ("settlement", "category", "company", "store", "date")


@dataclass
class Serving:
    """The serving surface: lookback fact, browse projection, dimensions, and indexes where they are published."""

    star: Star
    lookback: DataFrame
    projection: DataFrame
    summary: DataFrame | None = None
    pages: DataFrame | None = None
    page_counts: DataFrame | None = None
    trigrams: DataFrame | None = None


def serving_from_star(star: Star) -> Serving:
    lookback = build_lookback(star)
    return Serving(star=star, lookback=lookback, projection=star_projection(lookback, star))


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------

def key_filters(df: DataFrame, **keys) -> DataFrame:
    """Equality on each ``<name>=value`` whose value is not None."""
    for column, value in keys.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def name_contains(df: DataFrame, text: str | None, column: str = "product_name") -> DataFrame:
    """Case-insensitive substring; user ``%``/``_`` are wildcards, ``\\`` escapes."""
    if text:
        df = df.filter(F.col(column).ilike(like_pattern(f"%{text}%")))
    return df


def name_search(sv: Serving, df: DataFrame, text: str | None) -> DataFrame:
    """``name_contains`` by the trigram index: the same rows, read by name.

    Few names become an IN filter, which the scan's statistics skip by (the
    projection is sorted by name); more become a semi-join.  The pattern is
    checked again on every row.  Patterns without three letters in a row, and
    serving versions without the index, are scanned.
    """
    if not text or sv.trigrams is None:
        return name_contains(df, text)
    low = df.sparkSession.range(1).select(F.lower(F.lit(like_pattern(f"%{text}%"))).alias("p")).first()["p"]
    wanted = ix.pattern_trigrams(low)
    if not wanted:
        return name_contains(df, text)
    names = ix.names_with(sv.trigrams, wanted)
    few = [r["name"] for r in names.limit(ix.LISTED_NAMES + 1).collect()]
    if len(few) <= ix.LISTED_NAMES:
        found = df.filter(F.col("product_name").isin(few)) if few else df.filter(F.lit(False))
    else:
        found = df.join(names.withColumnRenamed("name", "product_name"), "product_name", "left_semi")
    return name_contains(found, text)


def like_pattern(pattern: str) -> str:
    """A LIKE pattern where a backslash may stand before any character.

    Spark accepts it only before a wildcard or a backslash; before anything
    else it means that character, so it is dropped.
    """
    return re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], pattern, flags=re.DOTALL)


def price_range(df: DataFrame, price_min=None, price_max=None, column: str = "price") -> DataFrame:
    """Bounds on the null-keeping price; a NULL price fails any bound."""
    if price_min is not None:
        df = df.filter(F.col(column) >= F.lit(price_min))
    if price_max is not None:
        df = df.filter(F.col(column) <= F.lit(price_max))
    return df


def projection_filters(df: DataFrame, date_key=None, settlement_key=None, category_key=None,
                       company_key=None, store_key=None, product_name=None,
                       price_min=None, price_max=None) -> DataFrame:
    df = key_filters(df, date_key=date_key, settlement_key=settlement_key,
                     category_key=category_key, company_key=company_key, store_key=store_key)
    df = name_contains(df, product_name)
    return price_range(df, price_min, price_max)


def known_categories_only(df: DataFrame, column: str = "category_name") -> DataFrame:
    return df.filter(~F.col(column).like("(unknown:%)"))


def official_category_codes(df: DataFrame, low: int = 1, high: int = 101,
                            column: str = "category_code") -> DataFrame:
    code = F.col(column).try_cast("int")
    return df.filter(code.between(low, high))


def _avg(c: Column) -> Column:
    """Average as double: sum / count (same bits in every engine)."""
    return F.sum(c).cast("double") / F.count(c)


# ---------------------------------------------------------------------------
# Browse rows and pages
# ---------------------------------------------------------------------------

def browse_rows(sv: Serving, date_key=None, settlement_key=None, category_key=None,
                company_key=None, store_key=None, product_name=None, price_min=None,
                price_max=None, offset: int = 0, limit: int = BROWSE_PAGE_SIZE,
                keep_order_columns: bool = False) -> DataFrame:
    """One page of projection rows in browse order (ASC, NULLs last).

    The top-k is a ``TakeOrderedAndProject``: each task keeps offset+limit
    rows, the driver merges them; nothing else is sorted globally.  Retail
    and promo close ties between duplicate facts so pages are stable.
    """
    df = projection_filters(sv.projection, date_key, settlement_key, category_key,
                            company_key, store_key, product_name, price_min, price_max)
    order = [F.col(c).asc_nulls_last() for c in BROWSE_ORDER + ("retail_price", "promo_price")]
    page = df.orderBy(*order)
    if offset:
        page = page.offset(int(offset))
    extra = [c for c in BROWSE_ORDER if c not in BROWSE_COLUMNS] if keep_order_columns else []
    return page.limit(int(limit)).select(*BROWSE_COLUMNS, *extra)


def browse_search(sv: Serving, product_name: str, offset: int = 0, limit: int = BROWSE_PAGE_SIZE, **filters) -> DataFrame:
    """A page of ``browse_rows`` with a name filter, through the trigram index."""
    df = name_search(sv, projection_filters(sv.projection, **filters), product_name)
    return df.orderBy(*ix.page_order()).offset(int(offset)).limit(int(limit)).select(*BROWSE_COLUMNS)


def browse_page(sv: Serving, page: int, size: int = BROWSE_PAGE_SIZE, **filters) -> DataFrame:
    """Page ``page`` (0-based) of the browse rows, however deep: only its ranges are read and sorted.

    Without filters the ranges' counts are the published ones; with filters
    the matching rows of each range are counted (a scan of the filter columns,
    one row per range).  A task then keeps at most a range and a page.
    """
    offset, limit = page_window(page, size)
    if sv.pages is None:
        return browse_rows(sv, offset=offset, limit=limit, **filters)
    rows = projection_filters(sv.pages, **filters)
    given = any(v is not None for v in filters.values())
    counts = rows.groupBy("range_id").agg(F.count(F.lit(1)).alias("rows")) if given else sv.page_counts
    ranges, before = ix.ranges_of_page(counts, offset, limit)
    if not ranges:
        return rows.limit(0).select(*BROWSE_COLUMNS)
    return (rows.filter(F.col("range_id").isin(ranges)).orderBy(*ix.page_order())
            .offset(offset - before).limit(limit).select(*BROWSE_COLUMNS))


def browse_after(sv: Serving, last: Row, seen: int = 1, limit: int = BROWSE_PAGE_SIZE, **filters) -> DataFrame:
    """The page after a row: its cost does not grow with the page's place.

    ``last`` is the last row shown (with the order columns, as
    ``browse_rows(keep_order_columns=True)`` gives them) and ``seen`` how many
    shown rows equal it in all order columns.  The rows from ``last`` on are a
    filter on the order, whose first column reaches the scan's statistics, so
    a task keeps ``seen + limit`` rows and no more.
    """
    df = projection_filters(sv.projection, **filters)
    columns = BROWSE_ORDER + ("retail_price", "promo_price")

    def at(value, kind=None):
        return F.lit(value) if kind is None else F.lit(value).cast(kind)

    # NULLs last: (is null, value) pairs compare in browse order.
    here = F.struct(*[x for c in columns for x in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(f"v_{c}"))])
    there = F.struct(*[x for c in columns for x in (at(last[c] is None).alias(f"n_{c}"),
                                                    at(last[c], df.schema[c].dataType).alias(f"v_{c}"))])
    first = F.col(columns[0])
    start = first.isNull() if last[columns[0]] is None else (first >= at(last[columns[0]])) | first.isNull()
    page = df.filter(start & (here >= there)).orderBy(*[F.col(c).asc_nulls_last() for c in columns])
    extra = [c for c in BROWSE_ORDER if c not in BROWSE_COLUMNS]
    return page.offset(seen).limit(limit).select(*BROWSE_COLUMNS, *extra)


def rows_equal_to_last(rows: list[Row]) -> int:
    """How many of a page's last rows equal the last one in all order columns."""
    columns = BROWSE_ORDER + ("retail_price", "promo_price")
    n = 0
    while n < len(rows) and all(rows[-1 - n][c] == rows[-1][c] for c in columns):
        n += 1
    return n


def page_window(page: int, size: int = BROWSE_PAGE_SIZE) -> tuple[int, int]:
    """(offset, limit) of a 0-based page index."""
    if page < 0:
        raise ValueError("page must be >= 0")
    return page * size, size


FIRST_PAGE_NUMBER = 1


def page_index_from_input(text: str) -> int:
    """0-based page index of a typed, 1-based page number; ValueError when invalid."""
    try:
        n = int(str(text).strip())
    except ValueError:
        raise ValueError(f"invalid page number: {text!r}") from None
    if n < FIRST_PAGE_NUMBER:
        raise ValueError(f"invalid page number: {text!r}")
    return n - FIRST_PAGE_NUMBER


def has_next_page(rows_on_page: int, size: int = BROWSE_PAGE_SIZE) -> bool:
    """The browse rule: a next page is offered when this page is full."""
    return rows_on_page == size


def page_exists(page: int, rows_on_page: int) -> bool:
    """An empty page after the first one does not exist."""
    return not (page > 0 and rows_on_page == 0)


def page_rows(sv: Serving, page: int = 0, size: int = BROWSE_PAGE_SIZE, **filters) -> DataFrame:
    """A page plus one look-ahead row (an exact next-page test: size + 1 rows)."""
    offset, limit = page_window(page, size)
    rows = browse_rows(sv, offset=offset, limit=limit + 1, **filters)
    return rows


def late_materialised_page(sv: Serving, offset: int = 0, limit: int = 10) -> DataFrame:
    """Top-k on the narrow lookback x product x store first, then the page's dims.

    The remaining dimensions (inner, file inner too) are joined to at most
    ``limit`` rows, then the page is re-ordered.
    """
    star = sv.star
    narrow = (sv.lookback.select("file_key", "category_key", "store_key", "product_key",
                                 "retail_price", "promo_price")
              .join(star.dim_for_join("product").select("product_key", "product_name"), "product_key")
              .join(star.dim_for_join("store").select("store_key", "store_name"), "store_key"))
    order = [F.col(c).asc_nulls_last() for c in BROWSE_ORDER + ("retail_price", "promo_price")]
    page = narrow.orderBy(*order)
    if offset:
        page = page.offset(int(offset))
    page = page.limit(int(limit))
    # The page holds at most ``limit`` rows: that side is broadcast, the
    # dimensions stream past it.
    stores = store_snowflake(star).df.select("store_key", "settlement_name", "company_name")
    full = (F.broadcast(page).join(stores, "store_key")
            .join(star.dim("category").select("category_key", "category_name"), "category_key")
            .join(star.dim("file").select("file_key", "file_name"), "file_key"))
    return (full.orderBy(*order)
                .select("file_name", "product_name", "category_name", "settlement_name",
                        "store_name", "company_name", "retail_price", "promo_price",
                        effective_price().alias("effective_price")))


JSON_ROWS = 100_000


def rows_as_json(df: DataFrame, order: list[str], columns: list[str] | None = None, most: int = JSON_ROWS) -> DataFrame:
    """One row, one JSON array of the (bounded) page rows; empty -> ``[]``.

    NULL fields are kept, array order follows ``order`` (ASC, NULLs last).
    Meant for a page or a grouped result: more than ``most`` rows are refused
    when the query runs, before they meet in one row.
    """
    columns = columns or df.columns
    # One row beyond the bound is enough to know; the rest is never gathered.
    df = df.limit(most + 1)
    js = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    key = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(f"k{i}")
                     for i, c in enumerate(order)])
    agg = df.select(key.alias("k"), js.alias("j")).agg(
        F.sort_array(F.collect_list(F.struct("k", "j"))).alias("rows"))
    too_many = F.raise_error(F.lit(f"more than {most} rows for one JSON text"))
    agg = agg.select(F.when(F.size("rows") > most, too_many.cast(agg.schema["rows"].dataType)).otherwise(F.col("rows")).alias("rows"))
    return agg.select(F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["j"]), ","),
                               F.lit("]")).alias("json"))


# ---------------------------------------------------------------------------
# Grouped prices
# ---------------------------------------------------------------------------

def grouped_prices(sv: Serving, group1: str, group2: str | None = None, date_key=None,
                   settlement_key=None, category_key=None, company_key=None, store_key=None,
                   product_name=None, price_min=None, price_max=None) -> DataFrame:
    """AVG/MIN/MAX of the null-keeping price and of positive promos per group.

    Partial aggregation runs before the shuffle, so one hot group costs one
    partial row per task.  Without a name or price filter the published
    summary is grouped instead.
    """
    for g in (group1, group2):
        if g is not None and g not in GROUP_DIMENSIONS:
            raise ValueError(f"cannot group by {g!r}; choose one of {', '.join(GROUP_DIMENSIONS)}")
    if group1 is None:
        raise ValueError("group1 is required")
    groups = [F.col(group1).alias("group1")]
    if group2 is not None:
        groups.append(F.col(group2).alias("group2"))
    if sv.summary is not None and not product_name and price_min is None and price_max is None:
        few = projection_filters(sv.summary, date_key, settlement_key, category_key, company_key, store_key)
        return ix.grouped_from_summary(few, groups).orderBy(F.col("group1").asc_nulls_last())
    df = projection_filters(sv.projection, date_key, settlement_key, category_key,
                            company_key, store_key, product_name, price_min, price_max)
    promo = positive_promo()
    out = df.groupBy(*groups).agg(
        _avg(F.col("price")).alias("price_avg"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        _avg(promo).alias("promo_avg"),
        F.min(promo).alias("promo_min"),
        F.max(promo).alias("promo_max"),
    )
    return out.orderBy(F.col("group1").asc_nulls_last())


# ---------------------------------------------------------------------------
# Cross-filter options
# ---------------------------------------------------------------------------

def options(sv: Serving, dimension: str, date_key=None, settlement_key=None,
            category_key=None, company_key=None, store_key=None) -> DataFrame:
    """Valid choices of one selector under the other four key filters (from the summary where it is published)."""
    if dimension not in OPTION_DIMENSIONS:
        raise ValueError(f"Unknown option dimension: {dimension}")
    filters = dict(date_key=date_key, settlement_key=settlement_key, category_key=category_key,
                   company_key=company_key, store_key=store_key)
    filters.pop(f"{dimension}_key")
    df = key_filters(sv.projection if sv.summary is None else sv.summary, **filters)
    if dimension == "date":
        keys = df.select("date_key").distinct()
        dd = sv.star.dim_for_join("date").select("date_key", "date")
        return keys.join(dd, "date_key").orderBy(F.col("date_key").desc())
    key = f"{dimension}_key"
    name_col = f"{dimension}_name"
    if dimension in ("settlement", "company"):
        df = df.filter(F.col(key).isNotNull())
    out_name = "store_name" if dimension == "store" else "name"
    return (df.select(key, F.col(name_col).alias(out_name)).distinct()
              .orderBy(F.col(out_name).asc_nulls_last(), F.col(key).asc_nulls_last()))


# ---------------------------------------------------------------------------
# Lookups
# ---------------------------------------------------------------------------

def available_dates(sv: Serving) -> DataFrame:
    return sv.lookback.select("date_key").distinct().orderBy(F.col("date_key").desc())


def settlements_for_date(sv: Serving, date_key) -> DataFrame:
    lb = sv.lookback.filter(F.col("date_key") == F.lit(date_key)).select("store_key")
    st = sv.star.dim_for_join("store").select("store_key", "settlement_key")
    return lb.join(st, "store_key").select("settlement_key").distinct()


def categories_for_settlement(sv: Serving, settlement_key, date_key) -> DataFrame:
    stores = (sv.star.dim_for_join("store")
              .filter(F.col("settlement_key") == F.lit(settlement_key)).select("store_key"))
    lb = sv.lookback.filter(F.col("date_key") == F.lit(date_key))
    return lb.join(stores, "store_key", "left_semi").select("category_key").distinct()


def settlements_for_category(sv: Serving, category_key, date_key) -> DataFrame:
    lb = (sv.lookback.filter((F.col("date_key") == F.lit(date_key))
                             & (F.col("category_key") == F.lit(category_key)))
          .select("store_key"))
    st = sv.star.dim_for_join("store").select("store_key", "settlement_key")
    return lb.join(st, "store_key").select("settlement_key").distinct()


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------

def report_1_category_prices(sv: Serving, date_key, settlement_key,
                             offset: str = "current") -> DataFrame:
    """Average zero-filled price per category for one date and settlement."""
    retail, promo = price_columns_for_offset(offset)
    st = sv.star.dim_for_join("store").select("store_key", "settlement_key")
    rows = (sv.lookback.filter(F.col("date_key") == F.lit(date_key))
            .join(st, "store_key")
            .filter(F.col("settlement_key") == F.lit(settlement_key))
            .select("category_key", effective_price_zero_filled(retail, promo).alias("p")))
    return (rows.groupBy("category_key").agg(_avg(F.col("p")).alias("avg_price"))
                .orderBy(F.col("avg_price").asc_nulls_last(), F.col("category_key").asc()))


def _report_rows(sv: Serving, offset: str, settlement_how: str) -> DataFrame:
    retail, promo = price_columns_for_offset(offset)
    stores = store_snowflake(sv.star, settlement_how=settlement_how).for_join()
    return (sv.lookback
            .join(stores, "store_key")
            .join(sv.star.dim_for_join("product").select("product_key", "product_name"), "product_key")
            .select("*", F.col(retail).alias("sel_retail"), F.col(promo).alias("sel_promo")))


def report_2_rows(sv: Serving, date_key, settlement_key, category_key,
                  offset: str = "current") -> DataFrame:
    base = sv.lookback.filter((F.col("date_key") == F.lit(date_key))
                              & (F.col("category_key") == F.lit(category_key)))
    sub = Serving(sv.star, base, sv.projection)
    rows = (_report_rows(sub, offset, "left")
            .filter(F.col("settlement_key") == F.lit(settlement_key))
            .join(sv.star.dim_for_join("file").select("file_key", "file_name", "zip_date"),
                  "file_key", "left"))
    calc = effective_price_zero_filled("sel_retail", "sel_promo")
    return (rows.select("product_key", "category_key", "file_key",
                        F.col("sel_retail").alias("retail_price"),
                        F.col("sel_promo").alias("promo_price"),
                        calc.alias("calculated_price"), "product_name", "store_name",
                        "company_name", "file_name", "zip_date")
                .orderBy(F.col("calculated_price").asc_nulls_last(),
                         F.col("product_name").asc_nulls_last(),
                         F.col("store_name").asc_nulls_last()))


def report_3_rows(sv: Serving, date_key, category_key, offset: str = "current") -> DataFrame:
    """Rows of one category on one date; stores without settlement are kept."""
    base = sv.lookback.filter((F.col("date_key") == F.lit(date_key))
                              & (F.col("category_key") == F.lit(category_key)))
    sub = Serving(sv.star, base, sv.projection)
    rows = _report_rows(sub, offset, "left")
    calc = effective_price_zero_filled("sel_retail", "sel_promo")
    return (rows.select("product_key", "category_key",
                        F.col("sel_retail").alias("retail_price"),
                        F.col("sel_promo").alias("promo_price"),
                        calc.alias("calculated_price"), "settlement_name", "product_name",
                        "store_name", "company_name")
                .orderBy(F.col("calculated_price").asc_nulls_last(),
                         F.col("settlement_name").asc_nulls_last(),
                         F.col("product_name").asc_nulls_last()))


# ---------------------------------------------------------------------------
# Documented ad-hoc queries
# ---------------------------------------------------------------------------

def top_products_by_avg_price(star: Star, n: int = 20) -> DataFrame:
    """AVG(retail) per product name over all fact dates, priced rows only, top n."""
    f = star.fact.filter(F.col("retail_price").isNotNull()).select("product_key", "retail_price")
    joined = f.join(star.dim_for_join("product").select("product_key", "product_name"), "product_key")
    return (joined.groupBy("product_name").agg(_avg(F.col("retail_price")).alias("avg_price"))
                  .orderBy(F.col("avg_price").desc(), F.col("product_name").asc())
                  .limit(n))


def fact_product_join(star: Star, n: int = 20) -> DataFrame:
    """Fact x product, product name and retail price, first n in a fixed order."""
    joined = star.fact.select("product_key", "retail_price").join(
        star.dim_for_join("product").select("product_key", "product_name"), "product_key")
    return (joined.select("product_name", "retail_price")
                  .orderBy(F.col("product_name").asc_nulls_last(),
                           F.col("retail_price").asc_nulls_last())
                  .limit(n))


def newest_dates(star: Star, n: int = 3) -> DataFrame:
    """The newest processed dates (also those without rows), ascending."""
    return latest_dates(processed_dates(star), n, star.partition_col)


def newest_date(star: Star) -> DataFrame:
    """One row: the newest processed date."""
    return latest_date(processed_dates(star), star.partition_col)
