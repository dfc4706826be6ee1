"""Registered queries through the indexes of a serving version.

The projection on the driver tables is written with its indexes to the shared
folder, once per session and data folder, and read back as a published serving
version is.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from shelfline.plans import catalog as c
from shelfline.plans import queries as q
from shelfline.plans import sync
from shelfline.plans.catalog import register, serving
from shelfline.plans.oracle import with_fixtures
from shelfline.session import ensure_checkpoint_dir, write_once

# Rows per page range: many ranges on the driver tables.
FIXTURE_RANGE_ROWS = 200

_WRITTEN: dict[tuple[str, str], str] = {}


def indexed(spark, sf) -> q.Serving:
    """The serving surface on the driver tables, with its indexes."""
    sv = serving(spark, sf)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WRITTEN:
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/serving-{uuid.uuid4().hex}"
        projection = write_once(sv.projection)
        sync.write_projection(projection, f"{base}/projection")
        sync.write_indexes(projection, lambda t: f"{base}/{t}", FIXTURE_RANGE_ROWS)
        _WRITTEN[key] = base
    base = _WRITTEN[key]
    return sync.with_indexes(replace(sv, projection=spark.read.parquet(f"{base}/projection")), lambda t: f"{base}/{t}")


def _page(where: str, page: int, size: int = 100) -> str:
    return with_fixtures(c._BROWSE_SELECT.format(where=where, limit=size, offset=page * size))


@register("browse_rows_jump", _page("1=1", 4))
def _jump(spark, sf):
    return q.browse_page(indexed(spark, sf), 4)


@register("browse_rows_jump_filtered", _page(f"date_key = {c.DATE} AND price >= {c.PRICE_MIN} AND price <= {c.PRICE_MAX * 2}", 7, 33))
def _jump_filtered(spark, sf):
    return q.browse_page(indexed(spark, sf), 7, 33, date_key=c.DATE, price_min=c.PRICE_MIN, price_max=c.PRICE_MAX * 2)


@register("browse_rows_trigram", _page(f"product_name ILIKE '%{c.NAME}%' ESCAPE '\\'", 0))
def _trigram(spark, sf):
    return q.browse_search(indexed(spark, sf), c.NAME)


@register("browse_rows_trigram_wildcards", _page("product_name ILIKE '%l_rge%bolt%' ESCAPE '\\' AND category_key IS NOT NULL", 0))
def _trigram_wild(spark, sf):
    return q.browse_search(indexed(spark, sf), "l_rge%bolt")


@register("browse_rows_trigram_short", _page(f"product_name ILIKE '%E%' ESCAPE '\\' AND settlement_key = {c.SETTLEMENT}", 0))
def _trigram_short(spark, sf):
    return q.browse_search(indexed(spark, sf), "E", settlement_key=c.SETTLEMENT)


for _dim, _where, _keys in (
        ("settlement", f"date_key = {c.DATE} AND category_key = {c.CATEGORY}", {"date_key": c.DATE, "category_key": c.CATEGORY}),
        ("category", f"settlement_key = {c.SETTLEMENT}", {"settlement_key": c.SETTLEMENT}),
        ("company", f"store_key = {c.STORE}", {"store_key": c.STORE}),
        ("store", "1=1", {})):
    register(f"options_{_dim}_summary", c._options_sql(_dim, _where))(
        lambda spark, sf, d=_dim, k=_keys: q.options(indexed(spark, sf), d, **k))


@register("options_date_summary", c.ORACLE["options_date"])
def _opt_date(spark, sf):
    return q.options(indexed(spark, sf), "date", settlement_key=c.SETTLEMENT)


@register("grouped_prices_1_summary", c._grouped_sql("settlement_name", None, "1=1"))
def _grouped1(spark, sf):
    return q.grouped_prices(indexed(spark, sf), "settlement_name")


@register("grouped_prices_2_summary", c._grouped_sql("category_name", "store_name", f"company_key = {c.COMPANY}"))
def _grouped2(spark, sf):
    return q.grouped_prices(indexed(spark, sf), "category_name", "store_name", company_key=c.COMPANY)


@register("summary_after_replacing_a_date", c._grouped_sql("date_key", None, "1=1"))
def _replaced(spark, sf):
    """The summary without its date, then with the date's rows merged in again."""
    from shelfline.operators import serving_index as ix

    sv = indexed(spark, sf)
    without = ix.replace_dates(sv.summary, sv.summary.limit(0), [c.DATE])
    merged = ix.replace_dates(without, ix.build_summary(sv.projection.filter(F.col("date_key") == c.DATE)), [c.DATE])
    return q.grouped_prices(replace(sv, summary=merged), "date_key")
