"""Registered queries: smoke entry, and each query against its DuckDB oracle
on the smallest driver tables (the driver repeats this at sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from shelfline.plans import catalog
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
FAST = ["lookback_join", "star_projection", "browse_rows", "browse_rows_price",
        "late_materialised_page", "grouped_prices_1", "grouped_prices_2", "options_store",
        "options_date", "report_1_category_prices_day1", "report_2_rows_current",
        "report_3_rows_day2", "categories_for_settlement", "top_products_by_avg_price",
        "conform_records", "fact_key_resolution", "quality_report", "upsert_dim_serving",
        "prune_dim_date", "discover_archive_links", "incremental_worklist", "detect_delimiter",
        "format_price_2dp", "parse_price_bound", "pipeline_stats", "incremental_dim_file",
        "load_typed_lookback", "load_typed_lookback_rejects"]
ALL = os.environ.get("SHELFLINE_FULL_ORACLE") == "1"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["group1", "price_avg"]


def test_every_query_has_oracle_or_is_documented():
    qs, oracle = catalog.QUERIES, catalog.ORACLE
    assert set(oracle) <= set(qs)
    assert set(qs) == set(oracle)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES) if ALL else FAST)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert r["ok"], r
