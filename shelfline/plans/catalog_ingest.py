"""Registered ingest-side queries: conform, dimensions, keyed facts, quality.

They run the ingest operators on raw records derived from lineitem (whole
table) with empty starting dimensions, exactly as a first run would.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.session import write_once
from shelfline.plans import ingest as I
from shelfline.plans.catalog import register
from shelfline.plans.oracle_ingest import CONFORM_SQL, DIM_SQL, FACT_SQL, QUALITY_SQL, with_ingest
from shelfline.plans.fixture_runs import fixture_first_run, fixture_noms, fixture_raw, fixture_staged


@register("conform_records", CONFORM_SQL)
def _conform(spark, sf):
    rows = I.conform(fixture_raw(spark, sf))
    return rows.select("zip_date", "file_name", "ekatte", "store_name", "product_name",
                       "product_code", "category_code", "retail_text", "promo_text",
                       "company_name", "uic")


def _dim_query(name):
    def run(spark, sf):
        _, _, _, built = fixture_first_run(spark, sf)
        return built.full[name]
    return run


for _name in schemas.DIMENSIONS:
    register(f"first_seen_dim_{_name}", with_ingest(DIM_SQL[_name]))(_dim_query(_name))


@register("fact_key_resolution", FACT_SQL)
def _fact(spark, sf):
    _, rows, _, built = fixture_first_run(spark, sf)
    return I.resolve_fact_keys(rows, built.full).drop("pos")


@register("quality_report", QUALITY_SQL)
def _quality(spark, sf):
    staged = fixture_staged(spark, sf)
    rows, members = I.staged_rows(staged), I.staged_members(staged)
    archives = staged.filter("kind = 'archive'").select("zip_date")
    return I.quality_report(rows, members, archives, fixture_noms(spark, sf))


# Two runs: history before HISTORY_UNTIL first, the rest second, with the first
# run's dimensions as existing rows.  First-seen order starts with the archive
# date, so the keys must equal those of one run over everything.
HISTORY_UNTIL = "1998-01-01"


def _two_runs(spark, sf):
    staged = fixture_staged(spark, sf)
    noms = fixture_noms(spark, sf)
    empty = {name: spark.createDataFrame([], schemas.DIMENSIONS[name][0]) for name in schemas.DIMENSIONS}
    early = staged.filter(F.col("zip_date") < HISTORY_UNTIL)
    late = staged.filter(F.col("zip_date") >= HISTORY_UNTIL)
    first = I.build_dimensions(I.staged_rows(early), I.staged_members(early), empty, noms)
    existing = {n: write_once(df) for n, df in first.full.items()}
    return I.build_dimensions(I.staged_rows(late), I.staged_members(late), existing, noms)


def _second_run(name):
    def run(spark, sf):
        return _two_runs(spark, sf).full[name]
    return run


for _name in ("product", "store", "settlement", "file"):
    register(f"incremental_dim_{_name}", with_ingest(DIM_SQL[_name]))(_second_run(_name))
