"""A first ingest run over the raw records derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelfline import schemas
from shelfline.plans import ingest as I
from shelfline.sources import fixtures as X
from shelfline.session import write_once


def fixture_noms(spark: SparkSession, sf: str) -> I.Nomenclatures:
    return I.Nomenclatures(X.settlement_nomenclature(spark, sf), X.category_nomenclature(spark, sf))


def fixture_raw(spark: SparkSession, sf: str):
    """Raw records derived from lineitem.

    Only their files are written, from the few columns that tell them; the
    records go into what reads them (the staging table, once) without a copy.
    """
    rows = X.raw_record_rows(spark, sf)
    return X.with_files(rows, write_once(X.record_files(rows)))


def fixture_staged(spark: SparkSession, sf: str):
    """The staging table of a first run (written once, columnar)."""
    return write_once(I.stage(fixture_raw(spark, sf)), "zstd")


def fixture_first_run(spark: SparkSession, sf: str):
    """(records, conformed rows, members, dimension build) of a first run."""
    # Staged once: every dimension reads it.
    recs = fixture_staged(spark, sf)
    rows = I.staged_rows(recs)
    members = I.staged_members(recs)
    empty = {name: spark.createDataFrame([], schemas.DIMENSIONS[name][0]) for name in schemas.DIMENSIONS}
    built = I.build_dimensions(rows, members, empty, fixture_noms(spark, sf))
    return recs, rows, members, built
