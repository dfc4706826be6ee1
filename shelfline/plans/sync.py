"""Publish job: (facts, dims) -> lookback, merged and pruned dims, browse projection.

Written into a new version folder ``<root>/serving/<version>/`` that is
published by one file creation (see ``sources.warehouse``), so readers never
see a half-written state.  The lookback is written first and everything after
it reads the written table.  Dimension rows are merged into the published ones
by key (``serve.upsert``); text columns are trimmed and blank ones become NULL.
With no fact partitions only the dimensions are published (empty lookback,
unchanged dims).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas
from shelfline.functions.conform import blank_to_null
from shelfline.operators import serve as S
from shelfline.operators import serving_index as ix
from shelfline.operators.joins import SizedFrame
from shelfline.operators.lookback import build_lookback, latest_dates
from shelfline.operators.projection import star_projection
from shelfline.plans.queries import Serving
from shelfline.sources import warehouse as W
from shelfline.sources.lookback_text import load as load_text_lookback
from shelfline.sources.lookback_text import refuse
from shelfline.sources.warehouse import Star

SERVING_DATES = 3


def serving_texts(dim: DataFrame) -> DataFrame:
    """Text columns as they are served: trimmed, blank as NULL."""
    return dim.select(*[blank_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                        for f in dim.schema.fields])


def serving_dims(star: Star, lookback: DataFrame, published: dict[str, DataFrame] | None = None,
                 n_dates: int = SERVING_DATES) -> dict[str, DataFrame]:
    """Dimensions to publish: merged into the published ones, then pruned."""
    dates_src = star.fact if star.dates is None else star.dates.withColumnRenamed("zip_date", star.partition_col)
    retained = latest_dates(dates_src, n_dates, star.partition_col).select(
        F.col(star.partition_col).cast("string").alias("zip_date"))
    dims = {}
    for name, (_, key, _nat) in schemas.DIMENSIONS.items():
        dims[name] = serving_texts(star.dim(name))
        if published is not None:
            dims[name] = S.upsert(published[name], dims[name], key)
    dims["date"], _ = S.prune_dim_date(dims["date"], S.retained_date_keys(dims["date"], retained))
    dims["category"], _ = S.prune_dim_category(dims["category"], lookback)
    return dims


def serving_path(root: str, version: str, table: str) -> str:
    return f"{root.rstrip('/')}/serving/{version}/{table}"


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/serving"


def _read_dims(spark: SparkSession, root: str, version: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(schemas.DIMENSIONS[name][0]).parquet(serving_path(root, version, f"dim_{name}"))
            for name in schemas.DIMENSIONS}


def run_sync(spark: SparkSession, root: str, version: str | None = None, lookback_text: str | None = None) -> str:
    """Publish a serving version for the warehouse at ``root``; returns the version.

    The lookback is built from the facts, or loaded from the stored text
    partitions at ``lookback_text``; a cell there that cannot be typed raises
    before anything is published.
    """
    version = version or W.new_version()
    before = W.current_version(spark, _folder(root))
    W.begin_version(spark, _folder(root), version)
    star = W.read_star(spark, root)
    if lookback_text is None:
        rows = build_lookback(star)
    else:
        rows, rejects = load_text_lookback(spark, lookback_text, f"{W.staging_path(root, version)}/lookback")
        refuse(rejects)
    rows.write.mode("errorifexists").parquet(serving_path(root, version, "lookback"))
    lookback = spark.read.parquet(serving_path(root, version, "lookback"))
    published = _read_dims(spark, root, before) if before else None
    for name, df in serving_dims(star, lookback, published).items():
        df.hint("rebalance").write.mode("errorifexists").parquet(serving_path(root, version, f"dim_{name}"))
    dims = {name: SizedFrame(df) for name, df in _read_dims(spark, root, version).items()}
    write_projection(star_projection(lookback, Star(dims=dims, fact=star.fact)), serving_path(root, version, "projection"))
    write_indexes(spark.read.parquet(serving_path(root, version, "projection")),
                  lambda table: serving_path(root, version, table))
    W.publish_version(spark, _folder(root), version)
    if lookback_text is not None:
        W.drop_staging(spark, root, version)
    return version


_INDEXES = ("summary", "pages", "page_counts", "trigrams")


def write_indexes(projection: DataFrame, path_of, range_rows: int = ix.RANGE_ROWS) -> None:
    """Selector summary, page ranges and trigrams of a written projection."""
    ix.build_summary(projection).hint("rebalance", "date_key").sortWithinPartitions(*ix.SELECTORS).write.mode(
        "errorifexists").parquet(path_of("summary"))
    ix.write_pages(projection, path_of("pages"), path_of("page_counts"), range_rows)
    ix.write_trigrams(projection, path_of("trigrams"))


def with_indexes(sv: Serving, path_of) -> Serving:
    """The serving surface with the indexes that are written beside it."""
    spark = sv.projection.sparkSession
    schema = {"pages": ix.pages_schema(sv.projection)}
    return replace(sv, **{t: (spark.read.schema(schema[t]) if t in schema else spark.read).parquet(path_of(t))
                          for t in _INDEXES if W.path_exists(spark, path_of(t))})


def write_projection(projection: DataFrame, path: str) -> None:
    """Browse projection rebalanced by (date, product name): adaptive file
    sizes, rows spread over writers even when one date is the whole table,
    a skewed product split further; sorted within files in browse order."""
    order = ["date_key", "product_name", "store_name", "product_key", "store_key", "file_key"]
    (projection.hint("rebalance", "date_key", "product_name")
               .sortWithinPartitions(*order)
               .write.mode("errorifexists").parquet(path))


def read_serving(spark: SparkSession, root: str, version: str | None = None) -> Serving:
    """The published serving surface (lookback, projection, pruned dims, facts)."""
    version = version or W.current_version(spark, _folder(root))
    if not version:
        raise FileNotFoundError(f"no serving version under {root}")
    dims = {name: SizedFrame(df) for name, df in _read_dims(spark, root, version).items()}
    star = Star(dims=dims, fact=W.read_facts(spark, root), partition_col="zip_date",
                dates=W.partition_dates(spark, root))
    sv = Serving(star=star,
                 lookback=spark.read.parquet(serving_path(root, version, "lookback")),
                 projection=spark.read.parquet(serving_path(root, version, "projection")))
    return with_indexes(sv, lambda table: serving_path(root, version, table))
