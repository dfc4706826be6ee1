"""Stored price lookback as text: written, and loaded typed with its rejects.

The text is CSV with a header line; cells are found by column name, so columns
may stand in any order and others are passed over.  Cells are trimmed, blank
ones are NULL, and a record's missing cells count as blank.  Keys must be whole
numbers and present, prices must fit ``decimal(12,4)`` (rounded half away from
zero).  A cell that breaks a rule rejects its record: the record gives no row,
and each such cell one reject with its place, text and reason.

Every file is read once, split as Spark likes, into a staging table that keeps
good rows and rejects apart by a column.  A record's number in its file comes
from the row counts of the splits before its own, so a file needs no task of
its own.  Records are lines: a quoted line break ends one (no cell of a lookback
holds any), and such pieces are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas
from shelfline.functions.conform import is_ascii_digits, is_float_text, strip_ws, trimmed_price_value
from shelfline.sources.warehouse import path_exists

LOOKBACK = T.StructType([T.StructField(c, T.LongType() if c in schemas.FACT_KEYS else schemas.PRICE)
                         for c in schemas.LOOKBACK_COLUMNS])
REJECT = T.StructType([T.StructField("file", T.StringType()), T.StructField("record", T.LongType()),
                       T.StructField("column", T.StringType()), T.StructField("value", T.StringType()),
                       T.StructField("reason", T.StringType())])
SHOWN = 20  # rejects named by the error of ``refuse``


class RejectedCells(ValueError):
    """A text lookback that holds cells which cannot be typed."""


def write_text(lookback: DataFrame, path: str) -> None:
    """Write a lookback as text partitions; NULL is an empty cell."""
    lookback.select(*schemas.LOOKBACK_COLUMNS).write.mode("errorifexists").option("header", True).csv(path)


def _typed(column: str) -> Column:
    """The value of a trimmed cell."""
    cell = F.col(f"__cell_{column}")
    return cell.try_cast(T.LongType()) if column in schemas.FACT_KEYS else trimmed_price_value(cell)


def _fault(column: str) -> Column:
    """Why a cell is rejected, from its trimmed text and its value; NULL where it is fine."""
    cell, lost = F.col(f"__cell_{column}"), F.col(f"__value_{column}").isNull()
    if column in schemas.FACT_KEYS:
        return (F.when(cell.isNull(), "missing")
                .when(~(is_ascii_digits(cell) | cell.rlike(r"^[+-]?[0-9]+$")), "not a whole number")
                .when(lost, "out of range"))
    return (F.when(cell.isNull() | ~lost, F.lit(None).cast("string"))
            .when(~is_float_text(cell), "not a number")
            .when(cell.rlike(r"(?i)[a-df-z]"), "not finite")
            .otherwise("out of range"))


def _cells(spark: SparkSession, path: str) -> DataFrame | None:
    """The records as text cells with their place; None where nothing is stored."""
    if not path_exists(spark, path):
        return None
    header = spark.read.option("header", True).csv(path).columns
    if not header:
        return None
    absent = [c for c in schemas.LOOKBACK_COLUMNS if c not in header]
    if absent:
        raise ValueError(f"the stored lookback has no column {', '.join(absent)}")
    # All files must have this header, in this order (Spark checks it per file).
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(*schemas.LOOKBACK_COLUMNS, F.col("_metadata.file_path").alias("__file"),
                       F.col("_metadata.file_block_start").alias("__split"),
                       F.monotonically_increasing_id().alias("__at"))


def load(spark: SparkSession, path: str, staged: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of the text lookback at ``path``, by way of the folder ``staged``.

    ``staged`` must not exist; it holds the typed records until the rows are
    published.  Nothing stored, or a file without a header, gives no rows.
    """
    cells = _cells(spark, path)
    if cells is None:
        return spark.createDataFrame([], LOOKBACK), spark.createDataFrame([], REJECT)
    # Trimmed text, value and fault are columns, each worked out once per cell.
    columns = schemas.LOOKBACK_COLUMNS
    cells = cells.withColumns({f"__text_{c}": strip_ws(c) for c in columns})
    cells = cells.withColumns({f"__cell_{c}": F.when(F.col(f"__text_{c}") != "", F.col(f"__text_{c}")) for c in columns})
    cells = cells.withColumns({f"__value_{c}": _typed(c) for c in columns})
    cells = cells.withColumns({f"__fault_{c}": _fault(c) for c in columns})
    faults = [F.when(F.col(f"__fault_{c}").isNotNull(), F.struct(
        F.lit(c).alias("column"), F.col(c).alias("value"), F.col(f"__fault_{c}").alias("reason"))) for c in columns]
    some = F.coalesce(*[F.col(f"__fault_{c}") for c in columns]).isNotNull()
    typed = cells.select(*[F.col(f"__value_{c}").alias(c) for c in columns], "__file", "__split", "__at",
                         F.when(some, F.array_compact(F.array(*faults))).alias("__faults"), some.alias("__bad"))
    typed.write.mode("errorifexists").parquet(staged)
    table = spark.read.schema(typed.schema).parquet(staged)
    return table.filter(~F.col("__bad")).select(*schemas.LOOKBACK_COLUMNS), _rejects(table)


def _rejects(table: DataFrame) -> DataFrame:
    # One row per split of a file, so the window orders few rows.
    splits = table.groupBy("__file", "__split").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = W.partitionBy("__file").orderBy("__split").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    bad = table.filter("__bad").select("__file", "__split", "__at", F.explode("__faults").alias("__fault"))
    return bad.join(splits, ["__file", "__split"]).select(
        F.col("__file").alias("file"), (F.col("__base") + F.col("__at") - F.col("__first") + 1).alias("record"),
        "__fault.column", "__fault.value", "__fault.reason")


def refuse(rejects: DataFrame) -> None:
    """Raise ``RejectedCells`` if there are any, naming the first few."""
    first = rejects.orderBy("file", "record", "column").limit(SHOWN).collect()
    if first:
        named = "; ".join(f"record {r['record']} of {r['file']}: {r['column']} {r['value']!r} {r['reason']}" for r in first)
        raise RejectedCells(f"{rejects.count()} cells of the stored lookback cannot be typed, first {named}")
