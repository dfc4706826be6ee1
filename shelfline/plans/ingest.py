"""Ingest: raw records -> conformed rows -> dimensions -> keyed facts + quality.

``conform``, ``build_dimensions``, ``resolve_fact_keys`` and
``quality_report`` are pure DataFrame functions; ``run_ingest`` wires them to
the archive scan and the warehouse folder (work list, partition overwrite,
versioned dimensions, appended quality report).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.functions import conform as C
from shelfline.operators import dims as D
from shelfline.operators.joins import SizedFrame
from shelfline.session import freed_shuffles


def conform(records: DataFrame) -> DataFrame:
    """Valid record rows (>= 7 fields) with cleaned and conformed fields.

    Output: zip_date, file_seq, file_name, delimiter, pos, ekatte, store_name,
    product_name, product_code, category_code, retail_text, promo_text,
    company_name, uic.
    """
    return staged_rows(stage(records)).select(
        "zip_date", "file_seq", "file_name", "delimiter", "pos", "ekatte", "store_name",
        "product_name", "product_code", "category_code", "retail_text", "promo_text",
        "company_name", "uic")


def stage(records: DataFrame) -> DataFrame:
    """Decoded rows of every kind, with the conformed fields of record rows.

    This is the run's staging table: the caller writes it once, and
    rows, members and archives are filters of it, so decoding and cleaning
    run once per record.  Intermediate values are separate columns so each
    expression is evaluated once per row (Catalyst does not inline costly
    expressions into several uses).
    """
    df = records.select(
        "kind", "zip_date", "file_seq", "file_name", "delimiter", "status", "n_fields", "pos",
        C.clean_field("settlement_code").alias("_sc"),
        C.clean_field("store_name").alias("store_name"),
        C.clean_field("product_name").alias("product_name"),
        C.clean_field("product_code").alias("product_code"),
        C.clean_field("category_code").alias("category_code"),
        C.price_text("retail_price").alias("_rp"),
        C.price_text("promo_price").alias("_pp"))
    # Each rule's intermediate values are columns, worked out once per row.
    df = df.withColumns(C.settlement_code_parts("_sc"))
    company, uic = C.company_from_file(F.col("file_name"))
    return df.select(
        "kind", "zip_date", "file_seq", "file_name", "delimiter", "status", "n_fields", "pos",
        C.settlement_code_of_parts().alias("ekatte"), "store_name", "product_name", "product_code", "category_code",
        C.valid_price_text("_rp").alias("retail_text"), C.valid_price_text("_pp").alias("promo_text"),
        company.alias("company_name"), uic.alias("uic"),
    )


def staged_rows(staged: DataFrame) -> DataFrame:
    """Valid records (>= 7 fields) of a staging table."""
    return staged.filter((F.col("kind") == "record") & (F.col("n_fields") >= schemas.EXPECTED_COLUMNS))


def staged_members(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("kind") == "member").select(
        "zip_date", "file_seq", "file_name", "delimiter", "status", "pos", "company_name", "uic")


def with_position(records: DataFrame) -> DataFrame:
    """``pos`` = (archive date, member index, record index) packed into one decimal.

    Member rows get record index 0 and sort before their records.
    """
    whole = schemas.POSITION
    days = F.datediff(F.to_date("zip_date"), F.lit("1970-01-01")).cast(whole)
    file_seq = F.coalesce(F.col("file_seq"), F.lit(0)).cast(whole)
    row = (F.coalesce(F.col("row_seq"), F.lit(-1)) + 1).cast(whole)
    unit = lambda n: F.lit(n).cast("decimal(25,0)")
    packed = days * unit(Decimal(schemas.POS_DATE_UNIT)) + file_seq * unit(Decimal(schemas.POS_FILE_UNIT)) + row
    return records.withColumn("pos", packed.cast(whole))


@dataclass
class Nomenclatures:
    settlements: SizedFrame   # (code, name), unique codes
    categories: SizedFrame    # (code, name), unique codes


@dataclass
class DimBuild:
    full: dict[str, DataFrame]
    new: dict[str, DataFrame]
    sized: dict[str, SizedFrame] | None = None


def _dim_cols(name: str) -> list[str]:
    return schemas.DIMENSIONS[name][0].fieldNames()


# The independent natural keys of a record, seen first in one pass.
_ROW_KEYS = {"date": ["zip_date"], "settlement": ["ekatte"], "category": ["category_code"],
             "product": ["product_code", "product_name"]}


def first_seen_keys(rows: DataFrame) -> DataFrame:
    """First place of every natural key of the rows, all dimensions in one pass (``dims.first_places``)."""
    return D.first_places(rows, _ROW_KEYS)


def build_dimensions(rows: DataFrame, members: DataFrame, existing: dict[str, DataFrame],
                     noms: Nomenclatures, keys: DataFrame | None = None) -> DimBuild:
    """All seven dimensions after this run (existing rows untouched).

    Two numbering rounds: six independent dimensions together, then stores
    (their natural key holds the settlement and company keys).  ``keys`` is
    ``first_seen_keys(rows)`` where the caller has it already.
    """
    if keys is None:
        keys = first_seen_keys(rows)

    def spec(name, candidates):
        _, key, nat = schemas.DIMENSIONS[name]
        return D.KeySpec(existing[name], candidates, key, nat, _dim_cols(name))

    def seen(name):
        return keys.filter(F.col("_dim") == name).select(*_ROW_KEYS[name], "first_pos")

    files = members.withColumn("zip_date", F.to_date("zip_date"))
    round1 = {
        # company and file: every member, in archive/member order
        "company": spec("company", D.first_seen(members, ["uic"], ["company_name"])),
        "file": spec("file", D.first_seen(files, ["file_name", "zip_date"], [])),
        # date: archives with at least one valid row
        "date": spec("date", seen("date").select(*C.date_attributes(F.col("zip_date")), "first_pos")),
        # settlement / category: names resolved once per distinct code
        "settlement": spec("settlement", D.resolve_settlement_names(seen("settlement"), noms.settlements)),
        "category": spec("category", D.resolve_category_names(seen("category"), noms.categories)),
        "product": spec("product", seen("product")),
    }
    keyed = D.assign_keys_many(round1)
    sized = {n: k.full for n, k in keyed.items()}
    with_keys = _with_keys(rows, sized, ["settlement", "company"])
    keyed.update(D.assign_keys_many({"store": spec(
        "store", D.first_places(with_keys, {"store": ["store_name", "settlement_key", "company_key"]}))}))
    return DimBuild(full={n: k.full.df for n, k in keyed.items()},
                    new={n: k.new for n, k in keyed.items()},
                    sized={n: k.full for n, k in keyed.items()})


_JOIN_ON = {
    "date": (["date"], lambda df: df.withColumn("date", F.to_date("zip_date"))),
    "company": (["uic"], None),
    "settlement": (["ekatte"], None),
    "category": (["category_code"], None),
    "product": (["product_code", "product_name"], None),
    "store": (["store_name", "settlement_key", "company_key"], None),
    "file": (["file_name", "zip_date_d"], lambda df: df.withColumn("zip_date_d", F.to_date("zip_date"))),
}


def _with_keys(rows: DataFrame, dims: dict[str, DataFrame | SizedFrame], names: list[str]) -> DataFrame:
    df = rows
    for name in names:
        cols, prep = _JOIN_ON[name]
        key = schemas.DIMENSIONS[name][1]
        if prep is not None:
            df = prep(df)
        sd = dims[name] if isinstance(dims[name], SizedFrame) else SizedFrame(dims[name])
        d = sd.df
        if name == "file":
            d = d.withColumnRenamed("zip_date", "zip_date_d")
        d = SizedFrame(d.select(key, *cols), rows=sd._rows).for_join()
        df = df.join(d, cols, "left")
    return df


def resolve_fact_keys(rows: DataFrame, dims: dict[str, DataFrame | SizedFrame]) -> DataFrame:
    """Conformed rows -> fact rows (7 columns + pos + zip_date).

    Every natural key of a row is present in the dimensions built from the
    same rows, so the left joins never leave a key NULL; small dimensions are
    broadcast after a row count, product and store shuffle when large.
    """
    # What is broadcast comes first, so that rows are shuffled with short keys and typed prices instead of texts.
    typed = rows.withColumns({"retail_price": C.price_value("retail_text"), "promo_price": C.price_value("promo_text")})
    keyed = _with_keys(typed, dims, ["date", "settlement", "company", "category", "file", "product", "store"])
    return keyed.select("date_key", "store_key", "file_key", "category_key", "product_key", "retail_price", "promo_price",
                        "pos", "zip_date")


def quality_report(rows: DataFrame, members: DataFrame, archives: DataFrame,
                   noms: Nomenclatures, keys: DataFrame | None = None) -> DataFrame:
    """One row per processed archive date; dates without rows show zeros.

    unknown settlements/categories are judged with this run's nomenclature,
    per row.  delimiter_anomalies counts files using ``;``.  untyped_prices
    counts price texts that pass the cleaner but do not fit ``decimal(12,4)``.
    """
    if keys is None:
        keys = first_seen_keys(rows)
    sett = D.resolve_settlement_names(keys.filter("_dim = 'settlement'").select("ekatte"), noms.settlements)
    cat = D.resolve_category_names(keys.filter("_dim = 'category'").select("category_code"), noms.categories)
    flagged = (rows.select("zip_date", "ekatte", "category_code", "retail_text", "promo_text")
               .join(SizedFrame(sett).for_join(), "ekatte", "left")
               .join(SizedFrame(cat).for_join(), "category_code", "left"))
    per_row = flagged.groupBy("zip_date").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("retail_text") == "").alias("null_prices"),
        F.count_if(C.is_unknown("settlement_name")).alias("unknown_settlements"),
        F.count_if(C.is_unknown("category_name")).alias("unknown_categories"),
        F.sum(C.typing_losses("retail_text") + C.typing_losses("promo_text")).alias("untyped_prices"))
    per_file = members.groupBy("zip_date").agg(
        F.count_if(F.col("delimiter") == ";").alias("delimiter_anomalies"))
    out = (archives.select("zip_date").distinct()
           .join(per_row, "zip_date", "left").join(per_file, "zip_date", "left"))
    return out.select("zip_date", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                    for c in schemas.QUALITY.fieldNames()[1:]])


# ---------------------------------------------------------------------------
# Work lists
# ---------------------------------------------------------------------------

def reprocess_worklist(archives: DataFrame, existing_dates: DataFrame, force_from: str = "") -> DataFrame:
    """Archive dates to (re)process: no fact partition yet, or date >= force date.

    Dates compare as ISO strings; an empty force date disables forcing.
    """
    ex = existing_dates.select(F.col("zip_date").alias("_have")).distinct()
    j = archives.join(ex, archives.zip_date == ex._have, "left")
    keep = F.col("_have").isNull()
    if force_from:
        keep = keep | (F.col("zip_date") >= F.lit(force_from))
    return j.filter(keep).drop("_have")


# ---------------------------------------------------------------------------
# The job
# ---------------------------------------------------------------------------

@dataclass
class IngestResult:
    processed_dates: list[str]
    max_processed_date: str
    quality: DataFrame


def run_ingest(spark: SparkSession, raw_dir: str, root: str, noms: Nomenclatures,
               force_from: str = "", run_ts: str | None = None) -> IngestResult:
    """Process the work list of ``raw_dir`` into the warehouse at ``root``."""
    from shelfline.sources import archives as A
    from shelfline.sources import warehouse as W

    W.check_versions(spark, root)
    listing = A.list_archives(spark, raw_dir)
    existing_dates = W.partition_dates(spark, root)
    # Names of the archives to do, which the reader then lists and reads; no others.
    work = [r["path"] for r in reprocess_worklist(listing, existing_dates, force_from).select("path").collect()]
    if not work:
        return IngestResult([], "", spark.createDataFrame([], schemas.QUALITY))
    return ingest_records(spark, A.scan_archives(spark, sorted(work)), root, noms, run_ts)


def ingest_records(spark: SparkSession, records: DataFrame, root: str, noms: Nomenclatures,
                   run_ts: str | None = None, label: str = "") -> IngestResult:
    """Decoded archive rows (``archives.RECORD_SCHEMA``) -> warehouse at ``root``.

    Shared by the batch job and the streaming micro-batches.  Order of the
    writes: staging, dimensions (published), facts, quality, log of processed
    dates, which commits all of them at once.  A failure anywhere leaves every
    date as it was and on the work list; a rerun finds the keys that were
    published and gives the same facts.
    """
    from shelfline.sources import warehouse as W

    version = W.new_version(label)
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d_%H%M%S")
    W.check_versions(spark, root)
    # Decoded and cleaned once; columnar, so each pass reads its columns.  Folders by kind would have every task sort its rows.
    cleaned = stage(with_position(records))
    with freed_shuffles(spark):
        cleaned.write.option("compression", "zstd").parquet(W.staging_path(root, version))
    staged = spark.read.schema(cleaned.schema).parquet(W.staging_path(root, version))
    archives = staged.filter((F.col("kind") == "archive") & (F.col("status") == "ok")).select("zip_date")
    processed = sorted(r["zip_date"] for r in archives.distinct().collect())  # one name per archive
    if not processed:
        W.drop_staging(spark, root, version)
        return IngestResult([], "", spark.createDataFrame([], schemas.QUALITY))
    rows, members = staged_rows(staged), staged_members(staged)
    keys = first_seen_keys(rows)
    existing = {name: W.read_dim(spark, root, name) for name in schemas.DIMENSIONS}
    built = build_dimensions(rows, members, existing, noms, keys)
    dims = dict(built.full)
    # Names that an earlier nomenclature lacked are repaired as soon as one has them.
    dims["settlement"], _ = D.patch_unknown_settlements(dims["settlement"], noms.settlements)
    W.write_dims(spark, root, dims, version)
    written = {name: SizedFrame(W.read_dim(spark, root, name, version)) for name in schemas.DIMENSIONS}
    per_date = {r["zip_date"]: r["count"] for r in rows.groupBy("zip_date").count().collect()}
    facts = resolve_fact_keys(rows, written)
    for dates in W.date_rounds(per_date):
        W.write_facts(spark, root, facts if dates is None else facts.filter(W.on_dates(dates)), version)
    W.append_quality(root, quality_report(rows, members, archives, noms, keys), run_ts)
    W.log_processed(spark, root, processed, run_ts, version, set(per_date))
    quality = W.read_quality(spark, root, run_ts)
    W.drop_staging(spark, root, version)
    return IngestResult(processed, max(processed), quality)
