"""Registered queries of the archive, nomenclature and warehouse code.

Archives, nomenclature texts and a warehouse are made from the driver tables,
written where the cluster shares files, read back by the same code that a
daily run uses, and compared in natural values.
"""

from __future__ import annotations

import io
import uuid
import zipfile

from pyspark.sql import functions as F

from shelfline.operators.joins import SizedFrame
from shelfline.plans import ingest as I
from shelfline.plans import sync
from shelfline.plans.catalog import register
from shelfline.plans.fixture_runs import fixture_noms, fixture_raw
from shelfline.plans.oracle_ingest import INGEST_CTES, QUALITY_SQL, typed_price, with_ingest
from shelfline.schemas import RAW_COLUMNS
from shelfline.session import ensure_checkpoint_dir, ship_package, write_once
from shelfline.sources import archives as A
from shelfline.sources import fixtures as X
from shelfline.sources import nomenclature as N
from shelfline.sources import warehouse as W

# Orders per archive: bounds an archive whatever the table's size.
ARCHIVE_ORDERS = 1 << 15


# ---------------------------------------------------------------------------
# Archives
# ---------------------------------------------------------------------------

def _zip(batches):
    """Sorted (zip_date, part, file_name, delimiter, line) -> a ZIP of CSV members for every date and part."""
    import pyarrow as pa

    def packed(zip_date, members):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as zf:
            for name, lines in members.items():
                zf.writestr(name, "".join(lines).encode("utf-8"))
        return pa.RecordBatch.from_pydict({"zip_date": pa.array([zip_date], pa.string()), "content": pa.array([data.getvalue()], pa.binary())})

    archive, members = None, {}
    for batch in batches:
        dates, parts, names, delimiters, lines = (c.to_pylist() for c in batch.columns)
        at = 0
        while at < len(lines):
            key, end = (dates[at], parts[at], names[at]), at + 1
            while end < len(lines) and names[end] == key[2] and parts[end] == key[1] and dates[end] == key[0]:
                end += 1
            if members and archive != key[:2]:
                yield packed(archive[0], members)
                members = {}
            archive = key[:2]
            # (The header's names need no quotes.)
            members.setdefault(key[2], [delimiters[at].join(RAW_COLUMNS), "\n"]).extend(lines[at:end])
            at = end
    if members:
        yield packed(archive[0], members)


def _csv_line():
    """A record as a CSV writer has it: fields in quotes where they hold a delimiter, a quote or a line end."""
    def field(c):
        x = F.coalesce(F.col(c), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(F.contains(x, F.col("delimiter")) | x.contains('"') | x.contains("\n") | x.contains("\r"), quoted).otherwise(x)

    more = [F.when(F.col("n_fields") > i, F.concat(F.col("delimiter"), field(c))).otherwise("") for i, c in enumerate(RAW_COLUMNS) if i]
    return F.concat(field(RAW_COLUMNS[0]), *more, F.lit("\n"))


def fixture_archives(spark, sf):
    """(zip_date, content): ZIP archives of the raw records, of bounded size."""
    ship_package(spark)
    lines = X.raw_record_rows(spark, sf).select(
        "zip_date", F.floor(F.col("row_seq") / ARCHIVE_ORDERS).alias("part"), "file_name", "delimiter", _csv_line().alias("line"))
    dealt = lines.repartition("zip_date", "part").sortWithinPartitions("zip_date", "part", "file_name")
    return dealt.mapInArrow(_zip, "zip_date string, content binary")


_FIELDS = ", ".join("CASE WHEN n_fields = 7 THEN promo_price END AS promo_price" if c == "promo_price" else c for c in RAW_COLUMNS)


@register("parse_records", with_ingest(f"""
SELECT zip_date, file_name, delimiter, n_fields, {_FIELDS} FROM raw"""))
def _parse(spark, sf):
    rows = A.decode_archives(fixture_archives(spark, sf))
    return rows.filter("kind = 'record'").select("zip_date", "file_name", "delimiter", "n_fields", *RAW_COLUMNS)


@register("archive_scan", with_ingest(f"""
SELECT zip_date, COUNT(DISTINCT l_orderkey // {ARCHIVE_ORDERS}) AS archives, 'ok' AS status FROM raw GROUP BY zip_date
UNION ALL SELECT zip_date, COUNT(DISTINCT l_orderkey // {ARCHIVE_ORDERS}), 'corrupt' FROM raw GROUP BY zip_date"""))
def _scan(spark, sf):
    good = write_once(fixture_archives(spark, sf))  # packed once, read whole and cut
    # The same archives with their last kilobyte cut off are reported, and give no rows.
    cut = good.withColumn("content", F.expr("substring(content, 1, length(content) - least(1000, length(content) div 2))"))
    rows = A.decode_archives(good.union(cut))
    return rows.filter("kind = 'archive'").groupBy("zip_date", "status").agg(F.count("*").alias("archives"))


def archive_files(spark, archives):
    """Archives as files of the shared folder (a byte behind each, which readers pass over); their paths."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    (archives.select("zip_date", F.col("content").cast("string").alias("value"))
     # (Tasks move their own files; nobody reads the folder before all are there.)
     .write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("zip_date").text(base))
    return base


def folder_date(path):
    return F.regexp_extract(path, r"zip_date=([^/]+)/", 1)


# Sizes that make every archive of the driver tables a large one, in many pieces, groups and blocks.
RANGES = {"whole_bytes": 0, "piece_bytes": 1 << 16, "tail_bytes": 1 << 12, "group_bytes": 1 << 18, "block_bytes": 1 << 16}


def _by_range(spark, archives):
    return A.scan_archives(spark, archive_files(spark, archives), date_of=folder_date, name_filter="*.txt", **RANGES)


@register("parse_records_by_range", with_ingest(f"""
SELECT zip_date, file_name, delimiter, n_fields, {_FIELDS} FROM raw"""))
def _parse_by_range(spark, sf):
    rows = _by_range(spark, fixture_archives(spark, sf))
    return rows.filter("kind = 'record'").select("zip_date", "file_name", "delimiter", "n_fields", *RAW_COLUMNS)


@register("archive_scan_by_range", with_ingest(f"""
SELECT zip_date, COUNT(DISTINCT l_orderkey // {ARCHIVE_ORDERS}) AS archives, 'ok' AS status FROM raw GROUP BY zip_date
UNION ALL SELECT zip_date, COUNT(DISTINCT l_orderkey // {ARCHIVE_ORDERS}), 'corrupt' FROM raw GROUP BY zip_date"""))
def _scan_by_range(spark, sf):
    good = write_once(fixture_archives(spark, sf))
    cut = good.withColumn("content", F.expr("substring(content, 1, length(content) - least(1000, length(content) div 2))"))
    rows = _by_range(spark, good.union(cut))
    return rows.filter("kind = 'archive'").groupBy("zip_date", "status").agg(F.count("*").alias("archives"))


# ---------------------------------------------------------------------------
# Nomenclatures
# ---------------------------------------------------------------------------

def _json_text(rows, *fields):
    """One JSON array of the rows (a table of a few dozen), in order of ``ord``."""
    items = F.sort_array(F.collect_list(F.struct("ord", *fields)))
    return rows.agg(F.to_json(F.transform(items, lambda x: F.struct(*[x[f].alias(f) for f in fields]))).alias("value"))


@register("load_settlement_nomenclature", """
WITH e AS (
  SELECT lpad(CAST(n_nationkey % 20 AS VARCHAR), 5, '0') AS code, n_name AS name, 0 AS prio, -n_nationkey AS ord FROM nation
  UNION ALL SELECT CASE WHEN n_nationkey % 7 > 0 THEN lpad(CAST(n_nationkey AS VARCHAR), 5, '0') ELSE '' END,
                   n_name || ' d', 1, n_nationkey FROM nation WHERE n_nationkey % 7 > 0
  UNION ALL SELECT lpad(CAST(n_nationkey // 2 + 15 AS VARCHAR), 5, '0'), n_name || ' r', 2, n_nationkey FROM nation)
SELECT code, name FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY prio, ord) AS rn FROM e) x WHERE rn = 1""")
def _settlements(spark, sf):
    n = X.table(spark, sf, "nation")
    key = F.col("n_nationkey")
    code = lambda k: F.lpad(k.cast("string"), 5, "0")
    files = (
        ("primary", n.select(key.alias("ord"), code(key % 20).alias("ekatte"), F.col("n_name").alias("name"))),
        ("districts", n.select(key.alias("ord"), F.when(key % 7 > 0, code(key)).otherwise("").alias("ekatte"),
                               F.concat("n_name", F.lit(" d")).alias("name"))),
        ("registry", n.select(key.alias("ord"), code(F.floor(key / 2) + 15).alias("ekatte"),
                              F.concat("n_name", F.lit(" r")).alias("name"))),
    )
    parts = [N.settlement_entries(N.entries_of(_json_text(rows, "ekatte", "name")), "ekatte", kind, prio)
             for prio, (kind, rows) in enumerate(files)]
    return N.precedence(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register("load_category_nomenclature", """
SELECT CAST(n % 20 AS VARCHAR) AS code, arg_max(p_brand, n) AS name
FROM (SELECT DISTINCT p_brand, CAST(split_part(p_brand, '#', 2) AS BIGINT) AS n FROM part) b GROUP BY 1""")
def _categories(spark, sf):
    b = X.table(spark, sf, "part").select("p_brand").distinct()
    n = X.brand_number()
    rows = b.select(n.alias("ord"), (n % 20).alias("id"), F.col("p_brand").alias("name"))
    return N.category_names(N.entries_of(_json_text(rows, "id", "name")))


# ---------------------------------------------------------------------------
# Warehouse
# ---------------------------------------------------------------------------

_ROOTS: dict[tuple[str, str], str] = {}


def fixture_warehouse(spark, sf) -> str:
    """Root of a warehouse ingested and published from the raw records, in the
    shared folder; made once per application and table folder."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _ROOTS:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouse-{uuid.uuid4().hex}"
        # Lines of an order are numbered within their order.
        rows = fixture_raw(spark, sf)
        line = F.coalesce(F.col("pos.l_linenumber"), F.lit(0))
        I.ingest_records(spark, rows.withColumn("row_seq", F.col("row_seq") * 8 + line), root, fixture_noms(spark, sf), "run")
        sync.run_sync(spark, root)
        _ROOTS[at] = root
    return _ROOTS[at]


_NATURAL = f"""
natural_rows AS (
  SELECT c.zip_date, c.file_name, c.ekatte, c.store_name, c.product_code, c.category_code, c.uic,
         CAST({typed_price('c.retail_text')} AS DOUBLE) AS retail_price,
         CAST({typed_price('c.promo_text')} AS DOUBLE) AS promo_price
  FROM conf c)"""
_NEWEST = "zip_date = (SELECT MAX(zip_date) FROM conf)"


def _with_names(df, star):
    """Replace keys by natural values (products first: rows are only keys yet where their join moves them)."""
    store = (star.dim("store").join(star.dim_for_join("settlement"), "settlement_key")
             .join(star.dim_for_join("company"), "company_key").select("store_key", "store_name", "ekatte", "uic"))
    return (df.join(star.dim_for_join("product").select("product_key", "product_code"), "product_key")
            .join(SizedFrame(store).for_join(), "store_key")
            .join(star.dim_for_join("category").select("category_key", "category_code"), "category_key")
            .join(star.dim_for_join("file").select("file_key", "file_name"), "file_key"))


@register("write_fact_partition", "WITH " + INGEST_CTES.strip() + "," + _NATURAL + " SELECT * FROM natural_rows")
def _facts(spark, sf):
    star = W.read_star(spark, fixture_warehouse(spark, sf))
    return _with_names(star.fact, star).select(
        "zip_date", "file_name", "ekatte", "store_name", "product_code", "category_code", "uic", "retail_price", "promo_price")


@register("write_dim", with_ingest("""
SELECT x.store_name, s.ekatte, o.uic FROM d_store x
JOIN d_settlement s ON s.settlement_key = x.settlement_key JOIN d_company o ON o.company_key = x.company_key"""))
def _write_dim(spark, sf):
    star = W.read_star(spark, fixture_warehouse(spark, sf))
    return (star.dim("store").join(star.dim("settlement"), "settlement_key").join(star.dim("company"), "company_key")
            .select("store_name", "ekatte", "uic"))


@register("load_dim", with_ingest("""
SELECT COUNT(*) AS n, CAST(MIN(product_key) AS BIGINT) AS first_key, CAST(MAX(product_key) + 1 AS BIGINT) AS next_key,
       COUNT(DISTINCT product_code) AS codes FROM d_product"""))
def _load_dim(spark, sf):
    dim = W.read_dim(spark, fixture_warehouse(spark, sf), "product")
    return dim.agg(F.count("*").alias("n"), F.min("product_key").alias("first_key"),
                   (F.max("product_key") + 1).alias("next_key"), F.countDistinct("product_code").alias("codes"))


@register("write_quality_report", QUALITY_SQL)
def _write_quality(spark, sf):
    return W.read_quality(spark, fixture_warehouse(spark, sf), "run")


@register("replace_lookback", "WITH " + INGEST_CTES.strip() + "," + _NATURAL + f"""
SELECT file_name, ekatte, store_name, product_code, NULLIF(category_code, '') AS category_code,
       NULLIF(uic, '') AS uic, retail_price, promo_price
FROM natural_rows WHERE {_NEWEST}""")
def _replace_lookback(spark, sf):
    sv = sync.read_serving(spark, fixture_warehouse(spark, sf))
    return _with_names(sv.lookback, sv.star).select(
        "file_name", "ekatte", "store_name", "product_code", "category_code", "uic", "retail_price", "promo_price")


@register("refresh_projection", with_ingest(f"""
SELECT c.file_name, NULLIF(c.product_name, '') AS product_name, k.category_name, s.settlement_name, c.store_name, c.company_name,
       CAST({typed_price('c.retail_text')} AS DOUBLE) AS retail_price, CAST({typed_price('c.promo_text')} AS DOUBLE) AS promo_price
FROM conf c JOIN res_s s ON s.ekatte = c.ekatte JOIN res_c k ON k.category_code = c.category_code WHERE c.{_NEWEST}"""))
def _refresh_projection(spark, sf):
    sv = sync.read_serving(spark, fixture_warehouse(spark, sf))
    return sv.projection.select("file_name", "product_name", "category_name", "settlement_name", "store_name", "company_name",
                                "retail_price", "promo_price")
