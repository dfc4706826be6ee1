"""Registered queries: serving merges/prunes, work lists, link discovery,
pipeline statistics, documented audits and display formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import conform as C
from shelfline.functions import prices as P
from shelfline.operators import dims as D
from shelfline.operators import serve as S
from shelfline.operators.joins import SizedFrame
from shelfline.operators.lookback import build_lookback, latest_dates
from shelfline.plans import analyses as A
from shelfline.plans import ingest as I
from shelfline.plans.catalog import register
from shelfline.plans.fixture_runs import fixture_first_run
from shelfline.plans.oracle import with_fixtures
from shelfline.plans.oracle_ingest import with_ingest
from shelfline.sources import fixtures as X
from shelfline.sources import links as L
from shelfline.sources.fixtures import fixture_star

# Fixed scenario parameters.
HISTORY_UNTIL = "1998-01-01"   # archives before this date were processed by an earlier run
FORCE_FROM = "1998-06-01"      # forced re-processing from this date
LINK_SUFFIX = "e"              # the driver pages hold no .zip links
MIRROR_PATH = "/en/"           # pages of this section were fetched already
LINK_FORCE = "t"


# ---------------------------------------------------------------------------
# Serving merges and prunes
# ---------------------------------------------------------------------------

def _customer_stores(spark, sf):
    c = X.table(spark, sf, "customer")
    return c.select(F.col("c_custkey").cast("bigint").alias("store_key"),
                    F.col("c_name").alias("store_name"),
                    F.col("c_nationkey").cast("bigint").alias("settlement_key"),
                    (F.col("c_custkey") % 5).cast("bigint").alias("company_key"))


_CUSTOMER_STORES = """
cust_st AS (SELECT CAST(c_custkey AS BIGINT) AS store_key, c_name AS store_name,
                   CAST(c_nationkey AS BIGINT) AS settlement_key, CAST(c_custkey % 5 AS BIGINT) AS company_key
            FROM customer)"""


@register("upsert_dim_serving", with_fixtures("," + _CUSTOMER_STORES + """
SELECT store_key, store_name, settlement_key, company_key FROM rf_dim_store
UNION ALL
SELECT store_key, store_name, settlement_key, company_key FROM cust_st
WHERE store_key NOT IN (SELECT store_key FROM rf_dim_store)"""))
def _upsert(spark, sf):
    return S.upsert(_customer_stores(spark, sf), X.dim_store(spark, sf), "store_key")


@register("upsert_counts", with_fixtures("," + _CUSTOMER_STORES + """
SELECT COUNT(*) FILTER (WHERE t.store_key IS NULL) AS inserted,
       COUNT(*) FILTER (WHERE t.store_key IS NOT NULL) AS updated
FROM rf_dim_store s LEFT JOIN cust_st t ON t.store_key = s.store_key"""))
def _upsert_counts(spark, sf):
    return S.upsert_counts(_customer_stores(spark, sf), X.dim_store(spark, sf), "store_key")


def _retained(spark, sf):
    star = fixture_star(spark, sf)
    newest = latest_dates(star.fact, 3, star.partition_col)
    # partition dates as ISO text (the snapshot of year y is y-01-01)
    iso = newest.select(F.date_format(F.make_date(F.col("date_key").cast("int"), F.lit(1), F.lit(1)),
                                      "yyyy-MM-dd").alias("zip_date"))
    return star, iso


_RETAINED_SQL = """
, retained AS (
  SELECT strftime(make_date(CAST(date_key AS INTEGER), 1, 1), '%Y-%m-%d') AS zip_date
  FROM (SELECT DISTINCT date_key FROM rf_fact) d ORDER BY date_key DESC LIMIT 3),
retained_keys AS (
  SELECT date_key FROM rf_dim_date WHERE strftime(date, '%Y-%m-%d') IN (SELECT zip_date FROM retained))
"""


@register("retained_date_keys", with_fixtures(_RETAINED_SQL + "SELECT date_key FROM retained_keys"))
def _retained_keys(spark, sf):
    star, iso = _retained(spark, sf)
    return S.retained_date_keys(star.dim("date"), iso)


@register("prune_dim_date", with_fixtures(_RETAINED_SQL + """
SELECT date_key, date FROM rf_dim_date WHERE date_key IN (SELECT date_key FROM retained_keys)"""))
def _prune_date(spark, sf):
    star, iso = _retained(spark, sf)
    kept, _ = S.prune_dim_date(star.dim("date"), S.retained_date_keys(star.dim("date"), iso))
    return kept.select("date_key", "date")


# Categories that no fact uses, with codes outside the official range or no number.
_OTHER_CATEGORIES = """
, all_categories AS (
  SELECT category_key, category_code, category_name FROM rf_dim_category
  UNION ALL
  SELECT 1000 + n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'X' || CAST(n_nationkey AS VARCHAR)
         ELSE CAST(n_nationkey * 9 AS VARCHAR) END, n_name FROM nation)
"""


def _all_categories(spark, sf):
    n = F.col("n_nationkey").cast("bigint")
    other = X.table(spark, sf, "nation").select(
        (n + 1000).alias("category_key"),
        F.when(n % 3 == 0, F.concat(F.lit("X"), n.cast("string"))).otherwise((n * 9).cast("string")).alias("category_code"),
        F.col("n_name").alias("category_name"))
    return X.dim_category(spark, sf).unionByName(other)


@register("prune_dim_category", with_fixtures(_OTHER_CATEGORIES + """
SELECT category_key, category_code, category_name FROM all_categories
WHERE category_key IN (SELECT category_key FROM rf_lookback)"""))
def _prune_category(spark, sf):
    star = fixture_star(spark, sf)
    kept, _ = S.prune_dim_category(_all_categories(spark, sf), build_lookback(star))
    return kept


# ---------------------------------------------------------------------------
# Work lists and link discovery
# ---------------------------------------------------------------------------

def _raw_dates(spark, sf):
    return X.raw_records(spark, sf).filter("kind = 'archive'").select("zip_date")


_RAW_DATES = f"""
arch AS (SELECT DISTINCT zip_date FROM raw),
have AS (SELECT DISTINCT zip_date FROM raw WHERE zip_date < '{HISTORY_UNTIL}')"""


@register("reprocess_worklist", with_ingest("," + _RAW_DATES + f"""
SELECT zip_date FROM arch
WHERE zip_date NOT IN (SELECT zip_date FROM have) OR zip_date >= '{FORCE_FROM}'"""))
def _reprocess(spark, sf):
    arch = _raw_dates(spark, sf)
    have = arch.filter(F.col("zip_date") < HISTORY_UNTIL)
    return I.reprocess_worklist(arch, have, FORCE_FROM).select("zip_date")


@register("pipeline_stats", with_ingest("," + _RAW_DATES + """
SELECT (SELECT COUNT(*) FROM arch) AS archives,
       (SELECT MIN(zip_date) FROM arch) AS first_archive,
       (SELECT MAX(zip_date) FROM arch) AS last_archive,
       (SELECT COUNT(*) FROM have) AS fact_partitions,
       COALESCE((SELECT MAX(zip_date) FROM have), 'not built') AS newest_fact"""))
def _stats(spark, sf):
    arch = _raw_dates(spark, sf)
    return A.pipeline_stats(arch, arch.filter(F.col("zip_date") < HISTORY_UNTIL))


def _links_sql(prefix: str = "", where: str = "") -> str:
    """Links by cutting pages at anchors and quotes (the driver pages quote every href)."""
    origin = "regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
    path = "split_part(split_part(substr(base, length(" + origin + ") + 1), '#', 1), '?', 1)"
    folder = f"array_to_string(string_split({path}, '/')[1:-2], '/') || '/'"
    return f"""
{prefix}tags AS (
  SELECT url AS base, split_part(piece, '>', 1) AS tag
  FROM (SELECT url, unnest(string_split(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<a ')[2:]) AS piece
        FROM pages {where}) x),
{prefix}hrefs AS (
  SELECT base, replace(split_part(split_part(' ' || tag, ' href="', 2), '"', 1), '&amp;', '&') AS href
  FROM {prefix}tags WHERE contains(' ' || tag, ' href="')),
{prefix}links AS (
  SELECT DISTINCT
    CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
         WHEN starts_with(href, '//') THEN split_part(base, ':', 1) || ':' || href
         WHEN starts_with(href, '/') THEN {origin} || href
         WHEN href = '' THEN split_part(base, '#', 1)
         ELSE {origin} || {folder} || href END AS link
  FROM {prefix}hrefs WHERE suffix(lower(href), '{LINK_SUFFIX}'))"""


@register("discover_archive_links", "WITH " + _links_sql().strip() + "\nSELECT link FROM links")
def _links(spark, sf):
    return L.discover_links(X.table(spark, sf, "pages"), suffix=LINK_SUFFIX)


# Anchors whose character references no parser may fail at, and the paths they stand for.
ODD_ANCHORS = {"&#1114112;a": "\ufffda", "&#xD800;b": "\ufffdb", "&#99999999999999999999;c": "\ufffdc", "&eacute;": "é", "&#150;": "\u2013",
               "&#65": "A", "&nosuch;": "&nosuch;", "&#1;": "", "&amp;amp;": "&amp;"}


@register("discover_archive_links_references", "WITH o AS (SELECT DISTINCT regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS o "
          "FROM pages) SELECT o.o || '/odd/' || p.p || '-x.zip' AS link FROM o, (VALUES "
          + ", ".join(f"('{p}')" for p in ODD_ANCHORS.values()) + ") AS p(p)")
def _odd_links(spark, sf):
    """Every page with anchors of bad and rare references appended; none of them ends the job."""
    anchors = "".join(f'<a href="/odd/{r}-x.zip">x</a>' for r in ODD_ANCHORS)
    pages = X.table(spark, sf, "pages").withColumn("html", F.concat(F.coalesce("html", F.lit("")), F.lit("-->" + anchors)))
    return L.discover_links(pages)


_FILE_NAME = "regexp_extract(regexp_replace(link, '[?#].*$', ''), '([^/]*)$', 1)"


@register("incremental_worklist", "WITH " + _links_sql().strip() + ","
          + _links_sql("m_", f"WHERE strpos(url, '{MIRROR_PATH}') > 0") + f""",
named AS (SELECT link, {_FILE_NAME} AS file_name FROM links),
mirror AS (SELECT DISTINCT {_FILE_NAME} AS file_name FROM m_links)
SELECT link, file_name, regexp_replace(file_name, '(?i){LINK_SUFFIX}$', '') AS file_date FROM named
WHERE file_name NOT IN (SELECT file_name FROM mirror)
   OR regexp_replace(file_name, '(?i){LINK_SUFFIX}$', '') >= '{LINK_FORCE}'""")
def _worklist(spark, sf):
    pages = X.table(spark, sf, "pages")
    links = L.discover_links(pages, suffix=LINK_SUFFIX)
    mirror = (L.discover_links(pages.filter(F.instr("url", MIRROR_PATH) > 0), suffix=LINK_SUFFIX)
              .select(L.link_file_name(F.col("link")).alias("file_name")))
    return L.incremental_worklist(links, mirror, LINK_FORCE, suffix=LINK_SUFFIX)


@register("detect_delimiter", """
SELECT doc_id,
       CASE WHEN length(l) - length(replace(l, ';', '')) > length(l) - length(replace(l, ',', ''))
            THEN ';' ELSE ',' END AS delimiter
FROM (SELECT doc_id, regexp_extract(text, '^([^\\r\\n]*)', 1) AS l FROM documents) d""")
def _delim(spark, sf):
    docs = X.table(spark, sf, "documents")
    return docs.select("doc_id", C.delimiter_of(C.first_line(F.col("text"))).alias("delimiter"))


# ---------------------------------------------------------------------------
# Documented audits (on a first ingest run)
# ---------------------------------------------------------------------------

def _audit_class(code: str) -> str:
    return (f"CASE WHEN {code} = '' THEN 'empty' WHEN {code} = '-1' THEN 'sentinel' "
            f"WHEN regexp_full_match({code}, '0[0-9]{{5}}') THEN 'swapped_zero_padded' "
            f"WHEN regexp_full_match({code}, '63[0-9]{{4}}') THEN 'swapped_63' "
            f"WHEN regexp_full_match({code}, '[0-9]+') THEN 'out_of_range' ELSE 'non_numeric' END")


@register("unknown_category_audit", with_ingest(f"""
SELECT {_audit_class('c.category_code')} AS failure_group,
       COUNT(*) AS categories, CAST(SUM(COALESCE(f.n, 0)) AS BIGINT) AS rows_affected
FROM d_category c
LEFT JOIN (SELECT category_key, COUNT(*) AS n FROM i_fact GROUP BY category_key) f
       ON f.category_key = c.category_key
WHERE starts_with(c.category_name, '(unknown:')
GROUP BY 1"""))
def _audit(spark, sf):
    _, rows, _, built = fixture_first_run(spark, sf)
    fact = I.resolve_fact_keys(rows, built.full)
    return A.unknown_category_audit(built.full["category"], fact)


@register("column_swap_detection", with_ingest("""
SELECT f.file_name, f.zip_date, COUNT(*) AS rows_swapped
FROM i_fact x
JOIN d_category c ON c.category_key = x.category_key
JOIN d_file f ON f.file_key = x.file_key
WHERE starts_with(c.category_name, '(unknown:')
  AND c.category_code IN (SELECT product_code FROM d_product)
GROUP BY f.file_name, f.zip_date"""))
def _swap(spark, sf):
    _, rows, _, built = fixture_first_run(spark, sf)
    fact = I.resolve_fact_keys(rows, built.full)
    return A.column_swap_detection(fact, built.full["category"], built.full["product"],
                                   built.full["file"])


@register("patch_unknown_settlements", with_ingest("""
, alt AS (SELECT 'X' || CAST(n_nationkey AS VARCHAR) AS code, n_name || ' (alt)' AS name FROM nation)
SELECT CAST(s.settlement_key AS BIGINT) AS settlement_key, s.ekatte,
       CASE WHEN starts_with(s.settlement_name, '(unknown:') AND a.name IS NOT NULL
            THEN a.name ELSE s.settlement_name END AS settlement_name
FROM d_settlement s LEFT JOIN alt a ON a.code = s.ekatte"""))
def _patch(spark, sf):
    _, _, _, built = fixture_first_run(spark, sf)
    n = X.table(spark, sf, "nation")
    alt = n.select(F.concat(F.lit("X"), F.col("n_nationkey").cast("string")).alias("code"),
                   F.concat(F.col("n_name"), F.lit(" (alt)")).alias("name"))
    lookup = SizedFrame(X.settlement_nomenclature(spark, sf).df.unionByName(alt))
    patched, _ = D.patch_unknown_settlements(built.full["settlement"], lookup)
    return patched


# ---------------------------------------------------------------------------
# Display formats and typed prices
# ---------------------------------------------------------------------------

@register("format_date_bg", with_fixtures("""
SELECT file_key, strftime(zip_date, '%d.%m.%Y') AS zip_date_bg FROM rf_dim_file"""))
def _fmt_date(spark, sf):
    f = X.dim_file(spark, sf)
    return f.select("file_key", P.format_date_bg(F.col("zip_date").cast("string")).alias("zip_date_bg"))


@register("format_price_2dp", with_fixtures("""
SELECT date_key, store_key, file_key, product_key,
       CASE WHEN price IS NULL THEN '—' ELSE CAST(CAST(ROUND(price, 2) AS DECIMAL(14,2)) AS VARCHAR) END AS price_text
FROM rf_projection"""))
def _fmt_price(spark, sf):
    from shelfline.plans.catalog import serving
    pr = serving(spark, sf).projection
    return pr.select("date_key", "store_key", "file_key", "product_key",
                     P.format_price_2dp("price").alias("price_text"))


@register("parse_price_bound", with_ingest("""
SELECT retail_price AS bound_text,
       CASE WHEN regexp_full_match(trim(retail_price), '[0-9]+([.,][0-9]{1,2})?')
            THEN CAST(CAST(replace(trim(retail_price), ',', '.') AS DECIMAL(38,2)) AS DOUBLE) END AS bound
FROM (SELECT DISTINCT retail_price FROM raw) r"""))
def _bound(spark, sf):
    r = X.raw_records(spark, sf).filter("kind = 'record'").select("retail_price").distinct()
    return r.select(F.col("retail_price").alias("bound_text"),
                    P.parse_price_bound("retail_price").alias("bound"))


@register("known_categories_only", with_fixtures("""
SELECT category_key, category_name FROM rf_dim_category WHERE category_name NOT LIKE '(unknown:%)'"""))
def _known(spark, sf):
    from shelfline.plans.queries import known_categories_only
    return known_categories_only(X.dim_category(spark, sf)).select("category_key", "category_name")


@register("official_category_codes", with_fixtures(_OTHER_CATEGORIES + """
SELECT category_key, category_code FROM all_categories
WHERE TRY_CAST(category_code AS INTEGER) BETWEEN 1 AND 101"""))
def _official(spark, sf):
    from shelfline.plans.queries import official_category_codes
    return official_category_codes(_all_categories(spark, sf)).select("category_key", "category_code")

