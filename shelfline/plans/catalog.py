"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Each query runs the library on the warehouse expressed on the driver tables
(``sources.fixtures``) over whole tables.  Parameters are the ones a user of
the browse page would pass: the newest snapshot, one settlement, one category.
Output decimals are compared as double and keys as bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.prices import parse_price_bound_value
from shelfline.operators.dims import number_sorted
from shelfline.plans import queries as q
from shelfline.plans.oracle import avg, with_fixtures, zero_filled
from shelfline.session import apply_conf
from shelfline.sources.fixtures import fixture_star

# Fixed query parameters (the newest snapshot of the fixture is 2001).
DATE = 2001
SETTLEMENT = 3
CATEGORY = 13
COMPANY = 2
STORE = 7
NAME = "Plate"
PRICE_MIN = 1000
PRICE_MAX = 20000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double, integers as bigint (the oracle's types)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark, sf_dir):
            apply_conf(spark)
            return comparable(fn(spark, sf_dir))
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def serving(spark: SparkSession, sf_dir: str) -> q.Serving:
    return q.serving_from_star(fixture_star(spark, sf_dir))


# ---------------------------------------------------------------------------
# Serving tables
# ---------------------------------------------------------------------------

@register("lookback_join", with_fixtures("""
SELECT date_key, store_key, file_key, category_key, product_key,
       CAST(retail_price AS DOUBLE) AS retail_price, CAST(promo_price AS DOUBLE) AS promo_price,
       CAST(retail_price_day1 AS DOUBLE) AS retail_price_day1,
       CAST(promo_price_day1 AS DOUBLE) AS promo_price_day1,
       CAST(retail_price_day2 AS DOUBLE) AS retail_price_day2,
       CAST(promo_price_day2 AS DOUBLE) AS promo_price_day2
FROM rf_lookback"""))
def _lookback(spark, sf):
    return serving(spark, sf).lookback


@register("star_projection", with_fixtures("""
SELECT date_key, settlement_key, category_key, company_key, store_key, file_key, product_key,
       file_name, product_name, category_name, settlement_name, store_name, company_name,
       CAST(retail_price AS DOUBLE) AS retail_price, CAST(promo_price AS DOUBLE) AS promo_price,
       CAST(price AS DOUBLE) AS price
FROM rf_projection"""))
def _projection(spark, sf):
    return serving(spark, sf).projection


@register("latest_dates", with_fixtures("""
SELECT date_key FROM (SELECT DISTINCT date_key FROM rf_fact) d ORDER BY date_key DESC LIMIT 3"""))
def _latest_dates(spark, sf):
    return q.newest_dates(fixture_star(spark, sf), 3)


@register("latest_date", with_fixtures("SELECT MAX(date_key) AS latest_date FROM rf_fact"))
def _latest_date(spark, sf):
    return q.newest_date(fixture_star(spark, sf))


# ---------------------------------------------------------------------------
# Browse
# ---------------------------------------------------------------------------

_BROWSE_SELECT = """
SELECT file_name, product_name, category_name, settlement_name, store_name, company_name,
       CAST(retail_price AS DOUBLE) AS retail_price, CAST(promo_price AS DOUBLE) AS promo_price,
       CAST(price AS DOUBLE) AS price
FROM rf_projection WHERE {where}
ORDER BY product_name ASC NULLS LAST, store_name ASC NULLS LAST, product_key ASC NULLS LAST,
         store_key ASC NULLS LAST, file_key ASC NULLS LAST, retail_price ASC NULLS LAST,
         promo_price ASC NULLS LAST
LIMIT {limit} OFFSET {offset}"""


@register("browse_rows", with_fixtures(_BROWSE_SELECT.format(where="1=1", limit=100, offset=0)))
def _browse(spark, sf):
    return q.browse_rows(serving(spark, sf), offset=0, limit=100)


@register("browse_rows_date_page2", with_fixtures(_BROWSE_SELECT.format(
    where=f"date_key = {DATE}", limit=100, offset=200)))
def _browse_p2(spark, sf):
    off, lim = q.page_window(2)
    return q.browse_rows(serving(spark, sf), date_key=DATE, offset=off, limit=lim)


@register("browse_rows_after", with_fixtures(_BROWSE_SELECT.format(
    where=f"date_key = {DATE}", limit=100, offset=100)))
def _browse_after(spark, sf):
    # The second page from the last row of the first one.
    sv = serving(spark, sf)
    page = q.browse_rows(sv, date_key=DATE, keep_order_columns=True).collect()  # one page
    if not page:
        return q.browse_rows(sv, date_key=DATE, offset=100)
    seen = q.rows_equal_to_last(page)
    return q.browse_after(sv, page[-1], seen, date_key=DATE).select(*q.BROWSE_COLUMNS)


@register("browse_rows_name", with_fixtures(_BROWSE_SELECT.format(
    where=f"product_name ILIKE '%{NAME}%' ESCAPE '\\'", limit=100, offset=0)))
def _browse_name(spark, sf):
    return q.browse_rows(serving(spark, sf), product_name=NAME)


@register("browse_rows_price", with_fixtures(_BROWSE_SELECT.format(
    where=f"price >= {PRICE_MIN} AND price <= {PRICE_MAX}", limit=100, offset=0)))
def _browse_price(spark, sf):
    return q.browse_rows(serving(spark, sf), price_min=PRICE_MIN, price_max=PRICE_MAX)


@register("browse_rows_all_filters", with_fixtures(_BROWSE_SELECT.format(
    where=(f"date_key = {DATE} AND settlement_key = {SETTLEMENT} AND category_key = {CATEGORY} "
           f"AND company_key IN (SELECT company_key FROM rf_dim_store WHERE settlement_key = {SETTLEMENT} "
           f"ORDER BY store_key LIMIT 1) AND store_key IN (SELECT store_key FROM rf_dim_store "
           f"WHERE settlement_key = {SETTLEMENT} ORDER BY store_key LIMIT 1) "
           f"AND product_name ILIKE '%E%' ESCAPE '\\' AND price >= 500 AND price <= 100000"),
    limit=100, offset=0)))
def _browse_all(spark, sf):
    sv = serving(spark, sf)
    store = sv.star.dim("store").filter(F.col("settlement_key") == SETTLEMENT).orderBy("store_key").first()
    return q.browse_rows(sv, date_key=DATE, settlement_key=SETTLEMENT, category_key=CATEGORY,
                         company_key=store["company_key"] if store else -1, store_key=store["store_key"] if store else -1,
                         product_name="E", price_min=500, price_max=100000)


@register("browse_rows_escaped_name", with_fixtures(_BROWSE_SELECT.format(
    where=r"lower(product_name) LIKE '%late%'", limit=100, offset=0)))
def _browse_escaped(spark, sf):
    # A backslash before an ordinary character means that character.
    return q.browse_rows(serving(spark, sf), product_name="l\\ate")


@register("browse_rows_high_bound", with_fixtures(_BROWSE_SELECT.format(
    where="price >= 100000000", limit=100, offset=0)))
def _browse_high(spark, sf):
    return q.browse_rows(serving(spark, sf), price_min=parse_price_bound_value("100000000"))


@register("late_materialised_page")
def _late(spark, sf):
    return q.late_materialised_page(serving(spark, sf), offset=0, limit=10)


# Rule: rows with a product and a store, in browse order (retail, promo last);
# the first ten keep only if category, settlement, company and file exist too.
ORACLE["late_materialised_page"] = with_fixtures("""
, ranked AS (
  SELECT l.*, p.product_name, s.store_name, s.settlement_key, s.company_key,
         row_number() OVER (ORDER BY p.product_name ASC NULLS LAST, s.store_name ASC NULLS LAST, l.product_key,
                            l.store_key, l.file_key, l.retail_price ASC NULLS LAST, l.promo_price ASC NULLS LAST) AS place
  FROM rf_lookback l INNER JOIN rf_dim_product p USING (product_key) INNER JOIN rf_dim_store s USING (store_key))
SELECT f.file_name, r.product_name, c.category_name, t.settlement_name, r.store_name, o.company_name,
       r.retail_price::DOUBLE AS retail_price, r.promo_price::DOUBLE AS promo_price,
       (CASE WHEN r.promo_price > 0 AND r.retail_price IS NOT NULL AND r.promo_price < r.retail_price THEN r.promo_price
             WHEN r.promo_price > 0 AND r.retail_price IS NULL THEN r.promo_price
             ELSE r.retail_price END)::DOUBLE AS effective_price
FROM ranked r, rf_dim_file f, rf_dim_category c, rf_dim_settlement t, rf_dim_company o
WHERE r.place <= 10 AND f.file_key = r.file_key AND c.category_key = r.category_key
  AND t.settlement_key = r.settlement_key AND o.company_key = r.company_key""")


_JSON_FIELDS = ", ".join(f"{c} := CAST(CAST({c} AS DECIMAL(12,4)) AS VARCHAR)" if "price" in c else f"{c} := {c}"
                         for c in q.BROWSE_COLUMNS)
_JSON_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in (*q.BROWSE_ORDER, "retail_price", "promo_price"))


@register("rows_as_json", with_fixtures(f"""
, page AS (SELECT * FROM rf_projection WHERE date_key = {DATE} ORDER BY {_JSON_ORDER} LIMIT 100)
SELECT CAST(to_json(coalesce(list(struct_pack({_JSON_FIELDS}) ORDER BY {_JSON_ORDER}), [])) AS VARCHAR) AS json FROM page"""))
def _rows_json(spark, sf):
    page = q.browse_rows(serving(spark, sf), date_key=DATE, offset=0, limit=100,
                         keep_order_columns=True)
    # Prices as fixed decimal text: the same in every engine.
    order = list(q.BROWSE_ORDER) + ["_r", "_p"]
    page = page.withColumns({"_r": F.col("retail_price"), "_p": F.col("promo_price")})
    page = page.withColumns({c: F.col(c).cast("decimal(12,4)").cast("string") for c in q.BROWSE_COLUMNS if "price" in c})
    return q.rows_as_json(page, order, list(q.BROWSE_COLUMNS))


# ---------------------------------------------------------------------------
# Grouped prices
# ---------------------------------------------------------------------------

def _grouped_sql(g1: str, g2: str | None, where: str) -> str:
    g2_sel = f", {g2} AS group2" if g2 else ""
    g2_grp = f", {g2}" if g2 else ""
    promo = "CASE WHEN promo_price IS NOT NULL AND promo_price > 0 THEN promo_price END"
    return with_fixtures(f"""
SELECT {g1} AS group1{g2_sel},
       {avg('price')} AS price_avg,
       CAST(MIN(price) AS DOUBLE) AS price_min, CAST(MAX(price) AS DOUBLE) AS price_max,
       {avg(promo)} AS promo_avg,
       CAST(MIN({promo}) AS DOUBLE) AS promo_min, CAST(MAX({promo}) AS DOUBLE) AS promo_max
FROM rf_projection WHERE {where}
GROUP BY {g1}{g2_grp}
ORDER BY {g1}""")


@register("grouped_prices_1", _grouped_sql("settlement_name", None, "1=1"))
def _grouped1(spark, sf):
    return q.grouped_prices(serving(spark, sf), "settlement_name")


@register("grouped_prices_1_date", _grouped_sql("date_key", None, f"company_key = {COMPANY}"))
def _grouped1d(spark, sf):
    return q.grouped_prices(serving(spark, sf), "date_key", company_key=COMPANY)


@register("grouped_prices_2", _grouped_sql("category_name", "store_name", f"date_key = {DATE}"))
def _grouped2(spark, sf):
    return q.grouped_prices(serving(spark, sf), "category_name", "store_name", date_key=DATE)


@register("grouped_prices_2_filtered", _grouped_sql(
    "company_name", "settlement_name",
    f"product_name ILIKE '%{NAME}%' ESCAPE '\\' AND price >= {PRICE_MIN} AND price <= {PRICE_MAX}"))
def _grouped2f(spark, sf):
    return q.grouped_prices(serving(spark, sf), "company_name", "settlement_name",
                            product_name=NAME, price_min=PRICE_MIN, price_max=PRICE_MAX)


# ---------------------------------------------------------------------------
# Cross-filter options
# ---------------------------------------------------------------------------

def _options_sql(dim: str, where: str) -> str:
    name_out = "store_name" if dim == "store" else "name"
    not_null = f"{dim}_key IS NOT NULL AND " if dim in ("settlement", "company") else ""
    return with_fixtures(f"""
SELECT DISTINCT {dim}_key, {dim}_name AS {name_out}
FROM rf_projection WHERE {not_null}{where}""")


@register("options_settlement", _options_sql("settlement", f"date_key = {DATE} AND category_key = {CATEGORY}"))
def _opt_s(spark, sf):
    return q.options(serving(spark, sf), "settlement", date_key=DATE, category_key=CATEGORY,
                     settlement_key=SETTLEMENT)


@register("options_category", _options_sql("category", f"date_key = {DATE} AND settlement_key = {SETTLEMENT}"))
def _opt_c(spark, sf):
    return q.options(serving(spark, sf), "category", date_key=DATE, settlement_key=SETTLEMENT)


@register("options_company", _options_sql("company", f"date_key = {DATE} AND store_key = {STORE}"))
def _opt_co(spark, sf):
    return q.options(serving(spark, sf), "company", date_key=DATE, store_key=STORE)


@register("options_store", _options_sql("store", f"date_key = {DATE} AND company_key = {COMPANY}"))
def _opt_st(spark, sf):
    return q.options(serving(spark, sf), "store", date_key=DATE, company_key=COMPANY)


@register("options_date", with_fixtures(f"""
SELECT dd.date_key, dd.date
FROM (SELECT DISTINCT date_key FROM rf_projection WHERE settlement_key = {SETTLEMENT}) k
JOIN rf_dim_date dd ON dd.date_key = k.date_key"""))
def _opt_d(spark, sf):
    return q.options(serving(spark, sf), "date", settlement_key=SETTLEMENT)


# ---------------------------------------------------------------------------
# Lookups
# ---------------------------------------------------------------------------

@register("available_dates", with_fixtures("SELECT DISTINCT date_key FROM rf_lookback"))
def _avail(spark, sf):
    return q.available_dates(serving(spark, sf))


# Lookups: keys that occur in the lookback, through the store's settlement.
_SEEN = with_fixtures("""
, seen AS (SELECT DISTINCT l.date_key, l.category_key, s.settlement_key
           FROM rf_lookback l INNER JOIN rf_dim_store s USING (store_key))
""")


@register("settlements_for_date", _SEEN + f"SELECT settlement_key FROM seen WHERE date_key = {DATE} GROUP BY ALL")
def _s4d(spark, sf):
    return q.settlements_for_date(serving(spark, sf), DATE)


@register("categories_for_settlement", _SEEN + f"""
SELECT category_key FROM seen WHERE date_key = {DATE} AND settlement_key = {SETTLEMENT} GROUP BY ALL""")
def _c4s(spark, sf):
    return q.categories_for_settlement(serving(spark, sf), SETTLEMENT, DATE)


@register("settlements_for_category", _SEEN + f"""
SELECT settlement_key FROM seen WHERE date_key = {DATE} AND category_key = {CATEGORY} GROUP BY ALL""")
def _s4c(spark, sf):
    return q.settlements_for_category(serving(spark, sf), CATEGORY, DATE)


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------

# The reports read one day's pair of prices: the current one or an earlier one.
_DAY_SUFFIX = {"current": "", "day1": "_day1", "day2": "_day2"}


def _report_base(offset: str, where: str) -> str:
    """One day's priced rows with their store, as CTE ``priced``."""
    x = _DAY_SUFFIX[offset]
    return with_fixtures(f"""
, priced AS (
  SELECT l.product_key, l.category_key, l.file_key, s.store_name, s.settlement_key, s.company_key,
         l.retail_price{x} AS retail, l.promo_price{x} AS promo
  FROM rf_lookback l INNER JOIN rf_dim_store s USING (store_key)
  WHERE l.date_key = {DATE} AND {where})
""")


def _report1_sql(offset: str) -> str:
    return _report_base(offset, f"s.settlement_key = {SETTLEMENT}") + f"""
SELECT category_key, {avg(zero_filled('retail', 'promo'))} AS avg_price FROM priced GROUP BY category_key"""


for _off in ("current", "day1", "day2"):
    def _mk1(off):
        def run(spark, sf):
            return q.report_1_category_prices(serving(spark, sf), DATE, SETTLEMENT, off)
        return run
    register(f"report_1_category_prices_{_off}", _report1_sql(_off))(_mk1(_off))


_PRICE_COLUMNS = f"""retail::DOUBLE AS retail_price, promo::DOUBLE AS promo_price,
       ({zero_filled('retail', 'promo')})::DOUBLE AS calculated_price"""


def _report2_sql(offset: str) -> str:
    return _report_base(offset, f"s.settlement_key = {SETTLEMENT} AND l.category_key = {CATEGORY}") + f"""
SELECT product_key, category_key, file_key, {_PRICE_COLUMNS},
       p.product_name, store_name, o.company_name, f.file_name, f.zip_date
FROM priced INNER JOIN rf_dim_company o USING (company_key) INNER JOIN rf_dim_product p USING (product_key)
     LEFT JOIN rf_dim_file f USING (file_key)"""


def _report3_sql(offset: str) -> str:
    return _report_base(offset, f"l.category_key = {CATEGORY}") + f"""
SELECT product_key, category_key, {_PRICE_COLUMNS},
       t.settlement_name, p.product_name, store_name, o.company_name
FROM priced INNER JOIN rf_dim_company o USING (company_key) INNER JOIN rf_dim_product p USING (product_key)
     LEFT JOIN rf_dim_settlement t USING (settlement_key)"""


for _off in ("current", "day1", "day2"):
    def _mk2(off):
        def run(spark, sf):
            return q.report_2_rows(serving(spark, sf), DATE, SETTLEMENT, CATEGORY, off)
        return run

    def _mk3(off):
        def run(spark, sf):
            return q.report_3_rows(serving(spark, sf), DATE, CATEGORY, off)
        return run
    register(f"report_2_rows_{_off}", _report2_sql(_off))(_mk2(_off))
    register(f"report_3_rows_{_off}", _report3_sql(_off))(_mk3(_off))


# The order of the reports' rows, as a position.
def _order_sql(rows: str, columns: tuple[str, ...]) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in columns)
    head, body = rows.split("SELECT product_key", 1)
    return head + f"""SELECT row_number() OVER (ORDER BY {order}) AS position, {', '.join(columns)}
FROM (SELECT product_key{body}) r"""


_ORDER_2 = ("calculated_price", "product_name", "store_name")
_ORDER_3 = ("calculated_price", "settlement_name", "product_name")


@register("report_2_order", _order_sql(_report2_sql("current"), _ORDER_2))
def _order2(spark, sf):
    rows = q.report_2_rows(serving(spark, sf), DATE, SETTLEMENT, CATEGORY)
    return number_sorted(rows, 1, "position").select("position", *_ORDER_2)


@register("report_3_order", _order_sql(_report3_sql("current"), _ORDER_3))
def _order3(spark, sf):
    rows = q.report_3_rows(serving(spark, sf), DATE, CATEGORY)
    return number_sorted(rows, 1, "position").select("position", *_ORDER_3)


# ---------------------------------------------------------------------------
# Documented ad-hoc queries
# ---------------------------------------------------------------------------

@register("top_products_by_avg_price", with_fixtures(f"""
SELECT dp.product_name, {avg('f.retail_price')} AS avg_price
FROM rf_fact f JOIN rf_dim_product dp ON f.product_key = dp.product_key
WHERE f.retail_price IS NOT NULL
GROUP BY dp.product_name ORDER BY avg_price DESC, dp.product_name ASC LIMIT 20"""))
def _top(spark, sf):
    return q.top_products_by_avg_price(fixture_star(spark, sf), 20)


@register("fact_product_join", with_fixtures("""
SELECT dp.product_name, CAST(f.retail_price AS DOUBLE) AS retail_price
FROM rf_fact f JOIN rf_dim_product dp ON f.product_key = dp.product_key
ORDER BY dp.product_name ASC NULLS LAST, f.retail_price ASC NULLS LAST LIMIT 20"""))
def _fpj(spark, sf):
    return q.fact_product_join(fixture_star(spark, sf), 20)


# Ingest-side queries register themselves into the same tables.
from shelfline.plans import catalog_ingest  # noqa: E402,F401
from shelfline.plans import catalog_more  # noqa: E402,F401
from shelfline.plans import catalog_store  # noqa: E402,F401
from shelfline.plans import catalog_index  # noqa: E402,F401
from shelfline.plans import catalog_transfer  # noqa: E402,F401
