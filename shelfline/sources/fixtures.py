"""The warehouse expressed on the driver's TPC-H-style tables.

Every query of the library runs unchanged on these frames; the oracle SQL in
``plans.oracle`` repeats the same definitions so DuckDB computes the same
answers independently.

* settlement  <- nation   (key, 5-digit code, name)
* company     <- region   (key, key + 100000000 as UIC, name)
* store       <- supplier (settlement NULL for every 11th supplier, company = key mod 5)
* category    <- part brand number (names above 20 are unknown placeholders)
* product     <- part
* file        <- orders (every 7th order has no file row, so the left join shows)
* fact        <- lineitem x part; the snapshot grain is the ship year
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.joins import SizedFrame
from shelfline.operators.partitioning import spread
from shelfline.sources.warehouse import Star

PRICE = "decimal(12,4)"

# Fixed values of the fixture mapping.
UIC_OFFSET = 100000000
STORE_WITHOUT_SETTLEMENT_MOD = 11
STORE_WITHOUT_SETTLEMENT_REM = 10
COMPANY_MOD = 5
FILE_GAP_MOD = 7
KNOWN_CATEGORY_MAX = 20
MISSING_RETAIL_QUANTITY = 50
PROMO_ABOVE_RETAIL_FACTOR = Decimal("1.05")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def brand_number(col: str = "p_brand"):
    return F.substring_index(F.col(col), "#", -1).cast("bigint")


def dim_settlement(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("settlement_key"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("ekatte"),
        F.col("n_name").alias("settlement_name"),
    )


def dim_company(spark, sf_dir) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(
        F.col("r_regionkey").cast("bigint").alias("company_key"),
        (F.col("r_regionkey").cast("bigint") + UIC_OFFSET).cast("string").alias("uic"),
        F.col("r_name").alias("company_name"),
    )


def dim_store(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("bigint")
    return s.select(
        key.alias("store_key"),
        F.col("s_name").alias("store_name"),
        F.when(key % STORE_WITHOUT_SETTLEMENT_MOD != STORE_WITHOUT_SETTLEMENT_REM,
               F.col("s_nationkey").cast("bigint")).alias("settlement_key"),
        (key % COMPANY_MOD).alias("company_key"),
    )


def dim_category(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_brand").distinct()
    n = brand_number()
    return p.select(
        n.alias("category_key"),
        n.cast("string").alias("category_code"),
        F.when(n > KNOWN_CATEGORY_MAX, F.concat(F.lit("(unknown:"), n.cast("string"), F.lit(")")))
         .otherwise(F.col("p_brand")).alias("category_name"),
    )


def dim_product(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("product_key"),
        F.col("p_partkey").cast("string").alias("product_code"),
        F.col("p_name").alias("product_name"),
    )


def dim_file(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.filter(F.col("o_orderkey") % FILE_GAP_MOD != 0)
             .select(F.col("o_orderkey").cast("bigint").alias("file_key"),
                     F.concat(F.col("o_orderpriority"), F.lit("_"),
                              F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
                     F.to_date(F.col("o_orderdate")).alias("zip_date")))


def fact(spark, sf_dir, part_for_join: DataFrame | None = None) -> DataFrame:
    """Fact rows with a ``pos`` struct that orders rows for last-row-wins."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate"))
    part = part_for_join
    if part is None:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey"), brand_number().alias("category_key"))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    promo = (F.when(disc == 0, F.lit(None))
              .when(disc == Decimal("0.01"), F.lit(0))
              .when(disc == Decimal("0.02"), price * F.lit(PROMO_ABOVE_RETAIL_FACTOR))
              .otherwise(price * (F.lit(1) - disc)))
    joined = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return joined.select(
        F.year("l_shipdate").cast("bigint").alias("date_key"),
        F.col("l_suppkey").cast("bigint").alias("store_key"),
        F.col("l_orderkey").cast("bigint").alias("file_key"),
        F.col("category_key").cast("bigint").alias("category_key"),
        F.col("l_partkey").cast("bigint").alias("product_key"),
        F.when(F.col("l_quantity") != MISSING_RETAIL_QUANTITY, price.cast(PRICE)).alias("retail_price"),
        promo.cast(PRICE).alias("promo_price"),
        F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount").alias("pos"),
    )


def dim_date(spark, sf_dir) -> DataFrame:
    """One row per snapshot (ship year); the date is 1 January of that year."""
    li = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("y")).distinct()
    d = F.make_date(F.col("y"), F.lit(1), F.lit(1))
    return li.select(
        F.col("y").cast("bigint").alias("date_key"), d.alias("date"),
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.weekday(d).alias("weekday"))


def fixture_star(spark: SparkSession, sf_dir: str) -> Star:
    part_keys = SizedFrame(table(spark, sf_dir, "part").select(
        F.col("p_partkey"), brand_number().alias("category_key")))
    dims = {
        "date": SizedFrame(dim_date(spark, sf_dir)),
        "company": SizedFrame(dim_company(spark, sf_dir)),
        "settlement": SizedFrame(dim_settlement(spark, sf_dir)),
        "category": SizedFrame(dim_category(spark, sf_dir)),
        "product": SizedFrame(dim_product(spark, sf_dir)),
        "store": SizedFrame(dim_store(spark, sf_dir)),
        "file": SizedFrame(dim_file(spark, sf_dir)),
    }
    return Star(dims=dims, fact=fact(spark, sf_dir, part_keys.for_join()),
                partition_col="date_key")


# ---------------------------------------------------------------------------
# Raw records: what the daily archives would contain, derived from lineitem
# ---------------------------------------------------------------------------

# Fixed values of the raw-record mapping.
RAW_COMPANIES = 5            # file (company) of a row = supplier key mod 5
RAW_NO_UIC_COMPANY = 4       # this company's file name has no "_<uic>" part
RAW_SEMICOLON_COMPANIES = (1, 3)
RAW_SHORT_LINE = 7           # line number 7 rows carry only six fields
RAW_RAION_SUFFIX = "-04"
RAW_BAD_CATEGORY_LINE = 6    # line number 6 rows carry the category codes that audits look for
RAW_HUGE_PRICE = "123456789.5"   # a number that decimal(12,4) can't hold
RAW_GROUPED_PRICE = "1_000"      # digit groups, as a float parser accepts them


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record, member and archive rows (see ``raw_record_rows`` and ``with_files``)."""
    return with_files(raw_record_rows(spark, sf_dir))


def raw_record_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive-style rows (see ``sources.archives.RECORD_SCHEMA``) plus ``pos``.

    One archive per ship month, one member file per company; the seven raw
    fields carry the variants the cleaner must handle: short, over-padded,
    district and non-numeric settlement codes; quoted and padded store names;
    decimal commas, quoted, blank, huge, grouped and ``n/a`` prices; empty,
    sentinel, swapped, textual and out-of-range category codes; rows with six
    fields.
    Member and archive rows are included so company/file dimensions and the
    quality report see every file.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate")
    sup = SizedFrame(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"))
    prt = SizedFrame(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"))
    if prt.is_small():
        li = spread(li)  # (A join that shuffles the lines spreads them by itself, before they get the supplier's texts.)
    j = (li.join(prt.for_join(), li.l_partkey == F.col("p_partkey"))
           .join(sup.for_join(), li.l_suppkey == F.col("s_suppkey")))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    # Columns of their own, so a plan works each out once per row.
    j = j.select(
        "*", F.concat(F.date_format("l_shipdate", "yyyy-MM"), F.lit("-01")).alias("_zip"), price.alias("_price"),
        F.col("l_discount").cast("decimal(4,2)").alias("_disc"), (F.col("l_suppkey") % RAW_COMPANIES).alias("_c"),
        F.col("s_nationkey").cast("string").alias("_n"))
    j = j.select("*", F.col("_price").cast("string").alias("_ptxt"), F.lpad("_n", 5, "0").alias("_n5"),
                 (F.col("_price") * (F.lit(1) - F.col("_disc"))).cast("decimal(12,2)").cast("string").alias("_promo"))
    c, n, n5, ptxt, promo_txt, disc, zip_date = (F.col(x) for x in ("_c", "_n", "_n5", "_ptxt", "_promo", "_disc", "_zip"))
    m = F.col("l_linenumber") % 4
    dotless = lambda x: F.replace(x, F.lit("."), F.lit(","))
    kind = F.col("l_orderkey") % 6
    category = (F.when(F.col("l_linenumber") != RAW_BAD_CATEGORY_LINE, brand_number().cast("string"))
                .when(kind == 0, F.lit("")).when(kind == 1, F.lit("-1"))
                .when(kind == 2, F.concat(F.lit("0"), F.lpad((F.col("l_partkey") % 1000).cast("string"), 5, "0")))
                .when(kind == 3, F.concat(F.lit("63"), F.lpad((F.col("l_partkey") % 100).cast("string"), 4, "0")))
                .when(kind == 4, F.lit("n.a.")).otherwise(F.lit("150")))
    pos = F.struct(_lead(F.to_date("l_shipdate"), c, F.col("l_orderkey"), F.col("l_linenumber")).alias("lead"),
                   zip_date.alias("zip_date"), c.alias("file_seq"), F.col("l_orderkey"),
                   F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.col("l_partkey"),
                   F.col("l_suppkey"), F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"))
    records = j.select(
        F.lit("record").alias("kind"),
        zip_date.alias("zip_date"),
        c.alias("file_seq"),
        F.when(c == RAW_NO_UIC_COMPANY, F.concat(F.lit("Chain"), c.cast("string"), F.lit(".csv")))
         .otherwise(F.concat(F.lit("Chain"), c.cast("string"), F.lit("_"),
                             (c + UIC_OFFSET).cast("string"), F.lit(".csv"))).alias("file_name"),
        F.when(c.isin(*RAW_SEMICOLON_COMPANIES), F.lit(";")).otherwise(F.lit(",")).alias("delimiter"),
        F.lit("ok").alias("status"),
        F.col("l_orderkey").alias("row_seq"),
        F.when(F.col("l_linenumber") == RAW_SHORT_LINE, F.lit(6)).otherwise(F.lit(7)).alias("n_fields"),
        F.when(m == 0, n).when(m == 1, F.concat(F.lit("0"), n5))
         .when(m == 2, F.concat(n5, F.lit(RAW_RAION_SUFFIX)))
         .otherwise(F.concat(F.lit("X"), n)).alias("settlement_code"),
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit(' "'), F.col("s_name"), F.lit('" ')))
         .otherwise(F.col("s_name")).alias("store_name"),
        F.col("p_name").alias("product_name"),
        F.col("p_partkey").cast("string").alias("product_code"),
        category.alias("category_code"),
        F.when(m == 0, ptxt).when(m == 1, dotless(ptxt))
         .when(m == 2, F.concat(F.lit('"'), ptxt, F.lit('"')))
         .when(F.col("l_quantity") % 2 == 0, F.lit(""))
         .when(F.col("l_quantity") % 10 == 1, F.lit(RAW_HUGE_PRICE))
         .when(F.col("l_quantity") % 10 == 3, F.lit(RAW_GROUPED_PRICE))
         .otherwise(F.lit("n/a")).alias("retail_price"),
        F.when(disc == 0, F.lit(""))
         .when(m % 2 == 1, dotless(promo_txt))
         .otherwise(promo_txt).alias("promo_price"),
        pos.alias("pos"),
    )
    return records


def _lead(date, file_seq, order, line):
    """A number that never falls where the position rises: it leads the position.

    Month (17 bits), file (4), order (38) and line (3); what does not fit is
    cut off at the ends, and the position's other fields tell such rows apart.
    """
    def part(x, bits):
        return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.coalesce(x.cast("bigint"), F.lit(0))))

    year = F.year(date)
    # (Years of other than four digits are written with a sign, which sorts first.)
    month = F.when(year.between(1, 9999), year * 12 + F.month(date))
    out = part(month, 17)
    for x, bits in ((file_seq + RAW_COMPANIES, 4), (order, 38), (line, 3)):
        out = F.shiftleft(out, bits).bitwiseOR(part(x, bits))
    return out


def record_files(records: DataFrame) -> DataFrame:
    """The (archive, file) pairs that have records."""
    return records.select("zip_date", "file_seq", "file_name", "delimiter").distinct()


def with_files(records: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Add one member row per (archive, file) and one archive row per date.

    ``files`` is ``record_files(records)`` where the caller has written it already.
    """
    if files is None:
        files = record_files(records)
    members = files.select(F.lit("member").alias("kind"), "zip_date", "file_seq", "file_name",
                           "delimiter", F.lit("ok").alias("status"))
    archives = (files.select("zip_date").distinct()
                .select(F.lit("archive").alias("kind"), "zip_date", F.lit("ok").alias("status")))
    cols = records.columns

    def like_records(df):
        out = df
        for f in records.schema.fields:
            if f.name not in df.columns:
                if f.name == "pos":
                    seq = F.col("file_seq") if "file_seq" in df.columns else F.lit(-1).cast("bigint")
                    p = F.struct(
                        _lead(F.to_date("zip_date"), seq, F.lit(-1), F.lit(-1)).alias("lead"),
                        F.col("zip_date").alias("zip_date"), seq.alias("file_seq"),
                        *[F.lit(-1).cast(t.dataType).alias(t.name) for t in f.dataType.fields[3:]])
                    out = out.withColumn("pos", p)
                else:
                    out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
        return out.select(*cols)

    return records.unionByName(like_records(members)).unionByName(like_records(archives))


def settlement_nomenclature(spark: SparkSession, sf_dir: str) -> SizedFrame:
    """Settlement names keyed by 5-digit code, plus district codes of even nations."""
    n = table(spark, sf_dir, "nation")
    code = F.lpad(F.col("n_nationkey").cast("string"), 5, "0")
    base = n.select(code.alias("code"), F.col("n_name").alias("name"))
    districts = (n.filter(F.col("n_nationkey") % 2 == 0)
                  .select(F.concat(code, F.lit(RAW_RAION_SUFFIX)).alias("code"),
                          F.concat(F.col("n_name"), F.lit(" district")).alias("name")))
    return SizedFrame(base.unionByName(districts))


def category_nomenclature(spark: SparkSession, sf_dir: str) -> SizedFrame:
    """Official categories: brand numbers up to 20, named by the brand."""
    b = table(spark, sf_dir, "part").select("p_brand").distinct()
    return SizedFrame(b.filter(brand_number() <= KNOWN_CATEGORY_MAX)
                       .select(brand_number().cast("string").alias("code"),
                               F.col("p_brand").alias("name")))
