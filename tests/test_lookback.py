"""Day-over-day lookback: previous available partitions, last row wins."""

from decimal import Decimal

from pyspark.sql import functions as F

from shelfline.operators.joins import SizedFrame
from shelfline.schemas import POSITION
from shelfline.operators.lookback import build_lookback, latest_dates
from shelfline.sources.warehouse import Star

FACT = ("zip_date string, date_key bigint, store_key bigint, file_key bigint, category_key bigint, "
        "product_key bigint, retail_price string, promo_price string, seq long")


def star(spark, rows):
    df = spark.createDataFrame(rows, FACT).select(
        "zip_date", "date_key", "store_key", "file_key", "category_key", "product_key",
        F.col("retail_price").cast("decimal(12,4)").alias("retail_price"),
        F.col("promo_price").cast("decimal(12,4)").alias("promo_price"),
        F.struct("zip_date", "seq").alias("pos"))
    return Star(dims={}, fact=df, partition_col="zip_date")


def lb(spark, rows):
    out = build_lookback(star(spark, rows)).collect()
    return sorted((tuple(r) for r in out), key=str)


def d(x):
    return None if x is None else Decimal(x).quantize(Decimal("0.0001"))


def test_three_dates_with_gap_and_last_row_wins(spark):
    rows = [
        ("2026-04-01", 1, 1, 10, 1, 1, "3.10", None, 1),   # D-2
        ("2026-04-20", 2, 1, 11, 1, 1, "3.30", None, 1),   # D-1, first row
        ("2026-04-20", 2, 1, 11, 1, 1, "3.20", None, 2),   # D-1, last row wins
        ("2026-04-29", 3, 1, 12, 1, 1, "3.17", None, 1),   # D
        ("2026-04-29", 3, 1, 12, 1, 1, "3.17", None, 2),   # D duplicate kept
        ("2026-03-01", 0, 1, 9, 1, 1, "9.99", None, 1),    # older than D-2: ignored
    ]
    got = lb(spark, rows)
    assert len(got) == 2
    for r in got:
        assert r[0] == 3 and r[5] == d("3.17")
        assert r[7] == d("3.20") and r[9] == d("3.10")
        assert r[8] is None and r[10] is None


def test_only_one_date_gives_null_lookback(spark):
    got = lb(spark, [("2026-04-29", 3, 1, 12, 1, 1, "3.17", "2.00", 1)])
    assert got == [(3, 1, 12, 1, 1, d("3.17"), d("2.00"), None, None, None, None)]


def test_two_dates(spark):
    got = lb(spark, [("2026-04-28", 2, 1, 11, 1, 1, "1.00", None, 1),
                     ("2026-04-29", 3, 1, 12, 1, 1, "2.00", None, 1),
                     ("2026-04-29", 3, 2, 12, 1, 1, "5.00", None, 2)])
    assert got == [(3, 1, 12, 1, 1, d("2.00"), None, d("1.00"), None, None, None),
                   (3, 2, 12, 1, 1, d("5.00"), None, None, None, None, None)]


def test_no_dates_gives_empty(spark):
    s = star(spark, [])
    assert build_lookback(s).count() == 0


def test_latest_dates(spark):
    rows = [(f"2026-04-0{i}", i, 1, 1, 1, 1, "1", None, 1) for i in range(1, 6)]
    s = star(spark, rows)
    assert [r[0] for r in latest_dates(s.fact, 3).collect()] == ["2026-04-03", "2026-04-04", "2026-04-05"]
    assert [r[0] for r in latest_dates(s.fact.limit(0), 3).collect()] == []
    two = star(spark, rows[:2])
    assert [r[0] for r in latest_dates(two.fact, 3).collect()] == ["2026-04-01", "2026-04-02"]


def test_dims_unused_by_lookback():
    assert SizedFrame  # lookback reads only the fact


def test_hot_key_is_collapsed_before_the_shuffle(spark):
    """One key holds a third of all rows: the prior days are reduced map-side
    (partial aggregation) and the result is still exact."""
    rows = []
    for day, date in ((1, "2026-04-01"), (2, "2026-04-02"), (3, "2026-04-03")):
        for i in range(300):
            hot = i % 3 == 0
            key = 1 if hot else 100 + i
            rows.append((date, day, 1, 10, 1, key, f"{day}.{i:03d}", None, i))
    s = star(spark, rows)
    lbk = build_lookback(s)
    plan = lbk._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    out = lbk.filter("product_key = 1").collect()
    assert len(out) == 100                      # every D row of the hot key is kept
    assert {r.retail_price_day1 for r in out} == {d("2.297")}   # last hot row of D-1
    assert {r.retail_price_day2 for r in out} == {d("1.297")}


def test_packed_position_aggregates_by_hash(spark):
    rows = [(f"2026-04-0{d}", d, 1, 1, 1, p, "1.00", None, p) for d in (1, 2, 3) for p in range(5)]
    df = spark.createDataFrame(rows, FACT).select(
        "zip_date", "date_key", "store_key", "file_key", "category_key", "product_key",
        F.col("retail_price").cast("decimal(12,4)").alias("retail_price"),
        F.col("promo_price").cast("decimal(12,4)").alias("promo_price"),
        F.col("seq").cast(POSITION).alias("pos"))
    plan = build_lookback(Star(dims={}, fact=df))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
