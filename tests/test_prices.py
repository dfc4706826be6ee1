"""Price rules and display formats."""

from decimal import Decimal

from shelfline.functions import prices as P


def rows(spark, data, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*cols).collect()]


def test_effective_price_zero_filled(spark):
    data = [("3.50", None), ("3.50", "0"), ("5.00", "3.20"), ("2.00", "4.00"), (None, None)]
    df = spark.createDataFrame(data, "r string, p string").selectExpr(
        "cast(r as decimal(12,4)) r", "cast(p as decimal(12,4)) p")
    got = [float(x[0]) for x in df.select(P.effective_price_zero_filled("r", "p")).collect()]
    assert got == [3.5, 3.5, 3.2, 2.0, 0.0]


def test_effective_price_keeps_null(spark):
    data = [(None, "2.00"), (None, None), ("5.00", "-1"), ("5.00", "7.00")]
    df = spark.createDataFrame(data, "r string, p string").selectExpr(
        "cast(r as decimal(12,4)) r", "cast(p as decimal(12,4)) p")
    got = [x[0] for x in df.select(P.effective_price("r", "p")).collect()]
    assert got == [Decimal("2.0000"), None, Decimal("5.0000"), Decimal("5.0000")]


def test_format_date_bg(spark):
    got = rows(spark, [("2026-04-25",), ("",), (None,), ("a-b-c-d",)], "d string", P.format_date_bg("d"))
    assert [g[0] for g in got] == ["25.04.2026", "", "", "a-b-c-d"]


def test_format_price_2dp(spark):
    got = rows(spark, [("3.1",), (None,), ("2.005",)], "p string",
               P.format_price_2dp(P.F.col("p").cast("decimal(12,4)")))
    assert [g[0] for g in got] == ["3.10", "—", "2.01"]


def test_parse_price_bound(spark):
    vals = [("1.5",), ("5",), ("2,25",), ("",), ("1.234",), ("abc",), (" 7 ",)]
    got = [g[0] for g in rows(spark, vals, "t string", P.parse_price_bound("t"))]
    assert got == [Decimal("1.5000"), Decimal("5.0000"), Decimal("2.2500"), None, None, None,
                   Decimal("7.0000")]
    assert P.parse_price_bound_value("2,5") == Decimal("2.5")
    assert P.parse_price_bound_value("100000000") == Decimal("100000000")
    assert P.parse_price_bound_value("9" * 50) == Decimal("9" * 36)
    assert P.parse_price_bound_value("  ") is None


def test_offsets():
    assert P.price_columns_for_offset("day1") == ("retail_price_day1", "promo_price_day1")
    assert P.price_columns_for_offset("day2") == ("retail_price_day2", "promo_price_day2")
    assert P.price_columns_for_offset("anything") == ("retail_price", "promo_price")


def test_paging_rules():
    import pytest

    from shelfline.plans import queries as q

    assert q.page_window(0) == (0, 100) and q.page_window(2) == (200, 100)
    assert q.page_index_from_input("3") == 2 and q.page_index_from_input(" 1 ") == 0
    for bad in ("0", "-1", "x", ""):
        with pytest.raises(ValueError):
            q.page_index_from_input(bad)
    assert q.has_next_page(100) and not q.has_next_page(99)
    assert not q.page_exists(2, 0) and q.page_exists(0, 0)
