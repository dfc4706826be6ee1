"""Page ranges, trigrams and the selector summary against plain scans."""

import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.operators import serving_index as ix
from shelfline.plans import queries as q
from shelfline.plans import sync

SCHEMA = ("file_name string, product_name string, category_name string, settlement_name string, store_name string, company_name string, "
          "retail_price decimal(12,4), promo_price decimal(12,4), price decimal(12,4), date_key int, store_key int, file_key int, "
          "category_key int, product_key int, settlement_key int, company_key int")
NAMES = ["Мляко прясно", "МЛЯКО", "хляб 100%", "bread_roll", "Bread", "bre", "İstanbul", "ΟΔΟΣ", "a\\b c", None, "", "ab", "straße", "Milk 1%"]


def rows(n=700):
    rnd = random.Random(3)
    price = lambda: rnd.choice([None, Decimal(rnd.randint(0, 99999)) / 100])
    out = []
    for _ in range(n):
        # What the page's order leaves open follows from what it fixes.
        p, s, f, retail, promo = rnd.randrange(len(NAMES)), rnd.randint(1, 6), rnd.randint(1, 3), price(), price()
        c = p % 4 + 1
        out.append(("f" if f > 1 else None, NAMES[p], f"c{c}", None if s == 6 else f"t{s % 3}", f"s{s % 4}", f"k{s % 2}", retail, promo,
                    retail, 20260401 + c % 3, s, f, c, p, None if s == 6 else s % 3, s % 2))
    return out + out[:60]  # repeated rows


@pytest.fixture(scope="module")
def sv(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("serving"))
    spark.createDataFrame(rows(), SCHEMA).repartition(4).write.parquet(f"{base}/projection")
    projection = spark.read.parquet(f"{base}/projection")
    sync.write_indexes(projection, lambda t: f"{base}/{t}", range_rows=50)
    return sync.with_indexes(q.Serving(None, None, projection), lambda t: f"{base}/{t}")


def plain(sv):
    return replace(sv, summary=None, pages=None, page_counts=None, trigrams=None)


def test_every_page_is_the_scan_s_page(sv):
    assert sv.page_counts.count() > 5
    everything = [tuple(r) for r in q.browse_rows(plain(sv), limit=10_000).collect()]
    for page in (0, 1, 9, 27, 28, 1000):
        assert [tuple(r) for r in q.browse_page(sv, page, 27).collect()] == everything[page * 27: (page + 1) * 27]


@pytest.mark.parametrize("filters", [{"date_key": 20260402, "price_min": 100}, {"product_name": "bre"}, {"store_key": 99}])
def test_filtered_pages(sv, filters):
    everything = [tuple(r) for r in q.browse_rows(plain(sv), limit=10_000, **filters).collect()]
    for page in (0, 3, 50):
        assert [tuple(r) for r in q.browse_page(sv, page, 20, **filters).collect()] == everything[page * 20: (page + 1) * 20]


def test_a_page_reads_its_ranges_only(sv):
    plan = q.browse_page(sv, 20, 20)._jdf.queryExecution().executedPlan().toString()
    ranges = plan.split("range_id")[-1]
    assert "PartitionFilters" in plan and "range_id" in plan, ranges


@pytest.mark.parametrize("text", ["bread", "BRE", "мля", "ПРЯСНО", "100\\%", "100%", "bread\\_roll", "b_ead", "ead%oll", "istan", "i̇stan", "οδος",
                                  "ΟΔΟΣ", "a\\\\b", "straße", "STRASSE", "ab", "_", "%", "nothing like it", "milk 1\\%", "b%d%r%l"])
def test_search_gives_the_scan_s_rows(sv, text, monkeypatch):
    want = [tuple(r) for r in q.browse_rows(plain(sv), product_name=text, limit=10_000).collect()]
    assert [tuple(r) for r in q.browse_search(sv, text, limit=10_000).collect()] == want
    monkeypatch.setattr(ix, "LISTED_NAMES", 0)  # the join
    assert [tuple(r) for r in q.browse_search(sv, text, limit=10_000).collect()] == want


def test_runs_between_wildcards():
    assert ix.literal_runs("%ab\\%c_d%%\\\\e\\") == ["ab%c", "d", "\\e\\"]
    assert ix.pattern_trigrams("%abcd%") == ["abc", "bcd"]
    assert ix.pattern_trigrams("%ab%cd_%") == []


def test_summary_gives_the_scan_s_choices_and_groups(sv):
    every = [{}, {"date_key": 20260402}, {"store_key": 3, "date_key": 20260402}, {"category_key": 2}, {"company_key": 1, "settlement_key": 1}]
    for keys in every:
        for dim in ("settlement", "category", "company", "store"):
            assert q.options(sv, dim, **keys).collect() == q.options(plain(sv), dim, **keys).collect()
        for g1, g2 in (("settlement_name", None), ("date_key", "store_name")):
            a, b = (sorted(map(tuple, q.grouped_prices(x, g1, g2, **keys).collect()), key=str) for x in (sv, plain(sv)))
            assert a == b


def test_a_date_is_replaced_or_removed(sv):
    day = 20260402
    changed = sv.projection.filter(F.col("date_key") != day).unionByName(
        sv.projection.filter((F.col("date_key") == day) & (F.col("store_key") < 3)))
    part = ix.build_summary(changed.filter(F.col("date_key") == day))
    for merged, source in ((ix.replace_dates(sv.summary, part, [day]), changed),
                           (ix.replace_dates(sv.summary, part.limit(0), [day]), sv.projection.filter(F.col("date_key") != day))):
        assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, ix.build_summary(source).collect()), key=str)


def test_json_refuses_more_than_its_bound(sv):
    page = q.browse_rows(sv, limit=30, keep_order_columns=True)
    assert q.rows_as_json(page, list(q.BROWSE_ORDER), most=30).first().json.count("file_name") == 30
    with pytest.raises(Exception, match="more than 29 rows"):
        q.rows_as_json(page, list(q.BROWSE_ORDER), most=29).collect()


def test_ranges_get_longer_instead_of_more(sv, spark, scratch, monkeypatch):
    monkeypatch.setattr(ix, "MAX_RANGES", 6)
    ix.write_pages(sv.projection, f"{scratch}/pages", f"{scratch}/counts", range_rows=5)
    counts = spark.read.parquet(f"{scratch}/counts").collect()
    assert len(counts) <= 6 and sum(r["rows"] for r in counts) == sv.projection.count()
    bounded = replace(sv, pages=spark.read.schema(ix.pages_schema(sv.projection)).parquet(f"{scratch}/pages"),
                      page_counts=spark.read.parquet(f"{scratch}/counts"))
    for page in (0, 11, 27, 28):
        assert q.browse_page(bounded, page, 27).collect() == q.browse_rows(plain(sv), offset=page * 27, limit=27).collect()
