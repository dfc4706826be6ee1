"""Serving merges and prunes with their empty-set guards."""

from shelfline.operators import serve as S

STORE = "store_key bigint, store_name string, settlement_key bigint, company_key bigint"


def test_upsert_replaces_whole_rows_and_keeps_others(spark):
    target = spark.createDataFrame([(1, "Old", 3, 1), (2, "Keep", 4, 1)], STORE)
    source = spark.createDataFrame([(1, "New", None, 2), (9, "Added", 5, 1)], STORE)
    got = sorted(tuple(r) for r in S.upsert(target, source, "store_key").collect())
    assert got == [(1, "New", None, 2), (2, "Keep", 4, 1), (9, "Added", 5, 1)]
    counts = S.upsert_counts(target, source, "store_key").first()
    assert (counts.inserted, counts.updated) == (1, 1)


def test_prune_dim_date_guard(spark):
    dd = spark.createDataFrame([(1, "2026-04-01"), (2, "2026-04-02"), (3, "2026-04-03")],
                               "date_key bigint, d string").selectExpr("date_key", "to_date(d) as date")
    empty = spark.createDataFrame([], "zip_date string")
    keys = S.retained_date_keys(dd, empty)
    assert keys.count() == 0
    kept, deleted = S.prune_dim_date(dd, keys)
    assert kept.count() == 3 and deleted.count() == 0
    keys = S.retained_date_keys(dd, spark.createDataFrame([("2026-04-02",), ("2026-04-03",)], "zip_date string"))
    kept, deleted = S.prune_dim_date(dd, keys)
    assert sorted(r.date_key for r in kept.collect()) == [2, 3]
    assert [r.date_key for r in deleted.collect()] == [1]


def test_prune_dim_category_guard(spark):
    cats = spark.createDataFrame([(1, "1", "a"), (2, "2", "b"), (3, "3", "c"), (4, "4", "d"), (5, "5", "e")],
                                 "category_key bigint, category_code string, category_name string")
    lookback = spark.createDataFrame([(1,), (2,), (3,), (3,)], "category_key bigint")
    kept, deleted = S.prune_dim_category(cats, lookback)
    assert sorted(r.category_key for r in kept.collect()) == [1, 2, 3]
    assert deleted.count() == 2
    kept, deleted = S.prune_dim_category(cats, lookback.limit(0))
    assert kept.count() == 5 and deleted.count() == 0
