"""Typed load of a stored lookback with its rejects; upserts into an external target."""

import json
import os
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.plans import queries as q
from shelfline.plans import sync
from shelfline.sources import external as E
from shelfline.sources import lookback_text as TL
from shelfline.sources import warehouse as W

HEADER = schemas.LOOKBACK_COLUMNS
GOOD = ["1", "2", "3", "4", "5", "1.5", "", "2", "", "", ""]


def put(folder, name, records, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write("".join(",".join(r) + "\n" for r in [header, *records]))


def cell(column, value):
    return [value if c == column else g for c, g in zip(HEADER, GOOD)]


def test_what_is_written_is_loaded(spark, scratch):
    rows = [(1, 2, 3, 4, 5, Decimal("1.2345"), None, Decimal("99999999.9999"), Decimal("-1.0000"), None, Decimal("0.0000"))]
    lookback = spark.createDataFrame(rows, TL.LOOKBACK)
    TL.write_text(lookback, f"{scratch}/text")
    got, rejects = TL.load(spark, f"{scratch}/text", f"{scratch}/staged")
    assert [tuple(r) for r in got.collect()] == rows and got.schema == TL.LOOKBACK
    assert rejects.count() == 0
    TL.refuse(rejects)


@pytest.mark.parametrize("column, value, reason", [
    ("store_key", " ", "missing"), ("store_key", "7.0", "not a whole number"), ("date_key", "9" * 19, "out of range"),
    ("retail_price", "1.2.3", "not a number"), ("promo_price", "-Infinity", "not finite"),
    ("promo_price", "NaN", "not finite"), ("retail_price_day2", "100000000", "out of range"),
    ("retail_price_day1", "99999999.99995", "out of range"), ("retail_price", "1e99", "out of range")])
def test_reasons(spark, scratch, column, value, reason):
    put(f"{scratch}/t", "a.csv", [GOOD, cell(column, value), GOOD])
    got, rejects = TL.load(spark, f"{scratch}/t", f"{scratch}/s")
    assert got.count() == 2
    assert [(r.record, r.column, r.value, r.reason) for r in rejects.collect()] == [
        (2, column, None if reason == "missing" and not value else value, reason)]


@pytest.mark.parametrize("value, typed", [(" 7.25 ", "7.2500"), ("1e2", "100.0000"), ("0.00005", "0.0001"),
                                          ("-0.00005", "-0.0001"), ("+3", "3.0000"), ("  ", None)])
def test_prices_that_fit(spark, scratch, value, typed):
    put(f"{scratch}/t", "a.csv", [cell("promo_price_day2", value)])
    got, rejects = TL.load(spark, f"{scratch}/t", f"{scratch}/s")
    assert rejects.count() == 0
    assert [r.promo_price_day2 for r in got.collect()] == [None if typed is None else Decimal(typed)]


def test_record_numbers_over_many_splits(spark, scratch):
    for name, step in (("a.csv", 7), ("b.csv", 11)):
        put(f"{scratch}/t", name, [cell("retail_price", f"bad{i}" if i % step == 0 else str(i)) for i in range(1, 400)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got, rejects = TL.load(spark, f"{scratch}/t", f"{scratch}/s")
        found = {(os.path.basename(r.file), r.record, r.value) for r in rejects.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert spark.read.parquet(f"{scratch}/s").select("__split").distinct().count() > 5
    assert found == {(n, i, f"bad{i}") for n, s in (("a.csv", 7), ("b.csv", 11)) for i in range(1, 400) if i % s == 0}
    assert got.count() == 2 * 399 - len(found)


def test_columns_by_name_short_records_and_nothing_stored(spark, scratch):
    order = ["more", *reversed(HEADER)]
    put(f"{scratch}/t", "a.csv", [["x", *reversed(GOOD)]], order)
    assert [r.store_key for r in TL.load(spark, f"{scratch}/t", f"{scratch}/s1")[0].collect()] == [2]
    put(f"{scratch}/short", "a.csv", [GOOD[:6], GOOD[:4]])
    got, rejects = TL.load(spark, f"{scratch}/short", f"{scratch}/s2")
    assert got.count() == 1
    assert [(r.record, r.column, r.reason) for r in rejects.collect()] == [(2, "product_key", "missing")]
    put(f"{scratch}/narrow", "a.csv", [], HEADER[1:])
    with pytest.raises(ValueError, match="date_key"):
        TL.load(spark, f"{scratch}/narrow", f"{scratch}/s3")
    for part in TL.load(spark, f"{scratch}/absent", f"{scratch}/s4"):
        assert part.count() == 0
    put(f"{scratch}/header", "a.csv", [])
    for part in TL.load(spark, f"{scratch}/header", f"{scratch}/s5"):
        assert part.count() == 0


def test_publishing_a_stored_lookback(spark, scratch):
    root = f"{scratch}/wh"
    dims = {n: spark.createDataFrame([], s) for n, (s, _, _) in schemas.DIMENSIONS.items()}
    W.write_dims(spark, root, dims, "v1")
    put(f"{scratch}/t", "a.csv", [GOOD, cell("retail_price", "oops")])
    with pytest.raises(TL.RejectedCells, match="record 2 .*retail_price 'oops' not a number"):
        sync.run_sync(spark, root, lookback_text=f"{scratch}/t")
    assert W.current_version(spark, f"{root}/serving") is None
    put(f"{scratch}/t", "a.csv", [GOOD])
    version = sync.run_sync(spark, root, lookback_text=f"{scratch}/t")
    sv = sync.read_serving(spark, root, version)
    assert [r.product_key for r in sv.lookback.collect()] == [5]
    # No dimension row matches, so the projection and its indexes are empty, and still answer.
    assert q.browse_page(sv, 0).count() == 0 and q.browse_page(sv, 3, date_key=1).count() == 0
    assert q.options(sv, "store").count() == 0 and q.browse_search(sv, "name").count() == 0


ROW = "k bigint, name string, n int"


def rows_of(spark, path):
    return sorted(tuple(r) for r in E.read_target(spark, path, spark.createDataFrame([], ROW).schema, "k").collect())


def test_newest_run_of_a_key_wins_whole_rows(spark, scratch):
    E.upsert_into(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], ROW).repartition(3), scratch, "r1")
    E.upsert_into(spark.createDataFrame([(2, None, 3), (9, "c", None)], ROW), scratch, "r 2%")
    E.upsert_into(spark.createDataFrame([], ROW), scratch, "r3")
    assert rows_of(spark, scratch) == [(1, "a", 1), (2, None, 3), (9, "c", None)]
    # Repeated under its name, a run leaves one result, and no part behind.
    E.upsert_into(spark.createDataFrame([(1, "late", 1)], ROW), scratch, "r1")
    assert rows_of(spark, scratch) == [(1, "a", 1), (2, None, 3), (9, "c", None)]
    named = {p for c in E.FolderTarget(scratch).commits() for p in c["parts"]}
    stored = {f"{r}/{f}" for r in os.listdir(f"{scratch}/parts") for f in os.listdir(f"{scratch}/parts/{r}")}
    assert named == stored


def test_failed_run_leaves_the_target_as_it_was(spark, scratch):
    E.upsert_into(spark.createDataFrame([(1, "a", 1)], ROW), scratch, "r1")
    broken = spark.range(0, 40, 1, 4).select(F.col("id").alias("k"), F.lit("x").alias("name"),
                                             F.when(F.col("id") == 39, F.raise_error(F.lit("stop"))).cast("int").alias("n"))
    with pytest.raises(Exception, match="stop"):
        E.upsert_into(broken, scratch, "r2")
    assert rows_of(spark, scratch) == [(1, "a", 1)]
    E.upsert_into(spark.createDataFrame([(1, "b", 2)], ROW), scratch, "r2")
    assert rows_of(spark, scratch) == [(1, "b", 2)]


def test_repeated_task_counts_once(scratch):
    target = E.FolderTarget(scratch)
    schema = pa.schema([("k", pa.int64())])
    batch = pa.record_batch([pa.array([1])], schema=schema)
    lost = target.write_part("r1", schema, iter([batch]))  # a task whose executor was lost after the write
    kept = target.write_part("r1", schema, iter([batch]))
    assert lost.name != kept.name and target.write_part("r1", schema, iter([])) is None
    target.commit("r1", [kept])
    assert [c["parts"] for c in target.commits()] == [[kept.name]]

    def dies():
        yield batch
        raise RuntimeError("gone")

    before = set(os.listdir(f"{scratch}/parts/r1"))
    with pytest.raises(RuntimeError):
        target.write_part("r1", schema, dies())
    assert set(os.listdir(f"{scratch}/parts/r1")) == before


def test_two_runs_never_share_a_commit_number(scratch):
    target = E.FolderTarget(scratch)
    target.commit("a", [])
    with open(f"{scratch}/commits/0000000002.json", "w", encoding="utf-8") as f:
        json.dump({"run": "other", "parts": [], "rows": 0}, f)
    target.commit("b", [])
    assert [c["run"] for c in target.commits()] == ["a", "other", "b"]


@pytest.mark.parametrize("run", ["", "a/b", ".hidden"])
def test_run_must_be_named(spark, scratch, run):
    with pytest.raises(Exception, match="name the run"):
        E.upsert_into(spark.createDataFrame([(1, "a", 1)], ROW), scratch, run)


def test_a_cell_is_trimmed_typed_and_judged_once():
    # A fault reads the trimmed text and the value as columns; it works neither out again.
    for column in schemas.LOOKBACK_COLUMNS:
        fault = str(TL._fault(column)).lower()
        assert f"__cell_{column}" in fault and "cast" not in fault.replace("cast(null", "") and r"^\s" not in fault
