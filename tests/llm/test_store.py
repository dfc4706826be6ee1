"""Row keys name the same rows however the input's scan is split when they are used."""

import pytest

from shelfline.llm import simhash, store

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def scan(spark, scratch):
    """A scan of several files, and a switch that splits it in another way."""
    rows = [(i, " ".join(f"w{i % 40}x{j}" for j in range(30))) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(12).write.parquet(f"{scratch}/docs")
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}
    yield spark.read.parquet(f"{scratch}/docs"), lambda: [spark.conf.set(k, "1") for k in before]
    for k, v in before.items():
        spark.conf.set(k, v)


def test_keys_stay_with_their_rows(scan):
    docs, split_anew = scan
    keyed = store.with_row_key(docs, "__row")
    keys = lambda: {r.doc_id: r["__row"] for r in keyed.select("doc_id", "__row").collect()}
    first = keys()
    assert len(set(first.values())) == 120
    split_anew()
    assert keys() == first


def test_keep_one_keeps_the_chosen_rows(scan):
    docs, split_anew = scan
    kept = simhash.keep_one(docs)
    split_anew()
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
