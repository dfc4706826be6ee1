"""Settings and shared-folder helpers."""

import time

from shelfline.plans import fixture_runs
from shelfline.session import write_once
from shelfline.sources import fixtures as X


def shuffle_files(spark):
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in jvm.scala.jdk.javaapi.CollectionConverters.asJava(files) if f.getName().startswith("shuffle_")}


def test_a_table_written_once_leaves_no_shuffle_files(spark):
    before, rows = shuffle_files(spark), spark.range(1000).repartition(7)
    assert write_once(rows).count() == 1000
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:  # (they are removed in the background)
        time.sleep(0.1)
    assert not {f for f in shuffle_files(spark) - before if f.endswith(".data")}
    assert write_once(rows).count() == 1000  # what was removed is made again


def test_raw_records_are_not_copied(spark, monkeypatch):
    written = []
    monkeypatch.setattr(fixture_runs, "write_once", lambda df, *a: written.append(df.columns) or write_once(df, *a))
    rows = fixture_runs.fixture_raw(spark, "/root/testdata/sf0.001")
    assert written == [["zip_date", "file_seq", "file_name", "delimiter"]]
    kinds = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}
    want = X.raw_records(spark, "/root/testdata/sf0.001")
    assert kinds == {r["kind"]: r["count"] for r in want.groupBy("kind").count().collect()} and len(kinds) == 3
