"""First-seen dimensions and stable surrogate keys."""

from pyspark.sql import functions as F

from shelfline.operators import dims as D

SETT = "settlement_key bigint, ekatte string, settlement_name string"


def cand(spark, rows):
    df = spark.createDataFrame(rows, "ekatte string, settlement_name string, p long")
    return df.select("ekatte", "settlement_name", F.struct("p").alias("first_pos"))


def test_new_code_gets_next_key(spark):
    existing = spark.createDataFrame([(4, "00001", "A")], SETT)
    full, new = D.assign_keys(existing, cand(spark, [("12345", "Sofia", 1)]), "settlement_key",
                              ["ekatte"], ["settlement_key", "ekatte", "settlement_name"])
    assert [tuple(r) for r in new.collect()] == [(5, "12345", "Sofia")]
    assert D.next_key(full, "settlement_key") == 6


def test_existing_code_keeps_key_and_attributes(spark):
    existing = spark.createDataFrame([(5, "12345", "Sofia")], SETT)
    full, new = D.assign_keys(existing, cand(spark, [("12345", "Renamed", 1)]), "settlement_key",
                              ["ekatte"], ["settlement_key", "ekatte", "settlement_name"])
    assert new.count() == 0
    assert [tuple(r) for r in full.collect()] == [(5, "12345", "Sofia")]
    assert D.next_key(full, "settlement_key") == 6


def test_next_key_of_loaded_dimension(spark):
    existing = spark.createDataFrame([(1, "68134", "Sofia"), (2, "10135", "Plovdiv")], SETT)
    assert D.next_key(existing, "settlement_key") == 3
    assert D.next_key(spark.createDataFrame([], SETT), "settlement_key") == 1


def test_non_integer_keys_ignored_for_next_key(spark):
    df = spark.createDataFrame([("7", "a"), ("x", "b")], "k string, v string")
    assert D.next_key(df, "k") == 8


def test_numbering_is_dense_and_ordered_across_partitions(spark):
    n = 5000
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("p")).repartition(7)
    out = D.number_sorted(df.orderBy("p"), 10, "k").collect()
    assert sorted((r.p, r.k) for r in out) == [(i, i + 10) for i in range(n)]


def test_first_seen_takes_first_occurrence(spark):
    rows = spark.createDataFrame(
        [("u1", "First name", 3), ("u1", "Later name", 9), ("u2", "Other", 5)],
        "uic string, company_name string, p long").withColumn("pos", F.struct("p"))
    fs = {r.uic: (r.company_name, r.first_pos.p) for r in D.first_seen(rows, ["uic"], ["company_name"]).collect()}
    assert fs == {"u1": ("First name", 3), "u2": ("Other", 5)}


def test_keys_follow_first_seen_order(spark):
    rows = spark.createDataFrame([("b", 2), ("a", 5), ("c", 1), ("b", 0)], "code string, p long") \
        .withColumn("pos", F.struct("p"))
    cands = D.first_seen(rows, ["code"], []).withColumnRenamed("code", "category_code") \
        .withColumn("category_name", F.col("category_code"))
    existing = spark.createDataFrame([], "category_key bigint, category_code string, category_name string")
    full, _ = D.assign_keys(existing, cands, "category_key", ["category_code"],
                            ["category_key", "category_code", "category_name"])
    assert sorted((r.category_key, r.category_code) for r in full.collect()) == [(1, "b"), (2, "c"), (3, "a")]


def test_what_a_first_run_writes_is_columnar(spark):
    import os

    from shelfline.plans.fixture_runs import fixture_first_run
    from shelfline.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    _, _, _, built = fixture_first_run(spark, "/root/testdata/sf0.001")
    assert built.full["store"].count() > 0
    made = set(os.listdir(folder)) - before
    assert made and all(n.startswith("written-") for n in made)


def test_first_places_tell_keys_of_one_leading_number_apart(spark):
    # Two keys share the leading number: the rest of the position orders them; a null key is a key.
    rows = spark.createDataFrame(
        [(7, 2, "a", "x"), (7, 1, "b", "x"), (3, 9, "c", "y"), (None, 5, None, "y"), (7, 0, "c", "y"), (9, 0, "b", "z")],
        "lead bigint, rest int, code string, name string").withColumn("pos", F.struct("lead", "rest"))
    found = D.first_places(rows, {"code": ["code"], "name": ["name"]})
    for dim, order in (("code", [None, "c", "b", "a"]), ("name", ["y", "x", "z"])):
        assert [r[dim] for r in found.filter(F.col("_dim") == dim).orderBy("first_pos").collect()] == order


def test_first_places_of_a_struct_are_found_by_hashing(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(D, "write_once", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    rows = spark.range(20).select(F.struct("id", F.lit("x").alias("rest")).alias("pos"), (F.col("id") % 5).alias("code"))
    assert [r.code for r in D.first_places(rows, {"code": ["code"]}).orderBy("first_pos").collect()] == [0, 1, 2, 3, 4]
    assert plans and not any("SortAggregate" in p for p in plans)
