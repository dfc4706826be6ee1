"""End-to-end ingest on hand-made archives, then serving build and a browse page."""

import os
import zipfile
from decimal import Decimal

import pytest

from shelfline.operators.joins import SizedFrame
from shelfline.plans import ingest as I
from shelfline.plans import queries as q
from shelfline.plans.sync import read_serving, run_sync
from shelfline.sources import warehouse as W

HEADER = "settlement,store,product_name,product_code,category,retail,promo\n"
HEADER_SC = HEADER.replace(",", ";")


def write_zip(path, members):
    with zipfile.ZipFile(path, "w") as zf:
        for name, data in members.items():
            zf.writestr(name, data if isinstance(data, bytes) else data.encode("utf-8"))


@pytest.fixture()
def archives(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write_zip(raw / "2026-04-01.zip", {
        "Chain A_111.csv": HEADER
        + '068134,"Shop, One",Milk,P1,1,"3,50",\n'
        + "68134,Shop Two,Bread,P2,2,1.20,0\n"
        + "2659,Shop Three,Bread,P2,2,1.50,\n"
        + "68134,Shop,X,P3,1,1.00\n"                                   # 6 fields: dropped
        + "68134,Shop Two,Cheese,P4,99,5.00,4.00,extra,extra2\n"         # 9 fields: kept
        + HEADER,                                                       # repeated header: data
        "Chain B_222.csv": "﻿" + HEADER_SC
        + '98226;Market;Milk;P1;1;2,30;""\n'
        + "68134-04;Market;Bread;P2;2;n/a;-1\n",
        "NoUnderscore.csv": HEADER,
        "Empty_333.csv": "",
        "readme.txt": "not a csv",
    })
    (raw / "2026-04-02.zip").write_bytes(b"this is not a zip archive")
    write_zip(raw / "2026-04-03.zip", {
        "Chain A renamed_111.csv": HEADER
        + "68134,Shop Two,Bread,P2,2,1.30,\n"
        + "68134,Shop Two,Bread,P2,2,1.25,\n",                          # duplicate key: last wins
    })
    write_zip(raw / "2026-04-05.zip", {
        "Chain A_111.csv": HEADER + "68134,Shop Two,Bread,P2,2,1.40,1.10\n",
    })
    return str(raw)


@pytest.fixture()
def noms(spark):
    s = spark.createDataFrame([("68134", "София"), ("02659", "Банкя"), ("68134-04", "Оборище")],
                              "code string, name string")
    c = spark.createDataFrame([("1", "Мляко"), ("2", "Хляб")], "code string, name string")
    return I.Nomenclatures(SizedFrame(s), SizedFrame(c))


def test_ingest_sync_browse(spark, archives, noms, tmp_path):
    root = str(tmp_path / "wh")
    res = I.run_ingest(spark, archives, root, noms, run_ts="r1")
    assert res.processed_dates == ["2026-04-01", "2026-04-03", "2026-04-05"]

    quality = {r.zip_date: tuple(r)[1:] for r in res.quality.collect()}
    # rows kept, missing retail, unknown settlements, unknown categories, ';' files, prices that don't fit
    assert quality["2026-04-01"] == (7, 2, 2, 2, 1, 0)
    assert quality["2026-04-03"] == (2, 0, 0, 0, 0, 0)

    star = W.read_star(spark, root)
    company = {r.uic: r.company_name for r in star.dim("company").collect()}
    assert company == {"111": "Chain A", "222": "Chain B", "": "NoUnderscore", "333": "Empty"}
    files = {(r.file_name, str(r.zip_date)) for r in star.dim("file").collect()}
    assert ("Empty_333.csv", "2026-04-01") in files and len(files) == 6
    sett = {r.ekatte: r.settlement_name for r in star.dim("settlement").collect()}
    assert sett == {"68134": "София", "02659": "Банкя", "98226": "(unknown:98226)",
                    "68134-04": "Оборище", "settlement": "(unknown:settlement)"}
    cats = {r.category_code: r.category_name for r in star.dim("category").collect()}
    assert cats["99"] == "(unknown:99)" and cats["1"] == "Мляко"
    keys_before = sorted(tuple(r) for r in star.dim("product").collect())

    fact = star.fact
    n_facts = fact.count()
    assert sorted(r.zip_date for r in fact.select("zip_date").distinct().collect()) == res.processed_dates
    milk = fact.filter("zip_date = '2026-04-01' and retail_price = 3.5").collect()
    assert len(milk) == 1 and milk[0].promo_price is None

    version = run_sync(spark, root, version="v1")
    with pytest.raises(FileExistsError):
        run_sync(spark, root, version="v1")
    sv = read_serving(spark, root, version)
    lb = sv.lookback.collect()
    assert len(lb) == 1
    row = lb[0]
    assert row.retail_price == Decimal("1.4000") and row.promo_price == Decimal("1.1000")
    assert row.retail_price_day1 == Decimal("1.2500")       # last row of 04-03 wins
    assert row.retail_price_day2 == Decimal("1.2000")       # 04-01 (04-02 was corrupt)
    page = q.browse_rows(sv, limit=10).collect()
    assert [(r.product_name, r.store_name, r.company_name) for r in page] == [("Bread", "Shop Two", "Chain A")]
    assert sorted(r.date_key for r in sv.star.dim("date").collect()) == sorted(
        r.date_key for r in star.dim("date").collect())

    # Second run, nothing new: nothing processed, dimensions unchanged.
    res2 = I.run_ingest(spark, archives, root, noms, run_ts="r2")
    assert res2.processed_dates == []
    # Forced from the newest date: that date is redone, keys stay.
    res3 = I.run_ingest(spark, archives, root, noms, force_from="2026-04-05", run_ts="r3")
    assert res3.processed_dates == ["2026-04-05"]
    star3 = W.read_star(spark, root)
    assert sorted(tuple(r) for r in star3.dim("product").collect()) == keys_before
    assert star3.fact.count() == n_facts


def test_corrupt_redownload_keeps_partition(spark, archives, noms, tmp_path):
    root = str(tmp_path / "wh")
    I.run_ingest(spark, archives, root, noms, run_ts="r1")
    before = W.read_facts(spark, root).filter("zip_date = '2026-04-03'").count()
    with open(os.path.join(archives, "2026-04-03.zip"), "wb") as fh:
        fh.write(b"broken")
    res = I.run_ingest(spark, archives, root, noms, force_from="2026-04-03", run_ts="r2")
    assert "2026-04-03" not in res.processed_dates
    assert W.read_facts(spark, root).filter("zip_date = '2026-04-03'").count() == before == 2


def test_sync_of_empty_warehouse(spark, tmp_path):
    root = str(tmp_path / "empty")
    version = run_sync(spark, root, version="v0")
    sv = read_serving(spark, root, version)
    assert sv.lookback.count() == 0
    assert sv.projection.count() == 0
    assert q.browse_rows(sv).count() == 0
    assert q.available_dates(sv).count() == 0


# ---------------------------------------------------------------------------
# Failures
# ---------------------------------------------------------------------------

def natural(spark, root):
    """Facts in natural values, with the keys they use."""
    star = W.read_star(spark, root)
    df = (star.fact.join(star.dim("product"), "product_key").join(star.dim("store"), "store_key")
          .select("zip_date", "product_key", "product_code", "product_name", "store_key", "store_name", "retail_price"))
    return sorted(map(tuple, df.collect()))


def test_only_work_list_archives_are_read(spark, archives, noms, tmp_path):
    """A processed archive that has become unreadable does not matter."""
    root = str(tmp_path / "wh")
    I.run_ingest(spark, archives, root, noms)
    with open(os.path.join(archives, "2026-04-01.zip"), "ab") as fh:
        fh.write(os.urandom(200_000))
    write_zip(os.path.join(archives, "2026-04-07.zip"), {"Chain A_111.csv": HEADER + "68134,Shop Two,Bread,P2,2,1.5,\n"})
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100000")
    try:
        assert I.run_ingest(spark, archives, root, noms).processed_dates == ["2026-04-07"]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


_CLEAN = []  # facts of one clean run over the archives


@pytest.mark.parametrize("step", ["publish_version", "write_facts", "append_quality", "log_processed"])
def test_rerun_after_a_failed_write(spark, archives, noms, tmp_path, monkeypatch, step):
    """A run that dies before any of its writes, and its rerun, equal one clean run."""
    root = str(tmp_path / "wh")
    if not _CLEAN:
        I.run_ingest(spark, archives, str(tmp_path / "clean"), noms)
        _CLEAN.append(natural(spark, str(tmp_path / "clean")))

    def die(*a, **k):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(W, step, die)
        with pytest.raises(OSError, match="lost"):
            I.run_ingest(spark, archives, root, noms)
    assert W.partition_dates(spark, root).count() == 0
    res = I.run_ingest(spark, archives, root, noms)
    assert res.processed_dates == ["2026-04-01", "2026-04-03", "2026-04-05"]
    assert natural(spark, root) == _CLEAN[0]


@pytest.mark.parametrize("step", ["half_of_the_facts", "log_processed"])
def test_forced_rerun_that_dies_leaves_every_date_whole(spark, archives, noms, tmp_path, monkeypatch, step):
    """Old facts for every date until the log's one write, new facts for every date after it."""
    root = str(tmp_path / "wh")
    I.run_ingest(spark, archives, root, noms)
    before = natural(spark, root)
    for day in ("01", "05"):
        write_zip(os.path.join(archives, f"2026-04-{day}.zip"), {"Chain A_111.csv": HEADER + f"68134,Shop New,Bread,P{day},2,1.5,\n"})

    def die(*a, **k):
        raise OSError("lost")

    def half(spark, root, fact, version):
        whole(spark, root, fact.filter("zip_date = '2026-04-01'"), version)
        raise OSError("lost")

    whole = W.write_facts
    with monkeypatch.context() as m:
        m.setattr(W, "write_facts" if step == "half_of_the_facts" else step, half if step == "half_of_the_facts" else die)
        with pytest.raises(OSError, match="lost"):
            I.run_ingest(spark, archives, root, noms, force_from="2026-04-01")
    assert natural(spark, root) == before
    I.run_ingest(spark, archives, root, noms, force_from="2026-04-01")
    facts = W.read_facts(spark, root)
    assert {d: facts.filter(f"zip_date = '2026-04-{d}'").count() for d in ("01", "05")} == {"01": 1, "05": 1}
    left = natural(spark, root)
    # Nothing that counts is removed, and nothing of a run that may still be on its way.
    assert W.vacuum(spark, root, "20000101T000000") == []
    gone = W.vacuum(spark, root, "99991231T000000", keep_versions=1)
    assert any("/facts/run=" in x for x in gone)
    assert natural(spark, root) == left
    assert W.vacuum(spark, root, "99991231T000000", keep_versions=1) == []
    I.run_ingest(spark, archives, root, noms)  # the log still finds its versions
    run_sync(spark, root)
    assert read_serving(spark, root).lookback.count() > 0


def test_lost_versions_are_an_error(spark, archives, noms, tmp_path):
    root = str(tmp_path / "wh")
    I.run_ingest(spark, archives, root, noms)
    record = os.path.join(root, "dims", "_versions")
    os.rename(record, record + ".away")
    with pytest.raises(RuntimeError, match="no record"):
        W.read_dim(spark, root, "product")
    os.mkdir(record)
    with pytest.raises(RuntimeError, match="gone"):
        I.run_ingest(spark, archives, root, noms, force_from="2026-04-05")
    os.rmdir(record)
    os.rename(record + ".away", record)
    version = W.current_version(spark, W.dims_path(root))
    os.rename(os.path.join(root, "dims", version, "dim_product"), os.path.join(root, "dims", version, "away"))
    with pytest.raises(FileNotFoundError, match="dim_product"):
        W.read_dim(spark, root, "product")


def damage(path, how):
    with open(path, "rb") as fh:
        data = bytearray(fh.read())
    if how == "flip":       # inside the data of the first member
        data[60] ^= 0xFF
    elif how == "cut":
        data = data[: len(data) // 2]
    with open(path, "wb") as fh:
        fh.write(data)


@pytest.mark.parametrize("how", ["flip", "cut"])
def test_damaged_archive_contributes_nothing(spark, archives, noms, tmp_path, how):
    root, path = str(tmp_path / "wh"), os.path.join(archives, "2026-04-03.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("A_1.csv", HEADER + "68134,Shop,Bread,P2,2,1.3,\n" * 40)
        zf.writestr("B_2.csv", HEADER + "68134,Shop,Milk,P1,1,2.5,\n" * 40)
    I.run_ingest(spark, archives, root, noms)
    before = natural(spark, root)
    damage(path, how)
    res = I.run_ingest(spark, archives, root, noms, force_from="2026-04-03")
    assert res.processed_dates == ["2026-04-05"]
    assert natural(spark, root) == before


def test_unbalanced_quote_does_not_end_the_run(spark, archives, noms, tmp_path):
    root = str(tmp_path / "wh")
    write_zip(os.path.join(archives, "2026-04-07.zip"), {
        "A_1.csv": HEADER + '68134,"Shop,' + "x,1,2,3\n" * 40_000,
        "B_2.csv": HEADER + "68134,Shop,Milk,P1,1,2.5,\n"})
    res = I.run_ingest(spark, archives, root, noms)
    assert "2026-04-07" in res.processed_dates
    assert W.read_facts(spark, root).filter("zip_date = '2026-04-07'").count() == 1


def test_names_are_repaired_and_texts_served_clean(spark, archives, noms, tmp_path):
    root = str(tmp_path / "wh")
    I.run_ingest(spark, archives, root, noms)
    run_sync(spark, root)
    more = spark.createDataFrame([("98226", "Village")], "code string, name string")
    later = I.Nomenclatures(SizedFrame(noms.settlements.df.union(more)), noms.categories)
    write_zip(os.path.join(archives, "2026-04-07.zip"), {"Chain A_111.csv": HEADER + "68134, Shop Two ,,P9,,123456789.5,\n"})
    res = I.run_ingest(spark, archives, root, later)
    assert res.quality.first().untyped_prices == 1
    names = {r.ekatte: r.settlement_name for r in W.read_dim(spark, root, "settlement").collect()}
    assert names["98226"] == "Village"
    sv = read_serving(spark, root, run_sync(spark, root))
    row = q.browse_rows(sv).collect()
    assert [(r.product_name, r.category_name, r.store_name, r.price) for r in row] == [(None, "(unknown:)", "Shop Two", None)]
    assert sv.star.dim("category").filter("category_code IS NULL").count() == 1
    # Rows that an earlier version published stay unless a prune drops them.
    assert sv.star.dim("file").filter("zip_date = '2026-04-01'").count() == 4


def test_newest_date_may_have_no_rows(spark, archives, noms, tmp_path):
    root = str(tmp_path / "wh")
    write_zip(os.path.join(archives, "2026-04-09.zip"), {"Chain A_111.csv": HEADER})
    I.run_ingest(spark, archives, root, noms)
    star = W.read_star(spark, root)
    assert q.newest_date(star).first()[0] == "2026-04-09"
    assert [r[0] for r in q.newest_dates(star, 2).collect()] == ["2026-04-05", "2026-04-09"]


def test_facts_are_written_some_dates_at_a_time(spark, archives, noms, tmp_path, monkeypatch):
    """What the joins shuffle lies on disk for some dates only; the facts are the same."""
    I.run_ingest(spark, archives, str(tmp_path / "one"), noms)
    whole, dates = W.write_facts, []

    def write(spark, root, fact, version):
        dates.append({r["zip_date"] for r in fact.select("zip_date").distinct().collect()})
        whole(spark, root, fact, version)

    monkeypatch.setattr(W, "write_facts", write)
    monkeypatch.setattr(W, "FACT_ROUND_ROWS", 1)
    I.run_ingest(spark, archives, str(tmp_path / "some"), noms)
    assert len(dates) > 1 and sorted(d for some in dates for d in some) == ["2026-04-01", "2026-04-03", "2026-04-05"]
    assert natural(spark, str(tmp_path / "some")) == natural(spark, str(tmp_path / "one"))


def test_dates_are_dealt_into_rounds_of_like_size(spark):
    assert W.date_rounds({"b": 5, "a": 5}, most_rounds=4, round_rows=10) == [None]
    assert W.date_rounds({}) == [None]
    assert W.date_rounds({"d": 1, "a": 1, None: 1, "b": 1, "c": 1}, most_rounds=2, round_rows=1) == [[None, "a", "b"], ["c", "d"]]
    assert W.date_rounds({"a": 1, "b": 90, "c": 1, "d": 1}, most_rounds=3, round_rows=1) == [["a"], ["b"], ["c", "d"]]
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "zip_date string")
    assert [sorted(str(r[0]) for r in rows.filter(W.on_dates(d)).collect()) for d in ([None], [None, "a"], ["a", "b"])] == [
        ["None"], ["None", "a"], ["a", "b"]]


def test_rows_are_shuffled_with_short_keys_and_typed_prices(spark, archives, noms, tmp_path, monkeypatch):
    """Joins with what is broadcast come before those that may move the rows."""
    joined, with_keys = [], I._with_keys
    monkeypatch.setattr(I, "_with_keys", lambda rows, dims, names: joined.append((rows.columns, names)) or with_keys(rows, dims, names))
    I.run_ingest(spark, archives, str(tmp_path / "wh"), noms)
    columns, names = next(x for x in joined if "product" in x[1])
    assert names[-2:] == ["product", "store"] and {"retail_price", "promo_price"} <= set(columns)
