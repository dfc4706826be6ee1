"""Incremental ingest with the file stream source and availableNow."""

import pytest
from pyspark.sql import functions as F

from shelfline.operators.joins import SizedFrame
from shelfline.plans.ingest import Nomenclatures
from shelfline.sources import warehouse as W
from shelfline.streaming.incremental import start_archive_stream
from test_ingest import HEADER, write_zip


@pytest.fixture()
def noms(spark):
    return Nomenclatures(
        SizedFrame(spark.createDataFrame([("68134", "София")], "code string, name string")),
        SizedFrame(spark.createDataFrame([("1", "Мляко")], "code string, name string")))


def test_stream_ingests_each_archive_once(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    noms = Nomenclatures(
        SizedFrame(spark.createDataFrame([("68134", "София")], "code string, name string")),
        SizedFrame(spark.createDataFrame([("1", "Мляко")], "code string, name string")))
    write_zip(raw / "2026-04-01.zip", {"A_1.csv": HEADER + "68134,S,Milk,P1,1,1.00,\n"})
    write_zip(raw / "2026-04-02.zip", {"A_1.csv": HEADER + "68134,S,Milk,P1,1,1.10,\n"})
    root, ckpt = str(tmp_path / "wh"), str(tmp_path / "stream-ckpt")
    start_archive_stream(spark, str(raw), root, noms, ckpt).awaitTermination()
    facts = W.read_facts(spark, root)
    assert sorted(r.zip_date for r in facts.select("zip_date").distinct().collect()) == ["2026-04-01", "2026-04-02"]

    write_zip(raw / "2026-04-03.zip", {"A_1.csv": HEADER + "68134,S,Milk,P1,1,1.20,\n"})
    start_archive_stream(spark, str(raw), root, noms, ckpt).awaitTermination()
    facts = W.read_facts(spark, root)
    assert facts.count() == 3
    assert facts.agg(F.countDistinct("product_key")).first()[0] == 1
    quality = spark.read.parquet(f"{root}/quality")
    assert sorted(r.zip_date for r in quality.collect()) == ["2026-04-01", "2026-04-02", "2026-04-03"]


def test_replayed_batch_and_new_checkpoint(spark, tmp_path, noms, monkeypatch):
    """A batch that died after its facts is replayed; a stream may also start over."""
    raw = tmp_path / "raw"
    raw.mkdir()
    write_zip(raw / "2026-04-01.zip", {"A_1.csv": HEADER + "68134,S,Milk,P1,1,1.00,\n68134,S,Bread,P2,1,2.00,\n"})
    root, ckpt = str(tmp_path / "wh"), str(tmp_path / "ckpt")

    def die(*a, **k):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(W, "log_processed", die)
        with pytest.raises(Exception, match="lost"):
            start_archive_stream(spark, str(raw), root, noms, ckpt).awaitTermination()
    for folder in (ckpt, str(tmp_path / "other")):
        start_archive_stream(spark, str(raw), root, noms, folder).awaitTermination()
        star = W.read_star(spark, root)
        rows = star.fact.join(star.dim("product"), "product_key").select("product_key", "product_name", "zip_date").collect()
        assert sorted(map(tuple, rows)) == [(1, "Milk", "2026-04-01"), (2, "Bread", "2026-04-01")]


def test_command_line_ingest_and_sync(spark, tmp_path, capsys):
    import json as _json

    from shelfline.__main__ import main

    raw = tmp_path / "raw"
    raw.mkdir()
    noms = tmp_path / "noms"
    (noms / "Ekatte").mkdir(parents=True)
    (noms / "cities-ekatte-nomenclature.json").write_text('[{"ekatte": "68134", "name": "София"}]', "utf-8")
    (noms / "product-categories.json").write_text('[{"id": 1, "name": "Мляко"}]', "utf-8")
    write_zip(raw / "2026-04-01.zip", {"A_1.csv": HEADER + "68134,S,Milk,P1,1,1.00,\n"})
    root = str(tmp_path / "wh")
    assert main(["ingest", "--raw", str(raw), "--root", root, "--nomenclatures", str(noms)]) == 0
    assert _json.loads(capsys.readouterr().out.strip().splitlines()[-1])["processed"] == ["2026-04-01"]
    assert main(["sync", "--root", root]) == 0
    assert W.read_dim(spark, root, "settlement").first().settlement_name == "София"
