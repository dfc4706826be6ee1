"""Settlement and category nomenclatures: precedence, duplicates, absent files."""

import json
import os

from shelfline.sources import nomenclature as N


def write(folder, rel, obj):
    path = os.path.join(folder, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(obj, fh, ensure_ascii=False)


def lookup(spark, folder):
    return {r.code: r.name for r in N.settlement_lookup(spark, folder).df.collect()}


def test_precedence_and_metadata_rows(spark, tmp_path):
    d = str(tmp_path)
    write(d, "cities-ekatte-nomenclature.json",
          [{"ekatte": "68134", "name": "София"}, {"ekatte": "68134", "name": "София (last)"},
           {"ekatte": "02659", "name": "Банкя"}])
    write(d, "Ekatte/sof_rai.json", [{"ekatte": "68134", "name": "ignored"},
                                     {"ekatte": "99999", "name": "Район"}, {"ekatte": "", "name": "x"}])
    write(d, "Ekatte/ek_obl.json", [{"ekatte": "11111", "name": "Област"}, {"ekatte": "99999", "name": "late"},
                                    {"meta": "trailing row"}])
    write(d, "Ekatte/ek_raion.json", [{"raion": "68134-04", "name": "Оборище", "ekatte": "68134"},
                                      {"document": "metadata only"}])
    got = lookup(spark, d)
    assert got == {"68134": "София (last)", "02659": "Банкя", "99999": "Район", "11111": "Област",
                   "68134-04": "Оборище"}


def test_primary_file_as_object_and_absent_files(spark, tmp_path):
    d = str(tmp_path)
    assert lookup(spark, d) == {}
    write(d, "cities-ekatte-nomenclature.json", {"68134": "София", "10135": "Пловдив"})
    assert lookup(spark, d) == {"68134": "София", "10135": "Пловдив"}


def test_category_lookup_last_duplicate_wins(spark, tmp_path):
    d = str(tmp_path)
    assert N.category_lookup(spark, d).df.count() == 0
    write(d, "product-categories.json", [{"id": 1, "name": "Хляб"}, {"id": 2, "name": "Мляко"},
                                         {"id": 1, "name": "Хляб и тестени"}])
    got = {r.code: r.name for r in N.category_lookup(spark, d).df.collect()}
    assert got == {"1": "Хляб и тестени", "2": "Мляко"}
