"""Settlement and category nomenclatures (JSON arrays of objects) -> (code, name).

Each nomenclature is a reference list of a few thousand entries; it is read
with Spark, reduced to one name per code, and joined by broadcast after a
row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.joins import SizedFrame
from shelfline.sources.warehouse import path_exists

LOOKUP = T.StructType([T.StructField("code", T.StringType()), T.StructField("name", T.StringType())])

# Settlement files in precedence order, with the field holding
# the code.  The first file ("primary") may also be a JSON object code->name,
# and inside it the last duplicate wins; every later file only adds codes not
# seen yet.
SETTLEMENT_FILES = [
    ("cities-ekatte-nomenclature.json", "ekatte", "primary"),
    ("Ekatte/sof_rai.json", "ekatte", "districts"),
    ("Ekatte/ek_atte.json", "ekatte", "registry"),
    ("Ekatte/ek_kmet.json", "ekatte", "registry"),
    ("Ekatte/ek_obl.json", "ekatte", "registry"),
    ("Ekatte/ek_obst.json", "ekatte", "registry"),
    ("Ekatte/ek_raion.json", "raion", "registry"),
]
CATEGORY_FILE = "product-categories.json"


def _entries(spark: SparkSession, path: str) -> DataFrame:
    return entries_of(spark.read.text(path, wholetext=True))


def entries_of(files: DataFrame) -> DataFrame:
    """(pos, item map) of JSON texts (column ``value``): an array of objects, or an
    object code->name."""
    text = files.select(F.trim("value").alias("v"))
    as_list = F.from_json("v", "array<map<string,string>>")
    as_map = F.from_json("v", "map<string,string>")
    items = F.when(F.col("v").startswith("{"),
                   F.transform(F.map_entries(as_map),
                               lambda e: F.create_map(F.lit("ekatte"), e["key"], F.lit("name"), e["value"])))
    return text.select(F.posexplode(F.coalesce(items, as_list)).alias("pos", "item"))


def settlement_lookup(spark: SparkSession, folder: str) -> SizedFrame:
    """Union of the settlement files with their precedence rules."""
    parts = []
    for prio, (rel, key, kind) in enumerate(SETTLEMENT_FILES):
        path = f"{folder.rstrip('/')}/{rel}"
        if not path_exists(spark, path):
            continue
        parts.append(settlement_entries(_entries(spark, path), key, kind, prio))
    if not parts:
        return SizedFrame(spark.createDataFrame([], LOOKUP), rows=0)
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    return SizedFrame(precedence(allp))


def settlement_entries(entries: DataFrame, key: str, kind: str, prio: int) -> DataFrame:
    """(code, name, ord, prio) of one settlement file by the rules of its kind."""
    code, name = F.col("item")[key], F.col("item")["name"]
    place = F.col("pos")
    if kind == "primary":
        code, name, place = F.coalesce(code, F.lit("")), F.coalesce(name, F.lit("")), -place
    elif kind == "districts":
        entries, name = entries.filter(F.coalesce(code, F.lit("")) != ""), F.coalesce(name, F.lit(""))
    else:
        entries = entries.filter(code.isNotNull() & name.isNotNull() & (code != ""))
    return entries.select(code.alias("code"), name.alias("name"), place.alias("ord"), F.lit(prio).alias("prio"))


def category_names(entries: DataFrame) -> DataFrame:
    """(code, name): the id as text; the last duplicate wins."""
    code = F.col("item")["id"]
    return (entries.filter(code.isNotNull())
            .select(code.alias("code"), F.coalesce(F.col("item")["name"], F.lit("")).alias("name"), "pos")
            .groupBy("code").agg(F.max_by("name", "pos").alias("name")))


def precedence(entries: DataFrame) -> DataFrame:
    """One name per code: lowest ``prio`` wins, then lowest ``ord``."""
    return entries.groupBy("code").agg(F.min_by("name", F.struct("prio", "ord")).alias("name"))


def category_lookup(spark: SparkSession, folder: str) -> SizedFrame:
    """id (as text) -> name; the last duplicate wins; absent file -> empty."""
    path = f"{folder.rstrip('/')}/{CATEGORY_FILE}"
    if not path_exists(spark, path):
        return SizedFrame(spark.createDataFrame([], LOOKUP), rows=0)
    return SizedFrame(category_names(_entries(spark, path)))
