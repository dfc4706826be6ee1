"""Dimensions: first-seen attributes, stable surrogate keys, key resolution.

Rules (type-1 with "first seen wins"):

* a natural key that already has a row keeps its key and its attributes;
* new natural keys get ``max(existing key) + 1 ...`` in first-seen order
  (archive date, member order, row order);
* attributes of a new key come from its first occurrence.

Everything is an aggregation or a join.  Numbering in first-seen order is
distributed: a range-partitioned sort, per-partition counts (one row per
partition), and an offset per partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import conform as C
from shelfline.operators.joins import SizedFrame
from shelfline.session import write_once


def first_seen(rows: DataFrame, natural_key: list[str], attrs: list[str],
               pos: str = "pos") -> DataFrame:
    """One row per natural key: its first position and first-seen attributes.

    ``min``/``min_by`` aggregate partially before the shuffle, so a hot key
    costs one row per task.
    """
    aggs = [F.min(pos).alias("first_pos")] + [F.min_by(a, pos).alias(a) for a in attrs]
    return rows.groupBy(*natural_key).agg(*aggs)


def _first(rows: DataFrame, keys: dict[str, list[str]], pos: str) -> DataFrame:
    """The least ``pos`` of every natural key: _dim, the key columns (NULL outside their dimension), ``pos``.

    Grouping sets: the rows are scanned and shuffled once, and each set's
    minimum is partially aggregated before the shuffle.
    """
    cols = list(dict.fromkeys(c for key in keys.values() for c in key))
    sets = [[F.col(c) for c in key] for key in keys.values()]
    seen = rows.groupingSets(sets, *[F.col(c) for c in cols]).agg(
        F.min(pos).alias(pos), F.grouping_id(*[F.col(c) for c in cols]).alias("_g"))
    names = F.lit(None).cast("string")
    for name, key in keys.items():
        bits = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in key)
        names = F.when(F.col("_g") == bits, F.lit(name)).otherwise(names)
    return seen.select(names.alias("_dim"), *cols, pos)


def first_places(rows: DataFrame, keys: dict[str, list[str]], pos: str = "pos") -> DataFrame:
    """First place of every natural key of several dimensions, written once.

    Columns: _dim, the key columns, first_pos, which sorts a dimension's keys
    by their first position.  Spark finds the minimum of a struct by sorting
    all rows.  So of a struct position that begins with a whole number, that
    number's minimum is found by hashing; only keys of one dimension that share
    it are told apart by the whole position, over the rows that have it.
    """
    kind = rows.schema[pos].dataType
    if not (isinstance(kind, T.StructType) and isinstance(kind.fields[0].dataType, T.IntegralType)):
        return write_once(_first(rows, keys, pos).withColumnRenamed(pos, "first_pos"))
    lead = F.coalesce(F.col(pos)[kind.fields[0].name].cast("bigint"), F.lit(-1 << 63))  # (NULL sorts first)
    led = rows.withColumn("_lead", lead)
    seen = write_once(_first(led, keys, "_lead"))
    shared = write_once(seen.groupBy("_dim", "_lead").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_lead").distinct())
    if shared.isEmpty():
        return seen.withColumn("first_pos", F.struct("_lead", F.lit(None).cast(kind).alias(pos))).drop("_lead")
    whole = _first(led.join(SizedFrame(shared).for_join(), "_lead", "left_semi"), keys, pos)
    cols = [c for c in seen.columns if c != "_lead"]
    found = seen.join(whole.withColumnsRenamed({c: f"_{c}" for c in cols}),
                      reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols]), "left")
    return write_once(found.select(*cols, F.struct("_lead", pos).alias("first_pos")))


def null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def next_key(existing: DataFrame, key_col: str) -> int:
    """``max(key) + 1`` over keys that are integers; 1 for an empty dimension."""
    row = existing.agg(F.max(F.col(key_col).cast("string").try_cast("bigint")).alias("m")).first()
    return (row["m"] or 0) + 1


def number_sorted(df: DataFrame, start: int, out_col: str) -> DataFrame:
    """Number the rows of a sorted frame ``start, start+1, ...`` as they stand."""
    # Adaptive execution coalesces the range partitions to the data size,
    # so a small run writes a small checkpoint.
    s = (df.withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = write_once(s)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # One row per partition: a bounded broadcast.
    numbered = s.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
    return (numbered.withColumn(out_col, F.lit(start) + F.col("_off") + F.col("_mid") - F.col("_m0"))
                    .drop("_pid", "_mid", "_off", "_m0", "_n"))


def assign_keys(existing: DataFrame, candidates: DataFrame, key_col: str,
                natural_key: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(full dimension, new rows only).

    ``candidates`` has the natural key, attributes and ``first_pos``.  Only the
    natural keys absent from ``existing`` are numbered (an anti join), so a
    steady daily run numbers only the day's new keys.
    """
    out = assign_keys_many({"_": KeySpec(existing, candidates, key_col, natural_key, columns)})
    return out["_"].full.df, out["_"].new


class KeySpec:
    """One dimension to key: existing rows, first-seen candidates, layout."""

    def __init__(self, existing: DataFrame, candidates: DataFrame, key_col: str,
                 natural_key: list[str], columns: list[str]):
        self.existing, self.candidates = existing, candidates
        self.key_col, self.natural_key, self.columns = key_col, natural_key, columns


class Keyed:
    def __init__(self, full: SizedFrame, new: DataFrame):
        self.full, self.new = full, new


def assign_keys_many(specs: dict[str, KeySpec]) -> dict[str, Keyed]:
    """Key several dimensions with one numbering pass.

    One job reads every existing dimension's max key and row count.  The new
    rows of all dimensions stand in one frame (each dimension its columns, the
    others NULL), sorted by (dimension, first position, natural key) and
    written; one count per dimension and partition tells the key of every row,
    continuing from the dimension's own max.
    """
    spark = next(iter(specs.values())).existing.sparkSession
    stats = reduce(DataFrame.unionByName, [
        sp.existing.select(F.lit(n).alias("_dim"),
                           F.col(sp.key_col).cast("string").try_cast("bigint").alias("_k"))
        for n, sp in specs.items()]).groupBy("_dim").agg(
            F.max("_k").alias("_max"), F.count(F.lit(1)).alias("_rows"))
    seen = {r["_dim"]: r for r in stats.collect()}
    payload = {n: [c for c in sp.columns if c != sp.key_col] for n, sp in specs.items()}

    def new_rows(n: str, sp: KeySpec) -> DataFrame:
        c = sp.candidates
        fresh = c.join(sp.existing.select(*sp.natural_key), null_safe_on(c, sp.existing, sp.natural_key), "left_anti")
        return fresh.select(F.lit(n).alias("_dim"), "first_pos", *payload[n])

    wide = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [new_rows(n, sp) for n, sp in specs.items()])
    # Written once: the range partitioner samples its input and the sort reads it again.
    wide = write_once(wide.hint("rebalance"))
    order = list(dict.fromkeys(c for sp in specs.values() for c in sp.natural_key))
    placed = write_once(wide.orderBy("_dim", "first_pos", *order)
                        .withColumn("_pid", F.spark_partition_id())
                        .withColumn("_mid", F.monotonically_increasing_id()))
    # One row per dimension and partition.
    counts = placed.groupBy("_dim", "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0")).collect()
    ahead = {n: ((seen[n]["_max"] or 0) + 1) if n in seen else 1 for n in specs}
    rows = {n: seen[n]["_rows"] if n in seen else 0 for n in specs}
    offsets = []
    for r in sorted(counts, key=lambda r: (r["_dim"], r["_pid"])):
        offsets.append((r["_dim"], r["_pid"], ahead[r["_dim"]] - r["_m0"]))
        ahead[r["_dim"]] += r["_n"]
        rows[r["_dim"]] += r["_n"]
    shift = spark.createDataFrame(offsets, "_dim string, _pid int, _shift bigint")
    keyed = placed.join(F.broadcast(shift), ["_dim", "_pid"]).withColumn("_key", F.col("_mid") + F.col("_shift"))
    out = {}
    for n, sp in specs.items():
        numbered = (keyed.filter(F.col("_dim") == n)
                    .select(F.col("_key").alias(sp.key_col), *payload[n]).select(*sp.columns))
        full = sp.existing.select(*sp.columns).unionByName(numbered)
        out[n] = Keyed(SizedFrame(full, rows=rows[n]), numbered)
    return out


# ---------------------------------------------------------------------------
# Name resolution (settlement and category nomenclatures)
# ---------------------------------------------------------------------------

def resolve_settlement_names(codes: DataFrame, lookup: SizedFrame, code_col: str = "ekatte",
                             out_col: str = "settlement_name") -> DataFrame:
    """Name of each code: exact, zero-filled, zero-stripped probe, else unknown.

    ``lookup`` has ``(code, name)`` with unique codes.  Apply it to distinct
    codes (a dimension), not to every fact row.
    """
    lk = lookup.for_join()
    p1, p2, p3 = C.settlement_probes(F.col(code_col))
    df = codes.withColumn("_p1", p1).withColumn("_p2", p2).withColumn("_p3", p3)
    for i in (1, 2, 3):
        df = df.join(lk.select(F.col("code").alias(f"_p{i}"), F.col("name").alias(f"_n{i}")),
                     f"_p{i}", "left")
    name = F.coalesce("_n1", "_n2", "_n3", C.unknown_name(F.col(code_col)))
    return df.withColumn(out_col, name).drop("_p1", "_p2", "_p3", "_n1", "_n2", "_n3")


def resolve_category_names(codes: DataFrame, lookup: SizedFrame, code_col: str = "category_code",
                           out_col: str = "category_name") -> DataFrame:
    lk = lookup.for_join().select(F.col("code").alias(code_col), F.col("name").alias("_n"))
    return (codes.join(lk, code_col, "left")
                 .withColumn(out_col, F.coalesce("_n", C.unknown_name(F.col(code_col))))
                 .drop("_n"))


def patch_unknown_settlements(dim_settlement: DataFrame, lookup: SizedFrame) -> tuple[DataFrame, DataFrame]:
    """Re-resolve ``(unknown:...`` names; keys kept.  Returns (dimension, changed rows)."""
    resolved = resolve_settlement_names(
        dim_settlement.withColumnRenamed("settlement_name", "_old"), lookup,
        out_col="_new")
    fix = C.is_unknown(F.col("_old")) & ~C.is_unknown(F.col("_new"))
    out = resolved.withColumn("settlement_name", F.when(fix, F.col("_new")).otherwise(F.col("_old")))
    changed = out.filter(fix).select("settlement_key", "ekatte", "settlement_name")
    return out.select("settlement_key", "ekatte", "settlement_name"), changed
