"""The star schema as a set of DataFrames, and its on-disk layout.

Layout of a warehouse folder::

    <root>/dims/<version>/dim_<name>/   Parquet tables of one version
    <root>/dims/_versions/              one empty file per published version
    <root>/facts/run=<version>/zip_date=YYYY-MM-DD/   fact rows of one run
    <root>/processed/                   log: which run's facts are a date's facts
    <root>/quality/                     appended quality reports
    <root>/staging/<version>/           cleaned records of a run

A run writes a version no other run ever wrote, publishes it, writes the facts
that use its keys into a folder of its own, and logs the dates last.  The log's
one new file is the commit of all its dates: before it readers see every date's
old facts, after it every date's new ones.  Whatever step fails, a rerun finds
the dates still on its work list and the keys already given.  What failed or
superseded runs left is removed by ``vacuum``.

A version is published by creating ``_versions/<number>.<version>``: one file
creation, so readers see the old version or the new one.  The highest number
is current.  A folder with versions but without ``_versions``, a version
without one of its tables, and a log that names an unpublished version are
errors, never an empty warehouse.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas
from shelfline.operators.joins import SizedFrame
from shelfline.session import freed_shuffles


@dataclass
class Star:
    """Dimensions (sized, so joins can decide on broadcast) and the fact."""

    dims: dict[str, SizedFrame]
    fact: DataFrame
    # Column that orders fact partitions in time ("previous available
    # partition" is defined on it).
    partition_col: str = "zip_date"
    # Processed partition dates when they can include dates without rows.
    dates: DataFrame | None = None

    def dim(self, name: str) -> DataFrame:
        return self.dims[name].df

    def dim_for_join(self, name: str) -> DataFrame:
        return self.dims[name].for_join()


def facts_path(root: str) -> str:
    return f"{root.rstrip('/')}/facts"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on the (possibly distributed) file system."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def new_version(label: str = "") -> str:
    """A version name that no other attempt uses."""
    now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    return "-".join(x for x in (label, now, uuid.uuid4().hex[:8]) if x)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def begin_version(spark: SparkSession, folder: str, version: str) -> None:
    """Prepare ``folder`` for a new version; refuses one that exists."""
    folder = folder.rstrip("/")
    current_version(spark, folder)  # refuses a folder that lost its versions
    fs, p = _fs(spark, f"{folder}/_versions")
    fs.mkdirs(p)
    if path_exists(spark, f"{folder}/{version}"):
        raise FileExistsError(f"version {version} exists under {folder}")


def published_versions(spark: SparkSession, folder: str) -> list[str]:
    """Published versions, oldest first."""
    return [n.split(".", 1)[1] for n in _names(spark, f"{folder.rstrip('/')}/_versions") if "." in n[1:]]


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The newest published version; None before the first one."""
    folder = folder.rstrip("/")
    versions = published_versions(spark, folder)
    if versions:
        return versions[-1]
    if not path_exists(spark, f"{folder}/_versions") and any(not n.startswith((".", "_")) for n in _names(spark, folder)):
        raise RuntimeError(f"{folder} has versions but no record of the published ones")
    return None


def publish_version(spark: SparkSession, folder: str, version: str) -> None:
    """Make ``version`` the current one (one file creation)."""
    folder = folder.rstrip("/")
    number = len(_names(spark, f"{folder}/_versions"))
    fs, p = _fs(spark, f"{folder}/_versions/{number:08d}.{version}")
    fs.create(p, False).close()


def dims_path(root: str) -> str:
    return f"{root.rstrip('/')}/dims"


def dim_path(root: str, name: str, version: str) -> str:
    return f"{dims_path(root)}/{version}/dim_{name}"


def read_dim(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A dimension of the current (or given) version; empty before the first one."""
    schema = schemas.DIMENSIONS[name][0]
    version = version or current_version(spark, dims_path(root))
    if version is None:
        return spark.createDataFrame([], schema)
    path = dim_path(root, name, version)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"version {version} has no table dim_{name}")
    return spark.read.schema(schema).parquet(path)


def write_dims(spark: SparkSession, root: str, dims: dict[str, DataFrame | SizedFrame], version: str) -> None:
    """Write every dimension into a new version folder, then publish it.

    Files are rebalanced by adaptive execution (one file for a small table)
    and sorted by key inside, so Parquet statistics skip on key lookups.
    """
    begin_version(spark, dims_path(root), version)
    for name, d in dims.items():
        key = schemas.DIMENSIONS[name][1]
        df = d.df if isinstance(d, SizedFrame) else d
        with freed_shuffles(spark):
            df.hint("rebalance").sortWithinPartitions(key).write.mode("errorifexists").parquet(dim_path(root, name, version))
    publish_version(spark, dims_path(root), version)


FACT_FILE_SCHEMA = T.StructType(
    [f for f in schemas.FACT.fields] + [T.StructField("zip_date", T.StringType())]
)


PROCESSED = T.StructType([T.StructField("zip_date", T.StringType()),
                          T.StructField("run_ts", T.StringType()),
                          T.StructField("version", T.StringType()),
                          T.StructField("has_rows", T.BooleanType())])


def _log(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/processed"
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROCESSED)
    return spark.read.schema(PROCESSED).parquet(path)


def current_runs(spark: SparkSession, root: str) -> dict[str, tuple[str, bool]]:
    """Date -> (run whose facts count, whether it has rows): per date the run published last.

    One entry per calendar day and run, so the log is read into the driver.
    """
    order = {v: i for i, v in enumerate(published_versions(spark, dims_path(root)))}
    last: dict[str, tuple[int, str, bool]] = {}
    for r in _log(spark, root).collect():
        if r["version"] not in order:
            raise RuntimeError(f"facts use dimension versions that are gone: {[r['version']]}")
        last[r["zip_date"]] = max(last.get(r["zip_date"], (-1, "", False)), (order[r["version"]], r["version"], r["has_rows"]))
    return {d: (version, rows) for d, (_, version, rows) in last.items()}


def run_path(root: str, version: str) -> str:
    return f"{facts_path(root)}/run={version}"


def read_facts(spark: SparkSession, root: str) -> DataFrame:
    """All dates' facts; ``zip_date`` stays an ISO string (explicit schema).

    Only the folders that the log names are listed; one that is gone is an error.
    """
    paths = [f"{run_path(root, version)}/zip_date={d}" for d, (version, rows) in sorted(current_runs(spark, root).items()) if rows]
    if not paths:
        return spark.createDataFrame([], FACT_FILE_SCHEMA)
    facts = spark.read.schema(FACT_FILE_SCHEMA).option("basePath", facts_path(root)).parquet(*paths)
    return facts.select(*FACT_FILE_SCHEMA.fieldNames())


def partition_dates(spark: SparkSession, root: str) -> DataFrame:
    """Processed archive dates, also those without rows."""
    return _log(spark, root).select("zip_date").distinct()


def check_versions(spark: SparkSession, root: str) -> None:
    """Refuse a warehouse whose log names a dimension version that is not published."""
    used = {r["version"] for r in _log(spark, root).select("version").distinct().collect()}
    lost = used - set(published_versions(spark, dims_path(root)))
    if lost:
        raise RuntimeError(f"facts use dimension versions that are gone: {sorted(lost)}")


# A run of more rows than FACT_ROUND_ROWS writes its facts some dates at a time, in FACT_ROUNDS jobs at most: what the
# joins and the rebalancing shuffle is on disk for the dates of one job only.
FACT_ROUNDS = 4
FACT_ROUND_ROWS = 1 << 20


def date_rounds(rows: dict[str | None, int], most_rounds: int | None = None,
                round_rows: int | None = None) -> list[list[str | None] | None]:
    """The dates (with their row counts), in order, as neighbours of about equally many rows; None alone: all in one job."""
    most_rounds, round_rows = most_rounds or FACT_ROUNDS, round_rows or FACT_ROUND_ROWS
    total, before, out = sum(rows.values()), 0, {}
    rounds = min(most_rounds, -(-total // round_rows))
    if rounds < 2:
        return [None]
    for d in sorted(rows, key=lambda d: (d is not None, d)):
        out.setdefault((2 * before + rows[d]) * rounds // (2 * total + 1), []).append(d)  # by where its middle row lies
        before += rows[d]
    return list(out.values())


def on_dates(dates: list[str | None]) -> Column:
    """Rows of the dates; a missing date is one of them where it is named."""
    named = F.col("zip_date").isin([d for d in dates if d is not None])
    return named | F.col("zip_date").isNull() if None in dates else named


def write_facts(spark: SparkSession, root: str, fact: DataFrame, version: str) -> None:
    """Write facts of a run into its own folder; nobody reads them before the log names the run.

    A run may write its dates in several calls, each date in one.

    The write is rebalanced by date: adaptive execution sizes the files of
    each date and splits a skewed date (or a store holding a third of the
    rows) over several writers, without the extra sampling pass a range
    partitioning would run over the whole join pipeline.  Rows are sorted
    within files by (store, product) for min/max skipping.
    """
    with freed_shuffles(spark):
        (fact.hint("rebalance", "zip_date")
             .sortWithinPartitions("zip_date", "store_key", "product_key")
             .write.mode("append").partitionBy("zip_date").parquet(run_path(root, version)))


def log_processed(spark: SparkSession, root: str, processed: list[str], run_ts: str, version: str,
                  dates_with_rows: set[str]) -> None:
    """Append the processed dates in one file: the commit of a run, and its last write."""
    rows = [(d, run_ts, version, d in dates_with_rows) for d in processed]
    spark.createDataFrame(rows, PROCESSED).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/processed")


def _written_at(version: str) -> str:
    """The UTC time (YYYYMMDDTHHMMSS) in a version's name; "" if it has none."""
    found = re.search(r"(\d{8}T\d{6})-[0-9a-f]{8}$", version)
    return found[1] if found else ""


def vacuum(spark: SparkSession, root: str, before: str, keep_versions: int = 2) -> list[str]:
    """Remove what no reader can reach any more; returns the folders removed.

    Fact runs that the log names for no date, dimension and serving versions
    that are unpublished, or published and neither among the newest
    ``keep_versions`` nor named by the log, and staging folders.  Only names
    with a time earlier than ``before`` (UTC, ``YYYYMMDDTHHMMSS``) go, so a
    running job keeps its own.
    """
    root = root.rstrip("/")
    named = {r["version"] for r in _log(spark, root).select("version").distinct().collect()}
    used = {version for version, _ in current_runs(spark, root).values()}
    doomed = [f"{root}/facts/{n}" for n in _names(spark, f"{root}/facts") if n.startswith("run=") and n[4:] not in used]
    doomed += [f"{root}/staging/{n}" for n in _names(spark, f"{root}/staging")]
    for folder, needed in ((dims_path(root), named), (f"{root}/serving", set())):
        newest = set(published_versions(spark, folder)[-keep_versions:])
        doomed += [f"{folder}/{n}" for n in _names(spark, folder) if not n.startswith(("_", ".")) and n not in newest | needed]
    old = [path for path in doomed if "" < _written_at(path.rsplit("/", 1)[1]) < before]
    for path in old:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return old


def staging_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/staging/{version}"


def drop_staging(spark: SparkSession, root: str, version: str) -> None:
    fs, p = _fs(spark, staging_path(root, version))
    fs.delete(p, True)


def append_quality(root: str, quality: DataFrame, run_ts: str) -> None:
    (quality.withColumn("run_ts", F.lit(run_ts))
            .write.mode("append").parquet(f"{root.rstrip('/')}/quality"))


def read_quality(spark: SparkSession, root: str, run_ts: str) -> DataFrame:
    """The quality report that a run appended."""
    schema = T.StructType([*schemas.QUALITY.fields, T.StructField("run_ts", T.StringType())])
    return (spark.read.schema(schema).parquet(f"{root.rstrip('/')}/quality")
            .filter(F.col("run_ts") == run_ts).drop("run_ts").distinct())


def read_star(spark: SparkSession, root: str) -> Star:
    dims = {name: SizedFrame(read_dim(spark, root, name)) for name in schemas.DIMENSIONS}
    return Star(dims=dims, fact=read_facts(spark, root), partition_col="zip_date",
                dates=partition_dates(spark, root))
