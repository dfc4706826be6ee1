"""Spark session settings and shared-folder helpers.

The library never starts its own session on a cluster: jobs receive the
session they run in.  ``local_session`` exists for tests, the bench and
the smoke entry point.
"""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  They are applied to a session the library
# builds itself; on a cluster the same values belong in the job config.
SESSION_CONF = {
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn sort-merge joins into broadcast joins when the
    # measured (not estimated) side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # The JVM never compiles a method of more bytes of code; wide projections are then split into smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Replace only the date partitions a run writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # ISO dates and timestamps are compared as UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # No web UI or REST endpoint.
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "shelfline") -> SparkSession:
    """Session for tests, the bench and smoke checks (``local[cores]``)."""
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of ``SESSION_CONF`` to a live session."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.ui."):
            continue  # static settings, fixed when the application starts
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is; a
    cluster session without it is refused, since a machine-local folder would
    lose data with its machine.  Only a local master gets a fresh local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - a session without the key
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the cluster shares")
        configured = tempfile.mkdtemp(prefix="shelfline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers (once per application).

    Equivalent to ``--py-files``: the package folder is zipped on the driver
    and distributed with ``addPyFile``.  Only the archive decoder runs
    library code on executors.
    """
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    submitted = spark.sparkContext.getConf().get("spark.submit.pyFiles", "") or ""
    if "shelfline" in submitted:  # already shipped with --py-files
        _SHIPPED.add(app)
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="shelfline-pkg-"), "shelfline.zip")
    with zipfile.ZipFile(out, "w") as zf:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint(df):
    """Reliable, eager checkpoint into the session's checkpoint folder.

    Cuts lineage so a lost executor does not force recomputation from the
    sources; the folder comes from ``spark.checkpoint.dir`` (shared on a
    cluster) and is created locally only when that setting is absent.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Writes made inside remove their shuffle files when they end.

    Otherwise the files stay until the driver happens to collect its garbage,
    so a job of several writes holds the shuffles of all of them.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_once(df, compression: str = "snappy"):
    """Write a table into the checkpoint folder and read it back.

    Like ``checkpoint``, but columnar: what reads it later reads its columns
    only.  Written when called, with the settings of that moment.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
