"""Upserts into an external target, as a Spark data source with one commit per run.

``upsert_into`` writes rows under a run name.  Every task writes its batches as
a part of its own that nobody reads yet; when all tasks are done, one commit
names the parts of the run, and from then on its rows replace the rows with
their keys.  A run that is committed already changes nothing, so a job that is
repeated under its name leaves one result; a failed job removes its parts.

``Target`` is what a store has to offer.  ``FolderTarget`` keeps parts and
commits in a folder that driver and executors share; a database would write a
part into a staging table and merge the named parts in one transaction.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfline.session import ship_package

FORMAT = "shelfline_target"


@dataclass
class Part(WriterCommitMessage):
    """One task's written rows."""

    name: str
    rows: int


class Target:
    """A store that takes parts and makes those of a run valid at once."""

    def write_part(self, run: str, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Part | None:
        raise NotImplementedError

    def commit(self, run: str, parts: list[Part]) -> None:
        raise NotImplementedError

    def discard(self, parts: list[Part]) -> None:
        raise NotImplementedError


class FolderTarget(Target):
    """``<path>/parts/<run>/<name>.parquet`` and ``<path>/commits/<number>.json``."""

    def __init__(self, path: str):
        path = path.removeprefix("file:")
        self.path = "/" + path.strip("/") if path.startswith("/") else path.rstrip("/")
        if ":/" in self.path:
            raise ValueError("a folder target is a path that driver and executors share")

    def write_part(self, run, schema, batches):
        os.makedirs(f"{self.path}/parts/{run}", exist_ok=True)
        name, rows, writer = f"{run}/{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in batches:
                if batch.num_rows:
                    writer = writer or pq.ParquetWriter(f"{self.path}/parts/{name}", schema)
                    writer.write_batch(batch.cast(schema))
                    rows += batch.num_rows
        except BaseException:
            if writer:
                writer.close()
                self.discard([Part(name, rows)])
            raise
        if writer is None:
            return None
        writer.close()
        return Part(name, rows)

    def commits(self) -> list[dict]:
        """Commits in order; of several under one run the first counts."""
        folder = f"{self.path}/commits"
        names = sorted(n for n in os.listdir(folder) if n.endswith(".json")) if os.path.isdir(folder) else []
        first: dict[str, dict] = {}
        for name in names:
            with open(f"{folder}/{name}", encoding="utf-8") as f:
                found = json.load(f)
            first.setdefault(found["run"], found)
        return list(first.values())

    def commit(self, run, parts):
        if any(c["run"] == run for c in self.commits()):
            return self.discard(parts)
        folder = f"{self.path}/commits"
        os.makedirs(folder, exist_ok=True)
        draft = f"{folder}/{uuid.uuid4().hex}.draft"
        with open(draft, "x", encoding="utf-8") as f:
            json.dump({"run": run, "parts": [p.name for p in parts], "rows": sum(p.rows for p in parts)}, f)
        number = len(os.listdir(folder))
        while True:  # a link appears whole, and only where no other run took the number
            try:
                os.link(draft, f"{folder}/{number:010d}.json")
                break
            except FileExistsError:
                number += 1
        os.unlink(draft)

    def discard(self, parts):
        for part in parts:
            if os.path.exists(f"{self.path}/parts/{part.name}"):
                os.unlink(f"{self.path}/parts/{part.name}")


class TargetWriter(DataSourceArrowWriter):
    """A task writes one part; the job commits the parts that its tasks report."""

    def __init__(self, target: Target, run: str, schema: StructType):
        self.target, self.run = target, run
        self.schema = to_arrow_schema(schema)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.target.write_part(self.run, self.schema, iterator) or Part("", 0)

    def commit(self, messages: list) -> None:
        self.target.commit(self.run, _parts(messages))

    def abort(self, messages: list) -> None:
        self.target.discard(_parts(messages))


def _parts(messages: list) -> list[Part]:
    """The parts of a job; failed tasks have none, tasks without rows an unnamed one."""
    return [m for m in messages if m is not None and m.name]


class TargetSource(DataSource):
    """``df.write.format("shelfline_target").option("path", ..).option("run", ..)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> TargetWriter:
        if overwrite:
            raise ValueError("rows are merged by key; write with mode append")
        run = self.options.get("run", "")
        if not run or run.startswith(".") or "/" in run:
            raise ValueError("option run must name the run")
        return TargetWriter(FolderTarget(self.options["path"]), run, schema)


def upsert_into(df: DataFrame, path: str, run: str) -> None:
    """Write ``df`` into the folder target at ``path`` as run ``run``; its keys should be distinct."""
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(TargetSource)
    df.write.format(FORMAT).mode("append").option("path", path).option("run", run).save()


def read_target(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """The target's rows: per key the row of the newest committed run.

    Only parts that a commit names are read.  The commits, one small record per
    run, are listed by the driver; the rows are merged by a grouped maximum.
    """
    target = FolderTarget(path)
    commits = target.commits()
    files = [f"file:{target.path}/parts/{p}" for c in commits for p in c["parts"]]
    if not files:
        return spark.createDataFrame([], schema)
    order = F.create_map(*[F.lit(x) for i, c in enumerate(commits) for x in (c["run"], i)])
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    rows = spark.read.schema(schema).parquet(*files).withColumn("__run", F.url_decode(run))
    others = [c for c in schema.names if c != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.element_at(order, F.col("__run"))).alias("__row"))
    return newest.select(*[F.col(key) if c == key else F.col("__row")[c].alias(c) for c in schema.names])
