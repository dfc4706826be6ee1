"""Join helpers: broadcast a side only behind a check of its bytes.

A side whose size the planner already knows to be small is left to the
planner (``spark.sql.autoBroadcastJoinThreshold``).  A derived side, whose
estimate is far off, is measured: it is broadcast when its bytes are within
``BROADCAST_MAX_BYTES``; otherwise the join is the planner's (sort-merge, or
a broadcast that adaptive execution picks from measured shuffle sizes).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_BYTES = 32 << 20
_CELL = 16  # bytes of a fixed-width cell, and of what a variable one adds to its text


def planned_bytes(df: DataFrame) -> int:
    """The planner's size estimate (file sizes for a scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class SizedFrame:
    """A DataFrame plus a lazily measured row count and size, measured at most once."""

    def __init__(self, df: DataFrame, rows: int | None = None):
        self.df = df
        self._rows = rows
        self._bytes: int | None = None

    def _measure(self) -> None:
        texts = [c.name for c in self.df.schema.fields if isinstance(c.dataType, T.StringType | T.BinaryType)]
        size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts],
                      F.lit(_CELL * len(self.df.columns)))
        row = self.df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("b")).first()
        self._rows, self._bytes = row["n"], row["b"]

    @property
    def rows(self) -> int:
        if self._rows is None:
            self._measure()
        return self._rows

    @property
    def bytes(self) -> int:
        if self._bytes is None:
            self._measure()
        return self._bytes

    def _planned_small(self) -> bool:
        """True where the planner broadcasts the frame by itself."""
        limit = self.df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return planned_bytes(self.df) <= limit

    def is_small(self, max_bytes: int | None = None) -> bool:
        """True where ``for_join`` gives a frame that is broadcast."""
        return self._planned_small() or self.bytes <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes)

    def for_join(self, max_bytes: int | None = None) -> DataFrame:
        """The frame, marked for broadcast only when measured small enough."""
        return F.broadcast(self.df) if not self._planned_small() and self.is_small(max_bytes) else self.df
