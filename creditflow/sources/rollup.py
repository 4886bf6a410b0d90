"""A roll-up of window partials that micro-batches append to and dashboards read.

A micro-batch reduces its records to one partial per window (:func:`metrics.window_partials`) and
writes them to a folder of its own, split by day (or another period); nothing that lies there is read or rewritten, and
no window is kept in a streaming state. A replayed micro-batch overwrites its folder. Readers add
the partials of a window up, and a trailing range reads only the days it covers. Late records are
further partials of their window, so none is dropped.

    <path>/writer=<query id>/batches=<first>-<last>/period=<n>/...

:meth:`RollupTable.fold` adds the partials of a writer's finished micro-batches up in one folder,
which readers take in place of the folders it covers. A folder counts once its writing has ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from creditflow.functions.clock import DAY_MS
from creditflow.operators import dashboard, metrics
from creditflow.sources import files

SCHEMA = StructType(
    [StructField(c, DoubleType() if c == "total_amount" else LongType()) for c in [*metrics.EDGES, *metrics.PARTIALS]]
)


class RollupTable:
    """Partials of windows of ``size_ms`` milliseconds under ``path``, split by ``period_ms``.

    A file holds the windows of a micro-batch and period: choose the period for ranges that are read.
    """

    def __init__(self, spark: SparkSession, path: str, size_ms: int = 1000, period_ms: int = DAY_MS):
        self.spark, self.path, self.size_ms, self.period_ms = spark, path.rstrip("/"), size_ms, period_ms

    # --- writes -------------------------------------------------------------------------

    def append(self, records: DataFrame, writer: str, batch_id: int) -> None:
        """The records (with ``event_ts``) of one micro-batch, reduced to windows."""
        self._write(metrics.window_partials(records, f"{self.size_ms} milliseconds"), writer, batch_id, batch_id)

    def _write(self, partials: DataFrame, writer: str, first: int, last: int) -> None:
        period = F.floor(F.col("bucket_start") / F.lit(self.period_ms)).cast("int")
        # Windows are few: one file per period.
        dealt = partials.withColumn("period", period).repartition("period")
        dealt.write.mode("overwrite").partitionBy("period").parquet(f"{self.path}/writer={writer}/batches={first:012d}-{last:012d}")

    def fold(self, writer: str, until: int) -> None:
        """Add up what ``writer``'s micro-batches up to ``until`` wrote in one folder.

        The folders that it covers stay for those who read them now; the next fold drops them.
        """
        home = f"{self.path}/writer={writer}"
        taken = {f"batches={first:012d}-{last:012d}" for first, last in self._batches(writer)}
        for name in files.names(self.spark, home):
            if name.startswith("batches=") and name not in taken and int(name.split("-")[1]) <= until:
                files.delete(self.spark, f"{home}/{name}")
        old = [(first, last) for first, last in self._batches(writer) if last <= until]
        if len(old) < 2:
            return
        paths = [f"{home}/batches={first:012d}-{last:012d}" for first, last in old]
        self._write(metrics.merged(self._load(paths)), writer, old[0][0], old[-1][1])

    # --- reads --------------------------------------------------------------------------

    def _batches(self, writer: str) -> list[tuple[int, int]]:
        """The folders of a writer that readers take: finished ones that no wider one covers."""
        home = f"{self.path}/writer={writer}"
        found = []
        for name in files.names(self.spark, home):
            if name.startswith("batches=") and files.exists(self.spark, f"{home}/{name}/_SUCCESS"):
                first, last = name.removeprefix("batches=").split("-")
                found.append((int(first), int(last)))
        taken: list[tuple[int, int]] = []
        for first, last in sorted(found, key=lambda b: (b[0], -b[1])):
            if not taken or last > taken[-1][1]:
                taken.append((first, last))
        return taken

    def folders(self) -> list[str]:
        writers = [n.removeprefix("writer=") for n in files.names(self.spark, self.path) if n.startswith("writer=")]
        return [f"{self.path}/writer={w}/batches={first:012d}-{last:012d}" for w in writers for first, last in self._batches(w)]

    def _load(self, folders: list[str]) -> DataFrame:
        """Partials as they lie there, with the period that their folder names."""
        schema = StructType([*SCHEMA, StructField("period", LongType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).select(*schema.names)

    def partials(self) -> DataFrame:
        return self._load(self.folders())

    def windows(self) -> DataFrame:
        """The metrics of all windows."""
        return metrics.finished(metrics.merged(self.partials()))

    def newest(self) -> Column:
        """The newest event time, as a scalar subquery that reads one period."""
        held = self.partials()
        held_periods = [n for f in self.folders() for n in files.names(self.spark, f) if n.startswith("period=")]
        newest = max((int(n.removeprefix("period=")) for n in held_periods), default=0)
        return dashboard.latest(held.filter(F.col("period") == newest))

    def recent(self, range_ms: int, anchor: Column | None = None) -> DataFrame:
        """The metrics of the windows whose last event lies in the ``range_ms`` before ``anchor`` (default: the newest event).

        Periods before the range are not read, also where the anchor is known only when the query runs.
        """
        anchor = self.newest() if anchor is None else anchor
        # A window's last event is less than its size behind its start.
        first = F.floor((anchor - F.lit(range_ms + self.size_ms)) / F.lit(self.period_ms))
        held = self.partials().filter(F.col("period") >= first)
        return dashboard.trailing(metrics.finished(metrics.merged(held)), anchor, range_ms)
