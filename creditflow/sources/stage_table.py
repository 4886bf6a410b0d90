"""A keyed stage table on plain parquet for one writer: merge by key, read, mark rows.

Rows are spread over a fixed number of buckets by the hash of their key and, with ``day_of``, over
days. A merge reads and rewrites only the parts that hold its keys or will hold them, and leaves
the files of all others alone. Every merge writes a directory of its own and then one small
version file, which names the parts; a job that dies at any point leaves the last version whole.

The first merge stores the layout with the table, and a table opened with another one is refused.
There is one writer at a time: a second one that comes to the same version is refused, not
merged. Several writers, object stores and tables of very many parts need a table format, whose
``MERGE INTO`` takes the same rules (:mod:`creditflow.operators.merge`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from creditflow.functions.clock import DAY_MS
from creditflow.operators import outbox
from creditflow.operators.merge import MergeSpec, fold, merge_folded


class ConcurrentCommit(RuntimeError):
    """Another writer has written this version; the table is for one writer."""


#: Times that split a table by day when ``day_of`` is ``auto``.
DAY_COLUMNS = ("bucket_start", "system_time")


@dataclass
class Snapshot:
    """``dirs`` maps a partition such as ``bucket=3`` to its directory; ``writers`` holds the
    last batch id that each stream has merged; ``layout`` tells how rows are spread; ``kind`` is
    ``merge``, or ``mark`` where rows were only marked as sent."""

    version: int = 0
    dirs: dict[str, str] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)
    layout: dict[str, object] = field(default_factory=dict)
    kind: str = "merge"


class StageTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        key: str = "request_id",
        buckets: int = 16,
        day_of: str | None = None,
    ):
        """One task writes one bucket: choose ``buckets`` for about a gigabyte each (per day).

        ``day_of`` splits by the day of a time column, so that a batch of today's rows leaves
        the parts of other days alone; ``"auto"`` takes the first of ``DAY_COLUMNS`` that the
        schema has. The version file lists every part, so keep their number well below a million.
        """
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        if day_of == "auto":
            day_of = next((c for c in DAY_COLUMNS if c in schema.fieldNames()), None)
        self.buckets, self.day_of = buckets, day_of

    @property
    def layout(self) -> dict[str, object]:
        return {"key": self.key, "buckets": self.buckets, "day_of": self.day_of}

    # --- snapshots ----------------------------------------------------------------------

    def snapshot(self) -> Snapshot:
        names = self._list(f"{self.path}/commits")
        if not names:
            return Snapshot()
        found = Snapshot(**json.loads(self._read_text(f"{self.path}/commits/{max(names)}")))
        if found.layout != self.layout:
            raise ValueError(f"the table is laid out as {found.layout}, not as {self.layout}")
        return found

    def read(
        self, snapshot: Snapshot | None = None, partitions: Sequence[str] | None = None
    ) -> DataFrame:
        """The table at a snapshot (default: the latest), or only some of its partitions."""
        dirs = (snapshot or self.snapshot()).dirs
        chosen = dirs.values() if partitions is None else [dirs[p] for p in partitions if p in dirs]
        files = [f"{self.path}/data/{d}" for d in chosen]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def lookup(self, value: str) -> DataFrame:
        """The row of one key: reads one bucket (of each day)."""
        bucket = self.spark.range(1).select(self._bucket(F.lit(value))).first()[0]
        snapshot = self.snapshot()
        chosen = [p for p in snapshot.dirs if p.split("/")[-1] == f"bucket={bucket}"]
        return self.read(snapshot, chosen).filter(F.col(self.key) == value)

    def since(self, ms: int) -> DataFrame:
        """The rows whose ``day_of`` time is at or after ``ms``: older days are not read."""
        if not self.day_of:
            raise ValueError("the table is not split by day")
        snapshot = self.snapshot()
        first = ms // DAY_MS
        chosen = [p for p in snapshot.dirs if int(p.split("/")[0].split("=")[1]) >= first]
        return self.read(snapshot, chosen).filter(F.col(self.day_of) >= ms)

    # --- writes -------------------------------------------------------------------------

    def merge(
        self,
        batch: DataFrame,
        spec: MergeSpec,
        order: Sequence[str],
        writer: str | None = None,
        batch_id: int | None = None,
    ) -> Snapshot:
        """Upsert ``batch``. A batch that ``writer`` has merged before is not merged again."""
        folded = fold(batch, spec, order)
        return self._rewrite(
            folded, lambda old, new: merge_folded(old, new, spec), writer, batch_id
        )

    def mark_sent(self, sent: DataFrame, spec: outbox.OutboxSpec) -> Snapshot:
        """Set flag and stamps of handed-over rows that have not changed since."""
        return self._rewrite(
            outbox.marks(sent, spec),
            lambda old, new: outbox.apply_marks(old, new, spec),
            kind="mark",
        )

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def _partition_columns(self) -> dict[str, Column]:
        bucket = {"bucket": self._bucket(F.col(self.key))}
        if not self.day_of:
            return bucket
        return {"day": F.floor(F.col(self.day_of) / F.lit(DAY_MS)), **bucket}

    def _partition_name(self) -> Column:
        parts = self._partition_columns().items()
        return F.concat_ws("/", *[F.concat(F.lit(f"{n}="), c.cast("string")) for n, c in parts])

    def _parts_of_keys(self, base: Snapshot, changes: DataFrame) -> list[str]:
        """The parts that hold keys of ``changes``, whatever day the changes carry."""
        buckets = {f"bucket={r[0]}" for r in changes.select(self._bucket(F.col(self.key))).distinct().collect()}
        near = [p for p in base.dirs if p.split("/")[-1] in buckets]
        if not self.day_of or not near:
            return near
        # Only key and day are read; the keys of the batch decide, not a time that may change.
        held = self.read(base, near).join(changes.select(self.key).distinct(), self.key, "left_semi")
        return [r[0] for r in held.select(self._partition_name()).distinct().collect()]

    def _rewrite(
        self,
        changes: DataFrame,
        apply: Callable[[DataFrame, DataFrame], DataFrame],
        writer: str | None = None,
        batch_id: int | None = None,
        kind: str = "merge",
    ) -> Snapshot:
        """Apply ``changes`` to the parts that hold their keys, and commit what was written.

        Rows whose part changes move: the parts that they leave are rewritten too, and so are
        the parts that receive them.
        """
        base = self.snapshot()
        if writer is not None and base.writers.get(writer, -1) >= batch_id:
            return base
        parts = self._partition_columns()
        changes = changes.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            old_parts = set(self._parts_of_keys(base, changes))
            if self.day_of in changes.columns:
                coming = changes.select(self._partition_name()).distinct().collect()
                old_parts |= {r[0] for r in coming} & base.dirs.keys()
            # Both sides are dealt by the hash that makes the buckets: the join needs no other
            # shuffle, and each task writes one bucket.
            old = self.read(base, sorted(old_parts)).repartition(self.buckets, self.key)
            new = changes.repartition(self.buckets, self.key)
            directory = f"{base.version + 1:020d}-{uuid.uuid4().hex}"
            apply(old, new).withColumns(parts).write.partitionBy(*parts).parquet(
                f"{self.path}/data/{directory}"
            )
        finally:
            changes.unpersist()
        written = self._written(f"{self.path}/data/{directory}", len(parts))
        if not written and not old_parts:
            return base
        dirs = {p: d for p, d in base.dirs.items() if p not in old_parts}
        dirs |= {p: f"{directory}/{p}" for p in written}
        writers = base.writers if writer is None else {**base.writers, writer: batch_id}
        return self._commit(Snapshot(base.version + 1, dirs, writers, self.layout, kind))

    def _written(self, path: str, depth: int) -> list[str]:
        """The parts that a merge has written."""
        names = [""]
        for _ in range(depth):
            names = [f"{n}/{c}" for n in names for c in self._list(f"{path}{n}") if "=" in c]
        return [n[1:] for n in names]

    def expire(self, keep: int = 2) -> None:
        """Drop the directories that none of the last ``keep`` versions uses.

        For the writer, between two merges.
        """
        names = sorted(self._list(f"{self.path}/commits"))
        used: set[str] = set()
        for name in names[-keep:]:
            dirs = json.loads(self._read_text(f"{self.path}/commits/{name}"))["dirs"]
            used |= {d.split("/", 1)[0] for d in dirs.values()}
        for directory in self._list(f"{self.path}/data"):
            if directory not in used:
                self._delete(f"{self.path}/data/{directory}")
        for name in names[:-keep]:
            self._delete(f"{self.path}/commits/{name}")

    # --- files, through the Hadoop file system of the session ---------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return hadoop_path.getFileSystem(conf), hadoop_path

    def _list(self, path: str) -> list[str]:
        """Names in a directory."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(p)]
        return [n for n in found if not n.startswith((".", "_"))]

    def _read_text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _commit(self, snapshot: Snapshot) -> Snapshot:
        """Write the version aside, then rename it into place; a second writer is refused."""
        fs, target = self._fs(f"{self.path}/commits/{snapshot.version:020d}.json")
        _, aside = self._fs(f"{self.path}/commits/.{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        stream.write(bytearray(json.dumps(snapshot.__dict__).encode()))
        stream.close()
        if fs.exists(target) or not fs.rename(aside, target):
            fs.delete(aside, False)
            raise ConcurrentCommit(f"version {snapshot.version} is taken")
        return snapshot

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)
