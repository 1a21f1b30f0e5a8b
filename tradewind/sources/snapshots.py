"""Tables kept in one folder per part value and renewed by one switch.

::

    root/data/<run>/part=<value>/…     rows, written once and never changed
    root/snapshots/<number>.json       which folder holds each part, and a mark

A run writes only the parts it renews, below a folder of its own, then the next snapshot file, by
one rename. Readers see the old table or the new one, never a mix; a run that dies leaves nothing
that a snapshot names. Two runs that start from one snapshot cannot both publish: the second
rename finds its number taken and fails. A snapshot lists parts, not rows or files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.schemas import layout

# What the rows of a part without a value are kept under.
NO_VALUE = "none"
_PART = "part"


class Outrun(RuntimeError):
    """Another run has published since this one read the table."""


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    mark: str | None = None


class SnapshotTable:
    """A table of the layout ``ddl`` below ``root``, in parts by the text column ``part_column``."""

    def __init__(self, spark: SparkSession, root: str, ddl: str, part_column: str) -> None:
        self.spark, self.root, self.ddl, self.part_column = spark, root.rstrip("/"), ddl, part_column

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, system = self._path(folder)
        if not system.exists(path):
            return []
        return [s.getPath().getName() for s in system.listStatus(path)]

    def live(self) -> Snapshot:
        """The newest snapshot; an empty one before the first."""
        numbers = [int(n[:-5]) for n in self._names("snapshots") if n.endswith(".json")]
        return self.at(max(numbers)) if numbers else Snapshot()

    def at(self, number: int) -> Snapshot:
        text = self.spark.read.text(f"{self.root}/snapshots/{number:012d}.json", wholetext=True).first()[0]
        held = json.loads(text)
        return Snapshot(number, held["folders"], held["mark"])

    def read(self, snapshot: Snapshot | None = None, parts: set[str] | None = None) -> DataFrame:
        """Rows of a snapshot (the live one), or of some of its parts: only their folders are read."""
        folders = (snapshot or self.live()).folders
        wanted = [f"{self.root}/{folders[p]}" for p in sorted(folders) if parts is None or p in parts]
        schema = layout(self.ddl)
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*wanted)

    def renew(self, rows: DataFrame, parts: set[str], base: Snapshot, mark: str | None) -> Snapshot:
        """Publish ``base`` with ``parts`` replaced by ``rows``, which belong to these parts only.

        A part without rows is gone. ``mark`` is kept with the snapshot, so that what has been
        taken in and the rows it gave become visible together.
        """
        run = f"data/{base.number + 1:012d}-{uuid.uuid4().hex}"
        # Rows of one part are rebalanced: few files per part, and a large part is split.
        keyed = rows.select(*layout(self.ddl).names).withColumn(
            _PART, F.coalesce(F.col(self.part_column), F.lit(NO_VALUE))
        )
        keyed.hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.root}/{run}")
        written = {n.removeprefix(f"{_PART}="): f"{run}/{n}" for n in self._names(run) if n.startswith(f"{_PART}=")}
        strange = set(written) - parts
        if strange:
            raise ValueError(f"rows of parts that are not renewed: {sorted(strange)[:5]}")
        kept = {p: f for p, f in base.folders.items() if p not in parts}
        return self._publish(Snapshot(base.number + 1, kept | written, mark))

    def _publish(self, snapshot: Snapshot) -> Snapshot:
        draft, system = self._path(f"snapshots/.{uuid.uuid4().hex}")
        final, _ = self._path(f"snapshots/{snapshot.number:012d}.json")
        out = system.create(draft, False)
        out.write(json.dumps({"folders": snapshot.folders, "mark": snapshot.mark}).encode())
        out.close()
        if system.exists(final) or not system.rename(draft, final):
            system.delete(draft, False)
            raise Outrun(f"snapshot {snapshot.number} of {self.root} exists already")
        return snapshot

    def clean(self, keep: int = 2) -> int:
        """Delete all but the newest snapshots and the folders only they name; how many folders went.

        Not to be called while a run is writing: its folders are named by no snapshot yet.
        """
        numbers = sorted(int(n[:-5]) for n in self._names("snapshots") if n.endswith(".json"))
        used = {f.split("/")[1] + "/" + f.split("/")[2] for n in numbers[-keep:] for f in self.at(n).folders.values()}
        gone = 0
        for number in numbers[:-keep]:
            path, system = self._path(f"snapshots/{number:012d}.json")
            system.delete(path, False)
        for run in self._names("data"):
            parts = [p for p in self._names(f"data/{run}") if p.startswith(f"{_PART}=")]
            left = [p for p in parts if f"{run}/{p}" in used]
            for name in ([f"{run}/{p}" for p in parts if p not in left] if left else [run]):
                path, system = self._path(f"data/{name}")
                system.delete(path, True)
                gone += 1
        return gone

