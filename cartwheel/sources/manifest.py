"""Tables of which a refresh rewrites only the parts that it touches.

A table is cut into parts by one or more integer or date expressions over its rows (a hash bucket of the key, say, and a
month). Each part's current files lie in one folder; a manifest names the folder of every part::

    root/data/<number>.<writer>/bucket=3/...     files that one commit wrote
    root/manifests/<number>.json                 parts -> folders, and the last batch of every writer

A commit writes new folders for the parts that it touches and publishes the next manifest by one rename that fails if that
number is taken. Until then readers see the former manifest and its files, which a commit never changes; a crash leaves
files that no manifest names, and the replay of the same batch writes them again. A batch that a manifest already holds is
not applied twice. The manifest grows with the number of parts, not with rows or commits.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ConcurrentCommit(RuntimeError):
    """Another commit took the number; read again and retry."""


def hash_bucket(keys: list[str], buckets: int) -> Column:
    """Bucket of a row by its keys (null keys have one too)."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    number: int = -1
    folders: dict[str, list[str]] = field(default_factory=dict)  # part -> commit folders that hold its files
    applied: dict[str, int] = field(default_factory=dict)      # writer -> its last batch
    settings: dict = field(default_factory=dict)


class ManifestTable:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _names(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    # -- reading ------------------------------------------------------------

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json"))

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest published state, or the one of a number."""
        if number is None:
            number = max(self.numbers(), default=-1)
        if number < 0:
            return Snapshot()
        stream = self._fs.open(self._path("manifests", f"{number:012d}.json"))
        try:
            return Snapshot(**json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def read(self, snapshot: Snapshot | None = None, parts: Iterable[str] | None = None) -> DataFrame | None:
        """All rows, or those of some parts; None if there are no files."""
        snapshot = snapshot or self.snapshot()
        wanted = snapshot.folders if parts is None else [p for p in parts if p in snapshot.folders]
        paths = [f"{self.root}/data/{f}/{p}" for p in wanted for f in snapshot.folders[p]]
        return self.spark.read.parquet(*paths) if paths else None

    # -- writing ------------------------------------------------------------

    @staticmethod
    def touched(rows: DataFrame, by: dict[str, Column]) -> list[str]:
        """The parts that ``rows`` fall into (as many values as there are parts reach the driver)."""
        names = rows.select(*(c.alias(n) for n, c in by.items())).distinct().collect()
        return sorted("/".join(f"{n}={r[n]}" for n in by) for r in names)

    def commit(self, rows: DataFrame | None, by: dict[str, Column], parts: Iterable[str], writer: str, batch: int,
               base: Snapshot | None = None, settings: dict | None = None, append: bool = False) -> Snapshot:
        """Replace ``parts`` by ``rows`` (their whole new content; a part without rows goes) and publish. ``append``
        adds the rows to the parts instead, whose files stay.

        ``base``: the snapshot that ``rows`` were made from; a commit in between raises :class:`ConcurrentCommit`.
        A ``batch`` that ``writer`` has published already changes nothing.
        """
        base = base or self.snapshot()
        if base.applied.get(writer, -1) >= batch:
            return base
        parts, folder = list(parts), f"{base.number + 1:012d}.{writer}"
        folders = {p: f for p, f in base.folders.items() if append or p not in set(parts)}
        if parts:
            marked = rows.withColumns({f"_part_{n}": c for n, c in by.items()})
            marked = marked.withColumnsRenamed({f"_part_{n}": n for n in by}) if not set(by) & set(rows.columns) else self._refuse(by)
            # REBALANCE deals rows out by part and lets AQE split large parts and join small ones
            marked.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(f"{self.root}/data/{folder}")
            folders |= {p: [*folders.get(p, []), folder] for p in parts if self._fs.exists(self._path("data", folder, p))}
        new = Snapshot(base.number + 1, folders, base.applied | {writer: batch}, base.settings | (settings or {}))
        self._publish(new)
        return new

    @staticmethod
    def _refuse(by: dict[str, Column]):
        raise ValueError(f"rows have a column named like a part: {sorted(by)}")

    def _publish(self, new: Snapshot) -> None:
        """One rename makes the manifest visible; it does not replace an existing one."""
        name = f"{new.number:012d}.json"
        draft, final = self._path("manifests", f".{name}.draft"), self._path("manifests", name)
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(new.__dict__).encode()))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise ConcurrentCommit(f"{self.root}: manifest {new.number} was published by another writer")

    def expire(self, keep: int) -> int:
        """Remove what only manifests older than the newest ``keep`` need: their files and the manifests. For a time when no
        reader uses them and no commit is under way. Returns the number of commit folders removed."""
        numbers = self.numbers()
        old, kept = numbers[: -max(1, keep)], numbers[-max(1, keep):]
        needed = {f for n in kept for held in self.snapshot(n).folders.values() for f in held}
        gone = [f for f in self._names("data") if f not in needed and int(f.split(".", 1)[0]) <= max(kept, default=-1)]
        for n in old:
            self._fs.delete(self._path("manifests", f"{n:012d}.json"), False)
        for f in gone:
            self._fs.delete(self._path("data", f), True)
        return len(gone)
