"""Tables as runs and the batches since, behind a pointer that is switched at once.

A streaming batch adds one folder; writing it costs what the batch costs. Every ``FOLD_AFTER``
batches those since the last fold become one run, and ``WIDTH`` runs of one level become one of
the next, so a row is rewritten a logarithmic number of times and a reader merges few folders
however long the stream has run. All of them lie side by side as values of one partition
column, so that a read is one scan of the folders it needs.

Which runs are valid, and which batches they hold, stands in the newest file under
``pointer``. A fold writes its run first and then renames a new pointer into place, which fails
if there is one of that number: a crash in between, or two folds at once, leave an unused folder
and lose nothing. What the pointer before the last no longer names is removed after
``KEEP_MS``, so that reads under way can finish.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLD_AFTER = 20
WIDTH = 8
KEEP_MS = 3_600_000
_RUN, _BATCH = "part=run.", "part=batch."


@dataclass(frozen=True)
class Version:
    """What a pointer says: runs as (level, folder), and the last batch they hold of each stream."""

    number: int = 0
    runs: list[tuple[int, str]] = field(default_factory=list)
    folded: dict[str, int] = field(default_factory=dict)

    def holds(self, stream_id: str, batch_id: int) -> bool:
        return batch_id <= self.folded.get(stream_id, -1)


class Files:
    """The few file operations tables need, on any file system Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, none if there is no folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def age_ms(self, path: str) -> int:
        return time.time_ns() // 1_000_000 - self._fs.getFileStatus(self._path(path)).getModificationTime()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Write a small file, in place of one of that name."""
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Make a file appear with all of its text; False if there is one of that name."""
        if self.exists(path):
            return False
        folder, name = path.rsplit("/", 1)
        hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.write(hidden, text)
        draft = self._path(hidden)
        rename = self._spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self._spark._jsc.hadoopConfiguration()
        )
        try:
            context.rename(draft, self._path(path), options)
        except Exception as error:  # Py4J gives one type for all Java errors
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class VersionedTable:
    """A table of rows of ``layout``; ``merge`` makes one row of those that stand for the same.

    ``merge`` has to give the same whatever the order and grouping it is applied in. ``layout``
    may hold a ``partition`` column, by which runs and batches are then divided into folders.
    """

    def __init__(
        self, spark: SparkSession, path: str, layout: T.StructType,
        merge: Callable[[DataFrame], DataFrame], partition: str | None = None,
    ):
        self.spark, self.path, self.layout = spark, path.rstrip("/"), layout
        self.merge, self.partition = merge, partition
        self.files = Files(spark, path)

    def version(self, before: int | None = None) -> Version:
        """The newest version, or the newest of a lower number than ``before``."""
        numbers = [int(n[:-5]) for n in self.files.names(f"{self.path}/pointer") if n.endswith(".json") and n[:-5].isdigit()]
        numbers = [n for n in numbers if before is None or n < before]
        if not numbers:
            return Version()
        said = json.loads(self.files.read(self._pointer(max(numbers))))
        return Version(max(numbers), [tuple(r) for r in said["runs"]], said["folded"])

    def _pointer(self, number: int) -> str:
        return f"{self.path}/pointer/{number:010d}.json"

    def _folder(self, name: str) -> str:
        return f"{self.path}/rows/{name}"

    @staticmethod
    def _batch(stream_id: str, batch_id: int) -> str:
        return f"{_BATCH}{urllib.parse.quote(stream_id, safe='').replace('.', '%2E')}.{batch_id}"

    def batches(self) -> list[tuple[str, int]]:
        """Stored batches whose write has ended, by stream and number."""
        found = []
        for name in self.files.names(f"{self.path}/rows"):
            if name.startswith(_BATCH) and self.files.exists(f"{self._folder(name)}/_SUCCESS"):
                stream, batch = name.removeprefix(_BATCH).split(".")
                found.append((urllib.parse.unquote(stream), int(batch)))
        return sorted(found)

    def add(self, rows: DataFrame, stream_id: str, batch_id: int) -> None:
        """Store a batch in place of an earlier attempt at it, and fold if it is time."""
        self._write(rows, self._batch(stream_id, batch_id))
        version = self.version()
        if sum(not version.holds(*b) for b in self.batches()) >= FOLD_AFTER:
            self.fold()

    def _write(self, rows: DataFrame, name: str) -> None:
        target = self._folder(name)
        writer = rows.select(*self.layout.names)
        if self.partition:
            writer = writer.hint("rebalance", self.partition)  # few files a folder; a large one is split
            writer.write.mode("overwrite").partitionBy(self.partition).parquet(target)
        else:
            writer.write.mode("overwrite").parquet(target)

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.layout)
        rows = self.spark.read.schema(self.layout).option("basePath", f"{self.path}/rows")
        return rows.parquet(*map(self._folder, names)).select(*self.layout.names)

    def rows(self, without: tuple[str, int] | None = None) -> DataFrame:
        """All stored rows, not merged; those of the batch ``without`` are left out."""
        version = self.version()
        since = [b for b in self.batches() if not version.holds(*b) and b != without]
        return self._read([name for _, name in version.runs] + [self._batch(*b) for b in since])

    def read(self) -> DataFrame:
        return self.merge(self.rows())

    def fold(self) -> bool:
        """Make a run of the batches since the last fold; False if another fold came first."""
        version = self.version()
        since = [b for b in self.batches() if not version.holds(*b)]
        if not since:
            return False
        source = [self._batch(*b) for b in since]
        level, runs = 0, list(version.runs)
        while sum(at == level for at, _ in runs) >= WIDTH - 1:
            source += [name for at, name in runs if at == level]
            runs = [r for r in runs if r[0] != level]
            level += 1
        name = f"{_RUN}{uuid.uuid4().hex}"
        self._write(self.merge(self._read(source)), name)
        folded = dict(version.folded)
        for stream, batch in since:
            folded[stream] = max(batch, folded.get(stream, -1))
        return self._switch(Version(version.number + 1, [*runs, (level, name)], folded))

    def _switch(self, version: Version) -> bool:
        said = json.dumps({"runs": version.runs, "folded": version.folded})
        if not self.files.write_new(self._pointer(version.number), said):
            return False
        self.remove_unused()
        return True

    def copy_to(self, target: str) -> None:
        """The merged table as one run of a new table, to be added to from then on."""
        table = VersionedTable(self.spark, target, self.layout, self.merge, self.partition)
        name = f"{_RUN}{uuid.uuid4().hex}"
        table._write(self.read(), name)
        table._switch(Version(1, [(0, name)], {}))

    def remove_unused(self, keep_ms: int = KEEP_MS) -> None:
        """Remove what neither the newest pointer nor one younger than ``keep_ms`` needs."""
        newest = self.version()
        kept, oldest = {name for _, name in newest.runs}, newest
        while oldest.number > 1 and self.files.age_ms(self._pointer(oldest.number)) < keep_ms:
            oldest = self.version(oldest.number)
            if not oldest.number:
                break
            kept |= {name for _, name in oldest.runs}
        for name in self.files.names(f"{self.path}/rows"):
            if name.startswith(_RUN) and name not in kept and self.files.age_ms(self._folder(name)) >= keep_ms:
                self.files.remove(self._folder(name))
        for batch in self.batches():
            if oldest.holds(*batch):
                self.files.remove(self._folder(self._batch(*batch)))
        for name in self.files.names(f"{self.path}/pointer"):
            if name[:-5].isdigit() and int(name[:-5]) < oldest.number:
                self.files.remove(f"{self.path}/pointer/{name}")
