"""A stream source of its own: a folder of growing CSV files, each a partition with its offset.

The offset of a file is the byte after its last whole line. New files and new lines are read from
where the checkpoint says; long stretches are divided among tasks at line ends.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "csv_folder"
PART_BYTES = 32 << 20
_TAIL = 1 << 16

# Ship the functions of this module with the query: workers then need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The columns of an event file.
COLUMNS = {"timestamp": pa.int64(), "visitorid": pa.int64(), "event": pa.string(), "itemid": pa.int64(), "transactionid": pa.string()}
_DDL = "timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid string"


class Stretch(InputPartition):
    """Bytes of a file; both bounds are ends of lines or of parts."""

    def __init__(self, file: str, start: int, end: int, last: int):
        self.file, self.start, self.end, self.last = file, start, end, last


class FolderReader(DataSourceStreamReader):
    def __init__(self, path: str, part_bytes: int):
        self._path, self._part_bytes = path, part_bytes

    def _folder(self) -> tuple[pyarrow.fs.FileSystem, str]:
        return pyarrow.fs.FileSystem.from_uri(self._path)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """The byte after the last whole line of each file."""
        system, folder = self._folder()
        found = {}
        for info in system.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True)):
            name = info.base_name
            if info.type == pyarrow.fs.FileType.File and name.endswith(".csv") and name[0] not in "._":
                found[name] = _last_line_end(system, info.path, info.size)
        return found

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        parts = []
        for file, last in sorted(end.items()):
            first = start.get(file, 0)
            for at in range(first, last, self._part_bytes):
                parts.append(Stretch(file, at, min(at + self._part_bytes, last), last))
        return parts or [Stretch("", 0, 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        system, folder = self._folder()
        with system.open_input_file(f"{folder}/{partition.file}") as file:
            header = file.read_at(min(_TAIL, partition.last), 0).split(b"\n", 1)[0]
            data = _whole_lines(file, partition)
        names = [n.strip('"') for n in header.decode("utf-8-sig").strip().split(",")]
        if partition.start == 0:
            data = data.split(b"\n", 1)[1] if b"\n" in data else b""
        if not data.strip():
            return
        table = pyarrow.csv.read_csv(
            io.BytesIO(data), read_options=pyarrow.csv.ReadOptions(column_names=names),
            convert_options=pyarrow.csv.ConvertOptions(column_types=COLUMNS, include_columns=list(COLUMNS), include_missing_columns=True, strings_can_be_null=True),
        )
        yield from table.to_batches()

    def commit(self, end: dict) -> None:
        pass  # files stay; the checkpoint holds the offsets


def _last_line_end(system: pyarrow.fs.FileSystem, path: str, size: int) -> int:
    with system.open_input_file(path) as file:
        to = size
        while to > 0:
            begin = max(0, to - _TAIL)
            at = file.read_at(to - begin, begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            to = begin
    return 0


def _whole_lines(file, part: Stretch) -> bytes:
    """The lines that begin inside a part: without the one begun before it, with the end of its last.

    A part begins with a line if it is the first of its stretch; a byte before it tells.
    """
    start = part.start
    if start and file.read_at(1, start - 1) != b"\n":
        at = start
        while at < part.last and (found := (piece := file.read_at(min(_TAIL, part.last - at), at)).find(b"\n")) < 0:
            at += len(piece)
        start = at + found + 1 if at < part.last else part.last
    if start >= part.end:
        return b""
    data, at = [file.read_at(part.end - start, start)], part.end
    while not data[-1].endswith(b"\n") and at < part.last:
        piece = file.read_at(min(_TAIL, part.last - at), at)
        found = piece.find(b"\n")
        data.append(piece[:found + 1] if found >= 0 else piece)
        at += len(piece)
    return b"".join(data)


class CsvFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return _DDL

    def streamReader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"], int(self.options.get("partBytes", PART_BYTES)))


def stream_events_csv(spark: SparkSession, path: str, part_bytes: int = PART_BYTES):
    """Event rows of the CSV files of a folder, as they grow; columns as in the files."""
    spark.dataSource.register(CsvFolder)
    return spark.readStream.format(NAME).option("path", path).option("partBytes", part_bytes).load()
