"""Reports of a folder as a stream that sees changed files again.

Spark's own file source knows files by path. The source here has the pair of modification
time and name as its offset, so a file changed under its old name comes once more. It lists
names only; texts are read through Spark, and the manifest of the ledger has the last word
on what is new. A file put there with a time before the last one read is not seen by the
stream; :meth:`LedgerStore.ingest` takes it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fnmatch import fnmatch

from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.sources.ledger import LedgerStore


class ReportFiles(DataSource):
    """Format ``report_files``: option ``path``, a folder in a store that Arrow knows, as an
    absolute path or URI, and ``glob``. A row per file that is new or changed."""

    @classmethod
    def name(cls) -> str:
        return "report_files"

    def schema(self) -> str:
        return "file_name string, mod_time bigint, path string"

    def streamReader(self, schema) -> ReportFileReader:
        return ReportFileReader(self.options["path"], self.options.get("glob", "*.csv"))


class ReportFileReader(DataSourceStreamReader):
    def __init__(self, directory: str, glob: str):
        self.directory, self.glob = directory.rstrip("/"), glob

    def _files(self) -> list[tuple[int, str]]:
        store, root = FileSystem.from_uri(self.directory)
        found = store.get_file_info(FileSelector(root, allow_not_found=True))
        return sorted(
            (info.mtime_ns, info.base_name)
            for info in found
            if info.is_file and fnmatch(info.base_name, self.glob) and not info.base_name.startswith("~$")
        )

    def initialOffset(self) -> dict:
        return {"time": -1, "name": ""}

    def latestOffset(self) -> dict:
        files = self._files()
        return {"time": files[-1][0], "name": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [InputPartition((start["time"], start["name"], end["time"], end["name"]))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        # A file changed since the batch was cut has a later time: it is the next one's.
        after, until = partition.value[:2], partition.value[2:]
        for time, name in self._files():
            if tuple(after) < (time, name) <= tuple(until):
                yield name, time // 10**9, f"{self.directory}/{name}"


def ingest_changes(
    store: LedgerStore,
    directory: str,
    checkpoint: str,
    sep: str = ";",
    glob: str = "*.csv",
    keep: str = "last",
    **trigger,
) -> StreamingQuery:
    """Start an ingest of new and changed reports. A repeated batch changes nothing: its
    files are in the manifest by then."""
    store.spark.dataSource.register(ReportFiles)

    def merge(files: DataFrame, batch_id: int) -> None:
        store.ingest_listed(files, sep, glob, keep)

    return (
        store.spark.readStream.format(ReportFiles.name())
        .option("glob", glob)
        .load(directory)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
