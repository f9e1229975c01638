"""The queue of input files as a stream source (S5): one row per file, whatever the file holds.

A stream of records learns of a file by its rows, so a file without any is never heard of. Here the stream's rows
are the files themselves: the source lists a folder, and every micro-batch takes the oldest files that were not
taken before. Offsets count the entries of a listing log, one entry of up to ``maxunits`` files each, written
before its offset is handed out: a restart reads the same entries again, so a replayed batch has the same files.

Memory: the driver holds the names of the files it has listed (as Spark's own file source does), never their rows.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SOURCE = "record_units"
SCHEMA = "path string, arrival timestamp, size long"


def _store(path: str):
    """The file system of a path and the path in it."""
    from pyarrow import fs
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


class UnitQueueReader(DataSourceStreamReader):
    """Options: ``path`` (a folder), ``log`` (a folder of the stream's own, beside its checkpoint), ``maxunits``
    (files a batch, 0: all that are there)."""

    def __init__(self, options):
        self.path, self.log, self.limit = options["path"].rstrip("/"), options["log"].rstrip("/"), int(options.get("maxunits", "1000"))
        self.seen = None
        self.entries = 0

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        self._recall()
        new = [f for f in self._listing() if f[0] not in self.seen]
        if new:
            new = sorted(new, key=lambda f: (f[1], f[0]))[: self.limit or None]
            self._append(new)
        return {"entry": self.entries}

    def partitions(self, start: dict, end: dict) -> list:
        return [InputPartition(self._entry(n)) for n in range(start["entry"] + 1, end["entry"] + 1)]

    def read(self, partition: InputPartition):
        from datetime import datetime, timezone
        for path, arrival, size in partition.value:
            yield path, datetime.fromtimestamp(arrival, timezone.utc), size

    def _listing(self) -> list:
        """(path, modified, size) of the folder's files; names that start with a dot or underscore are not input."""
        from pyarrow import fs
        store, folder = _store(self.path)
        files = [f for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
                 if f.type == fs.FileType.File and f.base_name[0] not in "._"]
        return [(f"{self.path}/{f.base_name}", f.mtime.timestamp() if f.mtime else 0.0, f.size or 0) for f in files]

    def _name(self, n: int) -> str:
        return f"{_store(self.log)[1]}/{n:012d}.json"

    def _recall(self) -> None:
        """The names in the log, once after a start."""
        if self.seen is not None:
            return
        from pyarrow import fs
        store, folder = _store(self.log)
        names = [f.base_name for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))]
        self.entries = max((int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n)), default=0)
        self.seen = {f[0] for n in range(1, self.entries + 1) for f in self._entry(n)}

    def _entry(self, n: int) -> list:
        store, _ = _store(self.log)
        with store.open_input_stream(self._name(n)) as f:
            return json.loads(f.read())

    def _append(self, files: list) -> None:
        """The next entry of the log, which appears by a rename."""
        store, folder = _store(self.log)
        store.create_dir(folder, recursive=True)
        written = f"{folder}/.{self.entries + 1:012d}"
        with store.open_output_stream(written) as f:
            f.write(json.dumps(files).encode())
        store.move(written, self._name(self.entries + 1))
        self.entries += 1
        self.seen.update(f[0] for f in files)


class UnitQueue(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> UnitQueueReader:
        return UnitQueueReader(self.options)


def unit_stream(spark: SparkSession, path: str, log: str, max_units: int = 1000):
    """The files of a folder as a stream of (path, arrival, size), ``max_units`` a micro-batch, oldest first;
    empty files are files too. ``log`` belongs to one stream, as its checkpoint does."""
    spark.dataSource.register(UnitQueue)
    return spark.readStream.format(SOURCE).option("path", path).option("log", log).option("maxunits", str(int(max_units))).load()
