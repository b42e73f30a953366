"""A stream over replay files by their offsets, as Spark's Python data source.

The files of a topic are `<path>/<topic>/<name>.json`; in order of name they are the log, and a file is a
run of it. An offset is the name of the last file taken, so "latest" means after the files that are
there when the query first starts, whatever times their rows carry. Files are never changed, and new
ones come after the old ones in order of name (as the segments of a log do); one that does not
is an error, not a loss. The offsets of a query are in its checkpoint.

Only names pass through the driver. Rows are read by the tasks, one file each.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "parcelake_replay"
NOTHING = ""


class Piece(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _files(path: str):
    """The file system of a path and the path in it. Runs in Python processes without a session."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def names(path: str) -> list[str]:
    """The files of a log in their order, without those still being written."""
    from pyarrow import fs

    files, root = _files(path)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File
                  and not f.base_name.startswith((".", "_")) and f.size)


class ReplayReader(DataSourceStreamReader):
    def __init__(self, path: str, since: str, per_batch: int | None):
        self.path, self.since, self.per_batch = path, since, per_batch
        self.taken: str | None = None       # the offset that the next batch starts from

    def initialOffset(self) -> dict:
        there = names(self.path)
        start = there[-1] if self.since == "latest" and there else NOTHING
        self.taken = start
        return {"after": start}

    def latestOffset(self) -> dict:
        there = names(self.path)
        if self.taken is not None and self.per_batch is not None:
            there = [n for n in there if n > self.taken][:self.per_batch]
        end = there[-1] if there else self.taken or NOTHING
        if self.taken is not None:
            self.taken = max(end, self.taken)
        return {"after": max(end, self.taken or NOTHING)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        there = names(self.path)
        self.taken = max(end["after"], self.taken or NOTHING)
        if end["after"] != NOTHING and end["after"] not in there:
            raise ValueError(f"the log {self.path} has lost {end['after']}")
        return [Piece(f"{self.path}/{n}") for n in there if start["after"] < n <= end["after"]]

    def read(self, partition: Piece) -> Iterator:
        import json
        from datetime import datetime

        files, path = _files(partition.path)
        with files.open_input_stream(path) as lines:
            for line in lines.read().decode().splitlines():
                if not line.strip():
                    continue
                row = json.loads(line)
                time = row.get("timestamp")
                yield (row.get("key"), row.get("value"), row.get("topic"), row.get("partition"),
                       row.get("offset"), None if time is None else datetime.fromisoformat(time))


class ReplaySource(DataSource):
    """Options: path, since ("earliest" or "latest"), filesPerTrigger."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"

    def streamReader(self, schema) -> ReplayReader:
        per_batch = self.options.get("filesPerTrigger")
        return ReplayReader(self.options["path"], self.options.get("since", "earliest"),
                            None if per_batch is None else int(per_batch))


def stream(spark: SparkSession, path: str, since: str, files_per_trigger: int | None = None):
    if since not in ("earliest", "latest"):
        raise ValueError(f"since is earliest or latest, not {since}")
    spark.dataSource.register(ReplaySource)
    reader = spark.readStream.format(NAME).option("path", path).option("since", since)
    if files_per_trigger is not None:
        reader = reader.option("filesPerTrigger", str(files_per_trigger))
    return reader.load()
