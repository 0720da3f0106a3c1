"""One record, one file: a Spark data source for folders of small text files
(mails, lists), written and read by tasks.

``df.write.format("record_files").option("path", p).mode("append").save()`` takes rows
(name, value) and writes each as a file of its own name; ``spark.read``
with the same format gives (name, value) back, whole files.  A task attempt
writes into a folder of its own; the commit names the folders of the attempts
that count in ``_committed.json``, so a lost or repeated task leaves nothing
that is read, and the driver lists folders, never files.  Rows of equal names
become files of equal names in numbered folders.
"""

from __future__ import annotations

import json
import sys
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FORMAT = "record_files"
COMMITTED = "_committed.json"


def _open(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    records: int


class RecordFilesWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator):
        store, root = _open(self.path)
        folder = f"part-{uuid.uuid4().hex}"
        seen: dict = {}
        made: list = []
        records = 0
        for row in iterator:
            name = quote(row["name"], safe="@ ")
            seen[name] = at = seen.get(name, -1) + 1
            while len(made) <= at:
                made.append(f"{root}/{folder}/{len(made)}")
                store.create_dir(made[-1], recursive=True)
            with store.open_output_stream(f"{made[at]}/{name}") as f:
                f.write((row["value"] or "").encode())
            records += 1
        return Written(folder, records)

    def commit(self, messages):
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        folders = [m.folder for m in messages if m is not None and m.records]
        with store.open_output_stream(f"{root}/{COMMITTED}") as f:
            f.write(json.dumps(folders).encode())


class Folder(InputPartition):
    def __init__(self, name: str):
        self.name = name


class RecordFilesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        store, root = _open(self.path)
        with store.open_input_stream(f"{root}/{COMMITTED}") as f:
            folders = json.loads(f.read())
        return [Folder(x) for x in folders] or [Folder("")]

    def read(self, partition):
        from pyarrow import fs

        if not partition.name:
            return
        store, root = _open(self.path)
        for info in store.get_file_info(fs.FileSelector(f"{root}/{partition.name}", recursive=True)):
            if info.type == fs.FileType.File:
                with store.open_input_stream(info.path) as f:
                    yield unquote(info.base_name), f.read().decode()


class RecordFiles(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "name string, value string"

    def reader(self, schema):
        return RecordFilesReader(self.options["path"])

    def writer(self, schema, overwrite):
        return RecordFilesWriter(self.options["path"])


# executors take the classes from the plan, not from an installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_records(df: DataFrame, path: str) -> None:
    """Rows (name, value) as files below ``path``, a new folder; a null value is
    an empty file, names must not be null."""
    df.sparkSession.dataSource.register(RecordFiles)
    df.select("name", "value").write.format(FORMAT).option("path", path).mode("append").save()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of every committed file, whole."""
    spark.dataSource.register(RecordFiles)
    return spark.read.format(FORMAT).option("path", path).load()
