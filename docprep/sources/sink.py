"""One file for each document, written by tasks and committed by the driver."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

_STAGING = "_staging"
_MOVES_AT_ONCE = 16


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address (``hdfs://``, ``s3://``, ``gs://``, ``file://`` or a plain path) and the path in it; workers and driver reach the same one."""
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


@dataclass
class Staged(WriterCommitMessage):
    """The files of one task: its staging folder and their names."""

    folder: str
    names: list[str]


class DocumentWriter(DataSourceWriter):
    """Each attempt of a task writes into a staging folder of its own; the driver moves the files of the attempts that counted, and drops the rest.

    Nothing is in the target before all tasks have ended, so failed, repeated and
    speculative attempts leave nothing there. A move replaces a file of that name as a whole.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.uri, self.run = options["path"].rstrip("/"), uuid.uuid4().hex

    def _root(self) -> tuple[fs.FileSystem, str]:
        system, path = file_system(self.uri)
        return system, f"{path}/{_STAGING}/{self.run}"

    def write(self, iterator: Iterator[Row]) -> Staged:
        system, root = self._root()
        task = TaskContext.get()
        folder = f"{root}/{task.partitionId()}-{task.taskAttemptId()}"
        names: list[str] = []
        for name, text in iterator:
            if not name or "/" in name or name.startswith((".", "_")):
                raise ValueError(f"a document can't be written as {name!r}")
            if not names:
                system.create_dir(folder, recursive=True)
            with system.open_output_stream(f"{folder}/{name}") as out:
                out.write((text or "").encode())
            names.append(name)
        return Staged(folder, names)

    def commit(self, messages: list[Staged | None]) -> None:
        system, root = self._root()
        target = root.rsplit(f"/{_STAGING}/", 1)[0]
        moves = [(m.folder, n) for m in messages if m for n in m.names]
        twice = {n for _, n in moves} if len({n for _, n in moves}) < len(moves) else None
        if twice is not None:
            self.abort(messages)
            seen: set[str] = set()
            raise ValueError("two documents have the name " + next(n for _, n in moves if n in seen or seen.add(n)))
        system.create_dir(target, recursive=True)

        def move(item: tuple[str, str]) -> None:
            folder, name = item
            if system.get_file_info(f"{target}/{name}").type != fs.FileType.NotFound:
                system.delete_file(f"{target}/{name}")
            system.move(f"{folder}/{name}", f"{target}/{name}")

        with ThreadPoolExecutor(_MOVES_AT_ONCE) as pool:
            list(pool.map(move, moves))
        self._clear(system, root)
        with system.open_output_stream(f"{target}/_SUCCESS"):
            pass

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear(*self._root())

    @staticmethod
    def _clear(system: fs.FileSystem, root: str) -> None:
        """Drops the staging folder of this run, and the folder of all runs if it is empty."""
        if system.get_file_info(root).type != fs.FileType.NotFound:
            system.delete_dir(root)
        above = root.rsplit("/", 1)[0]
        if system.get_file_info(above).type != fs.FileType.NotFound and not system.get_file_info(fs.FileSelector(above)):
            system.delete_dir(above)


class Documents(DataSource):
    """``df.write.format("documents")``: rows (name, text) as files of a folder."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options)


def export_documents(docs: DataFrame, folder: str, name: str = "file_final", text: str = "text") -> None:
    """SNK1: one file for each document, in a folder on any file system that the workers reach; names are unique, else nothing is written."""
    docs.sparkSession.dataSource.register(Documents)
    docs.selectExpr(f"`{name}` AS name", f"`{text}` AS text").write.format("documents").mode("append").save(folder)
