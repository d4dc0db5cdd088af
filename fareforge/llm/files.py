"""Binary files in the shared store, written and range-read by tasks."""
import uuid

import pyarrow.fs as pafs
from pyspark import TaskContext


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it: local, HDFS, S3 and what else pyarrow knows."""
    return pafs.FileSystem.from_uri(uri)


def attempt_name(kind: str) -> str:
    """A file name that no other task and no other try of this task uses; only names in a committed manifest count."""
    return f"{kind}-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"


class RangeReader:
    """Range reads from files of one folder; the few last used stay open."""

    def __init__(self, uri: str, most: int = 8):
        self.fs, self.root = open_store(uri)
        self.most, self.opened = most, {}

    def read(self, name: str, offset: int, length: int) -> bytes:
        handle = self.opened.pop(name, None)
        if handle is None:
            if len(self.opened) >= self.most:
                self.opened.pop(next(iter(self.opened))).close()
            handle = self.fs.open_input_file(f"{self.root}/{name}")
        self.opened[name] = handle
        handle.seek(offset)
        return handle.read(length)

    def whole(self, name: str) -> bytes:
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            return f.read()
