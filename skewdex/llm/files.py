"""Binary files that tasks write to, and read from, a folder that all executors share."""

from __future__ import annotations

import sys
import uuid

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's shared folder, as a URI; for the driver."""
    # Named here, as what this module names goes to the executors with it, and they need not have the package.
    from skewdex.sources.staging import shared_root

    root = shared_root(spark)
    return f"{root if '://' in root else 'file://' + root}/{name}-{uuid.uuid4().hex}"


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path in it; local, HDFS and object stores."""
    return fs.FileSystem.from_uri(uri)


def remove(uri: str) -> None:
    """Delete a folder with what it holds."""
    system, path = at(uri)
    system.delete_dir(path)


class Output:
    """A file that appears under its name when it is complete.

    A task that is run again writes a file of its own and puts the same content in place.
    """

    def __init__(self, folder: str, name: str):
        self.system, path = at(folder)
        self.system.create_dir(path, recursive=True)
        self.final, self.draft = f"{path}/{name}", f"{path}/.{name}.{uuid.uuid4().hex}"
        self.stream, self.size = self.system.open_output_stream(self.draft), 0

    def write(self, data: bytes) -> int:
        """Append; returns where the data begins."""
        start = self.size
        self.stream.write(data)
        self.size += len(data)
        return start

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.draft, self.final)


def sizes(folder: str, suffix: str) -> list[tuple[str, int]]:
    """Name and bytes of each file in ``folder``: one entry per file, so as many as tasks wrote."""
    system, path = at(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(
        (f.base_name, f.size) for f in found if f.is_file and f.base_name.endswith(suffix) and f.base_name[0] != "."
    )
