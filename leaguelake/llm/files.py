"""Files that tasks write to and read from the shared folder.

A task writes under a name of its own and reports it; only reports that Spark has committed count, so what a lost
or repeated task leaves behind is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def own_name(folder: str, label: str, suffix: str) -> str:
    return f"{folder}/{label}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    system, path = place(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def load(uri: str):
    system, path = place(uri)
    return system.open_input_file(path)


def committed(reports: DataFrame, name: str) -> DataFrame:
    """Run the tasks that write, and return the reports of those that count."""
    from leaguelake.session import stored  # not at the top: this module travels to workers, which need no copy of the package

    return stored(reports, name)
