"""Files in the shared folder, written from tasks.

A file is written under a name of its own and moved to its final one when complete, so a task
that is repeated or speculated replaces it by equal content.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from panelcast.llm.common import shared_dir


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, with its scheme as Hadoop resolves it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_dir(spark, name))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, *parts: bytes) -> str:
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, f"{path}/{name}")
    return f"{folder}/{name}"


def read_file(uri: str):
    """The file, open for reading at any place."""
    store, path = _open(uri)
    return store.open_input_file(path)
